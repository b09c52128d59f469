"""DB-1..DB-10: the dashboard's figures over the gold tables.

Sums of money go through decimals (whole cents), so totals do not depend on
the order rows meet in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import round_half_up

_C = "decimal(38,2)"


def _dsum(c: str):
    return F.sum(F.col(c).cast(_C))


def cards(desk_pnl: DataFrame, mtm: DataFrame) -> DataFrame:
    """DB-1: total trades, volume, net P&L, unrealized P&L in one row.

    Both gold tables are stacked (no cross join) and folded by one global
    aggregate."""
    a = desk_pnl.select(F.col("trade_count").cast("bigint").alias("tc"),
                        F.col("gross_volume_usd").alias("gv"), F.col("net_pnl_usd").alias("np"),
                        F.lit(None).cast("double").alias("up"))
    b = mtm.select(F.lit(None).cast("bigint").alias("tc"), F.lit(None).cast("double").alias("gv"),
                   F.lit(None).cast("double").alias("np"), F.col("unrealized_pnl_usd").alias("up"))
    return a.unionByName(b).agg(
        F.sum("tc").alias("total_trades"),
        _dsum("gv").cast("double").alias("total_volume_usd"),
        _dsum("np").cast("double").alias("net_pnl_usd"),
        _dsum("up").cast("double").alias("unrealized_pnl_usd"))


def pnl_by_desk(desk_pnl: DataFrame) -> DataFrame:
    """DB-2 (a desk may appear under several full names after a transfer)."""
    return desk_pnl.groupBy("desk").agg(_dsum("net_pnl_usd").cast("double").alias("net_pnl_usd"),
                                        F.sum("trade_count").alias("trade_count"))


def volume_by_sector(sector_exposure: DataFrame) -> DataFrame:
    """DB-3."""
    return sector_exposure.groupBy("sector").agg(
        _dsum("gross_exposure_usd").cast("double").alias("gross_volume_usd"),
        F.sum("trade_count").alias("trade_count"))


def volume_over_time(hourly: DataFrame) -> DataFrame:
    """DB-4."""
    return hourly.groupBy("trade_hour").agg(
        F.sum("trade_count").alias("trade_count"),
        _dsum("total_notional_usd").cast("double").alias("total_notional_usd"),
        F.sum("total_quantity").alias("total_quantity"))


def anomaly_counts(anomalies: DataFrame) -> DataFrame:
    """DB-5: anomaly count and count per flag (one global aggregate)."""
    return anomalies.agg(
        F.count(F.lit(1)).alias("anomaly_count"),
        F.count_if(F.col("is_qty_anomaly")).alias("qty_anomalies"),
        F.count_if(F.col("is_price_anomaly")).alias("price_anomalies"),
        F.count_if(F.col("is_risk_breach")).alias("risk_breaches"))


def exposure_by_sector(sector_exposure: DataFrame) -> DataFrame:
    """DB-6: net exposure and long/short ratio per sector (ratio of sums)."""
    g = sector_exposure.groupBy("sector").agg(
        _dsum("long_notional_usd").alias("__l"), _dsum("short_notional_usd").alias("__s"))
    return g.select(
        "sector", (F.col("__l") - F.col("__s")).cast("double").alias("net_exposure_usd"),
        F.col("__l").cast("double").alias("long_notional_usd"),
        F.col("__s").cast("double").alias("short_notional_usd"),
        round_half_up(F.when(F.col("__s") > 0, F.col("__l").cast("double") / F.col("__s").cast("double")), 4)
        .alias("long_short_ratio"))


def anomaly_detail(anomalies: DataFrame) -> DataFrame:
    """DB-7: the detail table's columns."""
    return anomalies.select("trade_id", "ticker", "desk", "trader_name", "quantity", "price",
                            "notional_usd", "is_qty_anomaly", "is_price_anomaly", "is_risk_breach",
                            "price_deviation_pct", "event_time")


def risk_breaches(anomalies: DataFrame) -> DataFrame:
    """DB-8."""
    return (anomalies.filter(F.col("is_risk_breach"))
            .select("trade_id", "trader_id", "trader_name", "desk", "notional_usd", "risk_limit_usd",
                    (F.col("notional_usd") - F.col("risk_limit_usd").cast("double")).alias("excess_usd"),
                    "event_time"))


def unrealized_by(mtm: DataFrame) -> DataFrame:
    """DB-9: unrealized P&L by desk and by sector, one grouping-sets pass."""
    g = mtm.groupingSets([["desk"], ["sector"]], "desk", "sector").agg(
        F.grouping_id().alias("__gid"), _dsum("unrealized_pnl_usd").alias("__u"))
    return g.select(
        F.when(F.col("__gid") == 1, "desk").otherwise("sector").alias("dimension"),
        F.when(F.col("__gid") == 1, F.col("desk")).otherwise(F.col("sector")).alias("name"),
        F.col("__u").cast("double").alias("unrealized_pnl_usd"))


def positions_detail(mtm: DataFrame) -> DataFrame:
    """DB-10: positions with average vs last price."""
    return mtm.select(
        "ticker", "desk", "sector", "position_side", "net_quantity", "avg_price", "last_price",
        round_half_up(F.when(F.col("avg_price") != 0,
                             (F.col("last_price") - F.col("avg_price")) / F.col("avg_price") * 100), 2)
        .alias("price_change_pct"),
        "market_value_usd", "unrealized_pnl_usd", "pnl_pct")


def from_catalog(spark) -> dict[str, DataFrame]:
    """DB-1..DB-10 over the published gold tables (``plans.tables.publish``)."""
    t = spark.table
    desk, sector, anomalies = t("gold.desk_pnl"), t("gold.risk_exposure_by_sector"), t("gold.trade_anomalies")
    hourly, mtm = t("gold.hourly_trade_volume"), t("gold.mark_to_market_pnl")
    return {
        "cards": cards(desk, mtm),
        "pnl_by_desk": pnl_by_desk(desk),
        "volume_by_sector": volume_by_sector(sector),
        "volume_over_time": volume_over_time(hourly),
        "anomaly_counts": anomaly_counts(anomalies),
        "exposure_by_sector": exposure_by_sector(sector),
        "anomaly_detail": anomaly_detail(anomalies),
        "risk_breaches": risk_breaches(anomalies),
        "unrealized_by": unrealized_by(mtm),
        "positions_detail": positions_detail(mtm),
    }

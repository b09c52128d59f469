"""Gold tables: desk cash flow, exposures, anomalies, hourly volume, MTM P&L."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import round_half_up
from ..plans.joins import lookup_join, prefixed
from ..schemas import ANOMALY_COLUMNS, MTM_COLUMNS
from .aggregates import COUNTERPARTY_EXPOSURE, DESK_PNL, HOURLY_VOLUME, SECTOR_EXPOSURE, TICKER_STATS
from .silver import enrich_trades


def _stamp(df: DataFrame, name: str, on: bool) -> DataFrame:
    return df.withColumn(name, F.current_timestamp()) if on else df


def desk_pnl(trades: DataFrame, *, calculated_at: bool = False) -> DataFrame:
    """AG-2: cash flow, volume and activity per desk."""
    return _stamp(DESK_PNL.batch(trades), "calculated_at", calculated_at)


def risk_exposure_by_sector(trades: DataFrame, *, calculated_at: bool = False) -> DataFrame:
    """AG-3: long, short, net and gross notional per sector and asset class."""
    return _stamp(SECTOR_EXPOSURE.batch(trades), "calculated_at", calculated_at)


def counterparty_exposure(trades: DataFrame, *, calculated_at: bool = False) -> DataFrame:
    """AG-4: concentration by counterparty."""
    return _stamp(COUNTERPARTY_EXPOSURE.batch(trades), "calculated_at", calculated_at)


def ticker_stats(trades: DataFrame) -> DataFrame:
    """WN-2 as a grouped aggregate: mean and sample stddev of quantity, mean price."""
    return TICKER_STATS.batch(trades)


def flag_anomalies(trades: DataFrame, stats: DataFrame) -> DataFrame:
    """AN-1 quantity spike (PRJ-18 ``coalesce(stddev, 0)``), AN-2 price
    deviation (compared after rounding), AN-3 risk breach, on every trade.
    Stats (one row per ticker) are looked up by a join instead of a
    whole-ticker window."""
    t = lookup_join(trades, stats.withColumnRenamed("ticker", "__key"), "ticker", "__key", spread_by="trade_id")
    dev = F.abs(F.col("price") - F.col("avg_price")) / F.col("avg_price") * 100
    return (t.withColumn("is_qty_anomaly",
                         F.col("quantity") > F.col("avg_qty") + 3 * F.coalesce(F.col("stddev_qty"), F.lit(0.0)))
             .withColumn("price_deviation_pct", round_half_up(F.when(F.col("avg_price") != 0, dev), 2))
             .withColumn("is_price_anomaly", F.col("price_deviation_pct") > 2.0)
             .withColumn("is_risk_breach", risk_breach())
             .withColumn("is_anomaly", F.col("is_qty_anomaly") | F.col("is_price_anomaly") | F.col("is_risk_breach")))


def risk_breach() -> Column:
    """AN-3 by itself needs no statistics."""
    return F.col("notional_usd") > F.col("risk_limit_usd")


def trade_anomalies(trades: DataFrame, *, detected_at: bool = False, stats_of: DataFrame | None = None) -> DataFrame:
    """AN-4 + FLT-2: keep rows whose OR of flags is TRUE (NULL OR FALSE drops).
    ``detected_at`` is the processing-time stamp (PRJ-17). ``stats_of`` may be
    the same trades before the lookups: the statistics need none of their
    columns, so the lookups are planned once."""
    flagged = flag_anomalies(trades, ticker_stats(trades if stats_of is None else stats_of))
    out = flagged.filter("is_anomaly").select(*ANOMALY_COLUMNS)
    return _stamp(out, "detected_at", detected_at)


def anomalies_of_clean(trades: DataFrame, instruments: DataFrame, traders: DataFrame, counterparties: DataFrame) -> DataFrame:
    """``trade_anomalies`` of trades before their lookups: flags need only the trader's limit, so
    the other two lookups run over the flagged rows alone."""
    limited = enrich_trades(trades, None, traders, None)
    flagged = flag_anomalies(limited, ticker_stats(trades)).filter("is_anomaly")
    return enrich_trades(flagged, instruments, None, counterparties, derive=False).select(*ANOMALY_COLUMNS)


def hourly_trade_volume(trades: DataFrame, *, calculated_at: bool = False) -> DataFrame:
    """AG-5: hour bucket × desk × sector."""
    return _stamp(HOURLY_VOLUME.batch(trades), "calculated_at", calculated_at)


def mark_to_market_pnl(positions: DataFrame, prices: DataFrame, *, calculated_at: bool = False) -> DataFrame:
    """JN-4 + PRJ-13 market value, PRJ-14 unrealized P&L, PRJ-15 P&L %:
    positions ⟕ latest prices (PRJ-16: the price side is renamed and pruned)."""
    slim = prefixed(prices, "ticker", "__key", "last_price", "bid", "ask", "mid_price", "spread_bps",
                    price_as_of="event_time")
    j = lookup_join(positions, slim, "ticker", "__key")
    exact = F.round(F.try_multiply(F.col("net_quantity").cast("decimal(20,0)"),
                                   F.col("last_price").try_cast("decimal(17,6)")), 2).cast("decimal(36,2)")
    mv = F.coalesce(exact.cast("double"), F.col("net_quantity") * F.col("last_price"))
    pnl = F.coalesce(F.try_subtract(exact, F.col("net_notional_usd").try_cast("decimal(36,2)")).cast("double"),
                     mv - F.col("net_notional_usd"))
    absn = F.abs(F.col("net_notional_usd"))
    out = (j.withColumn("market_value_usd", mv)
            .withColumn("unrealized_pnl_usd", pnl)
            .withColumn("pnl_pct", round_half_up(
                F.when(absn > 0, F.col("unrealized_pnl_usd") / absn * 100).otherwise(F.lit(0.0)), 2))
            .select(*MTM_COLUMNS))
    return _stamp(out, "calculated_at", calculated_at)

"""The checked queries: each maps (spark, sf_dir) to a DataFrame over the
driver tables. Processing-time stamps are left out (not deterministic)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import dashboard, gold, scd2, silver
from ..operators.quality import TICK_RULES, TRADE_RULES, rule_report, warn_rules
from ..session import Steps, scratch_path, shuffles_dropped
from ..sources import driver_tables as dt
from ..sources.counts import table_counts
from . import stream_checks
from .incremental import TRADE_INPUT, read_anomalies
from .tables import TableStore

TRADE_OUT = [
    "trade_id", "ticker", "side", "quantity", "price", "order_type", "trader_id", "desk",
    "counterparty_id", "exchange", "currency", "asset_class", "timestamp", "_dq_flag",
    "event_time", "company_name", "sector", "trader_name", "desk_full_name", "risk_limit_usd",
    "location", "counterparty_name", "risk_rating", "counterparty_type", "cp_country",
    "notional_usd", "trade_date", "trade_hour",
]
TICK_OUT = [
    "tick_id", "ticker", "bid", "ask", "last_price", "spread", "tick_volume",
    "cumulative_volume", "high_52w", "low_52w", "exchange", "asset_class", "timestamp", "event_time",
    "mid_price", "spread_bps",
]
RAW_TRADE_OUT = TRADE_OUT[:TRADE_OUT.index("event_time") + 1]


class Tables:
    """Lazily built plans of one pipeline run over the driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def raw_trades(self) -> DataFrame:
        return dt.raw_trades(self.spark, self.sf_dir)

    @cached_property
    def raw_ticks(self) -> DataFrame:
        return dt.raw_ticks(self.spark, self.sf_dir)

    @cached_property
    def deduped(self) -> DataFrame:
        return silver.dedup_trades(self.raw_trades)

    @cached_property
    def clean(self) -> DataFrame:
        return silver.clean_trades(self.raw_trades)

    @cached_property
    def instruments(self) -> DataFrame:
        return dt.instruments(self.spark, self.sf_dir)

    # Stored, as the pipeline stores its histories: Spark then plans lookups from their true size.
    @cached_property
    def traders(self) -> DataFrame:
        return self.kept(dt.traders(self.spark, self.sf_dir))

    @cached_property
    def counterparties(self) -> DataFrame:
        return self.kept(dt.counterparties(self.spark, self.sf_dir))

    @property
    def dims(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.instruments, self.traders, self.counterparties

    @cached_property
    def enriched(self) -> DataFrame:
        return silver.enrich_trades(self.clean, *self.dims)

    def in_steps(self, columns: list[str] | None = None) -> tuple[DataFrame, Callable[[], None]]:
        """``enriched`` (of it ``columns``) with one lookup on disk at a time, and what drops the rows stored for it."""
        steps = Steps(self.spark, columns)
        return silver.enrich_trades(self.clean, *self.dims, keep=steps), steps.drop

    @cached_property
    def priced(self) -> DataFrame:
        """Clean trades with their notional, before any lookup."""
        return silver.with_notional(self.clean)

    def kept(self, df: DataFrame) -> DataFrame:
        """``df`` written to the shared scratch folder and read back: what reads it twice runs it once."""
        path = scratch_path(self.spark, f"kept-{uuid.uuid4().hex}")
        with shuffles_dropped(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _sectors(self, rows: DataFrame) -> DataFrame:
        return silver.enrich_trades(rows, self.instruments, None, None, derive=False)

    def _desks(self, rows: DataFrame) -> DataFrame:
        return silver.enrich_trades(rows, None, self.traders, None, derive=False)

    def _counterparties(self, rows: DataFrame) -> DataFrame:
        return silver.enrich_trades(rows, None, None, self.counterparties, derive=False)

    @cached_property
    def derived_ticks(self) -> DataFrame:
        return silver.derive_ticks(self.raw_ticks)

    @cached_property
    def ticks(self) -> DataFrame:
        return silver.enrich_ticks(self.raw_ticks)

    @cached_property
    def latest(self) -> DataFrame:
        return silver.latest_prices(self.ticks)

    @cached_property
    def positions(self) -> DataFrame:
        return agg.POSITIONS.by_finer(self.priced, ["ticker", "desk", "asset_class"], self._sectors)

    @cached_property
    def desk_pnl(self) -> DataFrame:
        return agg.DESK_PNL.by_finer(self.priced, ["desk", "trader_id"], self._desks, self.kept)

    @cached_property
    def sector_exposure(self) -> DataFrame:
        return agg.SECTOR_EXPOSURE.by_finer(self.priced, ["ticker", "asset_class", "desk"], self._sectors, self.kept)

    @cached_property
    def anomalies(self) -> DataFrame:
        return gold.anomalies_of_clean(self.kept(self.clean), *self.dims)

    @cached_property
    def hourly(self) -> DataFrame:
        return gold.hourly_trade_volume(self._sectors(self.priced))

    @cached_property
    def mtm(self) -> DataFrame:
        return gold.mark_to_market_pnl(self.positions, self.latest)

    @cached_property
    def priority_history(self) -> DataFrame:
        return scd2.scd2_history(dt.customer_priority_changes(self.spark, self.sf_dir),
                                 keys=["customer_id"], sequence_by="updated_at",
                                 tie_break=["priority"])

    @cached_property
    def priority_history_tracked(self) -> DataFrame:
        return scd2.scd2_history(dt.customer_priority_changes(self.spark, self.sf_dir),
                                 keys=["customer_id"], sequence_by="updated_at",
                                 tie_break=["priority"], track=["priority"])


def _q(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(Tables(spark, sf_dir))


def _source_counts(t: Tables) -> DataFrame:
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
             "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
    return table_counts({n: dt.table(t.spark, t.sf_dir, n) for n in names})


def _parse_event_time(t: Tables) -> DataFrame:
    return t.deduped.select("trade_id", "timestamp", "event_time",
                            F.to_date("event_time").alias("trade_date"),
                            F.hour("event_time").alias("trade_hour"))


def _dq_warn(rules, df: DataFrame, dataset: str) -> DataFrame:
    return rule_report(df, warn_rules(rules), dataset).select("dataset", "rule", "failed_records")


# What the desk and position tables read of a trade.
FOLDED = ["trade_id", "ticker", "side", "quantity", "price", "trader_id", "desk", "asset_class", "event_time", "notional_usd"]


def _cards(t: Tables) -> DataFrame:
    t.priced = t.kept(t.priced.select(*FOLDED))   # two tables fold the same trades: they are put together once
    return dashboard.cards(t.desk_pnl, t.mtm)


def _folded(t: Tables) -> TableStore:
    trades, stored = t.in_steps(TRADE_INPUT)
    return stream_checks.incremental_tables(t.spark, trades, t.ticks, stored)


def _live(t: Tables) -> TableStore:
    trades, stored = t.in_steps()
    return stream_checks.live_tables(t.spark, trades, t.ticks, stored)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "source_counts": _q(_source_counts),
    "parse_event_time": _q(_parse_event_time),
    "dedup_trades": _q(lambda t: t.deduped.select(*RAW_TRADE_OUT)),
    "dq_drop_trades": _q(lambda t: t.clean.select(*RAW_TRADE_OUT)),
    "dq_drop_ticks": _q(lambda t: t.ticks.select(*TICK_OUT)),
    "dq_warn_trades": _q(lambda t: _dq_warn(TRADE_RULES, t.deduped, "enriched_trades")),
    "dq_warn_ticks": _q(lambda t: _dq_warn(TICK_RULES, t.derived_ticks, "enriched_market_data")),
    "dq_report": _q(lambda t: rule_report(t.deduped, TRADE_RULES, "enriched_trades")
                    .unionByName(rule_report(t.derived_ticks, TICK_RULES, "enriched_market_data"))),
    "enriched_trades": _q(lambda t: t.enriched.select(*TRADE_OUT)),
    "enriched_market_data": _q(lambda t: t.ticks.select(*TICK_OUT)),
    "latest_market_prices": _q(lambda t: t.latest),
    "positions": _q(lambda t: t.positions),
    "desk_pnl": _q(lambda t: t.desk_pnl),
    "risk_exposure_by_sector": _q(lambda t: t.sector_exposure),
    "counterparty_exposure": _q(lambda t: agg.COUNTERPARTY_EXPOSURE.by_finer(
        t.priced, ["counterparty_id"], t._counterparties, t.kept)),
    "ticker_stats": _q(lambda t: gold.ticker_stats(t.clean)),
    "anomaly_quantity": _q(lambda t: t.anomalies.filter("is_qty_anomaly")
                           .select("trade_id", "ticker", "quantity", "avg_qty")),
    "anomaly_price": _q(lambda t: t.anomalies.filter("is_price_anomaly")
                        .select("trade_id", "ticker", "price", "avg_price", "price_deviation_pct")),
    "anomaly_risk_limit": _q(lambda t: silver.enrich_trades(t.clean, None, t.traders, None).filter(gold.risk_breach())
                             .select("trade_id", "trader_id", "notional_usd", "risk_limit_usd")),
    "trade_anomalies": _q(lambda t: t.anomalies),
    "hourly_trade_volume": _q(lambda t: t.hourly),
    "mark_to_market_pnl": _q(lambda t: t.mtm),
    "scd2_history": _q(lambda t: t.priority_history),
    "scd2_history_tracked": _q(lambda t: t.priority_history_tracked),
    "scd2_current": _q(lambda t: silver.current_rows(t.priority_history_tracked)),
    "stream_enriched_trades": _q(lambda t: stream_checks.stream_enriched_trades(
        t.spark, t.sf_dir, TRADE_OUT, t.raw_trades)),
    "csv_reference": _q(lambda t: stream_checks.csv_reference(t.spark, t.sf_dir)),
    "lineage_columns": _q(lambda t: stream_checks.lineage_columns(t.spark, t.sf_dir, *t.in_steps())),
    "live_dq_report": _q(lambda t: stream_checks.live_dq_report(t.spark, t.sf_dir, t.deduped)),
    "enriched_trades_scd2": _q(lambda t: stream_checks.enriched_by_history(
        t.spark, t.sf_dir, t.clean).select(*TRADE_OUT)),
    "stream_market_data": _q(lambda t: stream_checks.stream_market_data(t.spark, t.sf_dir, TICK_OUT)),
    "stream_scd2_history": _q(lambda t: stream_checks.stream_scd2_history(t.spark, t.sf_dir)),
    "stream_scd2_history_bucketed": _q(lambda t: stream_checks.stream_scd2_history(
        t.spark, t.sf_dir, buckets=16)),
    "incremental_desk_pnl": _q(lambda t: _folded(t).read("desk_pnl")),
    "incremental_mark_to_market_pnl": _q(lambda t: _folded(t).read("mark_to_market_pnl")),
    "stream_dedup_within": _q(lambda t: stream_checks.stream_dedup_within(t.spark, t.raw_trades)),
    "live_mark_to_market_pnl": _q(lambda t: _live(t).read("mark_to_market_pnl")),
    "incremental_trade_anomalies": _q(lambda t: read_anomalies(_folded(t))),
    "dash_cards": _q(_cards),
    "dash_pnl_by_desk": _q(lambda t: dashboard.pnl_by_desk(t.desk_pnl)),
    "dash_volume_by_sector": _q(lambda t: dashboard.volume_by_sector(t.sector_exposure)),
    "dash_volume_over_time": _q(lambda t: dashboard.volume_over_time(t.hourly)),
    "dash_anomaly_counts": _q(lambda t: dashboard.anomaly_counts(t.anomalies)),
    "dash_exposure": _q(lambda t: dashboard.exposure_by_sector(t.sector_exposure)),
    "dash_anomaly_detail": _q(lambda t: dashboard.anomaly_detail(t.anomalies)),
    "dash_risk_breaches": _q(lambda t: dashboard.risk_breaches(t.anomalies)),
    "dash_unrealized": _q(lambda t: dashboard.unrealized_by(t.mtm)),
    "dash_positions": _q(lambda t: dashboard.positions_detail(t.mtm)),
}

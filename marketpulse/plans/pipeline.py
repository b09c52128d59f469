"""STR-3 triggered mode / SNK-2: recompute every table in dependency order.

reference tables → type-2 histories → ticks → trades → latest prices,
positions → gold. Each table is written as a new version in the
``TableStore`` and read back by the next step, so a later step never
recomputes the lineage of an earlier one (and a lost executor only costs the
step that was running).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold, scd2, silver
from ..operators.quality import assert_unique
from ..sources import driver_tables as dt
from ..sources.reference import with_backfill
from .tables import TableStore


@dataclass
class Inputs:
    raw_trades: DataFrame
    raw_ticks: DataFrame
    instruments: DataFrame
    trader_changes: DataFrame        # append-only log: trader rows + updated_at
    counterparty_changes: DataFrame  # append-only log: counterparty rows + updated_at
    backfill: DataFrame | None = None  # historical trades (SRC-5), deduplicated with the feed


def driver_inputs(spark: SparkSession, sf_dir: str, loaded_at: str = "2024-01-01 00:00:00") -> Inputs:
    """Inputs from the driver tables; each reference row is one change at ``loaded_at``."""
    ts = F.lit(loaded_at).cast("timestamp_ntz")
    return Inputs(
        raw_trades=dt.raw_trades(spark, sf_dir).drop(silver.TOGETHER),   # a backfill joins the feed, without it
        raw_ticks=dt.raw_ticks(spark, sf_dir),
        instruments=dt.instruments(spark, sf_dir),
        trader_changes=dt.traders(spark, sf_dir).withColumn("updated_at", ts),
        counterparty_changes=dt.counterparties(spark, sf_dir).withColumn("updated_at", ts))


def _putter(store: TableStore, out: dict[str, str]):
    def put(name: str, df: DataFrame, partition_by=None) -> DataFrame:
        out[name] = store.write(name, df, partition_by)
        return store.read(name)
    return put


def _together(*steps):
    """Run independent table writes as concurrent Spark jobs (one driver
    thread each); returns their results in order."""
    if len(steps) == 1:
        return [steps[0]()]
    with ThreadPoolExecutor(max_workers=min(len(steps), MAX_CONCURRENT_WRITES)) as pool:
        return [f.result() for f in [pool.submit(s) for s in steps]]


# Independent tables written at the same time.
MAX_CONCURRENT_WRITES = 4


def refresh_reference(store: TableStore, instruments: DataFrame, trader_changes: DataFrame,
                      counterparty_changes: DataFrame, *, validate: bool = True,
                      tie_break: list[str] | None = None, track: dict[str, list[str]] | None = None
                      ) -> dict[str, str]:
    """Reference tables and their type-2 histories. ``validate`` checks that
    every lookup dimension has one row per key (one grouped count each)."""
    out: dict[str, str] = {}
    put = _putter(store, out)
    track = track or {}
    instruments, _, _, traders, cps = _together(
        lambda: put("raw_instruments", instruments),
        lambda: put("raw_traders", trader_changes),
        lambda: put("raw_counterparties", counterparty_changes),
        lambda: put("scd2_traders", scd2.scd2_history(
            trader_changes, ["trader_id"], "updated_at", tie_break=tie_break,
            track=track.get("traders"))),
        lambda: put("scd2_counterparties", scd2.scd2_history(
            counterparty_changes, ["counterparty_id"], "updated_at", tie_break=tie_break,
            track=track.get("counterparties"))))
    # Written last: a reload compares with these, so a crash before them repeats the load.
    internal = _putter(store, {})
    opened = _together(*[lambda kind=kind, history=history: internal(open_table(kind), silver.current_rows(history))
                         for kind, history in (("traders", traders), ("counterparties", cps))])
    if validate:
        _together(lambda: assert_unique(instruments, ["ticker"], "raw_instruments"),
                  lambda: assert_unique(opened[0], ["trader_id"], "scd2_traders"),
                  lambda: assert_unique(opened[1], ["counterparty_id"], "scd2_counterparties"))
    return out


def open_table(kind: str) -> str:
    """The stored open versions of a history: lookups read these alone, however long the history grows."""
    return f"_open_{kind}"


def load_dims(store: TableStore) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(instruments, current traders, current counterparties) from the store."""
    return store.read("raw_instruments"), store.read(open_table("traders")), store.read(open_table("counterparties"))


def refresh_aggregates(store: TableStore, trades: DataFrame, ticks: DataFrame, *,
                       stamps: bool = True) -> dict[str, str]:
    """Latest prices, positions and the six gold tables from silver trades and ticks."""
    out: dict[str, str] = {}
    put = _putter(store, out)
    latest, positions = _together(
        lambda: put("latest_market_prices", silver.latest_prices(ticks)),
        lambda: put("positions", silver.positions(trades, calculated_at=stamps)))
    _together(
        lambda: put("desk_pnl", gold.desk_pnl(trades, calculated_at=stamps)),
        lambda: put("risk_exposure_by_sector", gold.risk_exposure_by_sector(trades, calculated_at=stamps)),
        lambda: put("counterparty_exposure", gold.counterparty_exposure(trades, calculated_at=stamps)),
        lambda: put("trade_anomalies", gold.trade_anomalies(trades, detected_at=stamps)),
        lambda: put("hourly_trade_volume", gold.hourly_trade_volume(trades, calculated_at=stamps)),
        lambda: put("mark_to_market_pnl", gold.mark_to_market_pnl(positions, latest, calculated_at=stamps)))
    return out


def refresh_all(store: TableStore, inputs: Inputs, *, stamps: bool = True,
                trades_partition_by: list[str] | None = None, validate: bool = True) -> dict[str, str]:
    """Run the whole pipeline once as a batch; returns table → written version path."""
    out: dict[str, str] = {}
    put = _putter(store, out)
    feed = inputs.raw_trades
    if inputs.backfill is not None:
        feed = with_backfill(feed, inputs.backfill)
    raw_trades, raw_ticks = _together(lambda: put("raw_trades", feed),
                                      lambda: put("raw_market_data", inputs.raw_ticks))
    out.update(refresh_reference(store, inputs.instruments, inputs.trader_changes,
                                 inputs.counterparty_changes, validate=validate))
    instruments, traders, cps = load_dims(store)
    ticks, trades = _together(
        lambda: put("enriched_market_data", silver.enrich_ticks(raw_ticks, processed_at=stamps)),
        lambda: put("enriched_trades",
                    silver.enriched_trades(raw_trades, instruments, traders, cps, processed_at=stamps),
                    trades_partition_by))
    out.update(refresh_aggregates(store, trades, ticks, stamps=stamps))
    return out

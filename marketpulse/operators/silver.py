"""Silver tables: enriched trades and ticks, latest price, positions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import FINE, notional, round_half_up
from ..functions.timefmt import with_event_time
from ..plans.joins import lookup_join, prefixed
from ..schemas import LATEST_PRICE_COLUMNS
from .aggregates import POSITIONS
from .dedup import dedup_first
from .quality import TICK_RULES, TRADE_RULES, Rule, apply_rules, drop_rules

ARRIVAL = "_arrival"   # optional sortable column: which copy of a trade came first
TOGETHER = "_order"    # optional column that a trade's id determines: rows come dealt over the tasks by it


def current_rows(history: DataFrame) -> DataFrame:
    """FLT-1: the open version of a type-2 history."""
    return history.filter(F.col("__END_AT").isNull())


def dedup_trades(raw: DataFrame) -> DataFrame:
    """DEDUP-1 over a batch of raw trades, then ``event_time`` parsed (a
    row-local step: only the surviving copies pay for it)."""
    return with_event_time(_first_copies(raw.drop(TOGETHER)))


def _first_copies(raw: DataFrame, together: Sequence[str] = ()) -> DataFrame:
    return dedup_first(raw, ["trade_id"], [ARRIVAL] if ARRIVAL in raw.columns else [], together)


def clean_trades(raw: DataFrame, rules: Sequence[Rule] = TRADE_RULES) -> DataFrame:
    """Parse → dedup → drop rules. Dedup comes first: a bad first copy of a
    trade_id hides a good later copy. The drop rules read only trade columns,
    so they run before the lookups (fewer join rows, same result because each
    lookup matches at most one dimension row). Where rows without an id are dropped in the end,
    the copies of a trade are looked for where they lie (``TOGETHER``)."""
    if TOGETHER not in raw.columns or all(r.sql != "trade_id IS NOT NULL" for r in drop_rules(rules)):
        return apply_rules(dedup_trades(raw), rules)
    return apply_rules(with_event_time(_first_copies(raw, [TOGETHER]).drop(TOGETHER)), rules)


def enrich_trades(trades: DataFrame, instruments: DataFrame | None, traders: DataFrame | None,
                  counterparties: DataFrame | None, *, processed_at: bool = False, derive: bool = True,
                  keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """JN-1 instruments, JN-2 current traders, JN-3 current counterparties
    (each dimension renamed and pruned first, PRJ-16), then PRJ-2 notional,
    PRJ-3 trade date, PRJ-4 trade hour, PRJ-17 ``processed_at``.

    ``traders`` and ``counterparties`` are current rows (``current_rows``). A query that
    needs none of a dimension's columns passes None and saves its lookup: Spark could not drop
    it, as it does not know the keys to be unique. ``keep`` may store the trades and each wide lookup's
    result, so that not all their shuffles lie on disk together."""
    t = keep(trades.drop(ARRIVAL) if ARRIVAL in trades.columns else trades)
    if instruments is not None:
        t = keep(_looked_up(t, "ticker", prefixed(instruments, "ticker", "__key", "company_name", "sector")))
    # Traders are fewest by far, often few enough to be broadcast: looked up last, their columns are never shuffled then.
    if counterparties is not None:
        t = keep(_looked_up(t, "counterparty_id", prefixed(counterparties, "counterparty_id", "__key", "counterparty_name",
                                                           "risk_rating", "counterparty_type", cp_country="country")))
        added = ["counterparty_name", "risk_rating", "counterparty_type", "cp_country"]
    if traders is not None:
        t = _looked_up(t, "trader_id", prefixed(traders, "trader_id", "__key", "trader_name", "desk_full_name",
                                                "risk_limit_usd", "location"))
        if counterparties is not None:
            t = t.select(*[c for c in t.columns if c not in added], *[c for c in added if c in t.columns])
    if derive:
        t = with_notional(t).withColumn("trade_date", F.to_date("event_time")).withColumn("trade_hour", F.hour("event_time"))
    if processed_at:
        t = t.withColumn("processed_at", F.current_timestamp())
    return t


def _looked_up(t: DataFrame, key: str, dim: DataFrame) -> DataFrame:
    return lookup_join(t, dim, key, "__key", spread_by="trade_id" if "trade_id" in t.columns else None)


def with_notional(trades: DataFrame) -> DataFrame:
    """PRJ-2."""
    return trades.withColumn("notional_usd", notional("price", "quantity"))


def enriched_trades(raw: DataFrame, instruments: DataFrame, traders: DataFrame,
                    counterparties: DataFrame, **kw) -> DataFrame:
    return enrich_trades(clean_trades(raw), instruments, traders, counterparties, **kw)


def derive_ticks(raw: DataFrame) -> DataFrame:
    """PRJ-1, PRJ-5, PRJ-6 on raw ticks (before the rules, as in the source:
    the division is a ``try_divide`` so bid = −ask cannot fail the batch)."""
    t = with_event_time(raw)
    mid = (F.col("bid") + F.col("ask")) / 2
    half = F.lit(Decimal("0.5"))
    exact = F.round(F.try_multiply(F.try_add(F.col("bid").try_cast(FINE), F.col("ask").try_cast(FINE)), half), 2)
    return (t.withColumn("mid_price", F.coalesce(exact.cast("double"), mid))
             .withColumn("spread_bps", round_half_up(F.try_divide(F.col("spread"), mid) * 10000, 2)))


def enrich_ticks(raw: DataFrame, rules: Sequence[Rule] = TICK_RULES, *,
                 processed_at: bool = False) -> DataFrame:
    t = apply_rules(derive_ticks(raw), rules)
    if processed_at:
        t = t.withColumn("processed_at", F.current_timestamp())
    return t


def latest_prices(ticks: DataFrame, keep_id: bool = False) -> DataFrame:
    """WN-1: newest tick per ticker (ties: greater tick_id; NULL times last).

    ``row_number() = 1`` is planned with a map-side ``WindowGroupLimit``: a
    hot ticker is cut to one row per task before the shuffle."""
    w = Window.partitionBy("ticker").orderBy(F.col("event_time").desc_nulls_last(),
                                             F.col("tick_id").desc_nulls_last())
    cols = LATEST_PRICE_COLUMNS + (["tick_id"] if keep_id else [])
    return (ticks.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1)
            .select(*cols))


def positions(trades: DataFrame, *, calculated_at: bool = False) -> DataFrame:
    """AG-1: net position per (ticker, desk, sector, asset_class)."""
    out = POSITIONS.batch(trades)
    return out.withColumn("calculated_at", F.current_timestamp()) if calculated_at else out

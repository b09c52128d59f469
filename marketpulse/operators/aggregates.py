"""AG-1..AG-5: the aggregate tables, each written once and run three ways.

An ``Aggregate`` names its group keys, its measures — exact sums, counts and
maxima, which merge by summing or taking the maximum — the columns whose distinct
values it counts, and how finished columns follow from these.

* ``batch``: over silver trades that carry all keys.
* ``by_finer``: over trades that still lack keys a lookup would add. They are
  aggregated by columns that determine the missing keys, the lookup runs over those few
  groups, and their measures are merged. No trade is widened for a lookup.
* ``rows`` / ``merge``: new trades, each a partial of its own, merged into stored ones (``plans.incremental``).

Distinct counts never expand rows: the first counted column joins the group keys of the
measures' own aggregation, so its values are counted when those groups are merged; a second one
is counted from the distinct (keys, value) pairs, which read only these columns. Both are
keyed by (group, value), so a group with a third of all trades spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import CENTS, FINE, round_half_up
from ..functions.signs import cashflow_signed, long_part, position_side, position_signed, short_part
from ..functions.timefmt import hour_bucket
from ..plans.joins import join_groups

Lookup = Callable[[DataFrame], DataFrame]
_FOLD = {"sum": F.sum, "max": F.max}


@dataclass(frozen=True)
class Aggregate:
    name: str
    keys: list[str]
    # partial column -> (its value for one trade, how trades and partials merge: "sum" | "max")
    measures: dict[str, tuple[Callable[[], Column], str]]
    finish: Callable[[DataFrame], DataFrame]
    # output column -> trade column whose distinct values are counted
    distinct: dict[str, str] = field(default_factory=dict)
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df

    def _measured(self) -> list[Column]:
        return [_FOLD[how](e()).alias(n) for n, (e, how) in self.measures.items()]

    def _merged(self, partial: DataFrame, extra: Sequence[str] = ()) -> list[Column]:
        out = []
        for n, how in [*((n, how) for n, (_, how) in self.measures.items()), *((n, "sum") for n in extra)]:
            c = _FOLD[how](n)
            # a sum of sums keeps the type of its parts
            out.append((c.cast(partial.schema[n].dataType) if how == "sum" else c).alias(n))
        return out

    def _counted(self, rows: DataFrame, keys: Sequence[str], merged: bool) -> DataFrame:
        """(keys, measures, distinct counts) of trades, or of partials if ``merged``."""
        measures = self._merged(rows) if merged else self._measured()
        if not self.distinct:
            return rows.groupBy(*keys).agg(*measures)
        (name, value), *others = self.distinct.items()
        cells = rows.groupBy(*keys, value).agg(*measures)
        out = cells.groupBy(*keys).agg(*self._merged(cells), F.count(value).alias(name))
        for name, value in others:
            pairs = rows.select(*keys, value).distinct()
            out = join_groups(out, pairs.groupBy(*keys).agg(F.count(value).alias(name)), keys)
        return out

    def batch(self, trades: DataFrame) -> DataFrame:
        return self.finish(self._counted(self.prepare(trades), self.keys, False))

    def by_finer(self, trades: DataFrame, by: Sequence[str], lookup: Lookup, keep: Lookup = lambda df: df) -> DataFrame:
        """``batch`` of trades without the keys that ``lookup`` adds from the columns ``by``.

        Where ``by`` and the keys make the same groups, the groups are finished as they are.
        ``keep`` may store the partials of a table with distinct counts, which reads them twice."""
        rows, by = self.prepare(trades), list(by)
        same = set(by) <= set(self.keys)
        if not self.distinct and same:
            return self.finish(lookup(self._counted(rows, by, False)))
        fine = keep(rows.groupBy(*dict.fromkeys([*by, *self.distinct.values()])).agg(*self._measured()))
        return self.finish(lookup(self._counted(fine, by, True)) if same else self._counted(lookup(fine), self.keys, True))

    def rows(self, trades: DataFrame) -> DataFrame:
        """New trades as partials, one each."""
        trades = self.prepare(trades)
        types = trades.groupBy().agg(*self._measured()).schema
        return trades.select(*self.keys, *[e().cast(types[n].dataType).alias(n) for n, (e, _) in self.measures.items()])

    def merge(self, old: DataFrame | None, rows: DataFrame, counts: Sequence[DataFrame] = ()) -> DataFrame:
        """Partials with new trades (``rows``) and the counts of new distinct values folded in, by one grouping."""
        every = rows if old is None else old.unionByName(rows, allowMissingColumns=True)
        for c in counts:
            every = every.unionByName(c, allowMissingColumns=True)
        names = list(self.distinct)
        return every.groupBy(*self.keys).agg(*self._merged(every, names)).fillna(0, names)

    def pairs(self, trades: DataFrame, value: str) -> DataFrame:
        """(keys, value) of each trade, the value named ``__value``."""
        return self.prepare(trades).select(*self.keys, F.col(value).alias("__value"))


def _money(c: Callable[[], Column], as_type: str = CENTS) -> tuple[Callable[[], Column], str]:
    return (lambda: c().try_cast(as_type), "sum")


def _one(if_: Column) -> Column:
    return F.when(if_, 1).otherwise(0)


def _known(c: str, as_type: str = CENTS) -> tuple[Callable[[], Column], str]:
    """How many values the exact sum holds."""
    return (lambda: _one(F.col(c).try_cast(as_type).isNotNull()), "sum")


def _side(side: str) -> tuple[Callable[[], Column], str]:
    return (lambda: _one(F.col("side") == side), "sum")


_COUNT = (lambda: _one(F.col("trade_id").isNotNull()), "sum")
_LAST = (lambda: F.col("event_time"), "max")
_NOTIONAL = {"__ns": _money(lambda: F.col("notional_usd")), "__nc": _known("notional_usd")}
_PRICE = {"__ps": _money(lambda: F.col("price"), FINE), "__pc": _known("price", FINE)}
_LEGS = {"__long": _money(lambda: long_part("notional_usd")), "__short": _money(lambda: short_part("notional_usd"))}


def _mean(total: str, count: str) -> Column:
    """One rounding, engine independent."""
    return F.col(total).cast("double") / F.col(count)


def _desk_finish(p: DataFrame) -> DataFrame:
    return p.select(
        "desk", "desk_full_name", F.col("__net").cast("double").alias("net_pnl_usd"),
        F.col("__gross").cast("double").alias("gross_volume_usd"), F.col("__n").alias("trade_count"),
        "unique_tickers", "active_traders", _mean("__ns", "__nc").alias("avg_trade_size_usd"),
        F.col("__last").alias("last_trade_time"), F.col("__buy").alias("buy_count"),
        F.col("__sell").alias("sell_count"),
        round_half_up(F.col("__buy") / F.greatest(F.col("__sell"), F.lit(1)), 2).alias("buy_sell_ratio"))


def _legs(p: DataFrame) -> list[Column]:
    long, short = F.col("__long"), F.col("__short")
    return [long.cast("double").alias("long_notional_usd"), short.cast("double").alias("short_notional_usd"),
            F.col("__n").alias("trade_count"), F.col("unique_tickers"), F.col("active_desks"),
            (long - short).cast("double").alias("net_exposure_usd"),
            (long + short).cast("double").alias("gross_exposure_usd")]


def _sector_finish(p: DataFrame) -> DataFrame:
    """PRJ-11 on top of PRJ-12 in exact decimals."""
    return p.select("sector", "asset_class", *_legs(p)).withColumn("long_short_ratio", round_half_up(
        F.when(F.col("short_notional_usd") > 0, F.col("long_notional_usd") / F.col("short_notional_usd")), 4))


CP_KEYS = ["counterparty_id", "counterparty_name", "risk_rating", "counterparty_type", "cp_country"]


def _cp_finish(p: DataFrame) -> DataFrame:
    return p.select(*CP_KEYS, *_legs(p)[:5], _mean("__ns", "__nc").alias("avg_trade_size_usd"),
                    F.col("__last").alias("last_trade_time"), *_legs(p)[5:])


def _hourly_finish(p: DataFrame) -> DataFrame:
    return p.select("trade_hour", "desk", "sector", F.col("__n").alias("trade_count"),
                    F.col("__ns").cast("double").alias("total_notional_usd"),
                    _mean("__ps", "__pc").alias("avg_price"), F.col("__q").alias("total_quantity"))


def _positions_finish(p: DataFrame) -> DataFrame:
    return p.select("ticker", "desk", "sector", "asset_class", F.col("__nq").alias("net_quantity"),
                    F.col("__nn").cast("double").alias("net_notional_usd"),
                    F.col("__g").cast("double").alias("gross_notional_usd"), F.col("__n").alias("trade_count"),
                    _mean("__ps", "__pc").alias("avg_price"),
                    F.col("__last").alias("last_trade_time")).withColumn("position_side", position_side())


#: AG-2 + PRJ-8, PRJ-10. ``net_pnl_usd`` is cash flow: sells − buys (non-SELL counts as buy).
DESK_PNL = Aggregate("desk_pnl", ["desk", "desk_full_name"], {
    "__net": _money(lambda: cashflow_signed("notional_usd")),
    "__gross": _money(lambda: F.abs("notional_usd")), "__n": _COUNT, **_NOTIONAL, "__last": _LAST,
    "__buy": _side("BUY"), "__sell": _side("SELL"),
}, _desk_finish, {"unique_tickers": "ticker", "active_traders": "trader_id"})

#: AG-3 + PRJ-11: BUY is long, SELL short, other sides neither.
SECTOR_EXPOSURE = Aggregate("risk_exposure_by_sector", ["sector", "asset_class"], {**_LEGS, "__n": _COUNT},
                            _sector_finish, {"unique_tickers": "ticker", "active_desks": "desk"})

#: AG-4: concentration by counterparty.
COUNTERPARTY_EXPOSURE = Aggregate("counterparty_exposure", CP_KEYS, {
    **_LEGS, "__n": _COUNT, **_NOTIONAL, "__last": _LAST,
}, _cp_finish, {"unique_tickers": "ticker", "active_desks": "desk"})

#: AG-5: hour bucket × desk × sector.
HOURLY_VOLUME = Aggregate("hourly_trade_volume", ["trade_hour", "desk", "sector"], {
    "__n": _COUNT, "__ns": _NOTIONAL["__ns"], **_PRICE, "__q": (lambda: F.col("quantity"), "sum"),
}, _hourly_finish, prepare=lambda t: t.withColumn("trade_hour", hour_bucket("event_time")))

#: AG-1: net position per (ticker, desk, sector, asset class).
POSITIONS = Aggregate("positions", ["ticker", "desk", "sector", "asset_class"], {
    "__nq": (lambda: position_signed("quantity"), "sum"),
    "__nn": _money(lambda: position_signed("notional_usd")),
    "__g": _money(lambda: F.abs("notional_usd")), "__n": _COUNT, **_PRICE, "__last": _LAST,
}, _positions_finish)



def _stats_finish(p: DataFrame) -> DataFrame:
    """The variance is formed from exact integer sums, (nΣx² − (Σx)²) / (n(n−1)), so it is engine
    independent; NULL for a single trade, like ``stddev``."""
    n = F.col("__qn")
    num = (n.cast("decimal(38,0)") * F.col("__qss") - F.col("__qs") * F.col("__qs")).cast("double")
    den = (n * (n - 1)).cast("double")
    return p.select("ticker", (F.col("__qs").cast("double") / n).alias("avg_qty"),
                    F.when(n > 1, F.sqrt(num / den)).alias("stddev_qty"), _mean("__ps", "__pc").alias("avg_price"))


def _quantity() -> Column:
    return F.col("quantity").cast("decimal(38,0)")


#: WN-2: moments of a ticker's trades.
TICKER_STATS = Aggregate("ticker_stats", ["ticker"], {
    "__qn": (lambda: _one(F.col("quantity").isNotNull()), "sum"),
    "__qs": (lambda: _quantity(), "sum"),
    "__qss": (lambda: _quantity() * _quantity(), "sum"), **_PRICE,
}, _stats_finish)

AGGREGATES: list[Aggregate] = [DESK_PNL, SECTOR_EXPOSURE, COUNTERPARTY_EXPOSURE, HOURLY_VOLUME, POSITIONS]

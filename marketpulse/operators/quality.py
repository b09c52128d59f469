"""DQ-1 (drop), DQ-2 (warn), DQ-3 (report): named expectations that drop or
count failing rows. Predicates are SQL text (FLT-3: IN lists, comparisons,
IS NOT NULL, a timestamp bound).

A rule passes only when its predicate is TRUE; NULL counts as a failure.
Counts are taken over all rows reaching the rules, each rule on its own (a
row may fail several).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DROP = "drop"
WARN = "warn"


@dataclass(frozen=True)
class Rule:
    name: str
    sql: str
    action: str = WARN

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.sql), F.lit(False))


# The rule names and predicates of the two silver tables.
TRADE_RULES = (
    Rule("valid_trade_id", "trade_id IS NOT NULL", DROP),
    Rule("valid_ticker", "ticker IS NOT NULL", DROP),
    Rule("valid_price", "price > 0", DROP),
    Rule("valid_quantity", "quantity > 0", DROP),
    Rule("valid_side", "side IN ('BUY', 'SELL')", WARN),
    Rule("valid_trader", "trader_id IS NOT NULL", WARN),
    Rule("valid_counterparty", "counterparty_id IS NOT NULL", WARN),
    Rule("valid_timestamp", "event_time IS NOT NULL AND event_time < '2028-01-01'", WARN),
)

TICK_RULES = (
    Rule("valid_tick_id", "tick_id IS NOT NULL", DROP),
    Rule("valid_md_ticker", "ticker IS NOT NULL", DROP),
    Rule("valid_bid", "bid > 0", DROP),
    Rule("valid_ask", "ask > 0", DROP),
    Rule("bid_less_than_ask", "bid <= ask", WARN),
)


def drop_rules(rules: Sequence[Rule]) -> list[Rule]:
    return [r for r in rules if r.action == DROP]


def warn_rules(rules: Sequence[Rule]) -> list[Rule]:
    return [r for r in rules if r.action == WARN]


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Keep the rows passing every drop rule; warn rules never filter."""
    cond = None
    for r in drop_rules(rules):
        cond = r.passes() if cond is None else cond & r.passes()
    return df if cond is None else df.filter(cond)


def _fail_counts(rules: Sequence[Rule]) -> list[Column]:
    return [F.sum(F.when(r.passes(), 0).otherwise(1)).cast("bigint").alias(r.name) for r in rules]


def rule_report(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """(dataset, rule, action, passed_records, failed_records), one pass.

    A single global aggregate (partial per task, one tiny final) followed by
    an unpivot of its one row.
    """
    totals = df.agg(F.count(F.lit(1)).alias("__n"), *_fail_counts(rules))
    stacked = totals.select(
        F.col("__n"),
        F.explode(F.array(*[
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
                     F.col(r.name).alias("failed_records"))
            for r in rules])).alias("r"))
    return stacked.select(
        F.lit(dataset).alias("dataset"), F.col("r.rule").alias("rule"),
        F.col("r.action").alias("action"),
        (F.col("__n") - F.col("r.failed_records")).alias("passed_records"),
        F.col("r.failed_records").alias("failed_records"))


def observe_rules(df: DataFrame, rules: Sequence[Rule], observation: str | Observation) -> DataFrame:
    """Rule counts of a job taken while its rows pass by: no second scan. On a stream they
    land in ``lastProgress``, with an ``Observation`` in ``observed_report``."""
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *_fail_counts(rules))


REPORT_SCHEMA = "dataset string, rule string, action string, passed_records bigint, failed_records bigint"


def observed_report(spark: SparkSession, counts: dict, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """One observation's counts in the shape of ``rule_report`` (an empty batch counts zero)."""
    n = counts.get("rows") or 0
    failed = {r.name: counts.get(r.name) or 0 for r in rules}
    return spark.createDataFrame([(dataset, r.name, r.action, n - failed[r.name], failed[r.name]) for r in rules], REPORT_SCHEMA)


def merge_reports(reports: DataFrame) -> DataFrame:
    """DQ-3 over any number of batches: counts summed per rule."""
    return reports.groupBy("dataset", "rule", "action").agg(
        F.sum("passed_records").alias("passed_records"), F.sum("failed_records").alias("failed_records"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (S24: a lookup dimension must have one
    row per key, or a left join would multiply fact rows). A grouped count
    with partial aggregation; only offending keys come back."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str], name: str = "table") -> None:
    bad = duplicate_keys(df, keys).take(5)
    if bad:
        raise ValueError(f"{name}: keys {list(keys)} are not unique, e.g. {[tuple(r) for r in bad]}")

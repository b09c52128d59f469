"""Connected components over an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.filter("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(low, "u")
    return (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct())


def component_roots(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that has an edge and is not its own root.

    ``edges`` has columns u, v of one ordered type. Each round makes every
    neighbourhood point to its smallest member; the number of rounds grows with
    the logarithm of the longest chain. Each round is written to the shared
    folder, which cuts the lineage; the test for the end is one aggregate row.
    """
    def mark(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    cur = scratch.save(edges.filter("u != v").select(F.greatest("u", "v").alias("u"),
                                                     F.least("u", "v").alias("v")).distinct(), "cc0")
    seen = mark(cur)
    if not seen[0]:
        return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for i in range(1, max_rounds + 1):
        nxt = scratch.save(_small_star(_large_star(cur)), f"cc{i}")
        now = mark(nxt)
        scratch.drop(f"cc{i - 1}")
        cur = nxt
        if now == seen:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")

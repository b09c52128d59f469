"""DEDUP-1: keep one row per key.

Batch form: ``row_number() = 1`` over (key, order). Catalyst plans it with a
``WindowGroupLimit`` in two steps, the first inside each map task before the
shuffle: a key holding a third of all rows is cut to one row per task before
any data moves. Stream form: Spark's stateful ``dropDuplicates``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None,
                together: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: the first by ``order_by`` (then by all columns, so
    the survivor is deterministic). All NULL keys fold into one row, like
    ``dropDuplicates``.

    ``together`` names columns that the keys determine, where they are not NULL. Rows that already
    lie by these columns, as after a join on them, are not shuffled; rows with NULL keys fold into one per value."""
    keys = [*together, *keys]
    order = list(order_by or [])
    rest = [c for c, t in df.dtypes if c not in keys and c not in order and not t.startswith("map")]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order + rest])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def dedup_stream(df: DataFrame, keys: Sequence[str], within: str | None = None,
                 arrival_col: str = "_ingested_at") -> DataFrame:
    """Stateful dedup on a stream.

    ``within=None`` (default): exact, state kept for the life of the stream.
    ``within="7 days"``: bounded state with ``dropDuplicatesWithinWatermark``;
    copies arriving later than that are no longer caught. The watermark runs
    on the arrival time alone, which no row of a new micro-batch is behind: a
    trade seen for the first time is kept however old or future-dated it is."""
    if within is None:
        return df.dropDuplicates(list(keys))
    return (df.withColumn("__dedup_time", F.col(arrival_col).cast("timestamp")).withWatermark("__dedup_time", within)
              .dropDuplicatesWithinWatermark(list(keys)).drop("__dedup_time"))

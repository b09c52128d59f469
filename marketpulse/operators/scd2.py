"""SCD-1: type-2 history (``__START_AT`` / ``__END_AT``) from a change log.

The history is always rebuilt from the append-only log, never patched from a
merged history: a late change (A@1, A@3, then B@2) must split [1,3) and a
merged history has already lost what A@3 followed.

One window per key would put a key with a third of all changes into one task. A
key's changes are therefore cut into slices of sequence (``slice_of``: months of a time,
a million steps of a number). One shuffle by (key, slice) and one sort serve everything
inside a slice: the change before a row, whether it opens a version, and where the next
one opens. Only a slice's first and last row depend on other slices; those two rows per
slice are stitched per key, by which time a key is a few rows per month. Slices follow from
the rows alone, so nothing is sampled, checkpointed or left behind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "__START_AT", "__END_AT"
#: Steps of a numeric sequence that one slice holds.
NUMERIC_SLICE = 1 << 20


def latest_per_sequence(changes: DataFrame, keys: Sequence[str], sequence_by: str,
                        tie_break: Sequence[str] | None = None) -> DataFrame:
    """One row per (key, sequence): the greatest by ``tie_break`` (then by all
    columns). Re-delivering a change therefore adds no version. A grouped
    ``max``: partial aggregation folds repeats before the shuffle."""
    keys = list(keys)
    group = keys + [sequence_by]
    rest = [c for c in changes.columns if c not in group]
    fields = [F.col(c).alias(f"__t{i}") for i, c in enumerate(tie_break or [])]
    fields += [F.col(c) for c in rest]
    best = changes.groupBy(*group).agg(F.max(F.struct(*fields)).alias("__b"))
    return best.select(*group, *[F.col(f"__b.{c}").alias(c) for c in rest])


def slice_of(sequence: Column, type_name: str) -> Column:
    """The slice of a sequence value; it never falls as the sequence rises. Other types are one slice."""
    if type_name in ("timestamp", "timestamp_ntz", "date"):
        return F.date_trunc("month", sequence).cast("timestamp_ntz")
    if type_name in ("tinyint", "smallint", "int", "bigint"):
        return F.floor(sequence / F.lit(NUMERIC_SLICE))
    return F.lit(0)


def scd2_history(changes: DataFrame, keys: Sequence[str], sequence_by: str, *,
                 tie_break: Sequence[str] | None = None, track: Sequence[str] | None = None) -> DataFrame:
    """Type-2 history of ``changes``.

    ``track=None`` tracks every column, so each new sequence value opens a
    version. With ``track=[...]`` a change whose tracked values equal the
    previous version's is folded into it (its other columns are dropped, the
    version keeps its first row)."""
    keys, seq = list(keys), F.col(sequence_by)
    rows = latest_per_sequence(changes, keys, sequence_by, tie_break)
    payload = [c for c in rows.columns if c not in keys and c != sequence_by]
    tracked = F.struct(*[F.col(c) for c in track]) if track else F.struct(seq)
    rows = rows.withColumns({"__slice": slice_of(seq, dict(rows.dtypes)[sequence_by]), "__tracked": tracked})
    inside = Window.partitionBy(*keys, "__slice").orderBy(seq.asc_nulls_first())
    rows = rows.withColumn("__before", F.lag("__tracked").over(inside))
    # A slice's first row may open a version; later ones do if they differ from the row before.
    rows = rows.withColumn("__first", F.col("__before").isNull())
    starts = rows.filter(F.col("__first") | ~F.col("__before").eqNullSafe(F.col("__tracked")))
    starts = starts.withColumns({"__next": F.lead(seq).over(inside), "__last": F.lead(F.lit(True)).over(inside).isNull()})
    out = [*keys, *payload, seq.alias(START)]
    inner = starts.filter("NOT __first AND NOT __last").select(*out, F.col("__next").alias(END))
    # Rows after a slice's last start equal it, so its last start holds what the slice ends with.
    along = Window.partitionBy(*keys).orderBy(seq.asc_nulls_first())
    later = Window.partitionBy(*keys).orderBy(seq.desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    edge = starts.filter("__first OR __last").withColumn("__prior", F.lag("__tracked").over(along))
    edge = edge.withColumn("__opens", ~F.col("__first") | F.col("__prior").isNull() | ~F.col("__prior").eqNullSafe(F.col("__tracked")))
    # Where a slice's versions begin: at its first row, or at the first later row that differs from it.
    begins = F.when(F.col("__first"), F.when(F.col("__opens"), seq).otherwise(F.col("__next")))
    edge = edge.withColumn("__begins", begins).withColumn("__after", F.last("__begins", ignorenulls=True).over(later))
    edge = edge.filter("__opens").select(*out, F.coalesce("__next", "__after").alias(END))
    return inner.unionByName(edge)


def current(history: DataFrame) -> DataFrame:
    return history.filter(F.col(END).isNull())

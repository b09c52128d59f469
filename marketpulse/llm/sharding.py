"""Balanced sharding by label propagation over copies.

Documents with equal texts are linked. Copies with one label are alike, so the
graph is held as cells, (group, first label) with a row count: a group of any
size is a few rows and its links are never listed.

Groups of more than a part of a shard are few (``LARGE_PART`` bounds their number).
Each moves as a whole, the largest first: to the shard that most of its copies
vote for if it has room there, else to the fullest shard that has; only a group
that fits nowhere, as one larger than a shard, is cut, into the emptiest shards.

The other groups propagate under the room that is left. Each round joins every
cell with its group's label counts; a cell wants to move to the label most of its
neighbours have, labels with room before full ones. Demand from label to label, a
matrix of shards x shards, is turned into quotas that keep every label under its
capacity, and a cell moves if its hash falls under the quota. Rounds end when
nothing moves, or with a warning after ``ROUNDS``; a group that still has several
labels then takes the one it wants. Rows are put in order of (label, group, id)
and dealt into the rest of the shards, so a cut separates at most one such group
per shard border and shards' counts differ by at most one: the law is ``rows``.

Edge cases: NULL text has size 8 and checksum 0 and groups with other NULLs;
repeated rows are copies; with fewer rows than shards some shards stay empty;
an empty table gives an empty result.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketpulse.llm.common import Scratch, id_text

SHARDS = 24
#: A label's capacity during propagation, as a multiple of the mean. The final cut
#: makes shards even at any slack; more slack lets more groups come together.
SLACK = 1.25
#: A group of more than this part of a shard is placed as a whole: fewer than SHARDS * LARGE_PART groups,
#: or, in shards of fewer rows than twice this, half the rows.
LARGE_PART = 4
#: Bound on the rounds; reaching it gives a warning.
ROUNDS = 64
_GROUP = ["g", "text_crc32", "size"]


def quotas(demand: np.ndarray, load: np.ndarray, capacity) -> np.ndarray:
    """Part of each from-to demand that can move while every load stays within the capacity."""
    part = np.ones_like(demand)
    for _ in range(200):
        flow = demand * part
        over = load + flow.sum(axis=0) - flow.sum(axis=1) - capacity
        if (over <= 1e-9).all():
            break
        inflow = flow.sum(axis=0)
        with np.errstate(divide="ignore", invalid="ignore"):
            shrink = np.where((over > 0) & (inflow > 0), np.clip(1 - over / inflow, 0, 1), 1.0)
        part = part * shrink[None, :]
    return part


def pack(groups: list[tuple[int, int]], sizes: list[int]) -> tuple[list[list[tuple[int, int]]], list[int]]:
    """The (shard, rows) parts of each (rows, wanted shard), given the largest first, and the room left in each shard."""
    room, out = list(sizes), []
    for n, want in groups:
        parts = []
        while n:
            fits = [k for k in range(len(room)) if room[k] >= n]
            if want in fits:
                k = want
            elif fits:
                k = min(fits, key=lambda k: room[k])
            else:
                k = max(range(len(room)), key=lambda k: room[k])
            parts.append((k, min(n, room[k])))
            n -= parts[-1][1]
            room[k] -= parts[-1][1]
        out.append(parts)
    return out, room


def _propagate(cells: DataFrame, load: np.ndarray, capacity: np.ndarray, scratch: Scratch, rounds: int) -> DataFrame:
    """(group..., label) from ``cells`` (group..., first_label, label, c); ``load`` has all rows of each label."""
    shards = len(load)
    fixed = None
    for k in range(rounds):
        open_to = F.array(*[F.lit(bool(x)) for x in load + 1 <= capacity])
        votes = cells.groupBy(*_GROUP, "label").agg(F.sum("c").alias("votes"))
        best = votes.groupBy(*_GROUP).agg(F.max_by("label", F.struct(
            F.get(open_to, F.col("label")), "votes", F.xxhash64("g", "label"))).alias("want"))
        asked = scratch.save(cells.join(best, _GROUP), f"round{k}")
        if k:
            scratch.drop(f"cells{k - 1}")
            scratch.drop(f"round{k - 1}")
        demand = np.zeros((shards, shards))   # on the diagonal, what stays
        for r in asked.groupBy("label", "want").agg(F.sum("c").alias("c")).collect():
            demand[r["label"], r["want"]] = r["c"]
        if fixed is None:
            fixed = load - demand.sum(axis=1)
        load = fixed + demand.sum(axis=1)
        np.fill_diagonal(demand, 0)
        part = quotas(demand, load, capacity)
        flow = demand * part
        if flow.sum() < 1:
            break
        flat = F.array(*[F.lit(float(x)) for x in part.reshape(-1)])
        draw = F.pmod(F.xxhash64("g", "first_label", F.lit(k)), F.lit(1 << 20)) / F.lit(float(1 << 20))
        moves = (F.col("want") != F.col("label")) & (draw < F.get(flat, F.col("label") * shards + F.col("want")))
        cells = scratch.save(asked.withColumn("label", F.when(moves, F.col("want")).otherwise(F.col("label"))).drop("want"),
                             f"cells{k}")
        load = load - flow.sum(axis=1) + flow.sum(axis=0)
    else:
        warnings.warn(f"labels still moved after {rounds} rounds; split groups take the label they want", stacklevel=2)
    return asked.groupBy(*_GROUP).agg(F.any_value("want").alias("label"))


def shard_rows(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
               slack: float = SLACK, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): one row per input row.

    Runs jobs while it is called; every round is written to the shared folder.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "sharding")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = scratch.save(id_text(docs, id_col, text_col).select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("g"), F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("first_label")), "rows")
    counts = scratch.save(rows.groupBy(*_GROUP, "first_label").agg(F.count("*").alias("c")), "counts")
    load = np.zeros(shards)
    for r in counts.groupBy("first_label").agg(F.sum("c").alias("n")).collect():
        load[r["first_label"]] = r["n"]
    total = int(load.sum())
    if not total:
        return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    border = [-(-k * total // shards) for k in range(shards + 1)]
    large_rows = max(1, total // shards // LARGE_PART)
    groups = counts.groupBy(*_GROUP).agg(
        F.sum("c").alias("n"), F.max_by("first_label", F.struct("c", F.xxhash64("g", "first_label"))).alias("want")).filter("n > 1")
    large = sorted(groups.filter(F.col("n") > large_rows).collect(), key=lambda r: (-r["n"], r["g"], r["size"], r["text_crc32"]))
    packed, room = pack([(r["n"], r["want"]) for r in large], [b - a for a, b in zip(border, border[1:])])
    # Large groups come first in the order, under labels below zero.
    whole = spark.createDataFrame([(*(r[c] for c in _GROUP), k - len(large)) for k, r in enumerate(large)],
                                  rows.select(*_GROUP, F.lit(0).alias("place")).schema)
    for r in counts.join(F.broadcast(whole), _GROUP).groupBy("first_label").agg(F.sum("c").alias("n")).collect():
        load[r["first_label"]] -= r["n"]
    cells = counts.join(groups.filter(F.col("n") <= large_rows).select(*_GROUP), _GROUP).withColumn("label", F.col("first_label"))
    own = _propagate(scratch.save(cells, "cells"), load, slack * np.array(room, float), scratch, rounds)
    placed = (rows.join(F.broadcast(whole), _GROUP, "left").join(own, _GROUP, "left")
              .select("doc_id", *_GROUP, F.coalesce("place", "label", "first_label").alias("label")))
    # A global row number: sorted ranges, each numbered by itself, plus the rows before it.
    order = ["label", *_GROUP, "doc_id"]
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = scratch.save(placed.repartitionByRange(parts, *order).select("*", F.spark_partition_id().alias("pid")), "ranged")
    before = (ranged.groupBy("pid").agg(F.count("*").alias("n"))
              .select("pid", (F.sum("n").over(Window.orderBy("pid")) - F.col("n")).alias("before")))
    rank = F.row_number().over(Window.partitionBy("pid").orderBy(*order)) - 1 + F.col("before")
    # Stretches of that order, one per part of a large group and one per shard's rest: (from, to, shard, slot of row 0).
    stretches, at, filled = [], 0, [0] * shards
    for k, n in [*(part for of in packed for part in of), *enumerate(room)]:
        if n:
            stretches.append((at, at + n, k, filled[k] - at))
        at += n
        filled[k] += n
    dealt = F.broadcast(spark.createDataFrame(stretches, "lo long, hi long, shard int, shift long"))
    return (ranged.join(before, "pid").select("*", rank.cast("long").alias("rank"))
            .join(dealt, (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    (F.col("rank") + F.col("shift")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))

"""Vector code compression: product codes by Lloyd rounds that look at active entries only.

Components become integers floor(4096 * x), vectors are cut into parts, and each
part position has a codebook that starts as that part of the vectors with the
smallest ids. A round assigns every part to its nearest entry (squared Euclidean
distance, ties to the lower index) and replaces entries by the floored mean of
their parts. All arithmetic is on 64-bit integers, so the result does not depend
on how rows are dealt to tasks.

After the first round a part keeps its entry and exact distance. If that entry
did not move, every entry that stayed where it was is still no better, so the part
is compared with the moved entries only; a part whose entry moved is compared with
all. A round is one pass over the rows: it writes the new state and, with the first
row of each batch, that batch's sums, which a second small job adds up from that one
column. Only codebooks and their sums reach the driver: entries x components numbers.
Label sums are added by partial aggregation and joined back by broadcast under a
counted bound, beyond it by a join whose hot labels are salted.

Edge cases: rows are dropped if the vector is NULL or holds NULL or non-finite
components, or has another length than the kept row with the smallest id. NULL ids
come after all others, equal ids in order of their vectors; repeated rows count as
often as they occur. A length that parts do not divide is cut as evenly as possible.
Fewer kept rows than entries give that many entries. Components are held within the
range whose squared distances fit 64 bits (for parts of 8: about 134 million, x of
32,768). NULL labels are one label; a label sum beyond 64 bits is NULL. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import Scratch

#: Fixed values of the code: scale, parts, entries of a codebook, rounds.
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Most labels whose sums are broadcast; beyond it the sums are joined by a shuffle with salted labels.
MAX_LABELS = 100_000
SALTS = 64
_STATE = "label string, no_label boolean, v array<long>, code array<int>, dist array<long>, sums array<long>"


def cuts(dim: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """(from, to) of each part of a vector."""
    return [(k * dim // parts, (k + 1) * dim // parts) for k in range(parts)]


def assign(x: np.ndarray, book: np.ndarray, moved: np.ndarray | None = None,
           code: np.ndarray | None = None, dist: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and exact squared distance of each row of ``x``, lower index first.

    With ``moved`` (entries that changed since ``code`` and ``dist`` were made), rows whose entry
    did not change are compared with the changed entries only."""
    gap = lambda rows, j: ((rows - book[j]) ** 2).sum(axis=1)

    def scan(rows):
        best, at = gap(rows, 0), np.zeros(len(rows), np.int64)
        for j in range(1, len(book)):
            d = gap(rows, j)
            closer = d < best
            best, at = np.where(closer, d, best), np.where(closer, j, at)
        return at, best

    if moved is None:
        return scan(x)
    code, dist = code.copy(), dist.copy()
    again = moved[code]
    stay = np.flatnonzero(~again)
    if len(stay):
        at, best, rows = code[stay], dist[stay], x[stay]
        for j in np.flatnonzero(moved):
            d = gap(rows, j)
            closer = (d < best) | ((d == best) & (j < at))
            best, at = np.where(closer, d, best), np.where(closer, j, at)
        code[stay], dist[stay] = at, best
    if again.any():
        code[again], dist[again] = scan(x[again])
    return code, dist


def _lists(a: np.ndarray, kind) -> pa.Array:
    n, width = a.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(a.reshape(-1), kind))


def _round(books: list[np.ndarray], moved: list[np.ndarray] | None, dim: int):
    """Worker of one round: batches of state rows → the same rows with new codes, distances and sums."""
    spans, entries = cuts(dim, len(books)), len(books[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            col = lambda name, width: b.column(name).flatten().to_numpy(zero_copy_only=False).reshape(n, width)
            v = col("v", dim)
            old = (col("code", len(books)).astype(np.int64), col("dist", len(books))) if moved else None
            code, dist = np.empty((n, len(books)), np.int64), np.empty((n, len(books)), np.int64)
            counts, sums = np.zeros((len(books), entries), np.int64), np.zeros((entries, dim), np.int64)
            for k, (lo, hi) in enumerate(spans):
                x = v[:, lo:hi]
                state = (moved[k], old[0][:, k], old[1][:, k]) if moved else ()
                code[:, k], dist[:, k] = assign(x, books[k], *state)
                counts[k] = np.bincount(code[:, k], minlength=entries)
                for j in range(entries):
                    sums[j, lo:hi] = x[code[:, k] == j].sum(axis=0)
            first = np.concatenate([counts.reshape(-1), sums.reshape(-1)])
            offsets = np.full(n + 1, len(first), np.int32)
            offsets[0] = 0
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), b.column("no_label"), b.column("v"), _lists(code, pa.int32()),
                 _lists(dist, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(first))],
                ["vec_id", "label", "no_label", "v", "code", "dist", "sums"])
    return run


def _means(state: DataFrame, books: list[np.ndarray], dim: int) -> list[np.ndarray]:
    """The codebooks with every used entry replaced by the floored mean of its parts."""
    at = state.filter(F.size("sums") > 0).select(F.posexplode("sums").alias("at", "x"))
    total = {r["at"]: int(r["x"]) for r in at.groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()}
    entries, base, out = len(books[0]), len(books) * len(books[0]), []
    for k, (lo, hi) in enumerate(cuts(dim, len(books))):
        book = books[k].copy()
        for j in range(entries):
            count = total[k * entries + j]
            if count:
                book[j] = [total[base + j * dim + i] // count for i in range(lo, hi)]
        out.append(book)
    return out


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray], Scratch]:
    """(vec_id, label as text, no_label, v, code, dist) of each kept row, the final codebooks, and the scratch tables.

    Runs one job per round while it is called; a round in which no entry moves ends them early."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "codes")
    src = vectors.select(vectors[id_col].alias("vec_id"), vectors[vector_col].alias("x"),
                         vectors[label_col].cast("string").alias("label"), vectors[label_col].isNull().alias("no_label"))
    fine = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    src = src.filter(F.col("x").isNotNull() & fine)
    order = [F.col("vec_id").asc_nulls_last(), F.col("x")]
    head = src.orderBy(*order).limit(1).select(F.size("x").alias("n")).collect()
    layout = f"vec_id {src.schema['vec_id'].dataType.simpleString()}, {_STATE}"
    if not head:
        return spark.createDataFrame([], layout), [], scratch
    dim = head[0]["n"]
    src = src.filter(F.size("x") == dim)
    bound = isqrt((1 << 59) // max(1, -(-dim // parts))) // 2
    scaled = lambda e: F.greatest(F.least(F.floor(e.cast("double") * SCALE), F.lit(bound)), F.lit(-bound))
    seeds = src.orderBy(*order).limit(entries).select(F.transform("x", scaled).alias("v")).collect()
    first = np.array([r["v"] for r in seeds], np.int64).reshape(len(seeds), dim)
    books = [first[:, lo:hi] for lo, hi in cuts(dim, parts)]
    state = src.select("vec_id", "label", "no_label", F.transform("x", scaled).alias("v"),
                       F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("array<long>").alias("dist"))
    moved = None
    for k in range(rounds + 1):
        state = scratch.save(state.mapInArrow(_round(books, moved, dim), layout), f"round{k}")
        if k:
            scratch.drop(f"round{k - 1}")
        if k == rounds:
            break
        new = _means(state, books, dim)
        moved = [(a != b).any(axis=1) for a, b in zip(books, new)]
        books = new
        if not any(m.any() for m in moved):
            break
    return state, books, scratch


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, max_labels: int = MAX_LABELS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): one row per kept row."""
    state, books, scratch = compress(vectors, id_col, vector_col, label_col, parts, entries, rounds)
    digits = ",".join(str(x) for book in books for x in book.reshape(-1).tolist())
    code = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    error = F.aggregate("dist", F.lit(0).cast("long"), lambda a, d: a + d)
    rows = state.select("vec_id", "label", "no_label", code.alias("code"), error.alias("error"))
    key = ["label", "no_label"]
    keyed = rows.withColumn("label", F.coalesce("label", F.lit("")))
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error")
    sums = scratch.save(keyed.groupBy(*key).agg(total), "labels")
    if sums.limit(max_labels + 1).count() <= max_labels:
        out = keyed.join(F.broadcast(sums), key)
    else:
        salted = keyed.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))
        out = salted.join(sums.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")),
                          [*key, "salt"])
    return out.select("vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(digits.encode()).hexdigest()).alias("codebooks_sha256"))

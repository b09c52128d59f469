"""Approximate nearest neighbours by learned partitions.

1. A sample of about ``SAMPLE`` distinct vectors, drawn by a hash, gets its exact neighbour graph
   (tasks compare blocks of the sample with the broadcast sample).
2. The graph is partitioned: parts start as median cuts along principal directions, then vectors move to the
   part most of their neighbours are in, demand between parts cut down to quotas that keep every part within
   ``SLACK`` of the mean.
3. A small classifier (one hidden layer) learns how a vector's neighbours are spread over the parts. Sample vectors
   held out from it tell how many of its most probable parts hold ``TARGET`` of their neighbours; a smaller
   sample has farther neighbours than the whole table, so this errs towards more parts.
4. Every row is indexed under its most probable part. Queries go to their most probable parts, and to further
   ones until these hold enough rows for a full result.
5. Rows of a part and queries of a part are cut into blocks by hash, so a part of any size, as one with a third of
   all rows, is many small groups; each pair of blocks is one group. A group picks candidates by a matrix product and reranks
   them by the distance itself, in double precision on the original vectors, component after component.
   The best of all groups are merged per query.

The sample and the model are bounded by parameters; all rows are indexed. Vectors without structure need a large
part of the table at any recall, and step 3 then picks that many parts.

Edge cases: vectors that are NULL, zero, or hold NULL or non-finite components take no part, nor do rows without an
integer id or with another length than the most common (the longer of ties). Repeated rows are rows of their own: a
query's own row is left out, its copies are candidates. Equal distances are ordered by id. With fewer than ``PER_PART``
sample rows a part, there are fewer parts, down to one, which is an exact search. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketpulse.llm.common import Scratch

K = 10
#: Rows whose id is divisible by this are the queries.
EVERY = 100
#: Bound on the sample that the graph and the classifier are fitted on (expected rows; the draw is by hash).
SAMPLE = 16_384
PARTS, PER_PART = 64, 64
SLACK = 1.05
#: Share of held-out sample neighbours that the probed parts must hold.
TARGET = 0.97
HELD_OUT = 1_024
#: Expected rows of a block of a part, and of its queries.
BLOCK = 32_768
_STRIP = 128    # queries of a block compared at once


def rank_within(keys: np.ndarray) -> np.ndarray:
    """Place of each item among the earlier ones of its key."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    start = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.zeros(0, int)
    out = np.empty(len(s), np.int64)
    out[order] = np.arange(len(s)) - np.repeat(start, np.diff(np.r_[start, len(s)]))
    return out


def median_cuts(x: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Parts of equal size by repeated cuts along the widest direction."""
    label, todo = np.zeros(len(x), np.int64), [(np.arange(len(x)), 0, parts)]
    while todo:
        rows, lo, hi = todo.pop()
        if hi - lo == 1:
            label[rows] = lo
            continue
        mid, v, w = (lo + hi) // 2, x[rows] - x[rows].mean(axis=0), rng.normal(size=x.shape[1])
        for _ in range(15):
            w = v.T @ (v @ w)
            w /= np.linalg.norm(w) + 1e-300
        rows = rows[np.argsort(v @ w, kind="stable")]
        at = len(rows) * (mid - lo) // (hi - lo)
        todo += [(rows[:at], lo, mid), (rows[at:], mid, hi)]
    return label


def partition_graph(x: np.ndarray, near: np.ndarray, parts: int, rounds: int = 40, seed: int = 0) -> np.ndarray:
    """A part for each vector: balanced label propagation over the neighbour graph ``near`` (row → neighbours)."""
    rng, n = np.random.default_rng(seed), len(x)
    label = median_cuts(x, parts, rng)
    a, b = np.repeat(np.arange(n), near.shape[1]), near.reshape(-1)
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    capacity = np.ceil(SLACK * n / parts)
    for _ in range(rounds):
        votes = np.bincount(a * parts + label[b], minlength=n * parts).reshape(n, parts)
        own, want = votes[np.arange(n), label], votes.argmax(axis=1)
        gain = votes.max(axis=1) - own
        # Half of those who would gain ask: neighbours that swap places at once would gain nothing.
        ask = np.flatnonzero((gain > 0) & (rng.random(n) < 0.5))
        ask = ask[np.argsort(-gain[ask], kind="stable")]
        way = label[ask] * parts + want[ask]
        demand = np.bincount(way, minlength=parts * parts).reshape(parts, parts).astype(float)
        load, share = np.bincount(label, minlength=parts), np.ones((parts, parts))
        for _ in range(100):
            flow = demand * share
            inflow = flow.sum(axis=0)
            over = load + inflow - flow.sum(axis=1) - capacity
            if (over <= 1e-9).all():
                break
            share *= np.where((over > 0) & (inflow > 0), np.clip(1 - over / np.maximum(inflow, 1e-9), 0, 1), 1)[None, :]
        go = ask[rank_within(way) < np.floor(demand * share + 1e-9).reshape(-1)[way]]
        if not len(go):
            break
        label[go] = want[go]
    return label


class Router:
    """One hidden layer, softmax over the parts; trained by Adam on neighbour shares."""

    def __init__(self, mean: np.ndarray, scale: float, weights: list[np.ndarray]):
        self.mean, self.scale, self.weights = mean, scale, weights

    @classmethod
    def fit(cls, x: np.ndarray, share: np.ndarray, hidden: int = 128, epochs: int = 30, batch: int = 256, seed: int = 0):
        rng, (n, dim), parts = np.random.default_rng(seed), x.shape, share.shape[1]
        mean = x.mean(axis=0)
        scale = float(np.sqrt(((x - mean) ** 2).sum(axis=1).mean())) or 1.0
        x = ((x - mean) / scale).astype(np.float32)
        w = [rng.normal(size=(dim, hidden)) * np.sqrt(2.0), np.zeros(hidden), rng.normal(size=(hidden, parts)) / np.sqrt(hidden),
             np.zeros(parts)]
        w = [m.astype(np.float32) for m in w]
        first, second, step = [np.zeros_like(m) for m in w], [np.zeros_like(m) for m in w], 0
        for epoch in range(epochs):
            rate, order = 2e-3 * (1 - epoch / epochs) + 1e-4, rng.permutation(n)
            for at in range(0, n, batch):
                rows = order[at:at + batch]
                h = np.maximum(x[rows] @ w[0] + w[1], 0)
                g = (cls._softmax(h @ w[2] + w[3]) - share[rows]) / len(rows)
                back = (g @ w[2].T) * (h > 0)
                step += 1
                for k, grad in enumerate((x[rows].T @ back, back.sum(axis=0), h.T @ g, g.sum(axis=0))):
                    first[k] = 0.9 * first[k] + 0.1 * grad
                    second[k] = 0.999 * second[k] + 0.001 * grad ** 2
                    w[k] = w[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
        return cls(mean, scale, w)

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return self._softmax(np.maximum(((x - self.mean) / self.scale).astype(np.float32) @ w[0] + w[1], 0) @ w[2] + w[3])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _squares(q: np.ndarray, x: np.ndarray, norms: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return (q ** 2).sum(axis=1)[:, None] + norms[None, :] - 2 * (q @ x.T)


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distance of ``q`` to each row of ``x``, summed component after component."""
    total = np.zeros(len(x))
    with np.errstate(over="ignore"):
        for j in range(len(q)):
            total += (x[:, j] - q[j]) ** 2
    return np.sqrt(total)


def _sample_graph(spark, x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each sample row, compared in blocks on the executors."""
    shared, n = spark.sparkContext.broadcast(x), len(x)
    blocks = spark.range(0, -(-n // 512), 1, max(1, min(32, -(-n // 512))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = shared.value
        norms = (every ** 2).sum(axis=1)
        for b in batches:
            for block in b.column("id").to_pylist():
                rows = np.arange(block * 512, min(n, block * 512 + 512))
                d = _squares(every[rows], every, norms)
                d[np.arange(len(rows)), rows] = np.inf
                near = np.argsort(np.where(np.isnan(d), np.inf, d), axis=1, kind="stable")[:, :k] if n <= 4 * k else \
                    np.argpartition(np.where(np.isnan(d), np.inf, d), k - 1, axis=1)[:, :k]
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([near.astype(np.int64).tobytes()])], ["block", "near"])

    got = sorted(blocks.mapInArrow(run, "block long, near binary").collect())
    return np.concatenate([np.frombuffer(r["near"], np.int64) for r in got]).reshape(n, k)


def fit(spark, x: np.ndarray, k: int = K, parts: int = PARTS, target: float = TARGET, seed: int = 0) -> tuple[Router | None, int, int]:
    """(router, parts, parts to probe) from the sample vectors; no router where one part is enough."""
    x = np.unique(x, axis=0)
    x = x[np.random.default_rng(seed).permutation(len(x))]
    held = min(HELD_OUT, len(x) // 5)
    parts = min(parts, (len(x) - held) // PER_PART)
    if parts < 2 or len(x) - held <= k:
        return None, 1, 1
    train, test = x[held:], x[:held]
    near = _sample_graph(spark, train, k)
    label = partition_graph(train, near, parts, seed=seed)
    with_self = np.concatenate([np.arange(len(train))[:, None], near], axis=1)
    cell = np.repeat(np.arange(len(train)), k + 1) * parts + label[with_self].reshape(-1)
    share = np.bincount(cell, minlength=len(train) * parts).reshape(-1, parts).astype(np.float32) / (k + 1)
    router = Router.fit(train, share, seed=seed)
    home = router.probabilities(train).argmax(axis=1)
    norms, found = (train ** 2).sum(axis=1), np.zeros(parts)
    for at in range(0, held, 256):
        q = test[at:at + 256]
        d = _squares(q, train, norms)
        near = np.argpartition(np.where(np.isnan(d), np.inf, d), k - 1, axis=1)[:, :k]
        place = np.argsort(np.argsort(-router.probabilities(q), axis=1, kind="stable"), axis=1)
        found += np.bincount(np.take_along_axis(place, home[near], axis=1).reshape(-1), minlength=parts)
    enough = np.flatnonzero(np.cumsum(found) >= target * found.sum())
    return router, parts, int(enough[0]) + 1


def _indexed(router: Router | None, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("x"), dim)
            part = np.zeros(len(x), np.int32) if router is None else router.probabilities(x).argmax(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(part)], [*b.schema.names, "part"])
    return run


def _routed(router: Router | None, dim: int, probes: int, sizes: np.ndarray, need: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("x"), dim)
            order = (np.zeros((len(x), 1), np.int64) if router is None
                     else np.argsort(-router.probabilities(x), axis=1, kind="stable"))
            full = (np.cumsum(sizes[order], axis=1) < need).sum(axis=1) + 1
            routes = [o[:max(probes, m)].tolist() for o, m in zip(order, full)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(routes, pa.list_(pa.int32()))], [*b.schema.names, "routes"])
    return run


def nearest_of(q: np.ndarray, own: np.ndarray, x: np.ndarray, uid: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query's index, rows, distances): the k nearest rows of each query, equal distances by id, without its own row."""
    norms = (x ** 2).sum(axis=1)
    for at in range(0, len(q), _STRIP):
        strip = q[at:at + _STRIP]
        d = _squares(strip, x, norms)
        d[own[at:at + _STRIP, None] == uid[None, :]] = np.inf
        # What rounding can add to a product; rows within it of the k-th are compared by the distance itself.
        fuzz = 1e-12 * (np.abs(norms).max(initial=0) + (strip ** 2).sum(axis=1))
        last = np.partition(np.where(np.isnan(d), np.inf, d), k - 1, axis=1)[:, k - 1] if len(x) >= k else np.full(len(strip), np.inf)
        for i in range(len(strip)):
            close = np.flatnonzero((~(d[i] > last[i] + fuzz[i])) & (uid != own[at + i]))
            score = distances(strip[i], x[close])
            best = np.lexsort((ids[close], score))[:k]
            yield at + i, close[best], score[best]


def _search(dim: int, k: int):
    """Worker: one block of a part's rows and one block of its queries → the k nearest of each query."""
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"own": [], "query_id": [], "vec_id": [], "score": []}
        if rows.num_rows and queries.num_rows:
            x, q = (_matrix(t.column("x").combine_chunks(), dim) for t in (rows, queries))
            uid, ids, own, qid = (t.column(c).to_numpy() for t, c in
                                  ((rows, "uid"), (rows, "vec_id"), (queries, "uid"), (queries, "vec_id")))
            for i, best, score in nearest_of(q, own, x, uid, ids, k):
                out["own"].append(np.full(len(best), own[i]))
                out["query_id"].append(np.full(len(best), qid[i]))
                out["vec_id"].append(ids[best])
                out["score"].append(score)
        kinds = {"own": pa.int64(), "query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        return pa.table({c: pa.array(np.concatenate(v) if v else [], kinds[c]) for c, v in out.items()})
    return run


def nearest_neighbours(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = EVERY,
                       parts: int = PARTS, sample: int = SAMPLE, target: float = TARGET, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found for every row whose id ``every`` divides.

    Fits the partitions and writes the index to the shared folder while it is called."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "nearest")
    fine = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists("x", lambda e: e != 0)
    src = (vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].alias("x"))
           .filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & fine))
    lengths = src.groupBy(F.size("x").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("n")).limit(1).collect()
    result = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return spark.createDataFrame([], result)
    dim, total = lengths[0]["n"], lengths[0]["c"]
    src = src.filter(F.size("x") == dim)
    chosen = src
    if total > sample:
        chosen = src.filter(F.pmod(F.xxhash64("vec_id", "x"), F.lit(1 << 30)) < int((1 << 30) * sample / total))
    points = np.array([r["x"] for r in chosen.select("x").collect()], np.float64).reshape(-1, dim)
    router, parts, probes = fit(spark, points, k, parts, target)
    layout = f"vec_id long, x {src.schema['x'].dataType.simpleString()}"
    index = scratch.save(src.mapInArrow(_indexed(router, dim), f"{layout}, part int")
                         .withColumn("uid", F.monotonically_increasing_id()), "index")
    sizes = np.zeros(parts, np.int64)
    for r in index.groupBy("part").agg(F.count("*").alias("n")).collect():
        sizes[r["part"]] = r["n"]
    asked = scratch.save(index.filter(F.col("vec_id") % every == 0).select("vec_id", "x", "uid")
                         .mapInArrow(_routed(router, dim, probes, sizes, k + 1), f"{layout}, uid long, routes array<int>")
                         .select("vec_id", "x", "uid", F.explode("routes").alias("part")), "queries")
    asks = np.zeros(parts, np.int64)
    for r in asked.groupBy("part").agg(F.count("*").alias("n")).collect():
        asks[r["part"]] = r["n"]
    cut = lambda n: F.get(F.array(*[F.lit(int(max(1, -(-m // block)))) for m in n]), F.col("part"))
    at = lambda n: F.pmod(F.xxhash64("uid"), cut(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), cut(n) - 1))
    key = ["part", "slab", "strip"]
    left = index.select("*", at(sizes).alias("slab"), spread(asks).alias("strip"))
    right = asked.select("*", spread(sizes).alias("slab"), at(asks).alias("strip"))
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        _search(dim, k), "own long, query_id long, vec_id long, score double")
    best = Window.partitionBy("own").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

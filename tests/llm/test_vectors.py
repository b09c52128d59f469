"""Vector operators: codes and neighbours against brute-force versions."""

import math
import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketpulse.llm import nearest as nn
from marketpulse.llm.nearest import nearest_neighbours, nearest_of, partition_graph
from marketpulse.llm.vector_codes import assign, vector_codes

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int"
key = lambda rows: sorted(map(tuple, rows), key=repr)


def rows_of(df):
    return [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]


def gaussians(n, dim, seed=0, spread=0.3):
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(12, dim))
    return (at[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, dim))).astype(np.float32)


@pytest.fixture(scope="module")
def odd_rows():
    """NULLs, NaN, infinities, zeros, copies, repeated ids, other lengths, NULL labels, NULL ids, large components."""
    rng, rows = random.Random(5), []
    for k in range(240):
        rows.append((k, [rng.uniform(-1, 1) for _ in range(16)], rng.choice([0, 1, None])))
    copy = [0.25, -0.5] * 8
    rows += [(1000 + k, copy, 1) for k in range(150)] + [(1100, copy, 1), (1100, copy, 1), (100, copy, None)]
    rows += [(2000, None, 0), (2001, [None] + [1.0] * 15, 0), (2002, [math.nan] * 16, 0), (2003, [math.inf] + [0.0] * 15, 0),
             (2004, [], 0), (2005, [1.0] * 15, 0), (2006, [0.0] * 16, 0), (None, [0.5] * 16, None), (2100, [9e3, -9e3] * 8, 2)]
    return rows


def odd_table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA + ", x string, part int, code int")


# --- codes

def test_codes_equal_full_lloyd(spark, odd_rows):
    for rows in (rows_of(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")), odd_rows, odd_rows[:5], [(3, None, 1)], []):
        assert key(vector_codes(odd_table(spark, rows)).collect()) == key(brute.op12(rows)), len(rows)
    df = odd_table(spark, odd_rows)
    assert key(vector_codes(df, max_labels=1).collect()) == key(brute.op12(odd_rows))   # labels joined by shuffle


def test_active_entries_equal_a_full_scan():
    rng = np.random.default_rng(1)
    for _ in range(60):
        x, book = rng.integers(-4, 5, (80, 3)), rng.integers(-4, 5, (7, 3))
        code, dist = assign(x, book)
        moved = rng.random(7) < 0.4
        new = np.where(moved[:, None], rng.integers(-4, 5, (7, 3)), book)
        moved = (new != book).any(axis=1)
        got, want = assign(x, new, moved, code, dist), assign(x, new)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


# --- neighbours

def gap(v, w):
    total = 0.0
    for a, b in zip(v, w):    # sum() would compensate rounding
        total += (float(a) - float(b)) * (float(a) - float(b))
    return math.sqrt(total)


def exact(rows, k=10, every=100):
    """{(query id, its vector): [(score, id)]} by comparing everything."""
    out = []
    for i, (q, v, _) in enumerate(rows):
        if q is not None and q % every == 0:
            near = sorted((gap(v, w), c) for j, (c, w, _) in enumerate(rows) if j != i and c is not None)[:k]
            out += [(q, r + 1, c, s) for r, (s, c) in enumerate(near)]
    return out


def usable(rows, dim):
    return [r for r in rows if r[1] is not None and len(r[1]) == dim and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]


def recall(got, want):
    have = {}
    for q, _, c, _ in want:
        have.setdefault(q, []).append(c)
    hit = sum(len({g[2] for g in got if g[0] == q} & set(c)) for q, c in have.items())
    return hit / sum(map(len, have.values()))


def test_one_part_is_exact(spark, odd_rows):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], c) for i, v, c in odd_rows]
    got = nearest_neighbours(odd_table(spark, odd_rows), parts=1).collect()
    assert key(got) == key(exact(usable(rows, 16)))
    assert nearest_neighbours(odd_table(spark, [])).collect() == []
    few = rows[:4]
    assert key(nearest_neighbours(odd_table(spark, few)).collect()) == key(exact(few))


def test_learned_parts_find_nine_in_ten(spark, monkeypatch):
    x = gaussians(4000, 16)
    rows = [(int(i), v.tolist(), 0) for i, v in enumerate(x)] + [(5000 + k, x[7].tolist(), 0) for k in range(1500)]
    table = spark.createDataFrame(rows, SCHEMA)
    got = nearest_neighbours(table, parts=16, sample=2048, block=256).collect()    # a hot part in several blocks
    want = exact(rows)
    assert recall(got, want) >= 0.9
    true = {(q, c): s for q, _, c, s in exact(rows, k=60)}
    assert [r for r in got if true.get((r.query_id, r.vec_id), r.score) != r.score] == []
    for q in {r.query_id for r in got}:
        mine = sorted((r.rank, r.score, r.vec_id) for r in got if r.query_id == q)
        assert [r for r, _, _ in mine] == list(range(1, 11)) and [m[1:] for m in mine] == sorted(m[1:] for m in mine)
        assert q not in [m[2] for m in mine]


def test_driver_table_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert recall(nearest_neighbours(table).collect(), exact(rows_of(table))) >= 0.9


def test_parts_are_even_and_cut_few_edges():
    x = gaussians(1500, 8).astype(float)
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1)[:, :10]
    label = partition_graph(x, near, 10)
    assert np.bincount(label, minlength=10).max() <= math.ceil(nn.SLACK * 150)
    cut = (label[near] != label[:, None]).mean()
    dealt = np.arange(1500) % 10
    assert cut < 0.5 * (dealt[near] != dealt[:, None]).mean()


def test_ties_go_to_smaller_ids():
    x = np.array([[1.0, 0], [0, 1], [-1, 0], [0, -1], [1, 0]])
    ids = np.array([9, 3, 7, 1, 2])
    (_, rows, score), = nearest_of(np.zeros((1, 2)), np.array([-1]), x, np.arange(5), ids, 3)
    assert ids[rows].tolist() == [1, 2, 3] and score.tolist() == [1.0, 1.0, 1.0]

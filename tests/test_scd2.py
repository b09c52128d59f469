import random

from pyspark.sql import functions as F

from marketpulse.operators.scd2 import current, scd2_history


def _hist(df, **kw):
    h = scd2_history(df, ["k"], "seq", **kw)
    return sorted(((r["k"], r["v"], r["__START_AT"], r["__END_AT"]) for r in h.collect()), key=str)


def test_late_change_splits_open_version(spark):
    df = spark.createDataFrame([("A", "a1", 1), ("A", "a3", 3), ("A", "a2", 2)], "k string, v string, seq int")
    assert _hist(df) == [("A", "a1", 1, 2), ("A", "a2", 2, 3), ("A", "a3", 3, None)]


def test_redelivery_adds_no_version(spark):
    df = spark.createDataFrame([("A", "x", 1, 10), ("A", "x", 1, 11), ("A", "y", 2, 12)],
                               "k string, v string, seq int, ingested int")
    h = scd2_history(df, ["k"], "seq", tie_break=["ingested"]).collect()
    assert len(h) == 2 and {r.ingested for r in h} == {11, 12}


def test_untracked_change_is_folded(spark):
    df = spark.createDataFrame([("A", "x", "m1", 1), ("A", "x", "m2", 2), ("A", "y", "m3", 3),
                                ("B", None, "n", 1), ("B", None, "n2", 5)],
                               "k string, v string, note string, seq int")
    assert _hist(df, track=["v"]) == [("A", "x", 1, 3), ("A", "y", 3, None), ("B", None, 1, None)]


def test_history_properties_and_input_order(spark):
    rnd = random.Random(7)
    rows = [(f"K{rnd.randint(0, 9)}", rnd.choice("abc"), rnd.randint(0, 60)) for _ in range(400)]
    a = scd2_history(spark.createDataFrame(rows, "k string, v string, seq int"), ["k"], "seq",
                     tie_break=["v"], track=["v"])
    rnd.shuffle(rows)
    b = scd2_history(spark.createDataFrame(rows, "k string, v string, seq int"), ["k"], "seq",
                     tie_break=["v"], track=["v"])
    ra = sorted(map(tuple, a.collect()), key=str)
    assert ra == sorted(map(tuple, b.collect()), key=str)
    by_key = {}
    for k, v, s, e in ra:
        by_key.setdefault(k, []).append((s, e, v))
    for k, vs in by_key.items():
        vs.sort()
        assert sum(e is None for _, e, _ in vs) == 1            # exactly one open row
        for (s1, e1, v1), (s2, _, v2) in zip(vs, vs[1:]):
            assert e1 == s2 and s1 < e1 and v1 != v2           # contiguous, no overlap
    assert current(a).count() == len(by_key)


def _brute(rows, tracked=True):
    """(key, value, start, end) by walking each key's changes in order."""
    out, by_key = [], {}
    for k, v, s in rows:
        by_key.setdefault(k, {})[s] = max(v, by_key.get(k, {}).get(s, v), key=lambda x: (x is not None, x))
    for k, changes in by_key.items():
        at = sorted(changes)
        starts = [s for i, s in enumerate(at) if not tracked or not i or changes[s] != changes[at[i - 1]]]
        out += [(k, changes[s], s, e) for s, e in zip(starts, [*starts[1:], None])]
    return sorted(out, key=str)


def test_hot_key_over_many_slices_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr("marketpulse.operators.scd2.NUMERIC_SLICE", 7)
    rnd = random.Random(3)
    rows = [("HOT", rnd.choice(["a", "b", None]), i) for i in range(0, 3000, 2)]           # a third and more
    rows += [("CALM", "x", i) for i in range(500)] + [("LATE", "x", 900), ("LATE", "y", 5)]
    rows += [(f"k{rnd.randint(0, 300)}", rnd.choice(["a", "b"]), rnd.randint(0, 10**4)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, v string, seq int")
    assert _hist(df, tie_break=["v"], track=["v"]) == _brute(rows)
    assert _hist(df, tie_break=["v"]) == _brute(rows, tracked=False)


def test_history_leaves_nothing_behind(spark):
    """Rows meet one shuffle by (key, slice) after the fold; no checkpoint is written."""
    import os
    folder = spark.conf.get("spark.checkpoint.dir")
    size = lambda: sum(len(f) for _, _, f in os.walk(folder))
    before = size()
    df = spark.createDataFrame([("A", "x", 1), ("A", "y", 2)], "k string, v string, seq int")
    h = scd2_history(df, ["k"], "seq", track=["v"])
    assert h.count() == 2 and size() == before
    plan = h._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Join" not in plan

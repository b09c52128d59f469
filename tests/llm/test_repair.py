"""Conversation structure repair against a brute-force version."""

import os
import random
import sys

import pytest

from marketpulse.llm.repair import BlockTables, SYMBOLS, _hash_batches, repair, repair_damaged

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string"
key = lambda rows: sorted(map(tuple, rows), key=repr)


def texts_of(symbols):
    """Rows (turn, role, text) that have these symbols."""
    roles = dict(zip("suao", ("system", "user", "assistant", "tool")))
    rows = []
    for k, s in enumerate(symbols):
        at = SYMBOLS.index(s)
        rows.append((k, roles["suao"[at // 4]], {0: f"Line {k}.", 1: f"line {k}", 2: " \t"}[at % 4]))
    return rows


@pytest.mark.parametrize("block", [1, 2, 3])
def test_block_tables_equal_all_edits(block):
    tables, rng = BlockTables(block), random.Random(block)
    usual = [s for s in SYMBOLS if SYMBOLS.index(s) % 4 < 3]
    for _ in range(400):
        symbols = "".join(rng.choice(usual) for _ in range(rng.randrange(12)))
        want = brute.repaired(texts_of(symbols))
        assert tables.solve(symbols) == (want[5], want[6]), symbols


def test_driver_table(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert key(repair_damaged(turns).collect()) == key(brute.op13(rows))


def test_edge_rows(spark):
    rng = random.Random(7)
    rows = [(None, None, None, None), (None, 1, "user", "No id."), (None, 1, "user", "No id."), (1, None, "user", "First."),
            (1, -5, "assistant", "Negative."), (1, 10 ** 12, "assistant", "Late."), (2, 0, "", "No role."), (2, 0, "", "No role."),
            (3, 0, "system", "Only system."), (4, 0, "user", "x" * 60_000), (4, 1, "assistant", " " * 60_000 + "." + " " * 60_000),
            (5, 0, "user", None), (6, 0, "user", "Ends with a dot.\n "), (7, 0, "user", " "), (8, 3, "User", "Case.")]
    roles = ["system", "user", "assistant", "tool", None, "Üser", "user"]
    for conv in range(100, 160):
        for _ in range(rng.randrange(1, 14)):
            rows.append((conv, rng.choice([None, *range(8)]), rng.choice(roles), rng.choice(["Yes.", "no", "Really?", "", " ", None, "Go!\t"])))
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", pos string, piece int")
    assert key(repair_damaged(turns).collect()) == key(brute.op13(rows))
    assert repair_damaged(turns.limit(0)).collect() == []


def test_long_conversation_in_many_pieces(spark, monkeypatch):
    """A conversation over several pieces and partitions, with many equal rows."""
    monkeypatch.setattr("marketpulse.llm.repair.PIECE", 4)
    rng = random.Random(3)
    rows = [(9, k // 3, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"Line {k}.", f"line {k}", ""])) for k in range(400)]
    rows += [(9, 500, "user", "Copy.")] * 300 + [(10, k, "user", "Hello.") for k in range(20)]
    turns = spark.createDataFrame(rows, SCHEMA)
    want = [(c, *brute.repaired(sorted([r[1:] for r in rows if r[0] == c], key=lambda r: (r[0], r[1], r[2])))) for c in (9, 10)]
    assert key(repair(turns, turns).collect()) == key(want)

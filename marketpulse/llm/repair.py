"""Conversation structure repair: cheapest edits by Four-Russians block tables.

A conversation is valid when its role initials read ``(s?(ua)+)?``. Each row is one
symbol: its role's initial (s, u, a or other) and whether it is sound, truncated, blank
or a duplicate. The edits are Keep (0), Rerole to user or assistant (1), Delete (2, the
only edit of blank and duplicate rows), and Insert of an empty user or assistant turn (5);
a truncated row that is not deleted costs 5 more.

Suffix costs form a vector over the four states of the pattern (nothing yet, after a
system turn, after a user turn, after an assistant turn). Less its minimum, only few
such vectors can arise, so a table holds, for every vector and every block of ``BLOCK``
symbols, the vector before the block and what was added. A conversation is read from its
end by one lookup a block, the vectors at block ends are remembered, and the edits are
then traced from its start: each block is expanded backward from the vector at its end,
and of the edits on a cheapest path the ASCII-least letter is taken. In each state a letter
leads to one state only, so this gives the least audit string. Expansions are remembered
per (vector at the end, block, state), so repeated blocks cost a lookup too.

On Spark: rows are range-partitioned on (conversation, turn, role, text), so a
conversation of any size is dealt over many tasks; their order number cuts them into
pieces of at most ``PIECE`` rows. Copies are found by a grouped minimum over hashes of
(conversation, role, text) and marked by a join on the unique order number. Symbols, one
byte a row, are gathered per conversation (the audit, one cell of the result, has the
same size); texts never are: the repaired text is hashed while rows stream by in order.

Edge cases: turns sort NULLs first, equal turns by role, then text, then row; NULL roles
and texts are one space, as are NULLs in the damaging key; a role's initial is its first
character as written, rows with other initials can be reroled or deleted; rows without a
conv_id form one conversation. A conversation that lost all its rows has zeros, an empty
audit and the hash of nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import Scratch

#: Fixed values of the contract: costs, the states' next state for u and a, what a text ends with.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLOCK = 3
PIECE = 1 << 12
_NONE = 1 << 20     # no path
# States: 0 nothing yet, 1 after the system turn, 2 after a user turn, 3 after an assistant turn.
_TURN = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}   # the one user or assistant turn a state allows
_END = (0, 2 * INSERT, INSERT, 0)                               # cheapest inserts to a valid end
_ROLES = {"u": "user", "a": "assistant"}
#: One byte a row: initials s, u, a, other, each sound, truncated, blank, duplicate.
SYMBOLS = "stbdUTBDaAxyo0pq"
_INITIAL = {c: "suao"[k // 4] for k, c in enumerate(SYMBOLS)}
_FAULT = {c: k % 4 for k, c in enumerate(SYMBOLS)}


def _edits(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of a row's edits but inserts, ASCII order."""
    out = [("D", DELETE, state)]
    if _FAULT[symbol] < 2:
        extra = TRUNCATED if _FAULT[symbol] == 1 else 0
        role, after = _TURN[state]
        if _INITIAL[symbol] == role:
            out.append(("K", KEEP + extra, after))
        elif _INITIAL[symbol] == "s" and state == 0:
            out.append(("K", KEEP + extra, 1))
        out.append(("R", REROLE + extra, after))
    return out


def _before(symbol: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """Suffix costs before a row from those after it, inserts ahead of the row included."""
    cost = [min(c + after[q] for _, c, q in _edits(symbol, state)) for state in range(4)]
    for _ in range(3):   # the longest useful chain of inserts
        cost = [min(cost[s], INSERT + cost[_TURN[s][1]]) for s in range(4)]
    return tuple(cost)


class BlockTables:
    """Normalised suffix-cost vectors, block transitions and traced expansions."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors, self.index = [_END], {_END: 0}
        self.step: list[dict[str, tuple[int, int]]] = []
        k = 0
        while k < len(self.vectors):   # every vector that can arise
            row = {}
            for s in SYMBOLS:
                cost = _before(s, self.vectors[k])
                low = min(cost)
                v = tuple(c - low for c in cost)
                if v not in self.index:
                    self.index[v] = len(self.vectors)
                    self.vectors.append(v)
                row[s] = (self.index[v], low)
            self.step.append(row)
            k += 1
        # Blocks grow by one symbol in front: the table of every fixed-length block.
        table = [{"": (k, 0)} for k in range(len(self.vectors))]
        for _ in range(block):
            longer = []
            for row in table:
                grown = {}
                for word, (at, added) in row.items():
                    for s, (to, low) in self.step[at].items():
                        grown[s + word] = (to, added + low)
                longer.append(grown)
            table = longer
        self.table = table
        self.traced: dict[tuple[int, str, int], tuple[str, int]] = {}

    def _expand(self, at: int, word: str, state: int) -> tuple[str, int]:
        """(edits, state after) of a block entered in ``state``, the vector at its end being ``at``."""
        key = (at, word, state)
        if key in self.traced:
            return self.traced[key]
        costs = [self.vectors[at]]
        for s in reversed(word):
            costs.append(_before(s, costs[-1]))
        costs.reverse()
        out = []
        for k, s in enumerate(word):
            here, after = costs[k], costs[k + 1]
            done = False
            while not done:
                want = here[state]
                options = [(e, q, True) for e, c, q in _edits(s, state) if c + after[q] == want]
                if here[_TURN[state][1]] + INSERT == want:
                    options.append(("I", _TURN[state][1], False))
                letter, state, done = min(options)
                out.append(letter)
        self.traced[key] = "".join(out), state
        return self.traced[key]

    def solve(self, symbols: str) -> tuple[int, str]:
        """(cost, audit) of a conversation."""
        words = [symbols[k:k + self.block] for k in range(0, len(symbols), self.block)]
        at, cost, ends = 0, 0, [0] * len(words)
        for k in range(len(words) - 1, -1, -1):
            ends[k] = at
            if len(words[k]) == self.block:
                at, added = self.table[at][words[k]]
                cost += added
            else:   # the last block may be shorter
                for s in reversed(words[k]):
                    at, added = self.step[at][s]
                    cost += added
        cost += self.vectors[at][0]
        state, out = 0, []
        for word, end in zip(words, ends):
            piece, state = self._expand(end, word, state)
            out.append(piece)
        out.append("I" * (_END[state] // INSERT))
        return cost, "".join(out)


def illegal_pairs(symbols: str) -> int:
    """Adjacent rows whose initials are not su, ua or au."""
    text = "".join(_INITIAL[s] for s in symbols)
    return max(0, len(text) - 1) - sum(text.count(p) for p in ("su", "ua", "au"))


def _slices(audit: str, sizes: list[int]) -> list[str]:
    """The audit cut after every ``sizes`` rows; inserts go with the row they precede, the last ones with the last row."""
    out, at = [], 0
    for k, n in enumerate(sizes):
        start = at
        while n:
            n -= audit[at] != "I"
            at += 1
        out.append(audit[start:at] if k < len(sizes) - 1 else audit[start:])
    return out


def _solve_batches(block: int):
    """Worker: (conv_id, pieces of symbols) → counts, cost, audit and the audit's slice and first state per piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = BlockTables(block)
        for b in batches:
            out = {c: [] for c in ("blank", "duplicate", "truncated", "illegal", "cost", "audit", "slices")}
            for pieces in b.column("pieces").to_pylist():
                symbols = "".join(p["symbols"] for p in pieces)
                cost, audit = tables.solve(symbols)
                faults = [sum(symbols.count(s) for s in SYMBOLS[f::4]) for f in range(4)]
                out["truncated"].append(faults[1])
                out["blank"].append(faults[2])
                out["duplicate"].append(faults[3])
                out["illegal"].append(illegal_pairs(symbols))
                out["cost"].append(cost)
                out["audit"].append(audit)
                cut = _slices(audit, [len(p["symbols"]) for p in pieces])
                out["slices"].append([{"piece": p["piece"], "edits": e} for p, e in zip(pieces, cut)])
            arrays = [b.column("conv_id"), *[pa.array(out[c], pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
                      pa.array(out["audit"], pa.string()),
                      pa.array(out["slices"], pa.list_(pa.struct([("piece", pa.int64()), ("edits", pa.string())])))]
            yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "slices"])
    return run


def _hash_batches(key: str):
    """Worker: rows sorted by (conversation, piece, edits first, order) → hash of each repaired conversation.

    One text is held at a time; a conversation's rows follow each other in one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, ident, digest, lines, state, edits = False, None, None, 0, 0, iter("")
        done_ids, done = [], []

        def write(role: str, text: str) -> None:
            nonlocal lines
            digest.update((("\n" if lines else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
            lines += 1

        def insert() -> None:
            nonlocal state
            role, state = _TURN[state]
            write(_ROLES[role], "")

        def close() -> None:
            done_ids.append(ident)
            done.append(digest.hexdigest())

        for b in batches:
            kind = b.schema.field("conv_id").type
            cols = [b.column(c).to_pylist() for c in ("conv_id", "slice", "role", "text")]
            for conv, part, role, text in zip(*cols):
                if not started or conv != ident:
                    if started:
                        close()
                    started, ident, digest, lines, state, edits = True, conv, hashlib.sha256(), 0, 0, iter("")
                if part is not None:
                    edits = iter(part)
                    if not part.strip("I"):   # no row of its own
                        for _ in part:
                            insert()
                    last = part.rstrip("I")
                    tail, rows = len(part) - len(last), sum(c != "I" for c in last)
                    continue
                letter = next(edits)
                while letter == "I":
                    insert()
                    letter = next(edits)
                if letter == "K":
                    state = 1 if state == 0 and role[:1] == "s" else _TURN[state][1]
                    write(role, text)
                elif letter == "R":
                    initial, state = _TURN[state]
                    write(_ROLES[initial], text)
                rows -= 1
                if not rows:
                    for _ in range(tail):
                        insert()
            if done_ids:
                yield pa.RecordBatch.from_arrays([pa.array(done_ids, kind), pa.array(done, pa.string())], ["conv_id", key])
                done_ids, done = [], []
        if started:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(done_ids, kind), pa.array(done, pa.string())], ["conv_id", key])
    return run


def damage(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) damaged by the checksum of ``conv_id:turn``, as the contract fixes it."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), kind.alias("kind"))
    text = (F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (rows.filter("kind != 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    text.alias("text"), copies.alias("copy")).drop("copy"))


def _symbol(duplicate: Column) -> Column:
    initial = F.coalesce(F.expr("nullif(position(substring(role, 1, 1) IN 'sua'), 0)"), F.lit(4)) - 1
    initial = F.when(F.col("role") == "", F.lit(3)).otherwise(initial)
    fault = F.when(F.col("blank"), 2).when(duplicate, 3).when(F.col("open"), 1).otherwise(0)
    return F.substring(F.lit(SYMBOLS), initial * 4 + fault + 1, F.lit(1))


def repair(rows: DataFrame, conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every row of
    ``conversations`` (conv_id), from the turns ``rows`` (conv_id, turn, role, text) without NULL roles or texts.

    Runs jobs while it is called; two tables in the shared folder hold the ordered rows and the edits."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "repair")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "salt"]
    trimmed = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    salted = rows.select("*", F.monotonically_increasing_id().alias("salt"))   # splits equal rows
    ranged = scratch.save(
        salted.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("pos"),
                (trimmed == "").alias("blank"), (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("open"),
                F.xxhash64(F.col("conv_id").isNull(), "conv_id", "role", F.lit("\n"), "text").alias("h1"),
                F.md5(F.concat_ws("\n", F.col("role"), F.col("text"))).alias("h2")), "ranged")
    first = ranged.groupBy("h1", "h2", "conv_id").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("is_first"))
    marked = ranged.select("conv_id", "pos", "role", "blank", "open").join(first, "pos", "left")
    piece = F.shiftright("pos", PIECE.bit_length() - 1)
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", c))), lambda s: s[c]), "")
    pieces = (marked.select("conv_id", "pos", piece.alias("piece"), _symbol(F.col("is_first").isNull()).alias("symbol"))
              .groupBy("conv_id", "piece").agg(joined("symbol").alias("symbols"))
              .groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("piece", "symbols"))).alias("pieces")))
    ident = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    solved = scratch.save(pieces.mapInArrow(
        _solve_batches(block), f"{ident}, {', '.join(c + ' long' for c in counts)}, audit string, "
        "slices array<struct<piece: long, edits: string>>"), "solved")
    head = solved.select("conv_id", F.explode("slices").alias("s")).select(
        "conv_id", F.col("s.piece").alias("piece"), F.lit(-1).cast("long").alias("pos"), F.col("s.edits").alias("slice"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    body = ranged.select("conv_id", piece.alias("piece"), "pos", F.lit(None).cast("string").alias("slice"), "role", "text")
    hashes = (head.unionByName(body).repartition(parts, "conv_id").sortWithinPartitions("conv_id", "piece", "pos")
              .mapInArrow(_hash_batches("repaired_sha256"), f"{ident}, repaired_sha256 string"))
    turns = ranged.filter("turn IS NOT NULL").select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).cast("long").alias("gaps"))
    all_ids = conversations.select("conv_id").distinct()
    every = (all_ids.unionByName(turns, True).unionByName(solved.drop("slices"), True).unionByName(hashes, True)
             .groupBy("conv_id").agg(*[F.max(c).alias(c) for c in ["gaps", *counts, "audit", "repaired_sha256"]]))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return every.select("conv_id", *[zero(c) for c in ["gaps", *counts]], F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def repair_damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``repair`` of the turns after ``damage``, for every original conversation."""
    slim = turns.select(turns[conv_col].alias("conv_id"), turns[turn_col].alias("turn"), turns[role_col].alias("role"),
                        turns[text_col].alias("text"))
    return repair(damage(slim), slim, block)

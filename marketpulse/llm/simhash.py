"""SimHash near-duplicates: bit-sliced distances inside blocks of fingerprints.

1. One pass over the texts gives a 64-bit fingerprint per document.
2. Distinct fingerprints are cut into radius + 2 bit blocks; two fingerprints
   within the radius agree on at least two blocks, so each is filed once per
   pair of blocks. A bucket with too many members is filed again under half of
   its remaining bits, which bounds what one task holds.
3. Inside a bucket the fingerprints are stored as vertical bit planes: word p
   holds bit p of 64 fingerprints. One query against 64 lanes is an XOR per
   plane, summed by carry-save counters of a few words; a group of lanes is
   given up as soon as all of them exceed the radius.
4. Each bucket returns a spanning forest of its links, never all pairs; star
   contraction joins the forests into components.

Edge cases: NULL or blank text has fingerprint zero and links like any other;
rows with equal doc_id are fingerprinted separately; a NULL doc_id is never a
component id unless the whole component has none; an empty table gives an
empty result.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import Scratch, drop_keyed, id_text
from marketpulse.llm.components import component_roots

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Distinct fingerprints in a bucket beyond which it is filed again by more bits.
HOT_BUCKET = 2048
_CHUNK = 1 << 16


def fingerprint(data: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bitwise majority of the XXH64 values of the word shingles."""
    w = (data or b"").lower().split()
    if not w:
        return 0
    if len(w) < shingle:
        grams, n = [b" ".join(w)], 1
    else:
        grams, n = map(b" ".join, zip(*(w[i:] for i in range(shingle)))), len(w) - shingle + 1
    h = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), grams), np.uint64, n)
    count = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        bits = np.unpackbits(h[at:at + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * count > n, bitorder="little").view(np.uint64)[0])


def text_keys(text: Column) -> dict[str, Column]:
    """128 bits that tell texts apart; NULL is not the empty text."""
    return {f"key{k}": F.xxhash64(F.lit(k), text.isNull(), text) for k in (1, 2)}


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, key1, key2, fp): one row per input row; fp is the fingerprint as a signed long, the keys name the text."""
    src = id_text(docs, id_col, text_col)
    src = src.select("doc_id", *[c.alias(n) for n, c in text_keys(F.col("text")).items()], F.col("text").cast("binary").alias("text"))
    names = ["doc_id", "key1", "key2", "fp"]

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(3).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(fp.view(np.int64))], names)

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, key1 long, key2 long, fp long")


# --- bit-sliced comparison ---------------------------------------------------

def bit_planes(lanes: np.ndarray) -> np.ndarray:
    """(blocks, 64 lanes) values to (blocks, 64 planes): bit i of plane p is bit p of lane i."""
    bits = np.unpackbits(lanes.view(np.uint8).reshape(len(lanes), 64, 8), axis=2, bitorder="little")
    planes = np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(planes).view(np.uint64).reshape(len(lanes), 64)


def _beyond(counter: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose sliced count is greater than the radius."""
    more, same = over.copy(), ~over
    for k in reversed(range(len(counter))):
        if radius >> k & 1:
            same &= counter[k]
        else:
            more |= same & counter[k]
            same &= ~counter[k]
    return more


def lanes_within(planes: np.ndarray, block: np.ndarray, query: np.ndarray, lanes: np.ndarray,
                 radius: int, stride: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """For each (query, block) pair, the lanes within the radius.

    ``lanes`` masks the lanes of interest. Returns the indices of the pairs
    that have such lanes, and their masks.
    """
    at = np.arange(len(query))
    width = max(1, radius.bit_length())
    counter = [np.zeros(len(query), np.uint64) for _ in range(width)]
    over = np.zeros(len(query), np.uint64)
    for p in range(64):
        carry = planes[block, p] ^ (np.uint64(0) - (query >> np.uint64(p) & np.uint64(1)))
        for k in range(width):
            counter[k], carry = counter[k] ^ carry, counter[k] & carry
        over |= carry
        if p % stride == stride - 1:
            left = lanes & ~_beyond(counter, over, radius)
            alive = left != 0
            if not alive.all():
                at, block, query, lanes, over = (x[alive] for x in (at, block, query, lanes, over))
                counter = [c[alive] for c in counter]
                left = left[alive]
            if not len(at):
                break
    return at, (left if len(at) else lanes[:0])


def _forest_small(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, radius: int):
    """Links of many buckets of at most 64 values each: (value, root value) pairs."""
    n = len(sizes)
    slot = np.arange(len(values)) - np.repeat(starts, sizes)
    bucket = np.repeat(np.arange(n), sizes)
    grid = np.zeros((n, 64), np.uint64)
    grid[bucket, slot] = values
    planes = bit_planes(grid)
    full = (~np.uint64(0)) >> (np.uint64(64) - sizes.astype(np.uint64))
    later = full[bucket] & ~((np.uint64(2) << slot.astype(np.uint64)) - np.uint64(1))
    later[slot == 63] = 0
    root = np.arange(len(values))
    src, dst = [], []
    for a in range(0, len(values), _CHUNK):
        b = min(len(values), a + _CHUNK)
        at, mask = lanes_within(planes, bucket[a:b], values[a:b], later[a:b], radius)
        hit = np.unpackbits(mask.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        i, lane = np.nonzero(hit)
        src.append(at[i] + a)
        dst.append(starts[bucket[at[i] + a]] + lane)
    src, dst = np.concatenate(src), np.concatenate(dst)
    while len(src):
        before = root.copy()
        low = np.minimum(root[src], root[dst])
        np.minimum.at(root, root[src], low)
        np.minimum.at(root, root[dst], low)
        root = root[root]
        if (root == before).all() and (root[src] == root[dst]).all():
            break
    moved = np.nonzero(root != np.arange(len(root)))[0]
    return values[moved], values[root[moved]]


def _forest_large(values: np.ndarray, radius: int):
    """Links of one larger bucket: breadth first, each value queries the lanes not yet reached."""
    n = len(values)
    blocks = -(-n // 64)
    grid = np.zeros((blocks, 64), np.uint64)
    grid.reshape(-1)[:n] = values
    planes = bit_planes(grid)
    left = np.full(blocks, ~np.uint64(0))
    if n % 64:
        left[-1] = (np.uint64(1) << np.uint64(n % 64)) - np.uint64(1)
    src, dst = [], []
    for seed in range(n):
        if not left[seed >> 6] >> np.uint64(seed & 63) & np.uint64(1):
            continue
        left[seed >> 6] ^= np.uint64(1) << np.uint64(seed & 63)
        queue = [seed]
        while queue:
            i = queue.pop()
            live = np.nonzero(left)[0]
            if not len(live):
                break
            at, mask = lanes_within(planes, live, np.full(len(live), values[i]), left[live], radius)
            if len(at):
                left[live[at]] &= ~mask
                k, lane = np.nonzero(np.unpackbits(mask.view(np.uint8).reshape(-1, 8), axis=1,
                                                   bitorder="little"))
                found = live[at[k]] * 64 + lane
                src.append(values[found])
                dst.append(np.full(len(found), values[seed]))
                queue.extend(found.tolist())
    if not src:
        return values[:0], values[:0]
    return np.concatenate(src), np.concatenate(dst)


def bucket_forest(batches, radius: int):
    """Arrow batches of one column ``fps`` (array of long) to spanning links (u, v)."""
    for b in batches:
        col = b.column(0)
        values = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        sizes = col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        small = sizes <= 64
        out = []
        if small.any():
            pick = np.repeat(small, sizes)
            s = sizes[small]
            out.append(_forest_small(values[pick], np.cumsum(s) - s, s, radius))
        for i in np.nonzero(~small)[0]:
            out.append(_forest_large(values[starts[i]:starts[i] + sizes[i]], radius))
        if out:
            u, v = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])


# --- candidate buckets ---------------------------------------------------------

def _cut(lo: int, hi: int, parts: int) -> list[tuple[int, int]]:
    edge = [lo + (hi - lo) * i // parts for i in range(parts + 1)]
    return list(zip(edge, edge[1:]))


def _bits(fp: Column, ranges) -> Column:
    key = F.lit(0).cast("long")
    for lo, hi in ranges:
        part = F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1).cast("long"))
        key = F.shiftleft(key, hi - lo).bitwiseOR(part)
    return key


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """(u, v) links that connect exactly the fingerprints within the radius of
    each other. ``fps`` holds distinct values in column fp."""
    if radius == 0:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    blocks = _cut(0, 64, radius + 2)
    pairs = list(combinations(range(len(blocks)), 2))
    fp = F.col("fp")
    filed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), _bits(fp, [blocks[i], blocks[j]]).alias("key"))
        for t, (i, j) in enumerate(pairs)])).alias("k")).select("fp", "k.t", "k.key")
    size = filed.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    # Of the other blocks, halved, at most `radius` halves differ: the rest agree.
    finer = F.lit(None)
    for t, (i, j) in enumerate(pairs):
        halves = [h for k, (lo, hi) in enumerate(blocks) if k not in (i, j) for h in _cut(lo, hi, 2)]
        keys = F.array(*[F.struct(F.lit(s + 1).alias("s"), _bits(fp, pick).alias("sub"))
                         for s, pick in enumerate(combinations(halves, len(halves) - radius))])
        finer = F.when(F.col("t") == t, keys).otherwise(finer)
    one = F.array(F.struct(F.lit(0).alias("s"), F.lit(0).cast("long").alias("sub")))
    buckets = (filed.join(size, ["t", "key"])
               .select("fp", "t", "key", F.explode(F.when(F.col("n") > hot_bucket, finer).otherwise(one)).alias("x"))
               .groupBy("t", "key", "x.s", "x.sub").agg(F.collect_list("fp").alias("fps"))
               .filter(F.size("fps") > 1).select("fps"))
    return buckets.mapInArrow(partial(bucket_forest, radius=radius), "u long, v long")


def _members(rows: DataFrame, scratch: Scratch, radius: int) -> DataFrame:
    """(fp, first_id, n, root): each distinct fingerprint with its rows and its component."""
    nodes = scratch.save(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")), "nodes")
    roots = component_roots(fingerprint_links(nodes.select("fp"), radius), scratch)
    return (nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
            .select("fp", "first_id", "n", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per input row.

    component_id is the smallest doc_id reachable over links of at most
    ``radius`` differing bits. Runs jobs while it is called: fingerprints and
    links are written to the shared folder.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.save(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    member = _members(rows, scratch, radius)
    lowest = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = member.join(lowest, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that lead their group: exactly one of each group stays, NULL ids and repeated ids included.

    Rows are told apart by (id, text): unlinked texts of one id both stay, and of copies without an id one does.
    The leader has the smallest id (NULL last), then the smallest text hash; rows that repeat the leader's id and
    text are reduced to one. Only the keys of rows to drop are joined with the texts.
    """
    scratch = Scratch(docs.sparkSession, "simhash-kept")
    rows = scratch.save(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    member = _members(rows, scratch, radius)
    many = member.join(member.groupBy("root").agg(F.sum("n").alias("rows")).filter("rows > 1").select("root"), "root")
    who = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key1", "key2")
    linked = scratch.save(rows.join(many.select("fp", "root"), "fp").groupBy("root", who.alias("who"))
                          .agg(F.count("*").alias("n")), "linked")
    leads = linked.groupBy("root").agg(F.min("who").alias("lead"))
    marked = linked.join(leads, "root").select("who.*", "n", (F.col("who") == F.col("lead")).alias("is_lead"))
    marked = scratch.save(marked.drop("no_id"), "marked")
    key = {"doc_id": docs[id_col], **text_keys(docs[text_col])}
    kept = drop_keyed(docs, marked.filter("NOT is_lead"), key)
    twice = marked.filter("is_lead AND n > 1").drop("n", "is_lead")
    if twice.limit(1).count():   # the leader's row itself is repeated: leave one row of each
        parts = [F.col(c) for c in docs.columns]
        named = docs.select(*parts, *[value.alias(f"_lead_{c}") for c, value in key.items()])
        same = F.lit(True)
        for c in key:
            same = same & F.col(f"_lead_{c}").eqNullSafe(twice[c])
        ones = named.join(twice, same, "left_semi").dropDuplicates([f"_lead_{c}" for c in key]).select(*docs.columns)
        kept = drop_keyed(kept, twice, key).union(ones)
    return kept

"""Repeated byte strings by a run-compressed Burrows-Wheeler index.

The repeated pieces of the collection (see ``passages``) are compared in blocks
of bounded size, the pieces of one anchor always in one block. A block's cuts
are sorted by their suffixes into a Burrows-Wheeler transform, of which only
the runs matter: a suffix whose left neighbour in the transform has the same
letter matches one symbol less than the suffix before it in the text. So match
lengths are computed and sampled at the run ends alone, and one stream over the
text fills in the matching statistics between the samples. Where the longer of
the two neighbours' matches reaches the window, the window occurs elsewhere.
An anchor with too many cuts is compared by shuffles of their parts.

Edge cases: NULL is an empty text; texts shorter than a window keep all bytes;
repeated rows are repeats of each other, whatever their ids; removing bytes may
cut a character, so kept texts are bytes; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import Scratch
from marketpulse.llm.passages import (RANGES, Units, compared_cuts, in_groups, removed_runs, repeated_pieces, sources,
                                      split_by_load, verdicts, window_verdicts, with_spans)

WINDOW = 200
GRAM = 64
#: Bytes of cuts that are indexed together.
BLOCK_BYTES = 1 << 16
_SYMBOLS_PER_KEY = 7   # nine bits each, in one unsigned 64-bit key


def byte_units(window: int = WINDOW, gram: int = GRAM) -> Units:
    code = np.random.default_rng(7).integers(0, 2 ** 64, 256, dtype=np.uint64)
    return Units(split=lambda data: data, codes=lambda data: code[np.frombuffer(data, np.uint8)],
                 pack=bytes, codes_of=lambda texts: (code[np.frombuffer(b"".join(texts), np.uint8)],
                                                     np.fromiter(map(len, texts), np.int64, len(texts))),
                 cuts_of=lambda texts, row, lo, hi: [texts[i][a:b] for i, a, b in zip(row.tolist(), lo.tolist(), hi.tolist())],
                 window=window, gram=gram)


def suffix_order(symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Positions of ``symbols`` in the order of their suffixes, by prefix doubling.

    Symbol 0 ends a cut, ``left`` is the number of symbols up to that end. Equal
    suffixes of different cuts keep their order, as if their ends differed.
    """
    n = len(symbols)
    key = np.zeros(n, np.uint64)
    wide = np.concatenate([symbols, np.zeros(_SYMBOLS_PER_KEY, np.uint64)])
    for k in range(_SYMBOLS_PER_KEY):
        key = (key << np.uint64(9)) | np.where(left >= k, wide[k:k + n], np.uint64(0))
    reach, longest = _SYMBOLS_PER_KEY, int(left.max()) + 1
    while True:
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        step = np.concatenate([[False], ranked[1:] != ranked[:-1]])
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(step).astype(np.uint64) + np.uint64(1)
        if reach >= longest or step[1:].all():
            return order
        beyond = np.zeros(n, np.uint64)
        inside = np.nonzero(left >= reach)[0]
        beyond[inside] = rank[inside + reach]
        key = rank * np.uint64(n + 2) + beyond
        reach *= 2


def common_prefix(symbols: np.ndarray, left: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b``, without their ends."""
    most = np.minimum(left[a], left[b])
    length = np.zeros(len(a), np.int64)
    live = np.nonzero(most > 0)[0]
    stride = 16
    spread = np.arange(stride)
    wide = np.concatenate([symbols, np.zeros(stride, symbols.dtype)])
    while len(live):
        x = wide[(a[live] + length[live])[:, None] + spread]
        y = wide[(b[live] + length[live])[:, None] + spread]
        differ = x != y
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), stride)
        length[live] = np.minimum(length[live] + same, most[live])
        live = live[(same == stride) & (length[live] < most[live])]
    return length


def match_lengths(cuts: list[bytes]) -> list[np.ndarray]:
    """For each position of each cut, the longest match that starts at any other position of the block."""
    parts = [np.concatenate([np.frombuffer(c, np.uint8).astype(np.uint64) + np.uint64(1), [np.uint64(0)]]) for c in cuts]
    size = np.array([len(p) for p in parts])
    start = np.cumsum(size) - size
    symbols = np.concatenate(parts)
    n = len(symbols)
    left = np.repeat(start + size - 1, size) - np.arange(n)
    order = suffix_order(symbols, left)
    before = np.where(left == np.repeat(size - 1, size), np.uint64(0), np.roll(symbols, 1))
    bwt = before[order]
    # A run goes on where the letter to the left is the same and is a letter.
    joined = (bwt[1:] == bwt[:-1]) & (bwt[1:] != 0)
    stream = np.zeros(n, np.int64)
    at = np.arange(n)
    for heads, other in ((np.concatenate([[True], ~joined]), -1), (np.concatenate([~joined, [True]]), 1)):
        rows = np.nonzero(heads)[0]
        sample = np.zeros(n, np.int64)
        inner = rows[(rows + other >= 0) & (rows + other < n)]
        sample[order[inner]] = common_prefix(symbols, left, order[inner], order[inner + other])
        mark = np.zeros(n, np.int64)
        mark[order[rows]] = order[rows]
        source = np.maximum.accumulate(mark)   # the last sampled position at or before each position
        stream = np.maximum(stream, sample[source] - (at - source))
    return [stream[s:s + k - 1] for s, k in zip(start, size)]


def _ranges(flags: np.ndarray) -> list[dict]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return [{"start": int(a), "end": int(b)} for a, b in zip(np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0])]


def _blocks(window: int, block_bytes: int):
    def judge(rows):
        lengths = match_lengths([r[4] for r in rows])
        out = [(r[1], r[2], _ranges(m[:len(r[4]) - window + 1] >= window)) for r, m in zip(rows, lengths) if r[3] == 1]
        out = [x for x in out if x[2]]
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
             pa.array([x[2] for x in out], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
            ["h1", "h2", "ranges"])

    def run(batches):
        block, held = [], 0
        for group in in_groups(batches, 0, 5):   # anchor, h1, h2, n, cut
            if all(g[3] > 1 for g in group):
                continue   # every place of these cuts is known to repeat
            block += group
            held += sum(len(g[4]) for g in group)
            if held >= block_bytes:
                yield judge(block)
                block, held = [], 0
        if block:
            yield judge(block)
    return run


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                          gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept): one row per input row.

    A byte goes if a window over it also starts anywhere else, in this text or
    another. ``spans`` are the maximal removed runs of bytes, ``kept`` the other
    bytes. Runs jobs while it is called.
    """
    units = byte_units(window, gram)
    scratch = Scratch(docs.sparkSession, "run-index")
    src = sources(docs, id_col, text_col)
    places, cuts = repeated_pieces(src, units, scratch)
    few, many = split_by_load(compared_cuts(src, cuts, units, scratch))
    found = (few.select("anchor", "h1", "h2", "n", "cut").repartition("anchor").sortWithinPartitions("anchor", "h1", "h2")
             .mapInArrow(_blocks(window, block_bytes), f"h1 long, h2 long, ranges {RANGES}"))
    alone = window_verdicts(many, units, (F.sum("n"), lambda m, first: m > 1), scratch)
    spans = scratch.save(verdicts(places, cuts, found.unionByName(alone), F.col("n") > 1), "spans")
    scratch.release("places", "cuts", "compared", "parts", "windows")
    src = with_spans(src, spans)

    def cut_out(batches):
        run_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                b = whole.slice(k, 256)
                total, gone, spans_out, kept = [], [], [], []
                for data, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                    runs = removed_runs(found, window)
                    total.append(len(data))
                    gone.append(sum(e - s for s, e in runs))
                    spans_out.append([{"start": s, "end": e} for s, e in runs])
                    edge = [0, *(x for r in runs for x in r), len(data)]
                    kept.append(b"".join(data[a:z] for a, z in zip(edge[::2], edge[1::2])))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                     pa.array(spans_out, run_type), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(cut_out, f"doc_id {kind}, n_bytes long, n_removed long, spans {RANGES}, kept binary")

"""Substring dedup by relative Lempel-Ziv parsing.

The collection's repeated pieces (see ``passages``) are the reference, split
into blocks by anchor: a window can only repeat inside the block that its
anchor names, so each piece is parsed against the one block that can hold it
and blocks are compared in parallel. A block keeps its cuts in order of the
smallest document that holds them. Each cut is factored greedily against the
cuts before it: the longest match at the current word becomes a factor, and
where a factor ends, the windows that straddle its end are looked up one by one
before the next factor starts. Factors of at least a window become duplicate
spans. A block with too many cuts is compared by shuffles of its parts.

Edge cases: NULL or blank text has no words and nothing to remove; a NULL
doc_id counts as larger than any other; rows of one doc_id are one document as
to "smaller", so they do not remove each other's words; texts shorter than a
window keep all words; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import Scratch
from marketpulse.llm.passages import (RANGES, Units, compared_cuts, in_groups, repeated_pieces, runs_of_rows, some_texts,
                                      sources, split_by_load, verdicts, window_verdicts, with_spans)

WINDOW = 13
GRAM = 5
#: Bytes whose words are hashed together; only a longer word makes a longer run.
_RUN_BYTES = 1 << 16
_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_BYTE = np.random.default_rng(13).integers(0, 2 ** 64, 256, dtype=np.uint64)
_BASE = 0x9FB21C651E98DF25


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(n - 1, b, np.uint64)])
                                  for b in (_BASE, pow(_BASE, -1, 2 ** 64)))
        return self.up, self.down


def _word_codes(texts: list[bytes], powers: _Powers) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word, of all texts, and the number of words of each text.

    A word's hash is the sum of its bytes' random numbers times powers of a base by
    place, divided by the power of its first place: sums of whole runs of text give it."""
    data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    space = _IS_SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    out = np.empty(len(start), np.uint64)
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(end, start[a] + _RUN_BYTES, "right")))
        run = data[start[a] - 1:end[b - 1]]   # with the space before it
        up, down = powers.upto(len(run))
        total = np.cumsum(_BYTE[run] * up[:len(run)])
        lo = start[a:b] - (start[a] - 1)
        out[a:b] = (total[end[a:b] - start[a]] - total[lo - 1]) * down[lo]
        a = b
    out = (out ^ (out >> np.uint64(32))) * np.uint64(_BASE)
    borders = np.cumsum([1, *(len(t) + 1 for t in texts)])
    return out ^ (out >> np.uint64(29)), np.diff(np.searchsorted(start, borders))


def _word_cuts(texts: list[bytes], row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[bytes]:
    """The words [lo, hi) of the texts ``row``, joined by one space."""
    plain = [b" ".join(t.split()) for t in texts]
    data = b"\n".join(plain)
    gap = np.flatnonzero(_IS_SPACE[np.frombuffer(data, np.uint8)])
    first = np.searchsorted(gap, np.cumsum([0, *(len(t) + 1 for t in plain[:-1])]))[row]   # a text's first word
    start, end = np.r_[0, gap + 1], np.r_[gap, len(data)]
    return [data[a:b] for a, b in zip(start[first + lo].tolist(), end[first + hi - 1].tolist())]


def word_units(window: int = WINDOW, gram: int = GRAM) -> Units:
    powers = _Powers()
    return Units(split=lambda data: data.split(), codes=lambda w: _word_codes([b" ".join(w)], powers)[0],
                 pack=lambda w: b" ".join(w), codes_of=lambda texts: _word_codes(texts, powers), cuts_of=_word_cuts,
                 window=window, gram=gram)


def parse(words: list[bytes], index: dict, owner: int, window: int) -> list[tuple[int, int]]:
    """Greedy factors of ``words``, as ranges of window starts, against an index
    from windows to (smallest id, reference words, position)."""
    found, i, last = [], 0, len(words) - window
    while i <= last:
        hit = index.get(tuple(words[i:i + window]))
        if hit is None or hit[0] >= owner:
            i += 1
            continue
        _, ref, at = hit
        length = window
        while i + length < len(words) and at + length < len(ref) and words[i + length] == ref[at + length]:
            length += 1
        found.append((i, i + length - window + 1))
        i += length - window + 1   # the first window that straddles the factor's end
    return found


def parse_block(cuts: list[tuple[int, list[bytes]]], window: int) -> list[list[tuple[int, int]]]:
    """Factors of each (smallest id, words), ordered by id, against those before it."""
    index: dict = {}
    out = []
    for owner, words in cuts:
        out.append(parse(words, index, owner, window))
        for i in range(len(words) - window + 1):
            index.setdefault(tuple(words[i:i + window]), (owner, words, i))
    return out


def _blocks(window: int):
    def run(batches):
        for group in in_groups(batches, 0, 5):   # anchor, first, h1, h2, cut
            factors = parse_block([(g[1], g[4].split()) for g in group], window)
            rows = [(g[2], g[3], [{"start": a, "end": b} for a, b in f]) for g, f in zip(group, factors) if f]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                    ["h1", "h2", "ranges"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept): one row per input row.

    A word goes if a window over it also starts in a document with a smaller
    id. ``spans`` are the maximal removed runs of words, ``kept`` the other
    words joined by one space. Runs jobs while it is called.
    """
    units = word_units(window, gram)
    scratch = Scratch(docs.sparkSession, "relative-lz")
    src = sources(docs, id_col, text_col)
    places, cuts = repeated_pieces(src, units, scratch)
    few, many = split_by_load(compared_cuts(src, cuts, units, scratch))
    factors = (few.select("anchor", "first", "h1", "h2", "cut").repartition("anchor")
               .sortWithinPartitions("anchor", "first", "h1", "h2")
               .mapInArrow(_blocks(window), f"h1 long, h2 long, ranges {RANGES}"))
    alone = window_verdicts(many, units, (F.min("first"), lambda m, first: m < first), scratch)
    spans = scratch.save(verdicts(places, cuts, factors.unionByName(alone), F.col("did") > F.col("first")), "spans")
    scratch.release("places", "cuts", "compared", "parts", "windows")
    src = with_spans(src, spans)

    def cut_out(batches):
        for b in batches:
            for first, texts in some_texts(b, 1):
                row, start, stop = runs_of_rows(b.column(2).slice(first, len(texts)), window)
                words = [t.split() for t in texts]
                total = list(map(len, words))
                for i, s, e in zip(row[::-1].tolist(), start[::-1].tolist(), stop[::-1].tolist()):
                    del words[i][s:e]
                ends = np.r_[0, np.cumsum(np.bincount(row, minlength=len(texts)))]
                runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(start, pa.int64()), pa.array(stop, pa.int64())], ["start", "end"]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(texts)), pa.array(total, pa.int64()),
                     pa.array([n - len(w) for n, w in zip(total, words)], pa.int64()), runs,
                     pa.array(map(b" ".join, words), pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "n_removed", "spans", "kept"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(cut_out, f"doc_id {kind}, n_words long, n_removed long, spans {RANGES}, kept string")

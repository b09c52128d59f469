"""Repeated passages: which stretches of which texts can repeat at all.

A text is a sequence of units (words or bytes); a window is a fixed number of
consecutive units. Each window has an anchor, the first of the smallest hashes
among the shorter grams inside it, so equal windows have equal anchors.
Consecutive windows with one anchor at one place form a piece. Every window lies in exactly one piece
and a piece, cut out with the units its windows need, holds no other windows.

``repeated_pieces`` keeps the pieces whose anchor is found more than once and
counts the different cuts by their hashes; ``compared_cuts`` takes the units of
one place per cut, where an anchor has several. Whole texts move through a
shuffle three times, one after the other, and nothing larger ever does. Anchors only
route: a collision costs work, never a wrong result, because operators compare
the cuts themselves.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import Scratch, id_text

#: Different cuts of one anchor that one task compares; an anchor with more is
#: compared part by part through shuffles (``window_verdicts``).
MAX_CUTS = 1024
#: Windows in one part of such a cut, if the window is long enough (``part_windows``).
PART_WINDOWS = 16
#: Bytes of texts that are read together.
TEXT_BYTES = 1 << 18
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LAST_ID = 2 ** 63 - 1


@dataclass(frozen=True)
class Units:
    """How texts are read: ``split`` gives a sequence that slices, ``codes`` one
    number per unit, ``pack`` the bytes of a slice. Of several texts at once,
    ``codes_of`` gives the numbers, one text after the other, and how many each
    has; ``cuts_of`` the bytes of the slices [lo, hi) of the texts ``row``."""
    split: Callable
    codes: Callable
    pack: Callable
    codes_of: Callable
    cuts_of: Callable
    window: int
    gram: int


def gram_hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every run of ``gram`` codes, by joining runs of powers of two."""
    base = np.uint64(0xD6E8FEB86659FD93)
    out, out_len = None, 0
    part, part_len, power = codes, 1, base   # power = base ** part_len
    left = gram
    while left:
        if left & 1:
            if out is None:
                out, out_len = part, part_len
            else:
                n = len(codes) - out_len - part_len + 1
                out = out[:n] * power + part[out_len:out_len + n]
                out_len += part_len
        left >>= 1
        if left:
            n = len(part) - part_len
            part = part[:n] * power + part[part_len:part_len + n]
            power, part_len = power * power, part_len * 2
    out = (out ^ (out >> np.uint64(31))) * _MIX
    return out ^ (out >> np.uint64(29))


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    if span < width:
        h = np.minimum(h[:len(h) - (width - span)], h[width - span:])
    return h


def pieces(codes: np.ndarray, counts: np.ndarray, window: int,
           gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, anchor, first window, number of windows) of each piece of texts that lie
    one after the other in ``codes``, ``counts`` units each."""
    fits = np.maximum(counts - window + 1, 0)
    text = np.repeat(np.arange(len(counts)), fits)
    if not len(text):
        return text, text, text, text
    with np.errstate(over="ignore"):
        h = gram_hashes(codes, gram)
    low = sliding_min(h, window - gram + 1)
    # Windows over the border of two texts are left out.
    first = np.cumsum(fits) - fits
    at = np.arange(len(text)) - first[text]
    flat = (np.cumsum(counts) - counts)[text] + at
    low = low[flat]
    # The next window has another anchor when a smaller gram comes in or when
    # this window's anchor is its first gram; equal grams are told apart by place.
    new = np.ones(len(text), bool)
    new[1:] = (low[1:] != low[:-1]) | (h[flat[:-1]] == low[:-1])
    new[first[fits > 0]] = True
    cut = np.flatnonzero(new)
    return text[cut], low[cut].view(np.int64), at[cut], np.diff(np.append(cut, len(text)))


def sources(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, did, tk, data): the id; the id as a key, last for a NULL id; a hash
    that tells apart texts of one id, or zero where no id repeats; the text's bytes."""
    own = id_text(docs, id_col, text_col).select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID)).alias("did"), "text")
    again = own.groupBy("did").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
    tk = F.xxhash64("text").alias("tk") if again else F.lit(0).cast("long").alias("tk", metadata={"single": True})
    return own.select("doc_id", "did", tk,
                      F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"))


def some_texts(b: pa.RecordBatch, column: int):
    """(first row, texts) of a batch's rows, some at a time, which bounds what is held."""
    held, size, start = [], 0, 0
    for i, data in enumerate(b.column(column)):
        held.append(data.as_py())
        size += len(held[-1])
        if size >= TEXT_BYTES:
            yield start, held
            held, size, start = [], 0, i + 1
    if held:
        yield start, held


def _find(units: Units):
    def run(batches):
        for b in batches:
            did, tk = b.column(0).to_numpy(), b.column(1).to_numpy()
            for start, texts in some_texts(b, 2):
                row, anchor, at, n = pieces(*units.codes_of(texts), units.window, units.gram)
                if len(row):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(did[row + start]), pa.array(tk[row + start]), pa.array(anchor), pa.array((at << 16) | n)],
                        ["did", "tk", "anchor", "at"])
    return run


def _found_cuts(units: Units, b: pa.RecordBatch, data: int, found: int):
    """(row, columns of ``found``, cuts) of a batch's rows, some at a time."""
    for start, texts in some_texts(b, data):
        lists = b.column(found).slice(start, len(texts))
        row = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy())
        places = lists.flatten()
        columns = dict(zip((f.name for f in places.type), (c.to_numpy() for c in places.flatten())))
        lo = columns["at"] >> 16
        yield row + start, columns, units.cuts_of(texts, row, lo, lo + (columns["at"] & 0xFFFF) + units.window - 1)


def _hash_cuts(units: Units):
    """(did, tk, data, found) to the 128-bit hash of each found piece."""
    def run(batches):
        for b in batches:
            did, tk = b.column(0).to_numpy(), b.column(1).to_numpy()
            for row, found, cuts in _found_cuts(units, b, 2, 3):
                both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, cuts)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (did[row], tk[row], found["anchor"], found["at"], both[:, 0], both[:, 1])],
                    ["did", "tk", "anchor", "at", "h1", "h2"])
    return run


def _take_cuts(units: Units):
    """(data, found) to the found pieces themselves."""
    names = ["anchor", "h1", "h2", "first", "n", "load"]

    def run(batches):
        for b in batches:
            for _, found, cuts in _found_cuts(units, b, 0, 1):
                yield pa.RecordBatch.from_arrays([pa.array(found[c]) for c in names] + [pa.array(cuts, pa.binary())],
                                                 [*names, "cut"])
    return run


def repeated_pieces(src: DataFrame, units: Units, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The pieces of ``src`` (see ``sources``) whose anchor occurs more than once.

    places: (did, tk, anchor, at, h1, h2), one row per piece, ``at`` = first
    window << 16 | number of windows, h1 and h2 the hash of its cut. cuts:
    (anchor, h1, h2, first, tk, at, n), one row per different cut: the place
    with the smallest id, and the number of places. Neither holds any text.
    """
    found = src.select("did", "tk", "data").mapInArrow(_find(units), "did long, tk long, anchor long, at long")
    rows = scratch.save(found, "anchors")
    often = rows.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    keep = scratch.save(rows.join(often, "anchor"), "repeated")
    del rows, often
    scratch.release("anchors")
    per_text = keep.groupBy("did", "tk").agg(F.collect_set(F.struct("anchor", "at")).alias("found"))
    # One text of an id and hash is enough to cut from; all its rows are places.
    places = scratch.save(src.join(per_text, ["did", "tk"]).select("did", "tk", "data", "found").mapInArrow(
        _hash_cuts(units), "did long, tk long, anchor long, at long, h1 long, h2 long"), "places")
    del keep, per_text
    scratch.release("repeated")
    cuts = scratch.save(places.groupBy("anchor", "h1", "h2").agg(F.min(F.struct("did", "tk", "at")).alias("p"),
                                                               F.count("*").alias("n"))
                        .select("anchor", "h1", "h2", F.col("p.did").alias("first"), "p.tk", "p.at", "n"), "cuts")
    return places, cuts


def compared_cuts(src: DataFrame, cuts: DataFrame, units: Units, scratch: Scratch) -> DataFrame:
    """(anchor, h1, h2, first, n, load, cut): the cuts, with their units, of every
    anchor that has more than one (``load`` is how many)."""
    load = cuts.groupBy("anchor").agg(F.count("*").alias("load")).filter("load > 1")
    per_text = (cuts.join(load, "anchor").groupBy(F.col("first").alias("did"), "tk")
                .agg(F.collect_set(F.struct("anchor", "at", "h1", "h2", "first", "n", "load")).alias("found")))
    texts = src.join(per_text, ["did", "tk"]).select("data", "found")
    out = scratch.save(texts.mapInArrow(
        _take_cuts(units), "anchor long, h1 long, h2 long, first long, n long, load long, cut binary"), "compared")
    scratch.release()
    return out.dropDuplicates(["anchor", "h1", "h2"]) if _texts_repeat(src) else out


def _texts_repeat(src: DataFrame) -> bool:
    """Whether rows share an id: then a cut may have been taken from each of them."""
    return not any(f.name == "tk" and f.metadata.get("single") for f in src.schema.fields)


def split_by_load(compared: DataFrame, max_cuts: int = MAX_CUTS) -> tuple[DataFrame, DataFrame]:
    """Cuts of anchors that one task can compare, and those of anchors with too many."""
    return compared.filter(F.col("load") <= max_cuts), compared.filter(F.col("load") > max_cuts)


def in_groups(batches, key: int, columns: int):
    """Rows of sorted Arrow batches, a list per run of equal values in column ``key``."""
    group, now = [], None
    for b in batches:
        for row in zip(*(b.column(j).to_pylist() for j in range(columns))):
            if row[key] != now and group:
                yield group
                group = []
            now = row[key]
            group.append(row)
    if group:
        yield group


def verdicts(places: DataFrame, cuts: DataFrame, flagged: DataFrame, whole) -> DataFrame:
    """(did, tk, spans): the flagged window ranges [start, end) of each text.

    ``flagged`` holds (h1, h2, ranges) of cuts with flagged windows; ``whole``
    is a condition on did, first and n under which all windows of a place count."""
    by_cut = (cuts.select("h1", "h2", "first", "n").join(flagged, ["h1", "h2"], "left"))
    lo, size = F.shiftright("at", 16), F.col("at").bitwiseAND(F.lit(0xFFFF).cast("long"))
    all_of_it = F.array(F.struct(lo.alias("start"), (lo + size).alias("end")))
    some = F.transform("ranges", lambda r: F.struct((lo + r["start"]).alias("start"), (lo + r["end"]).alias("end")))
    return (places.join(by_cut, ["h1", "h2"])
            .select("did", "tk", F.when(whole, all_of_it).otherwise(some).alias("r")).filter("r IS NOT NULL")
            .groupBy("did", "tk").agg(F.flatten(F.collect_list("r")).alias("spans")))


RANGES = "array<struct<start:long,end:long>>"


def part_windows(window: int) -> int:
    """Windows in one part: at most half a window, so that more than half a window is common to them all."""
    return max(1, min(PART_WINDOWS, window // 2))


def _parts(units: Units):
    """Cuts to parts of ``part_windows`` windows or fewer, by the windows' distance to the
    anchor: equal windows fall into parts that share their core, the units common to
    all windows at those distances. s1, s2 hash the part, w1, w2 its core."""
    width = units.window - units.gram + 1
    size = part_windows(units.window)
    names = ["h1", "h2", "first", "n", "at", "size", "s1", "s2", "w1", "w2", "part"]

    def run(batches):
        for b in batches:
            rows, keys, parts = [], [], []
            for h1, h2, first, n, data in zip(*(b.column(j).to_pylist() for j in range(5))):
                seq = units.split(data)
                count = len(seq) - units.window + 1
                with np.errstate(over="ignore"):
                    anchor = int(gram_hashes(units.codes(seq), units.gram)[:width].argmin())
                for k in range((anchor - count + 1) // size, anchor // size + 1):
                    near = anchor - k * size   # start of the window nearest to the anchor
                    far = near - size + 1
                    lo, hi = max(0, far), min(count, near + 1)
                    part = units.pack(seq[lo:hi + units.window - 1])
                    rows.append((h1, h2, first, n, lo, hi - lo))
                    keys += [xxhash.xxh3_128_digest(part),
                             xxhash.xxh3_128_digest(units.pack(seq[near:far + units.window]))]
                    parts.append(part)
            hashes = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[j] for r in rows], pa.int64()) for j in range(6)]
                + [pa.array(hashes[:, j]) for j in range(4)] + [pa.array(parts, pa.binary())], names)
    return run


def _windows_of(units: Units):
    """(s1, s2, first, n, part) to one row per window, with the window's hash."""
    def run(batches):
        for b in batches:
            rows, keys = [], []
            for s1, s2, first, n, data in zip(*(b.column(j).to_pylist() for j in range(5))):
                seq = units.split(data)
                for i in range(len(seq) - units.window + 1):
                    rows.append((s1, s2, first, n, i))
                    keys.append(xxhash.xxh3_128_digest(units.pack(seq[i:i + units.window])))
            both = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[j] for r in rows], pa.int64()) for j in range(5)] + [pa.array(both[:, 0]), pa.array(both[:, 1])],
                ["s1", "s2", "first", "n", "i", "v1", "v2"])
    return run


def window_verdicts(cuts: DataFrame, units: Units, measure, scratch: Scratch) -> DataFrame:
    """(h1, h2, ranges) for cuts of anchors with too many cuts to compare in one task.

    ``measure`` is (aggregate of first and n over the cuts of one window, condition
    on it and a cut's first). Cuts go into parts; equal parts are measured once, a
    part whose core no other part has is its windows' only measure, and the windows
    of the remaining parts alone are grouped by their 128-bit hash in a shuffle.
    """
    agg, condition = measure
    parts = scratch.save(cuts.select("h1", "h2", "first", "n", "cut").mapInArrow(
        _parts(units), "h1 long, h2 long, first long, n long, at long, size long, s1 long, s2 long, w1 long, w2 long, "
                       "part binary"), "parts")
    distinct = parts.groupBy("s1", "s2", "w1", "w2").agg(
        agg.alias("own"), F.min("first").alias("first"), F.sum("n").alias("n"), F.any_value("part").alias("part"))
    met = distinct.groupBy("w1", "w2").agg(F.count("*").alias("load")).filter("load > 1").select("w1", "w2")
    rows = scratch.save(distinct.join(met, ["w1", "w2"]).select("s1", "s2", "first", "n", "part").mapInArrow(
        _windows_of(units), "s1 long, s2 long, first long, n long, i long, v1 long, v2 long"), "windows")
    seen = rows.groupBy("v1", "v2").agg(agg.alias("m"))
    one = F.lit(1).cast("long").alias("size")
    by_window = (rows.join(seen, ["v1", "v2"]).groupBy("s1", "s2")
                 .agg(F.collect_list(F.struct("i", one, "m")).alias("of")))
    judged = distinct.select("s1", "s2", "own").join(by_window, ["s1", "s2"], "left")
    alone = F.array(F.struct(F.lit(0).cast("long").alias("i"), "size", F.col("own").alias("m")))
    ranges = F.transform(F.filter(F.coalesce("of", alone), lambda x: condition(x["m"], F.col("first"))), lambda x: F.struct(
        (F.col("at") + x["i"]).alias("start"), (F.col("at") + x["i"] + x["size"]).alias("end")))
    return (parts.select("h1", "h2", "first", "at", "size", "s1", "s2").join(judged, ["s1", "s2"])
            .select("h1", "h2", ranges.alias("r")).filter(F.size("r") > 0)
            .groupBy("h1", "h2").agg(F.flatten(F.collect_list("r")).alias("ranges")))


def removed_runs(spans, window: int) -> list[list[int]]:
    """Maximal runs of units covered by the windows in ``spans``, a list of (start, end)."""
    runs: list[list[int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans or ()):
        stop = b + window - 1
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], stop)
        else:
            runs.append([a, stop])
    return runs


def runs_of_rows(spans: pa.ListArray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, stop) of the ``removed_runs`` of several rows' spans, by row and start."""
    row = np.repeat(np.arange(len(spans)), spans.value_lengths().fill_null(0).to_numpy())
    if not len(row):
        return row, row, row
    start, end = (x.to_numpy() for x in spans.flatten().flatten())
    order = np.lexsort((start, row))
    row, start, stop = row[order], start[order], end[order] + window - 1
    reach = np.maximum.accumulate((row << 40) + stop)   # 40 bits hold a place in a text
    new = np.r_[True, (row[1:] << 40) + start[1:] > reach[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(row) - 1]
    return row[new], start[new], reach[last] - (row[last] << 40)


def with_spans(src: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, data, spans): every input row with its flagged windows."""
    return src.join(spans, ["did", "tk"], "left").select("doc_id", "data", "spans")

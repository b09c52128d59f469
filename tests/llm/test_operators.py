"""Every text operator against a brute-force version: driver tables, edge rows, empty tables."""

import os
import sys

import pytest
from pyspark.sql import functions as F

from marketpulse.llm import queries as q
from marketpulse.llm.decontaminate import contamination
from marketpulse.llm.pii import mask_personal_data, personal_data
from marketpulse.llm.quality import keep_good, quality
from marketpulse.llm.relative_lz import remove_repeats
from marketpulse.llm.run_index import match_lengths, remove_repeated_bytes
from marketpulse.llm.sharding import shard_rows
from marketpulse.llm.simhash import drop_near_duplicates, near_duplicates

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
key = lambda rows: sorted(map(tuple, rows), key=repr)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def check(df, want):
    assert key(df.collect()) == key(want)


EDGE_TEXT = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau "
             "upsilon phi chi psi omega one two three four five six seven eight nine ten eleven twelve")


def edge_rows():
    """(doc_id, text): NULLs, blanks, ties, repeats, copies, near copies, one very long word, one long text."""
    long_text = " ".join(f"w{i * 7919 % 1009}" for i in range(6000))
    rows = [(1, EDGE_TEXT), (2, EDGE_TEXT), (3, EDGE_TEXT + " and more"), (4, None), (5, ""), (6, " \t\n "),
            (7, "one"), (8, "Two words"), (9, "x" * 5000), (10, "a b c d e " * 60), (11, long_text),
            (12, "intro " + long_text[:3000]), (None, EDGE_TEXT), (None, None), (13, EDGE_TEXT), (13, EDGE_TEXT),
            (14, "same id first text " * 3), (14, EDGE_TEXT + " other"), (15, "ÉCOLE École école naïve İstanbul ß x"),
            (16, EDGE_TEXT.upper()), (17, "tab\tsep\x0bver\x0cform\rret\nline " * 8)]
    return rows


@pytest.fixture(scope="module")
def edge_docs(spark):
    """The edge rows, with extra columns whose names operators use inside."""
    rows = [(d, t, "x", 1, 2, "k", 5) for d, t in edge_rows()]
    return spark.createDataFrame(rows, "doc_id long, text string, fp string, did long, tk long, spans string, n_words int")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def items(spark):
    return spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF_SMALL}/labels.parquet")


def sha_of(df, *cols):
    return df.select(*cols, F.sha2(F.col("kept").cast("binary"), 256))


def run_all(docs, items, labels):
    """(result, brute-force rows) of each deterministic digest."""
    rows = pairs(docs)
    return {
        "op1": (near_duplicates(docs), brute.op1(rows)),
        "op2": (sha_of(remove_repeats(docs), "doc_id", "n_words", "n_removed"), brute.op2(rows)),
        "op4": (personal_data(docs).drop("spans", "scores"), brute.op4(rows)),
        "op5": (quality(docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                             "n_repeat_words", "base_failed"), brute.op5(rows)),
        "op6": (sha_of(remove_repeated_bytes(docs), "doc_id", "n_bytes", "n_removed", F.size("spans")), brute.op6(rows)),
        "op7": (contamination(docs, items), brute.op7(rows, pairs(items.withColumnRenamed("item_id", "doc_id")))),
    }


@pytest.mark.parametrize("which", ["given and edge", "empty"])
def test_digests_match_brute_force(which, docs, edge_docs, items, labels):
    """The given documents with the edge rows among them (ids meet: ties and repeats of ids)."""
    table = edge_docs.unionByName(docs.select("doc_id", "text"), allowMissingColumns=True)
    table = table if which != "empty" else edge_docs.limit(0)
    for name, (got, want) in run_all(table, items, labels).items():
        assert key(got.collect()) == key(want), name


def test_query_names_cover_every_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in q.QUERIES) == list(range(1, 14))


# --- op1 --------------------------------------------------------------------

def test_buckets_with_too_many_members_are_filed_again(spark):
    import random
    from marketpulse.llm.common import Scratch
    from marketpulse.llm.components import component_roots
    from marketpulse.llm.simhash import fingerprint_links
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(6)]
    fps = {b ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for b in base for _ in range(120)} | {
        r.getrandbits(64) for _ in range(200)}
    fps = sorted(fps)
    signed = [f - 2 ** 64 if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    comp = brute.components(fps)
    want = {}
    for f, c in zip(signed, comp):
        want[c] = min(want.get(c, f), f)
    for hot in (2048, 8):   # with 8, nearly every shared bucket is filed by its finer keys
        roots = {x["node"]: x["root"] for x in component_roots(
            fingerprint_links(df, 2, hot), Scratch(spark, "test")).collect()}
        assert [roots.get(f, f) for f in signed] == [want[c] for c in comp], hot


def test_one_document_of_each_group_stays(edge_docs):
    kept = drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    want = {c for _, _, c in brute.op1(pairs(edge_docs)) if c is not None}
    got = [r.doc_id for r in kept.filter("doc_id is not null").collect()]
    assert sorted(got) == sorted(want)


# --- op2, op6 ----------------------------------------------------------------

def test_hot_anchors_take_the_shuffle_path(spark, monkeypatch):
    """With room for two cuts per anchor, most anchors go window by window; results stay."""
    import random
    from marketpulse.llm import relative_lz, run_index
    from marketpulse.llm.passages import split_by_load
    r = random.Random(3)
    common = " ".join(f"line{i}" for i in range(40))
    rows = [(i, f"{' '.join(f'a{r.randrange(999)}' for _ in range(8))} {common} "
                f"{' '.join(f'b{r.randrange(999)}' for _ in range(8))}") for i in range(30)]
    rows += [(100 + i, common[i:] + " tail" * 50) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for module in (relative_lz, run_index):
        monkeypatch.setattr(module, "split_by_load", lambda cuts: split_by_load(cuts, 2))
    check(sha_of(remove_repeats(df), "doc_id", "n_words", "n_removed"), brute.op2(rows))
    check(sha_of(remove_repeated_bytes(df), "doc_id", "n_bytes", "n_removed", F.size("spans")), brute.op6(rows))


def test_hot_passage_whose_first_gram_is_the_anchor(spark, monkeypatch):
    """The smallest holder has no left context, the others have different ones: all copies but the first go."""
    import random
    from marketpulse.llm import relative_lz
    from marketpulse.llm.passages import gram_hashes, split_by_load
    r = random.Random(7)
    units = relative_lz.word_units()
    for lead in (0, 1):   # the anchor is the first or the second gram of the smallest holder
        passage = []
        while not passage or gram_hashes(units.codes(passage), units.gram).argmin() != lead:
            passage = [f"p{r.randrange(10 ** 6)}".encode() for _ in range(units.window)]
        text = b" ".join(passage).decode()
        rows = [(d, " ".join([*(f"a{r.randrange(10 ** 6)}" for _ in range(9 if d else 0)), text,
                              *(f"b{r.randrange(10 ** 6)}" for _ in range(9))])) for d in range(30)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        monkeypatch.setattr(relative_lz, "split_by_load", lambda cuts: split_by_load(cuts, 2))
        want = brute.op2(rows)
        assert sorted(x[2] for x in want) == [0] + [units.window] * 29
        check(sha_of(remove_repeats(df), "doc_id", "n_words", "n_removed"), want)


def test_texts_are_read_together(monkeypatch):
    """Words, pieces, cuts and runs of several texts at once are those of each text by itself."""
    import random
    import numpy as np
    import pyarrow as pa
    from marketpulse.llm import passages, relative_lz, run_index
    r = random.Random(3)
    word = lambda: bytes(r.choice(b"ab\xc3") for _ in range(r.randrange(1, 4)))
    texts = [b"", b" \t\n ", b"y" * 300, *(b"".join(word() + r.choice([b" ", b"  ", b"\x0b", b"\n"])
                                                for _ in range(r.randrange(60))) for _ in range(40))]
    monkeypatch.setattr(relative_lz, "_RUN_BYTES", 16)
    units = relative_lz.word_units(4, 2)
    codes, counts = units.codes_of(texts)
    words = [w for t in texts for w in t.split()]
    assert counts.tolist() == [len(t.split()) for t in texts]
    assert len(dict(zip(words, codes.tolist()))) == len(set(zip(words, codes.tolist()))) == len(set(codes.tolist()))
    for units in (units, run_index.byte_units(8, 3)):
        codes, counts = units.codes_of(texts)
        assert codes.tolist() == [c for t in texts for c in units.codes(units.split(t)).tolist()]
        row, anchor, at, n = passages.pieces(codes, counts, units.window, units.gram)
        assert (np.bincount(row, n, len(texts)) == np.maximum(counts - units.window + 1, 0)).all()   # each window once
        alone = [(i, *x) for i, t in enumerate(texts)
                 for x in zip(*(c.tolist() for c in passages.pieces(*units.codes_of([t]), units.window, units.gram)[1:]))]
        assert list(zip(row.tolist(), anchor.tolist(), at.tolist(), n.tolist())) == alone
        hi = at + n + units.window - 1
        assert units.cuts_of(texts, row, at, hi) == [
            units.pack(units.split(texts[i])[a:b]) for i, a, b in zip(row.tolist(), at.tolist(), hi.tolist())]
    spans = [None, [], *([{"start": (a := r.randrange(40)), "end": a + r.randrange(1, 5)} for _ in range(r.randrange(6))]
                         for _ in range(30))]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    got = list(zip(*(x.tolist() for x in passages.runs_of_rows(pa.array([[], *spans], kind).slice(1), 4))))
    assert got == [(i, *run) for i, x in enumerate(spans) for run in passages.removed_runs(x, 4)]


def test_match_lengths_are_the_longest_matches():
    import random
    r = random.Random(1)
    cuts = [bytes(r.choice(b"ab\x00") for _ in range(r.randrange(1, 40))) for _ in range(12)] + [b"abab" * 9, b"abab" * 9]
    text = [(c, i) for c in range(len(cuts)) for i in range(len(cuts[c]))]

    def lcp(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n
    got = match_lengths(cuts)
    for c, i in text:
        want = max(lcp(cuts[c][i:], cuts[d][j:]) for d, j in text if (d, j) != (c, i))
        assert got[c][i] == want


# --- op3 ----------------------------------------------------------------------

def test_best_path_equals_the_library_and_round_trips(spark, docs, edge_docs):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb
    from marketpulse.llm.pieces import SPACE, Codec, decode_column, default_model, encode_column, read_pieces
    if not os.path.exists(default_model()):
        pytest.skip("no vocabulary files")
    table = read_pieces(default_model())
    codec = Codec(table)
    model = pb.ModelProto()
    with open(default_model(), "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1   # best path over the same pieces and scores
    for piece in model.pieces:   # the library adds in 32 bits, where -1e9 drowns the other scores
        piece.score = max(piece.score, -1e5)
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    known = {w for _, t in pairs(docs)[:60] for w in t.split()}
    import numpy as np
    for w in known:
        assert np.frombuffer(codec.encode(w), np.int32).tolist() == library.encode(w), w
    texts = [t for _, t in pairs(docs)[:40]] + ["", " ", "  two  spaces ", f"mark {SPACE} in text", "日本語 \U0001f600 \x00\x01", "\n\n a"]
    for t in texts:   # whole texts against their best path without the word memory
        ids = np.frombuffer(codec.encode(t), np.int32).tolist()
        assert codec.decode(ids) == t
        if t and SPACE not in t:
            assert ids == codec.best_path(SPACE + t.replace(" ", SPACE))
    for df in (edge_docs, edge_docs.limit(0)):
        enc = encode_column(df, table)
        got = enc.collect()
        assert all(r.exact for r in got if r.ids is not None)
        assert key([(r.doc_id, r.text) for r in decode_column(enc, table).collect()]) == key(pairs(df))


# --- op4 ----------------------------------------------------------------------

def test_spans_and_masks(spark):
    rows = [(1, "mail bob@x.org_y@z.net now"), (2, "ip 300.1.1.1 and 10.0.0.255.7 x"), (3, "card 4111 1111 1111 1111!"),
            (4, "call +1 (555) 123-4567 é +12"), (5, "IBAN GB82 WEST 1234 5698 7654 32, not GB82 WEST 1234 5698 7654 33"),
            (6, "my ssn is 123-45-6789 but 123-45-6788"), (7, "é" * 30 + " a@b.c"), (8, "9" * 40000), (9, "a" * 60000 + "@"),
            (10, "1 2 3 " * 3000), (11, None), (12, "0000.0.0.00255 1.2.3.4567")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(personal_data(df).drop("spans", "scores"), brute.op4(rows))
    spans = {r.doc_id: r.spans for r in personal_data(df).collect()}
    assert spans[5] == "iban:5:32" and spans[6].startswith("ssn:10:21") and spans[11] == ""
    clean = {r.doc_id: r.text for r in mask_personal_data(df).collect()}
    assert clean[1] == "mail [EMAIL][EMAIL] now" and clean[3] == "card [CARD]!"
    assert clean[7] == "é" * 30 + " [EMAIL]" and clean[11] is None and clean[8] == rows[7][1]


def test_texts_with_many_matches(spark):
    """Work follows the length of a text with tens of thousands of matches; positions are of code points."""
    import time
    iban = "GB82WEST12345698765432"
    texts = [", ".join(str(10000 + i) for i in range(40000)), "é𝄞 ".join(f"u{i}@x.org" for i in range(16000)), f"{iban}, " * 3000,
             "card 4111 1111 1111 1111; 10.0.0.1 +1 555 123 4567 " * 2000]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    began = time.time()
    check(personal_data(df).drop("spans", "scores"), brute.op4(rows))
    clean = {r.doc_id: r.text for r in mask_personal_data(df).collect()}
    assert time.time() - began < 60
    assert clean[0] == texts[0] and clean[1] == "é𝄞 ".join(["[EMAIL]"] * 16000) and clean[2] == "[IBAN], " * 3000
    assert clean[3] == "card [CARD]; [IP] [PHONE] " * 2000


def test_ibans_before_other_upper_case_words(spark):
    def iban(country, rest):
        number = int("".join(str(int(c, 36)) for c in rest + country + "00"))
        return f"{country}{98 - number % 97:02d}{rest}"
    gb, de = "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"
    other = iban("QQ", "ABCD1234567890123")   # no country of the registry
    rows = [(1, f"{gb} Please", [gb]), (2, f"{de} BIC COBADEFF", [de]), (3, "GB82WEST12345698765432 2024-01-01", ["GB82WEST12345698765432"]),
            (4, f"{gb} {de} NOW {gb}", [gb, de, gb]), (5, f"AT12 {gb} A", [gb]), (6, f"{other} PAID 7", [other]), (7, f"AT12 {other}", [other]),
            (8, f"{gb[:-1]}3 Please", []), (9, f"{de}A {de}x", []), (10, "AB12 " * 3000, []), (11, "A" * 40000 + "B1" * 9000, [])]
    df = spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string")
    found = {r.doc_id: [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("iban:")]
             for r in personal_data(df).collect()}
    clean = {r.doc_id: r.text for r in mask_personal_data(df).collect()}
    for d, t, want in rows:
        assert [t[a:b] for a, b in found[d]] == want, t[:60]
    assert clean[1] == "[IBAN] Please" and clean[2] == "[IBAN] BIC COBADEFF" and clean[3] == "[IBAN] 2024-01-01"


# --- op5 ----------------------------------------------------------------------

def test_quality_keeps_rows_whole_and_rejects_junk(spark, docs, labels, edge_docs):
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns
    verdict = {r.doc_id: r for r in quality(docs, labels).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, r in verdict.items() if r.kept)
    good = {r.doc_id: r.quality for r in labels.collect()}
    judged = [(good[d], r.kept) for d, r in verdict.items() if d in good and not r.base_failed]
    assert all(k for g, k in judged if g)
    assert keep_good(edge_docs, labels).columns == edge_docs.columns
    none = quality(docs, labels.limit(0))
    assert none.filter("kept = base_failed").count() == 0


# --- op8 ----------------------------------------------------------------------

def test_snapshots_collapse(spark):
    from marketpulse.llm.chat import format_chats
    talk = [("user", "hi"), ("assistant", "hello"), ("user", "how"), ("assistant", "so")]
    rows = [(c, i, r, t) for c, n in ((1, 2), (2, 4), (3, 4), (4, 1), (5, 3)) for i, (r, t) in enumerate(talk[:n])]
    rows += [(6, 0, "user", None), (7, 0, "user", ""), (8, 0, None, "hi"), (9, 5, "user", "hi"), (9, 9, "assistant", "other"),
             (None, 0, "user", "alone"), (None, 1, "user", "apart"), (None, 2, "user", "alone"), (None, 0, "user", "hi"), (10, 1, "b", "x"), (10, 1, "a", "y"), (2, 0, "user", "hi")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = format_chats(df)
    assert key(got.select("conv_id", "n_turns").collect()) == key(brute.op8(rows))
    text = {r.conv_id: r.text for r in got.collect()}
    assert text[2].startswith("<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>")
    assert format_chats(df.limit(0)).count() == 0
    given = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    want = brute.op8([tuple(r) for r in given.select("conv_id", "turn", "role", "text").collect()])
    assert key(format_chats(given).select("conv_id", "n_turns").collect()) == key(want)


def test_long_conversations_spread_over_parts(spark):
    """20,000 turns, all their snapshots of a few lengths, a repeated row at each place and rows without an id."""
    from marketpulse.llm.chat import format_chats
    turn = lambda c, i: (c, i // 3, "user" if i % 2 else None, f"text {i} " + "x" * 100)
    rows = [turn(c, i) for c, n in ((7, 20000), (3, 20000), (5, 19999), (2, 12345), (9, 1)) for i in range(n)]
    rows += [turn(7, i) for i in range(0, 20000, 7)] + [turn(8, i) for i in range(1, 300)]
    rows += [(None, 0, "user", f"alone {i % 500}") for i in range(5000)]
    got = format_chats(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    assert key(got.select("conv_id", "n_turns").collect()) == key(brute.op8(rows))


# --- op9 ----------------------------------------------------------------------

def test_toxicity_scores(spark, docs, labels, edge_docs):
    import random
    import zlib
    from marketpulse.llm.toxicity import toxicity
    r = random.Random(2)
    plain = ["river", "stone", "house", "green", "walk", "table", "light", "bread", "cloud", "paper"]
    bad = ["grumbo", "grumbel", "zonkar", "zonkle"]
    rows, marks = [], []
    for i in range(400):
        w = [r.choice(plain) + r.choice(["", "s", "er"]) for _ in range(60)]
        if i % 4 == 0:
            for _ in range(4):
                w[r.randrange(60)] = r.choice(bad)
        rows.append((i, " ".join(w)))
        marks.append((i, 1, int(i % 4 == 0)))
    rows += [(1000, None), (1001, ""), (1002, "12 34"), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = toxicity(df, lab).collect()
    assert len(got) == len(rows) and all(0 <= x.score <= 1 for x in got)
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 3 == 1) for x in got)
    held = [(x.predicted, int(x.doc_id % 4 == 0)) for x in got if x.held_out and x.doc_id < 400]
    assert sum(p == t for p, t in held) >= 0.95 * len(held)
    # Labels of held-out rows are never read.
    flipped = lab.withColumn("toxic", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1,
                                             1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert key(toxicity(df, flipped).collect()) == key(got)
    assert {x.score for x in toxicity(df, lab.filter("toxic = 0")).collect()} == {0.5}
    assert toxicity(df.limit(0), lab).count() == 0
    assert toxicity(edge_docs, labels).count() == edge_docs.count()


def test_rare_letter_runs_keep_their_counts(spark):
    """More than 500,000 different trigrams, each in few word types: every word's ratio equals that of full counts."""
    import math
    import random
    import zlib
    from collections import Counter
    from marketpulse.llm.toxicity import DISCOUNT, ClassModels, fit, letter_runs
    r = random.Random(4)
    rows = [(i, " ".join("".join(chr(0x4E00 + r.randrange(20000)) for _ in range(20)) for _ in range(130))) for i in range(200)]
    rows = [(i, t + " river rivers driver") for i, t in rows]
    marks = [(i, 1, i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    tables, _ = fit(df, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    models = ClassModels(tables["runs"], tables["shared"])
    shared = Counter(x for w in {w for _, t in rows for w in t.split()} for x in letter_runs(w, 3))
    assert len(shared) > 500_000
    total, kinds, single = Counter(), Counter(x[:-1] for x in shared), Counter(x[-1] for x in shared)
    for x, n in shared.items():
        total[x[:-1]] += n
    train = [i for i, _, _ in marks if zlib.crc32(str(i).encode()) % 3 != 1]
    count = [Counter(x for i in train if i % 2 == toxic for w in rows[i][1].split() for k in (4, 5) for x in letter_runs(w, k))
             for toxic in (1, 0)]
    after, follow = [Counter(), Counter()], [Counter(x[:-1] for x in c) for c in count]
    for c in (0, 1):
        for x, n in count[c].items():
            after[c][x[:-1]] += n

    def ratio(word):
        value = 0.0
        for run in letter_runs(word, 5):
            x = run[2:]
            p = [max(shared[x] - DISCOUNT, 0) / total[x[:-1]]
                 + DISCOUNT * kinds[x[:-1]] / total[x[:-1]] * (single[x[-1]] + 1) / (sum(single.values()) + 5000)] * 2
            for part in (run[1:], run):
                for c in (0, 1):
                    n = after[c][part[:-1]]
                    if n:
                        p[c] = max(count[c][part] - DISCOUNT, 0) / n + DISCOUNT * follow[c][part[:-1]] / n * p[c]
            value += math.log(p[0] / p[1])
        return value
    for i in (*train[:6], 150):
        for w in rows[i][1].split():
            assert abs(models.ratio(w) - ratio(w)) < 1e-9, w


def test_long_words_give_all_their_trigrams(spark, tmp_path):
    import time
    from collections import Counter
    from marketpulse.llm.common import Scratch
    from marketpulse.llm.toxicity import DISCOUNT, SHARED_ORDER, STRETCH, _backoffs
    words = [("ab" * k + "c" * 3)[:n] for k, n in ((80000, 160000), (200, STRETCH - 1), (200, STRETCH), (200, STRETCH + 1), (1, 1), (300, 603))]
    marked = ["\u0002" * (SHARED_ORDER - 1) + w + "\u0003" for w in words]
    runs = Counter(m[i:i + SHARED_ORDER] for m in marked for i in range(len(m) - SHARED_ORDER + 1))
    counted = spark.createDataFrame([("x" + r,) for r in runs], "run string")
    began = time.time()
    got = {r.run: r.p for r in _backoffs(spark.createDataFrame([(w,) for w in words], "word string"), counted,
                                         Scratch(spark, "trigrams")).collect()}
    assert time.time() - began < 30
    total, kinds, single = Counter(), Counter(), Counter()
    for r, n in runs.items():
        total[r[:-1]] += n
        kinds[r[:-1]] += 1
        single[r[-1]] += 1
    # The trigrams are taken whose first letters end a history of ``counted``: the last but the newest of "x" + run.
    seen = {("x" + r)[1:SHARED_ORDER] for r in runs}
    want = {r: max(n - DISCOUNT, 0) / total[r[:-1]] + DISCOUNT * kinds[r[:-1]] / total[r[:-1]] * (single[r[-1]] + 1) / (len(runs) + 5000)
            for r, n in runs.items() if r[:-1] in seen}
    assert set(got) == set(want) and all(abs(got[r] - want[r]) < 1e-12 for r in want)


# --- op10 ---------------------------------------------------------------------

@pytest.mark.parametrize("which", ["given", "edge", "empty", "hot"])
def test_shards(which, spark, docs, edge_docs):
    from collections import Counter, defaultdict
    hot = spark.createDataFrame([(i, "copy" if i % 3 == 0 else f"t{i // 4}") for i in range(900)], "doc_id long, text string")
    df = {"given": docs, "edge": edge_docs, "empty": docs.limit(0), "hot": hot}[which]
    rows, got = pairs(df), shard_rows(df).collect()
    import zlib
    assert key([(r.doc_id, r.size, r.text_crc32) for r in got]) == key(
        [(d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows])
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if len(rows) >= 24:
        counts = Counter(r.shard for r in got)
        assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    if which == "hot":   # small groups stay together but for those at a shard's border
        where = defaultdict(set)
        for r in got:
            where[dict(rows)[r.doc_id]].add(r.shard)
        assert sum(len(s) > 1 for t, s in where.items() if t != "copy") <= 40


def test_groups_up_to_a_shard_are_not_cut(spark):
    """24 shards of 40 rows: groups of 0.3 to 1 shard stay whole, three shards of copies fill three, small groups
    are cut at borders only."""
    from collections import defaultdict
    sizes = {"all": 120, "one": 40, "most": 36, "half": 20, "part": 14, **{f"g{i}": 12 for i in range(5)}, **{f"s{i}": 5 for i in range(100)}}
    texts = [t for t, n in sizes.items() for _ in range(n)]
    texts += [f"alone {i}" for i in range(24 * 40 - len(texts))]
    assert len(texts) == 24 * 40
    df = spark.createDataFrame([(i * 7919 % 9973, t) for i, t in enumerate(texts)], "doc_id long, text string")
    of = {r.doc_id: r.text for r in df.collect()}
    where = defaultdict(set)
    for r in shard_rows(df).collect():
        where[of[r.doc_id]].add(r.shard)
    assert len(where["all"]) == 3
    assert {t: len(where[t]) for t in sizes if sizes[t] > 5 and t != "all"} == {t: 1 for t in sizes if sizes[t] > 5 and t != "all"}
    assert sum(len(where[t]) - 1 for t in sizes if sizes[t] == 5) <= 23


# --- op7 ----------------------------------------------------------------------

def test_contaminated_rows_go_by_row(spark):
    from marketpulse.llm.decontaminate import drop_contaminated
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"x {item} y"), (1, "clean text"), (None, item), (None, "clean too"), (None, None), (2, item), (2, item), (3, "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = drop_contaminated(df, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert kept.columns == df.columns
    check(kept, [r for r in rows if item not in (r[1] or "")])


# --- pipeline -----------------------------------------------------------------

def test_pipeline_equals_its_stages_by_brute_force(spark, docs, items, labels):
    import corpus_pipeline
    from marketpulse.llm.pieces import decode_column, default_model, read_pieces
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "sentencepiece"]
    good = {r.doc_id for r in quality(docs, labels).filter("kept").collect()}
    rows = [r for r in pairs(docs) if r[0] in good]
    lead = {d for d, _, c in brute.op1(rows) if d == c}
    rows = [r for r in rows if r[0] in lead]
    dirty = {r[0] for r in brute.op7(rows, pairs(items.withColumnRenamed("item_id", "doc_id"))) if r[5]}
    rows = [r for r in rows if r[0] not in dirty]
    want = []
    for d, t in rows:
        out, at = "", 0
        for s, _, e, kind in brute.base_spans(t):
            if s >= at:
                out += t[at:s] + f"[{kind.upper()}]"
            at = max(at, e)
        want.append((d, out + t[at:]))
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.filter("not exact").count() == 0
    text = decode_column(got, read_pieces(default_model()))
    assert key([(r.doc_id, r.text) for r in text.collect()]) == key(want)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).columns == docs.columns, name


def test_near_duplicates_lose_no_row_by_its_id(spark, monkeypatch):
    a, b, c = EDGE_TEXT, "other words entirely " * 9 + "end", "third text " * 20 + "stop"
    rows = [(1, a, "x"), (2, a, "y"), (2, b, "z"), (None, c, "n"), (None, c, "m"), (None, a, "o"), (7, b, "p"), (5, None, "q"), (5, None, "r")]
    df = spark.createDataFrame(rows, "doc_id long, text string, key1 string")
    want = [(1, a), (2, b), (None, c), (5, None)]    # blank texts are linked too
    for bound in (500_000, 0):                       # keys broadcast, keys shuffled
        monkeypatch.setattr("marketpulse.llm.common.drop_keyed.__defaults__", (bound,))
        got = [(r.doc_id, r.text) for r in drop_near_duplicates(df).collect()]
        assert key(got) == key(want)
    assert drop_near_duplicates(df.limit(0)).collect() == []


def test_benchmark_gram_in_many_items(spark):
    text = "one two three four five six seven eight nine ten"
    items = spark.range(2000).select(F.col("id").alias("item_id"), F.lit(text).alias("text"))
    df = spark.createDataFrame([(1, f"so {text} end"), (2, "clean")], "doc_id long, text string")
    rows = [tuple(r) for r in contamination(df, items).collect()]
    assert key(rows) == key([tuple(r) for r in contamination(df, items, max_broadcast=10).collect()])
    assert {r[0]: r[3] for r in rows} == {1: 2000, 2: 0}

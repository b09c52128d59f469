"""Benchmark decontamination with DataFrame functions only.

The benchmark's distinct word n-grams form a hash set that is broadcast after
its size is counted (beyond the bound the same join shuffles). Every window of
every document probes it by its text, so a hash hit is verified by equality
inside the join. Hits come back as word positions and become hit words, item
lists and, in a pipeline, dropped documents.

Edge cases: NULL text has no words; an item without words has no window and
never occurs; repeated rows are judged alike, and rows that share an id but
not their text are judged apart; an item without id contaminates but is not
listed; an empty benchmark or an empty table gives clean or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import Scratch, drop_keyed, id_text, lower_ascii, sha256_hex

WINDOW = 10
#: Distinct n-grams up to which the set is broadcast (about 100 bytes each).
MAX_BROADCAST_GRAMS = 500_000
#: Words of a document that one generated row holds; a document has as many rows as it needs.
CHUNK_WORDS = 4096
# Fixed value: everything below 0x80 but 0-9 and a-z separates words.
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _SEPARATORS), "")


def benchmark_grams(benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id",
                    text_col: str = "text") -> DataFrame:
    """Distinct (item_id, gram, len): the windows of every item, or the item itself where it is shorter."""
    w = benchmark.select(benchmark[item_col].alias("item_id"), item_words(benchmark[text_col]).alias("w"))
    n = F.least(F.size("w"), F.lit(window))
    return (w.filter(F.size("w") > 0).withColumn("len", n)
            .select("item_id", "len", F.explode(F.transform(
                F.sequence(F.lit(1), F.size("w") - n + 1),
                lambda i: F.array_join(F.slice("w", i, F.col("len")), " "))).alias("gram"))
            .distinct())


def _windows(docs: DataFrame, lengths: list[int], chunk: int) -> DataFrame:
    """(doc_id, text_key, pos, len, gram): every window of the given lengths."""
    longest = max(lengths)
    rows = docs.select("doc_id", "text_key", item_words(F.col("text")).alias("w"))
    chunks = (rows.filter(F.size("w") > 0)
              .select("doc_id", "text_key", F.explode(F.transform(
                  F.sequence(F.lit(0), F.size("w") - 1, F.lit(chunk)),
                  lambda s: F.struct(s.alias("at"), F.slice("w", s + 1, F.lit(chunk + longest - 1)).alias("w"))))
                  .alias("c"))
              .select("doc_id", "text_key", "c.at", "c.w"))
    def windows(k: int) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.least(F.size("w") - k + 1, F.lit(chunk))),
            lambda i: F.struct((F.col("at") + i - 1).alias("pos"), F.lit(k).alias("len"),
                               F.array_join(F.slice("w", i, k), " ").alias("gram")))
    empty = F.array().cast("array<struct<pos:int,len:int,gram:string>>")
    all_windows = F.concat(*[F.when(F.size("w") >= k, windows(k)).otherwise(empty) for k in lengths])
    return (chunks.select("doc_id", "text_key", F.explode(all_windows).alias("x"))
            .select("doc_id", "text_key", "x.pos", "x.len", "x.gram"))


def _covered(spans: Column) -> Column:
    """Number of positions covered by an array of (pos, len) structs."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def step(a, s):
        stop = (s["pos"] + s["len"]).cast("long")
        grown = F.greatest(stop - F.greatest(a["end"], s["pos"].cast("long")), F.lit(0).cast("long"))
        return F.struct((a["n"] + grown).alias("n"), F.greatest(a["end"], stop).alias("end"))
    return F.aggregate(F.array_sort(spans), start, step, lambda a: a["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", max_broadcast: int = MAX_BROADCAST_GRAMS) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated): one row per input row."""
    return _judged(docs, benchmark, window, id_col, text_col, max_broadcast).drop("text_key")


def _judged(docs: DataFrame, benchmark: DataFrame, window: int, id_col: str, text_col: str,
            max_broadcast: int = MAX_BROADCAST_GRAMS) -> DataFrame:
    """``contamination`` with text_key, the hash that tells apart texts of one id."""
    src = id_text(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    items = benchmark_grams(benchmark, window)
    facts = items.agg(F.countDistinct("gram").alias("n"), F.count("*").alias("pairs"), F.collect_set("len").alias("lens")).first()
    out = src.select("doc_id", "text_key", F.size(item_words(F.col("text"))).cast("long").alias("n_words"))
    if facts["n"] == 0:
        found = out.select("doc_id", "text_key", F.lit(0).cast("long").alias("n_hit"),
                           F.array().cast("array<string>").alias("items")).limit(0)
    else:
        small = facts["n"] <= max_broadcast
        put = F.broadcast if small else (lambda df: df)
        grams = items.select("gram").distinct()
        hits = _windows(src, sorted(facts["lens"]), CHUNK_WORDS).join(put(grams), "gram")
        per_gram = Scratch(docs.sparkSession, "decontaminate").save(   # read twice below
            hits.groupBy("doc_id", "text_key", "gram").agg(F.collect_set(F.struct("pos", "len")).alias("at")), "hits")
        spans = per_gram.groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("at")).alias("at"),
                                                           F.collect_list("gram").alias("grams"))
        of = items.select("gram", "item_id")    # one gram may be in any number of items
        named = (spans.select("doc_id", "text_key", F.explode("grams").alias("gram"))
                 .join(F.broadcast(of) if facts["pairs"] <= max_broadcast else of, "gram")
                 .groupBy("doc_id", "text_key")
                 .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
        found = (spans.select("doc_id", "text_key", _covered(F.col("at")).alias("n_hit")).alias("s")
                 .join(named.alias("m"), F.col("s.doc_id").eqNullSafe(F.col("m.doc_id"))
                       & (F.col("s.text_key") == F.col("m.text_key")), "left")
                 .select("s.doc_id", "s.text_key", "n_hit", "items"))
    none = F.array().cast("array<string>")
    return (out.alias("d").join(found.alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.doc_id"))
                                & (F.col("d.text_key") == F.col("f.text_key")), "left")
            .select("d.doc_id", "d.text_key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", none).alias("items"))
            .select("doc_id", "text_key", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    sha256_hex(F.array_join("items", ",")).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                      id_col: str = "doc_id", text_col: str = "text", max_broadcast: int = MAX_BROADCAST_GRAMS) -> DataFrame:
    """The rows of ``docs`` without a benchmark window, whatever their id.

    Only hits name rows to drop, by (id, text hash); clean texts meet no join but that with these keys."""
    src = id_text(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    items = benchmark_grams(benchmark, window)
    facts = items.agg(F.countDistinct("gram").alias("n"), F.collect_set("len").alias("lens")).first()
    if not facts["n"]:
        return docs
    grams = items.select("gram").distinct()
    hits = _windows(src, sorted(facts["lens"]), CHUNK_WORDS).join(
        F.broadcast(grams) if facts["n"] <= max_broadcast else grams, "gram")
    dirty = Scratch(docs.sparkSession, "decontaminate").save(hits.select("doc_id", "text_key").distinct(), "dirty")
    return drop_keyed(docs, dirty, {"doc_id": docs[id_col], "text_key": F.xxhash64(docs[text_col])})

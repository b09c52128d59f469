"""Quality rules with DataFrame functions only.

Base rules (word count, repeated five-word windows) come from the text of each
row. The verdict is a hashed n-gram log-likelihood ratio: unigrams and bigrams
of word and punctuation runs are hashed into a fixed number of buckets; the
corpus multinomial counts every document, the target multinomial a bounded
sample of documents labelled good. A document's score is the sum of
log(target/corpus) over its n-grams divided by their number, and every
document is compared with one fixed threshold: no sampling, no noise.

The bucket weights, a fixed number of doubles, enter the scoring expression as
one literal array, so scoring moves no text and shuffles nothing.

Edge cases: NULL or blank text has no words and fails the base rule; repeated
rows are judged alike; without labels or without documents every weight is
zero and only the base rules decide.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import id_text, words

BUCKETS = 1 << 14
#: Documents labelled good that the target multinomial is fitted on, by smallest id hash.
TARGET_SAMPLE = 20_000
#: Added to each bucket's target count; the corpus count gets the same in proportion.
PRIOR = 0.5
#: Mean log-likelihood ratio below which a document is rejected.
THRESHOLD = -0.35
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
# Fixed values of the base rules: symbols counted, and the two kinds of run that n-grams are made of.
SYMBOLS = r"[#*$%&|<>]"
TOKENS = r"[0-9A-Za-z_\x{80}-\x{10FFFF}]++|[!-/:-@\[-^`{-~]++"


def base_counts(src: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words to (doc_id, text)."""
    k = REPEAT_WINDOW
    step1 = src.select("*", words(F.col("text")).alias("_w")).select("*", F.transform("_w", lambda w: F.xxhash64(w)).alias("_x"))
    lines = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), "\n"),
                     lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    none = F.array().cast("array<bigint>")
    step2 = step1.select(
        "*", F.size("_w").cast("long").alias("n_words"),
        F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.coalesce(F.regexp_count("text", F.lit(SYMBOLS)), F.lit(0)).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        F.when(F.size("_w") > k, F.transform(
            F.sequence(F.lit(1), F.size("_w") - (k - 1)),
            lambda i: F.xxhash64(*[F.get("_x", i + (j - 1)) for j in range(k)]))).otherwise(none).alias("_h"))
    # Only documents in which some window repeats pay for the sort.
    step3 = step2.select(
        "*", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.array_sort(
            F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("_p")).drop("_lines", "_h", "_w", "_x")

    def again(x, i):
        return (F.get("_p", i - 1)["h"].eqNullSafe(x["h"])) | (F.get("_p", i + 1)["h"].eqNullSafe(x["h"]))
    step4 = step3.select("*", F.array_sort(F.transform(F.filter("_p", again), lambda x: x["i"])).alias("_s")).drop("_p")
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    cover = F.aggregate("_s", zero, lambda a, s: F.struct(
        (a["n"] + (s + k) - F.greatest(a["end"], s)).cast("long").alias("n"), (s + k).alias("end")), lambda a: a["n"])
    return step4.select("*", F.coalesce(cover, F.lit(0).cast("long")).alias("n_repeat_words")).drop("_s")


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKENS), F.lit(0))


def _bucket(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets).cast("long")).cast("int")


def ngram_buckets(tokens: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of the unigrams and bigrams of the array column named by ``tokens``."""
    one = F.transform(tokens, lambda t: _bucket(F.xxhash64(t), buckets))
    two = F.transform(F.slice(tokens, F.lit(2), F.greatest(F.size(tokens), F.lit(1))),
                      lambda t, i: _bucket(F.xxhash64(F.get(tokens, i), t), buckets))
    return F.concat(one, two)


def bucket_weights(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS,
                   target_sample: int = TARGET_SAMPLE, prior: float = PRIOR) -> list[float]:
    """log(target/corpus) of each bucket, from all of ``docs`` (doc_id, text)."""
    good = (labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_sample)
            .select("doc_id", F.lit(1).alias("_good")))
    grams = (docs.select("doc_id", "text").join(F.broadcast(good), "doc_id", "left")
             .select("_good", _tokens(F.col("text")).alias("_t"))
             .select("_good", F.explode(ngram_buckets(F.col("_t"), buckets)).alias("b")))
    rows = grams.groupBy("b").agg(F.count("*").alias("n"), F.count("_good").alias("good")).collect()
    all_n, good_n = sum(r["n"] for r in rows), sum(r["good"] for r in rows)
    weights = [0.0] * buckets
    if not good_n:
        return weights
    for r in rows:
        raw = (r["n"] + prior * all_n / good_n) / (all_n + prior * buckets * all_n / good_n)
        weights[r["b"]] = round(math.log((r["good"] + prior) / (good_n + prior * buckets) / raw), 5)
    return weights


def llr_score(tokens: Column, weights: list[float]) -> Column:
    """Mean weight over the n-grams of the array column ``tokens``; 0 when it has none."""
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    b = ngram_buckets(tokens, len(weights))
    total = F.aggregate(b, F.lit(0.0), lambda a, x: a + F.get(table, x))
    n = 2 * F.size(tokens) - 1
    return F.when(F.size(tokens) > 0, F.round(total / n, 9)).otherwise(F.lit(0.0))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            threshold: float = THRESHOLD, target_sample: int = TARGET_SAMPLE) -> DataFrame:
    """(doc_id, counts, base_failed, score, kept): one row per input row."""
    src = id_text(docs, id_col, text_col)
    return _judge(src, bucket_weights(src, labels, target_sample=target_sample), threshold).drop("text")


def _judge(src: DataFrame, weights: list[float], threshold: float) -> DataFrame:
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    # A filter on the verdict must not move below the token array: put in place
    # of its name there, the pattern would run again for every token. Filters
    # do not pass a projection whose value they need and that is not fixed.
    fence = F.spark_partition_id().alias("_fence")
    verdict = ~F.col("base_failed") & (F.col("score") >= threshold)
    return (base_counts(src).select("*", _tokens(F.col("text")).alias("_t"), fence)
            .select("*", llr_score(F.col("_t"), weights).alias("score")).drop("_t")
            .select("*", failed.alias("base_failed"))
            .select("*", F.when(F.col("_fence") >= 0, verdict).alias("kept")).drop("_fence"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              threshold: float = THRESHOLD, target_sample: int = TARGET_SAMPLE) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns; nothing is joined or shuffled."""
    weights = bucket_weights(id_text(docs, id_col, text_col), labels, target_sample=target_sample)
    whole = F.struct(*[docs[c] for c in docs.columns])
    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), whole.alias("_row"))
    return _judge(src, weights, threshold).filter("kept").select("_row.*")

"""Toxicity by class-conditional Kneser-Ney models over the letters of words.

Two models, toxic and ordinary, predict each letter of a word from the four
before it. Both are interpolated Kneser-Ney models fitted on labelled texts;
below the trigram they share one backoff distribution, whose counts are the
word types of the whole corpus that hold a trigram. A letter run that neither
class has seen thus costs both the same, and rare words lean on shared counts.
The trigrams are counted in Spark, all of them; workers get the probabilities of
those that go on from letters a class has seen, as the others cost both the same.

A document's evidence is the log-likelihood ratio of its distinct words,
normalised by their number (plain and by its root), the share of clearly toxic
words and the two strongest ones; a logistic curve, fitted on the evidence that
models of one half of the labelled texts give for the other, turns it into a
score from 0 to 1.

Labels of rows whose crc32(doc_id) leaves 1 modulo 3 are never read; language,
source and id are never inputs. Class models and curve are fitted on at most
``SAMPLE_DOCS`` labelled documents per class, the smallest by a hash of the id.

Edge cases: NULL and empty texts have no words and get the curve's value at
zero evidence; with labels of one kind only, every score is 0.5; a document
labelled twice counts as toxic if one label says so; repeated rows score alike;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import Scratch, id_text

ORDER = 5
SHARED_ORDER = 3
DISCOUNT = 0.75
#: Labelled documents per class. Models of one half give the evidence that the
#: curve is fitted on for the other half; the models that score use both.
SAMPLE_DOCS = 3000
CUTOFF = 0.7
_STRONG, _CAP = 3.0, 30.0
_WORD = r"[^\W\d_]+"
_MEMORY = 300_000
_FLUSH = 200_000


def letter_runs(word: str, order: int) -> list[str]:
    """The runs of ``order`` letters that predict each letter and the word's end."""
    s = "\u0002" * (order - 1) + word + "\u0003"
    return [s[i:i + order] for i in range(len(s) - order + 1)]


class ClassModels:
    """Log-likelihood ratios of words under the two models.

    ``runs``: (run, toxic count, ordinary count) for each order from ORDER down
    to SHARED_ORDER + 1; ``shared``: (run, backoff probability) of SHARED_ORDER, for
    all runs that follow letters of ``runs``."""

    def __init__(self, runs, shared):
        self.levels = []
        for order in range(ORDER, SHARED_ORDER, -1):
            count = ({}, {})
            total, kinds = ({}, {}), ({}, {})
            for run, *both in runs:
                if len(run) == order:
                    for c in (0, 1):
                        if both[c]:
                            h = run[:-1]
                            count[c][run] = both[c]
                            total[c][h] = total[c].get(h, 0) + both[c]
                            kinds[c][h] = kinds[c].get(h, 0) + 1
            self.levels.append((count, total, kinds))
        self.shared = dict(shared)
        self.run_memory: dict = {}
        self.word_memory: dict = {}

    def _backoff(self, run: str) -> float:
        return self.shared.get(run, 1.0)   # 1 for runs that only count where no class has seen the letters

    def probability(self, run: str, c: int) -> float:
        """Of the last letter of ``run`` after the others, in class c."""
        p = self._backoff(run[-SHARED_ORDER:])
        for k in range(len(self.levels) - 1, -1, -1):
            count, total, kinds = (x[c] for x in self.levels[k])
            part = run[-(ORDER - k):]
            n = total.get(part[:-1])
            if n:
                p = max(count.get(part, 0) - DISCOUNT, 0) / n + DISCOUNT * kinds[part[:-1]] / n * p
        return p

    def ratio(self, word: str) -> float:
        known = self.word_memory.get(word)
        if known is not None:
            return known
        value, memory = 0.0, self.run_memory
        for run in letter_runs(word, ORDER):
            x = memory.get(run)
            if x is None:
                if len(memory) >= _MEMORY * 4:
                    memory.clear()
                x = memory[run] = math.log(self.probability(run, 0) / self.probability(run, 1))
            value += x
        if len(word) <= 40:
            if len(self.word_memory) >= _MEMORY:
                self.word_memory.clear()
            self.word_memory[word] = value
        return value

    def evidence(self, words) -> list[float]:
        kinds = sorted(set(words))   # sums in one order, whatever the text's
        if not kinds:
            return [0.0] * 5
        v = np.array([self.ratio(w) for w in kinds])
        m = len(v)
        top = np.sort(v)[-2:].sum() / 2
        return [v.sum() / m, v.sum() / math.sqrt(m), (v > _STRONG).sum() / m, min(float(top), _CAP), math.log(m)]


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 40):
    """Logistic regression by Newton steps: (means, deviations, weights)."""
    mean, dev = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - mean) / dev, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (q - y) + ridge * w
        w = w - np.linalg.solve((z * (q * (1 - q))[:, None]).T @ z + ridge * np.eye(len(w)), slope)
    return mean, dev, w


def curve_value(curve, x: np.ndarray) -> np.ndarray:
    mean, dev, w = curve
    return 1 / (1 + np.exp(-np.clip(np.c_[(x - mean) / dev, np.ones(len(x))] @ w, -30, 30)))


def held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _sample(labels: DataFrame, size: int) -> DataFrame:
    """(label_id, toxic, fold): at most ``size`` training rows per class, in two halves."""
    rows = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out("doc_id"))
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    half = [rows.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size) for t in (0, 1)]
    return half[0].union(half[1]).select(F.col("doc_id").alias("label_id"), "toxic",
                                         F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)).cast("int").alias("fold"))


def _words(text: str | None) -> list[str]:
    return re.findall(_WORD, (text or "").lower())


def _type_runs(batches):
    """The distinct words of a task's texts."""
    seen: set = set()
    for b in batches:
        for t in b.column(0).to_pylist():
            seen.update(_words(t))
            if len(seen) >= _FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], ["word"])
                seen = set()
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], ["word"])


def _count_runs(batches):
    """(run, toxic, fold, n) for the labelled texts of a batch, of every class order."""
    from collections import Counter
    for b in batches:
        count: Counter = Counter()
        for t, toxic, fold in zip(*(b.column(k).to_pylist() for k in range(3))):
            for w, n in Counter(_words(t)).items():
                for order in range(SHARED_ORDER + 1, ORDER + 1):
                    for run in letter_runs(w, order):
                        count[run, toxic, fold] += n
        keys = list(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([k[2] for k in keys], pa.int32()), pa.array([count[k] for k in keys], pa.int64())],
            ["run", "toxic", "fold", "n"])


#: Letters of a stretch of a word.
STRETCH = 256


def _backoffs(types: DataFrame, counted: DataFrame, scratch: Scratch) -> DataFrame:
    """(run, p): the shared probability of the last letter of each trigram of the word types, for the trigrams
    whose other letters end what stands before a letter of ``counted``; counts, totals and kinds are of all trigrams."""
    marked = F.concat(F.lit("\u0002" * (SHARED_ORDER - 1)), F.col("word"), F.lit("\u0003"))
    # Long words are cut once into stretches that overlap by all but a letter of a run.
    stretch = rf"(?s)(?=(.{{1,{STRETCH + SHARED_ORDER - 1}}})).{{1,{STRETCH}}}"
    cut = types.select(F.explode(F.regexp_extract_all(marked, F.lit(stretch), F.lit(1))).alias("cut"))
    starts = F.sequence(F.lit(1), F.char_length("cut") - (SHARED_ORDER - 1))
    rows = scratch.save(cut.filter(F.char_length("cut") >= SHARED_ORDER).select(F.explode(F.transform(
        starts, lambda i: F.substring("cut", i, F.lit(SHARED_ORDER)))).alias("run")).groupBy("run").agg(F.count("*").alias("n"))
        .select("run", "n", F.substring("run", 1, SHARED_ORDER - 1).alias("h"), F.substring("run", SHARED_ORDER, 1).alias("last")),
        "trigrams")
    every = rows.count()
    after = rows.groupBy("h").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    single = rows.groupBy("last").agg(F.count("*").alias("single"))   # letters: bounded by Unicode
    seen = (counted.filter(F.char_length("run") == SHARED_ORDER + 1)
            .select(F.substring("run", 2, SHARED_ORDER - 1).alias("h")).distinct())
    low = (F.col("single") + 1) / F.lit(float(every + 5000))
    p = F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) / F.col("total") + DISCOUNT * F.col("kinds") / F.col("total") * low
    return (rows.join(after.join(seen, "h", "left_semi"), "h").join(F.broadcast(single), "last")
            .select("run", p.alias("p")))


def _models(holder: dict) -> ClassModels:
    """Built once per worker: a broadcast value stays with the worker's process."""
    if "models" not in holder:
        holder["models"] = ClassModels(holder["runs"], holder["shared"])
    return holder["models"]


def _evidence(shared, extra: int):
    """Arrow batches (text, other columns...) to (other columns..., x)."""
    def run(batches):
        models = _models(shared.value)
        for b in batches:
            x = [models.evidence(_words(t)) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(k + 1) for k in range(extra)] + [pa.array(x, pa.list_(pa.float64()))],
                [*b.schema.names[1:1 + extra], "x"])
    return run


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id",
        text_col: str = "text") -> tuple[dict, tuple] | None:
    """The models' tables and the curve; None without labels of both kinds."""
    src = id_text(docs, id_col, text_col)
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample = _sample(labels, sample_docs)
    texts = scratch.save(src.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
                         .select("text", F.col("toxic").cast("int").alias("toxic"), "fold"), "labelled")
    seen = {(r["toxic"], r["fold"]) for r in texts.select("toxic", "fold").distinct().collect()}
    if len(seen) < 4:
        return None

    def count(toxic: int, fold: int):
        return F.sum(F.when((F.col("toxic") == toxic) & (F.col("fold") == fold), F.col("n")).otherwise(0)).alias(f"c{toxic}{fold}")
    counted = scratch.save(texts.mapInArrow(_count_runs, "run string, toxic int, fold int, n long").groupBy("run")
                           .agg(*[count(t, f) for f in (0, 1) for t in (1, 0)]), "runs")
    runs = [tuple(r) for r in counted.collect()]   # those of the sample
    types = src.select("text").mapInArrow(_type_runs, "word string").distinct()
    shared = [tuple(r) for r in _backoffs(types, counted, scratch).collect()]
    x, y = [], []
    for fold in (0, 1):   # each half is judged by models of the other
        other = 2 * (1 - fold)
        half = {"runs": [(r[0], r[1 + other], r[2 + other]) for r in runs], "shared": shared}
        sent = docs.sparkSession.sparkContext.broadcast(half)
        for r in (texts.filter(F.col("fold") == fold).select("text", "toxic")
                  .mapInArrow(_evidence(sent, 1), "toxic int, x array<double>").collect()):
            x.append(r["x"])
            y.append(r["toxic"])
        sent.unpersist()
    x, y = np.array(x), np.array(y, float)
    best = np.lexsort((y, *x.T))   # one order of addition, whatever the partitions
    return {"runs": [(r[0], r[1] + r[3], r[2] + r[4]) for r in runs], "shared": shared}, fit_curve(x[best], y[best])


def toxicity(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id",
             text_col: str = "text", cutoff: float = CUTOFF) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per input row. Fits its models while it is called."""
    src = id_text(docs, id_col, text_col)
    fitted = fit(docs, labels, sample_docs, id_col, text_col)
    if fitted is None:
        return src.select("doc_id", held_out("doc_id").alias("held_out"), F.lit(0.5).alias("score"),
                          F.lit(0).alias("predicted"))
    tables, curve = fitted
    sent = docs.sparkSession.sparkContext.broadcast(tables)

    def run(batches):
        for b in _evidence(sent, 1)(batches):
            x = np.array(b.column(1).to_pylist()).reshape(-1, len(curve[0]))
            score = np.round(curve_value(curve, x), 9)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score)], ["doc_id", "score"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return (src.select("text", "doc_id").mapInArrow(run, f"doc_id {kind}, score double")
            .select("doc_id", held_out("doc_id").alias("held_out"), "score",
                    (F.col("score") >= cutoff).cast("int").alias("predicted")))

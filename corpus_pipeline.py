"""The training-text pipeline: five operators, one after the other, over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet to the cluster's shared folder and read back as the next stage's
docs, so a lost executor costs at most the running stage. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.llm.common import Scratch, table
from marketpulse.llm.decontaminate import drop_contaminated
from marketpulse.llm.pieces import default_model, encode_column, read_pieces
from marketpulse.llm.pii import mask_personal_data
from marketpulse.llm.quality import keep_good
from marketpulse.llm.simhash import drop_near_duplicates


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked; ``n_chars`` follows the new text."""
    out = mask_personal_data(docs)
    if "n_chars" not in out.columns:
        return out
    count = F.when(F.col("text").isNotNull(), F.char_length("text").cast(out.schema["n_chars"].dataType))
    return out.withColumn("n_chars", F.coalesce(count, F.col("n_chars")))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, exact): the documents as subword ids, each decoded once to prove it."""
    return encode_column(docs, read_pieces(default_model()))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("sentencepiece", encoding_stage),
]

#: Scores from a fitted model, 64-bit hashes and subword ids are beyond SQL;
#: tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs

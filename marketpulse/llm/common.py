"""Shared helpers: table access, text expressions and scratch tables."""

from __future__ import annotations

import gc
import os
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.session import checkpoint_dir

# Fixed value: the white space of the word rule.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): whatever else the table holds, under any name, is left out."""
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+``; empty for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else: ``lower`` would also fold other alphabets,
    so it serves only for texts of one byte per character."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


#: Keys of dropped rows up to which they are broadcast (an id and hashes, about 100 bytes each).
MAX_BROADCAST_KEYS = 500_000


def drop_keyed(docs: DataFrame, keys: DataFrame, on: dict[str, Column], max_broadcast: int = MAX_BROADCAST_KEYS) -> DataFrame:
    """The rows of ``docs`` whose values ``on`` (key column → expression) are in no row of ``keys``; NULLs are equal.

    ``keys`` is a written table. Its rows are counted: a small one is broadcast, so that no text moves; a larger one is
    joined by a shuffle."""
    names = [f"_key{k}" for k in range(len(on))]
    gone = keys.select(*[F.col(c).alias(n) for c, n in zip(on, names)])
    if gone.limit(max_broadcast + 1).count() <= max_broadcast:
        gone = F.broadcast(gone)
    same = F.lit(True)
    for n, value in zip(names, on.values()):
        same = same & value.eqNullSafe(F.col(n))
    return docs.join(gone, same, "left_anti")


class Scratch:
    """Tables written to the cluster's shared checkpoint folder.

    A table written once is read back by every later step, so a lost executor
    costs only the running step and no expensive step runs twice. ``drop``
    deletes a table that no later plan reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = os.path.join(checkpoint_dir(spark), f"llm-{label}-{uuid.uuid4().hex}")

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def release(self, *names: str) -> None:
        """Deletes finished tables and lets Spark free finished shuffles.

        Shuffle files live until the driver's collector notices that no plan
        refers to them; a driver with a quiet heap may not collect for a long
        time, so it is asked to after a phase whose result is on disk."""
        for n in names:
            self.drop(n)
        for _ in range(2):   # the first frees the plans, the second what only they referred to
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.5)

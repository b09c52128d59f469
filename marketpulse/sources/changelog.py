"""SRC-6: an append-only change log of a reference table.

Every load of a reference table appends its rows (with ``_ingested_at``) to
the log; the log is never rewritten, so a stream over it has no update or
delete commits to skip. Batch id directories make a replayed batch
overwrite itself instead of appending twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def append_changes(df: DataFrame, log_dir: str, batch_id: int | str) -> None:
    df.write.mode("overwrite").parquet(f"{log_dir}/batch={batch_id}")


def read_change_log(spark: SparkSession, log_dir: str, schema: StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(log_dir)
    return df.drop("batch") if "batch" in df.columns else df


def change_log_stream(spark: SparkSession, log_dir: str, schema: StructType,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.parquet(log_dir)
    return df.drop("batch") if "batch" in df.columns else df

"""SRC-3, SRC-4, SRC-5, SNK-5: reference tables over JDBC or CSV, the
historical-trade backfill, and loading seed rows into the database.

JDBC reads are parallel when a numeric/date partition column and bounds are
given (Spark issues one range query per partition); without them the whole
table arrives in one task, fine only for small reference tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import REFERENCE_CSV, TRADE_RAW
from ..functions.timefmt import format_event_time


def jdbc_options(url: str, table: str, *, user: str | None = None, password: str | None = None,
                 driver: str | None = None, partition_column: str | None = None,
                 lower_bound=None, upper_bound=None, num_partitions: int | None = None,
                 fetch_size: int | None = 10_000) -> dict[str, str]:
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    if fetch_size:
        opts["fetchsize"] = str(fetch_size)
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return opts


def read_reference_jdbc(spark: SparkSession, url: str, table: str, *, lineage: bool = True,
                        **options) -> DataFrame:
    df = spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()
    return df.withColumn("_ingested_at", F.current_timestamp()) if lineage else df


def read_reference_csv(spark: SparkSession, path: str, kind: str, *, lineage: bool = True) -> DataFrame:
    """Typed CSV with a header; an empty field (e.g. ``manager``) reads as NULL."""
    df = spark.read.schema(REFERENCE_CSV[kind]).option("header", True).option("mode", "PERMISSIVE").csv(path)
    return df.withColumn("_ingested_at", F.current_timestamp()) if lineage else df


def read_historical_trades(spark: SparkSession, url: str, *, table: str = "source.historical_trades",
                           lower_date: str, upper_date: str, num_partitions: int, **options) -> DataFrame:
    """Backfill rows, range-partitioned on ``trade_date``."""
    return spark.read.format("jdbc").options(**jdbc_options(
        url, table, partition_column="trade_date", lower_bound=lower_date, upper_bound=upper_date,
        num_partitions=num_partitions, **options)).load()


def historical_as_raw(hist: DataFrame) -> DataFrame:
    """Historical rows in the raw-trade shape (decimal price → double, the
    timestamp rendered in the feed's text format), ready to union."""
    cols = []
    for f in TRADE_RAW.fields:
        if f.name == "timestamp":
            cols.append(format_event_time(F.col("timestamp").cast("timestamp_ntz")).alias("timestamp"))
        elif f.name in hist.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return hist.select(*cols)


def with_backfill(raw: DataFrame, hist: DataFrame) -> DataFrame:
    """Live raw trades ∪ backfill; the trade dedup then keeps one per id."""
    return raw.unionByName(historical_as_raw(hist), allowMissingColumns=True)


def load_reference(df: DataFrame, url: str, table: str, *, truncate: bool = False,
                   **options) -> None:
    """Seed load. ``truncate`` empties the table first but keeps its DDL."""
    w = df.write.format("jdbc").options(**jdbc_options(url, table, **options))
    if truncate:
        w = w.option("truncate", "true").mode("overwrite")
    else:
        w = w.mode("append")
    w.save()

"""SRC-8: row count per source table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count): one global count per table, stacked.

    Each count reads only parquet footers / the cheapest column."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)

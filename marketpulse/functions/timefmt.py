"""Event-time parsing and bucketing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the text format of event times in trade and tick files.
# The 'Z' is a quoted literal, not a zone: the text is wall-clock UTC.
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

# Fixed value: events at or after this instant fail the timestamp rule.
FUTURE_CUTOFF = "2028-01-01"


def parse_event_time(c) -> Column:
    """Text → ``timestamp_ntz`` holding the literal wall clock.

    ``try_to_timestamp`` yields NULL on garbage instead of failing the batch
    (Spark 4 runs ANSI by default). Parsing and the cast back to NTZ use the
    same session zone, so the result is the text's clock whatever the zone.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(c, F.lit(EVENT_TIME_PATTERN)).cast("timestamp_ntz")


def format_event_time(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, EVENT_TIME_PATTERN)


def with_event_time(df: DataFrame, source: str = "timestamp") -> DataFrame:
    """Add ``event_time`` from the raw text unless the input already has it."""
    if "event_time" in df.columns:
        return df
    return df.withColumn("event_time", parse_event_time(source))


def hour_bucket(c) -> Column:
    """``date_trunc('hour', t)`` kept as ``timestamp_ntz``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_trunc("hour", c).cast("timestamp_ntz")

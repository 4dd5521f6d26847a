"""Event-time helpers. Wall-clock results are zone-less and mean UTC."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def utc_wall_clock(df: DataFrame, name: str) -> Column:
    """The column as TIMESTAMP_NTZ in UTC, whatever the session time zone is."""
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.expr(f"{EPOCH} + INTERVAL '0.000001' SECOND * unix_micros(`{name}`)")
    return F.col(name)


def utc_instant(df: DataFrame, name: str) -> Column:
    """The column as TIMESTAMP (an instant), reading zone-less values as UTC."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        seconds = f"CAST(CAST(`{name}` - {EPOCH} AS INTERVAL SECOND) AS DECIMAL(20, 6))"
        return F.expr(f"timestamp_seconds({seconds})")
    return F.col(name)


def iso_utc(wall_clock: Column) -> Column:
    """yyyy-MM-ddTHH:mm:ssZ; casting keeps the session time zone out of it."""
    return F.concat(F.translate(wall_clock.cast("string"), " ", "T"), F.lit("Z"))


def date_key(wall_clock: Column) -> Column:
    """yyyyMMdd."""
    return F.translate(wall_clock.cast("date").cast("string"), "-", "")


def as_of_column(as_of: datetime | Column) -> Column:
    """The reference time of a report: a given moment, or a column such as latest_event."""
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def latest_event(logs: DataFrame) -> Column:
    """The newest event time as a scalar subquery: no driver round trip."""
    return logs.agg(F.max("timestamp")).scalar()

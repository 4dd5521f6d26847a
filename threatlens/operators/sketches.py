"""Daily sketches: volume profiles and distinct targets over any range of stored days.

A day of logs becomes one small row per group, with exact counts and a mergeable sketch. A
range of days merges the stored rows; no log is read again, and a new day costs that day.
"""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.functions.times import utc_wall_clock
from threatlens.operators.reputation import suspicious_events
from threatlens.operators.volume import GROUP, PERCENTILE, SIZE

#: Size of a quantile sketch, and the error of its ranks: twice that of 99 percent confidence.
QUANTILE_SKETCH = 1_000
RANK_ERROR = 2 * 2.296 / QUANTILE_SKETCH**0.9723
#: Registers (as a power of two) of a distinct-count sketch; three standard errors of it.
DISTINCT_SKETCH = 12
DISTINCT_ERROR = 3 * 1.04 / 2 ** (DISTINCT_SKETCH / 2)
TARGET_GROUP = ["source_ip", "log_type"]
# Columns of the stored tables, the day being the folder.
VOLUME_DAYS = (
    "threat_label string, log_type string, protocol string, event_count long, size_count long, total_bytes long,"
    " max_bytes long, sizes binary, day date"
)
TARGET_DAYS = "source_ip string, log_type string, total_events long, total_bytes long, targets binary, day date"


def _day(logs: DataFrame) -> Column:
    return utc_wall_clock(logs, "timestamp").cast("date").alias("day")


def volume_by_day(logs: DataFrame) -> DataFrame:
    """Per day and group: counts, bytes, and a quantile sketch of the sizes.

    A task sends one sketch per group and day, however many rows it has read.
    """
    return logs.groupBy(*GROUP, _day(logs)).agg(
        F.count("*").alias("event_count"),
        F.count(SIZE).alias("size_count"),
        F.sum(SIZE).alias("total_bytes"),
        F.max(SIZE).alias("max_bytes"),
        F.kll_sketch_agg_bigint(SIZE, QUANTILE_SKETCH).alias("sizes"),
    ).select(*GROUP, "event_count", "size_count", "total_bytes", "max_bytes", "sizes", "day")


def volume_of_days(days: DataFrame) -> DataFrame:
    """The volume profile over stored days; exact but for the percentile (RANK_ERROR)."""
    merged = days.groupBy(*GROUP).agg(
        F.sum("event_count").alias("event_count"),
        F.sum("size_count").alias("size_count"),
        F.sum("total_bytes").alias("total_bytes"),
        F.max("max_bytes").alias("max_bytes"),
        F.kll_merge_agg_bigint(F.when(F.col("size_count") > 0, F.col("sizes"))).alias("sizes"),
    )
    known = F.col("size_count") > 0
    return merged.select(
        *GROUP,
        F.when(known, F.col("total_bytes") / F.col("size_count")).alias("avg_bytes"),
        "max_bytes",
        F.when(known, F.kll_sketch_get_quantile_bigint("sizes", F.lit(PERCENTILE))).alias("p95_bytes"),
        "event_count",
        "total_bytes",
    ).orderBy(F.desc("total_bytes"), *GROUP)


def targets_by_day(logs: DataFrame) -> DataFrame:
    """Per day, source and log type: suspicious events, bytes, and a sketch of their targets."""
    bad = suspicious_events(logs)
    return bad.groupBy(*TARGET_GROUP, _day(bad)).agg(
        F.count("*").alias("total_events"),
        F.sum("bytes_transferred").alias("total_bytes"),
        F.hll_sketch_agg("dest_ip", DISTINCT_SKETCH).alias("targets"),
    ).select(*TARGET_GROUP, "total_events", "total_bytes", "targets", "day")


def targets_of_days(days: DataFrame) -> DataFrame:
    """As `suspicious_by_ip_logtype`, over stored days; targets within DISTINCT_ERROR."""
    return days.groupBy(*TARGET_GROUP).agg(
        F.sum("total_events").alias("total_events"),
        F.hll_sketch_estimate(F.hll_union_agg("targets")).alias("unique_targets"),
        F.sum("total_bytes").alias("total_bytes"),
    )


def store_days(rows: DataFrame, path: str) -> None:
    """Stores daily rows, one folder a day; days that are there are replaced, others stay."""
    (
        rows.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("day").parquet(path)
    )


def read_days(
    spark: SparkSession, path: str, columns: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """The stored days of a range, ends included; only their folders are read."""
    days = spark.read.schema(columns).parquet(path)
    if first is not None:
        days = days.filter(F.col("day") >= F.lit(first))
    if last is not None:
        days = days.filter(F.col("day") <= F.lit(last))
    return days

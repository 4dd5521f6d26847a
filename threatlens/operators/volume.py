"""Volume profile and hourly timeline."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threatlens.functions.times import as_of_column, date_key
from threatlens.session import shared_folder, stage

LABELS = ["malicious", "suspicious", "benign"]
TIMELINE_KEYS = ["event_date", "event_hour"]
GROUP = ["threat_label", "log_type", "protocol"]
SIZE = "bytes_transferred"
PERCENTILE = 0.95
PERCENTILE_ACCURACY = 10_000
SLICES = 4_096


def volume_profile(logs: DataFrame, staging: str | None = None) -> DataFrame:
    """Average, maximum, exact 95th percentile, count and sum of bytes per group.

    Runs jobs when called, and stages their small results below `staging` (by default in
    the shared folder of the session). The groups are few and huge, so nothing
    proportional to a group may meet in one task. The first pass counts by group and size
    bucket, a few thousand buckets per group at most; its result gives every measure but
    the percentile, and the bucket the percentile falls in. The second pass counts the
    values of that one bucket, which is then narrowed slice by slice.
    """
    folder = shared_folder(logs.sparkSession, staging)
    sized = logs.select(*GROUP, SIZE, _bucket().alias("bucket"))
    buckets = stage(
        sized.groupBy(*GROUP, "bucket").agg(
            F.count("*").alias("events"),
            F.count(SIZE).alias("values"),
            F.sum(SIZE).alias("bytes"),
            F.max(SIZE).alias("largest"),
        ),
        f"{folder}/buckets",
    )
    totals = buckets.groupBy(*GROUP).agg(
        (F.sum("bytes") / F.sum("values")).alias("avg_bytes"),
        F.max("largest").alias("max_bytes"),
        F.sum("events").alias("event_count"),
        F.sum("bytes").alias("total_bytes"),
    )
    # One row per group, staged so that Spark knows its size and picks the join.
    targets = stage(_holder(buckets.filter("bucket is not null"), "bucket", _share()), f"{folder}/targets")
    in_bucket = with_group(sized, targets, "inner", "bucket").filter(F.col(SIZE).isNotNull())
    counted = stage(
        in_bucket.groupBy(*GROUP, "rank", SIZE).agg(F.count("*").alias("values")), f"{folder}/counted-0"
    )
    return (
        with_group(totals, _percentile(counted, folder), "left")
        .select(*GROUP, "avg_bytes", "max_bytes", "p95_bytes", "event_count", "total_bytes")
        .orderBy(F.desc("total_bytes"), *GROUP)
    )


def _bucket() -> Column:
    """A non-decreasing integer of the size; neighbours differ by about 1.5 percent."""
    size = F.col(SIZE).cast("double")
    return (F.signum(size) * F.floor(F.log1p(F.abs(size)) * 64)).cast("int")


def _share() -> Column:
    """The rank of the percentile among all values of the group."""
    return F.ceil(F.sum("values").over(Window.partitionBy(*GROUP)) * PERCENTILE)


def _holder(counts: DataFrame, part: str, rank: Column) -> DataFrame:
    """Per group the part whose values hold the rank, and the rank inside it."""
    so_far = F.sum("values").over(Window.partitionBy(*GROUP).orderBy(part))
    return (
        counts.select(*GROUP, part, "values", so_far.alias("so_far"), rank.alias("rank"))
        .filter((F.col("so_far") >= F.col("rank")) & (F.col("so_far") - F.col("values") < F.col("rank")))
        .select(*GROUP, part, (F.col("rank") - F.col("so_far") + F.col("values")).alias("rank"))
    )


def _percentile(counted: DataFrame, folder: str) -> DataFrame:
    """The value at the rank of each group, from the counts of its distinct values.

    While a group's values span more than SLICES integers they are cut into that many
    slices, and only the slice that holds the rank goes on: no task orders more than
    SLICES values of a group.
    """
    turn = 0
    while True:
        spans = counted.groupBy(*GROUP).agg(F.min(SIZE).alias("low"), F.max(SIZE).alias("high"))
        width = F.floor((F.col("high") - F.col("low")) / SLICES) + 1
        spans = stage(spans.select(*GROUP, "low", width.alias("width")), f"{folder}/spans-{turn}")
        if spans.filter("width > 1").isEmpty():
            break
        sliced = with_group(counted, spans, "inner").select(
            *GROUP, "rank", SIZE, "values", F.floor((F.col(SIZE) - F.col("low")) / F.col("width")).alias("slice")
        )
        counts = sliced.groupBy(*GROUP, "rank", "slice").agg(F.sum("values").alias("values"))
        held = _holder(counts, "slice", F.col("rank"))
        turn += 1
        counted = stage(
            with_group(sliced.drop("rank"), held, "inner", "slice").select(*GROUP, "rank", SIZE, "values"),
            f"{folder}/counted-{turn}",
        )
    return _holder(counted, SIZE, F.col("rank")).select(*GROUP, F.col(SIZE).alias("p95_bytes"))


def with_group(left: DataFrame, right: DataFrame, how: str, *more_keys: str) -> DataFrame:
    """Joins by group, where a missing label is a group too."""
    keys = [*GROUP, *more_keys]
    renamed = right.withColumnsRenamed({k: f"other_{k}" for k in keys})
    same = [left[k].eqNullSafe(renamed[f"other_{k}"]) for k in keys]
    return left.join(renamed, same, how).drop(*[f"other_{k}" for k in keys])


def volume_profile_sketch(logs: DataFrame, accuracy: int = PERCENTILE_ACCURACY) -> DataFrame:
    """The same profile in one pass, with a percentile sketch of rank error 1/accuracy.

    Lazy and quick on small data; at scale all sketches of a group meet in one task.
    """
    size = F.col(SIZE)
    return (
        logs.groupBy(*GROUP)
        .agg(
            F.avg(size).alias("avg_bytes"),
            F.max(size).alias("max_bytes"),
            F.percentile_approx(size, PERCENTILE, accuracy).alias("p95_bytes"),
            F.count("*").alias("event_count"),
            F.sum(size).alias("total_bytes"),
        )
        .orderBy(F.desc("total_bytes"), *GROUP)
    )


def _per_hour(logs: DataFrame, *counts: Column) -> DataFrame:
    """Counts by date and hour; the date becomes text once per group, not per row."""
    return (
        logs.groupBy(F.to_date("timestamp").alias("day"), F.hour("timestamp").alias("event_hour"))
        .agg(*counts)
        .withColumn("event_date", date_key(F.col("day")))
        .drop("day")
    )


def threat_timeline(logs: DataFrame) -> DataFrame:
    """Events per label for every hour that has any, in one pass."""
    counts = [
        F.count_if(F.col("threat_label") == label).alias(f"{label}_count") for label in LABELS
    ]
    known = logs.filter(F.col("threat_label").isin(LABELS))
    return _per_hour(known, *counts).orderBy(*TIMELINE_KEYS)


def timeline_full_join(logs: DataFrame) -> DataFrame:
    """The same rows as `threat_timeline`, written as two full outer joins."""
    counts = [
        _per_hour(
            logs.filter(F.col("threat_label") == label), F.count("*").alias(f"{label}_count")
        )
        for label in LABELS
    ]
    joined = counts[0]
    for other in counts[1:]:
        joined = joined.join(other, TIMELINE_KEYS, "full")
    return joined.na.fill(0, [f"{label}_count" for label in LABELS]).orderBy(*TIMELINE_KEYS)


def timeline_range(
    timeline: DataFrame,
    as_of: datetime | Column,
    from_date: str | None = None,
    to_date: str | None = None,
) -> DataFrame:
    """Hours from one yyyyMMdd date to another, inclusive; by default yesterday and today."""
    today = as_of_column(as_of)
    start = (
        F.lit(from_date)
        if from_date and from_date.strip()
        else date_key(today - F.expr("INTERVAL '1' DAY"))
    )
    stop = F.lit(to_date) if to_date and to_date.strip() else date_key(today)
    return timeline.filter(F.col("event_date").between(start, stop)).orderBy(*TIMELINE_KEYS)

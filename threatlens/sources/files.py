"""File sources and sinks: CSV in, the date-partitioned Parquet lake in and out."""

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from threatlens.schema import LAKE, LAKE_PARTITIONS, LOG_COLUMNS, LOG_FILE, REQUIRED_COLUMNS

# Fixed value: the stamp format of the CSV files.
CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"


def read_csv_logs(spark: SparkSession, path: str) -> DataFrame:
    """Logs from CSV with a header; a damaged value becomes NULL."""
    return (
        spark.read.schema(LOG_FILE)
        .option("header", True)
        .option("timestampNTZFormat", CSV_TIMESTAMP)
        .csv(path)
    )


def with_missing_fields(logs: DataFrame) -> DataFrame:
    """Adds the names of required fields that are NULL: file sources cannot enforce them."""
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED_COLUMNS]
    return logs.withColumn("missing_fields", F.array_compact(F.array(*missing)))


def with_partition_columns(logs: DataFrame) -> DataFrame:
    """Adds the zero-padded strings year, month and day."""
    stamp = F.col("timestamp")
    return (
        logs.withColumn("year", F.year(stamp).cast("string"))
        .withColumn("month", F.lpad(F.month(stamp).cast("string"), 2, "0"))
        .withColumn("day", F.lpad(F.dayofmonth(stamp).cast("string"), 2, "0"))
    )


def write_lake(
    logs: DataFrame, root: str, replace_all: bool = True, files_per_day: int | None = None
) -> None:
    """Writes logs below year/month/day directories.

    replace_all=False replaces only the days present in `logs` (a daily load). Each
    task writes the days it holds, without a shuffle: right for input in time order.
    For mixed input `files_per_day` shuffles rows by day and a hash of the row, so a
    day gets at most that many files and a day with most of the rows is still
    written by that many tasks.
    """
    dated = with_partition_columns(logs)
    if files_per_day:
        slot = F.pmod(F.xxhash64("timestamp", "source_ip", "dest_ip", "request_path"), F.lit(files_per_day))
        dated = dated.repartition(*LAKE_PARTITIONS, slot)
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(*LAKE_PARTITIONS)
        .parquet(root)
    )


def read_logs(
    spark: SparkSession,
    root: str,
    from_day: date | None = None,
    to_day: date | None = None,
) -> DataFrame:
    """The lake, optionally a range of days, which prunes directories.

    The schema is given, so no footer is read to infer it and the padded directory
    names stay strings.
    """
    lake = spark.read.schema(LAKE).parquet(root)
    day = F.concat_ws("-", *LAKE_PARTITIONS)
    if from_day is not None:
        lake = lake.filter(day >= from_day.isoformat())
    if to_day is not None:
        lake = lake.filter(day <= to_day.isoformat())
    return lake


def convert_csv_to_lake(
    spark: SparkSession,
    csv_path: str,
    root: str,
    replace_all: bool = True,
    files_per_day: int | None = None,
    rejected: str | None = None,
) -> int:
    """Converts CSV to the lake; the row count is observed during the write.

    With `rejected`, rows that lack a required field go there, with the names of the
    missing fields, instead of into the lake.
    """
    converted = Observation("converted")
    logs = read_csv_logs(spark, csv_path)
    if rejected:
        checked = with_missing_fields(logs)
        checked.filter(F.size("missing_fields") > 0).write.mode("overwrite").parquet(rejected)
        logs = checked.filter(F.size("missing_fields") == 0).drop("missing_fields")
    logs = logs.observe(converted, F.count("*").alias("rows"))
    write_lake(logs, root, replace_all, files_per_day)
    return converted.get["rows"]


def write_result(result: DataFrame, path: str) -> None:
    """A job result: one Parquet overwrite, one action."""
    result.write.mode("overwrite").parquet(path)


def log_columns(logs: DataFrame) -> DataFrame:
    return logs.select(*LOG_COLUMNS)



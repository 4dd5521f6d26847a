"""Message sources and sinks: the same record on Kafka or in files."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatlens.functions.times import iso_utc, utc_wall_clock
from threatlens.schema import LOG_COLUMNS, LOG_MESSAGE
from threatlens.session import move_files

DEFAULT_TOPIC = "security-logs"
# Partition of each log type (others go to 0), offsets per trigger.
LOG_TYPE_PARTITIONS = {"firewall": 0, "ids": 1, "application": 2}
MAX_OFFSETS_PER_TRIGGER = 10_000
RECORDS_PER_FILE = 100_000

# A file of records has the columns of a Kafka record that we use.
RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("offset", T.LongType()),
    T.StructField("partition", T.IntegerType()),
])


def log_type_partition(log_type: Column) -> Column:
    chosen = F.lit(0)
    for name, number in LOG_TYPE_PARTITIONS.items():
        if number:
            chosen = F.when(log_type == name, number).otherwise(chosen)
    return chosen


def to_records(logs: DataFrame, *kept: str) -> DataFrame:
    """Logs as key = log type, value = JSON, with the target partition and the `kept` columns."""
    stamp = (
        F.col("timestamp")
        if isinstance(logs.schema["timestamp"].dataType, T.StringType)
        else iso_utc(utc_wall_clock(logs, "timestamp"))
    )
    offset = F.col("log_id") if "log_id" in logs.columns else F.lit(None)
    body = F.struct(stamp.alias("timestamp"), *LOG_COLUMNS[1:])
    return logs.select(
        F.encode("log_type", "UTF-8").alias("key"),
        F.encode(F.to_json(body), "UTF-8").alias("value"),
        offset.cast("bigint").alias("offset"),
        log_type_partition(F.col("log_type")).cast("int").alias("partition"),
        *kept,
    )


def publish_logs(logs: DataFrame, kind: str = "kafka", **options: str) -> None:
    """Publishes logs. `kind` is "kafka" (kafka.bootstrap.servers) or "files" (path)."""
    records = to_records(logs)
    if kind == "kafka":
        records.select("key", "value", "partition").write.format("kafka").options(
            **{"topic": DEFAULT_TOPIC, **options}
        ).save()
    else:
        records.write.mode("append").partitionBy("partition").parquet(options["path"])


def stage_records(logs: DataFrame, by: str, path: str) -> None:
    """Writes the logs as records, a folder below `path` for each value of the column `by`.

    Tasks that read the logs in their order hold few values each; short files let as many
    tasks as there are read one value.
    """
    to_records(logs, by).write.partitionBy(by, "partition").option("maxRecordsPerFile", RECORDS_PER_FILE).parquet(path)


def release_records(spark: SparkSession, staged: str, path: str) -> None:
    """Moves a folder of staged records into the topic at `path`, file by file, as a file stream asks.

    Tasks give their files the same name in every folder, so the folder becomes part of it.
    """
    move_files(spark, f"{staged}/partition=*/*.parquet", path, f"{staged.rstrip('/').rsplit('/', 1)[1]}-")


def _source_options(kind: str, options: dict[str, str]) -> tuple[str, dict[str, str]]:
    if kind == "kafka":
        return "kafka", {"subscribe": DEFAULT_TOPIC, "failOnDataLoss": "false", **options}
    return "parquet", options


def read_records(spark: SparkSession, kind: str = "kafka", **options: str) -> DataFrame:
    """All published records, as a batch."""
    source, options = _source_options(kind, options)
    reader = spark.read.format(source).options(**options)
    return reader.load() if kind == "kafka" else reader.schema(RECORD).load()


def read_stream(spark: SparkSession, kind: str = "kafka", **options: str) -> DataFrame:
    """Records as a stream; rate limits are maxOffsetsPerTrigger or maxFilesPerTrigger."""
    source, options = _source_options(kind, options)
    if kind == "kafka":
        defaults = {
            "startingOffsets": "latest",
            "maxOffsetsPerTrigger": str(MAX_OFFSETS_PER_TRIGGER),
        }
        return spark.readStream.format(source).options(**{**defaults, **options}).load()
    return spark.readStream.format(source).schema(RECORD).options(**options).load()


def _record_id(records: DataFrame) -> Column:
    if "topic" in records.columns:
        return F.concat_ws("-", "topic", "partition", "offset")
    return F.col("offset").cast("string")


def checked_log_json(records: DataFrame) -> DataFrame:
    """As `parse_log_json`, with `fault` (null if the record is sound) and `body`, its text.

    A body is read as a variant, so one field of a wrong type does not cost the others.
    Numbers and stamps may come as text that reads as such; absent or null fields and fields
    that nobody asked for are no fault.
    """
    body = F.col("value").cast("string")
    data = records.select(_record_id(records).alias("log_id"), body.alias("body"), F.try_parse_json(body).alias("data"))
    kind = F.schema_of_variant("data")
    is_object, v = kind.startswith("OBJECT"), F.col("data")
    readable = F.when(is_object, v)

    def field(name: str, sql_type: str) -> Column:
        return F.try_variant_get(readable, f"$.{name}", sql_type)

    def present(name: str) -> Column:
        given = F.try_variant_get(readable, f"$.{name}", "variant")
        return given.isNotNull() & ~F.coalesce(F.is_variant_null(given), F.lit(False))

    fields = {c: field(c, "string") for c in LOG_COLUMNS}
    fields["timestamp"] = F.coalesce(field("timestamp", "timestamp"), fields["timestamp"].try_cast("timestamp"))
    fields["bytes_transferred"] = field("bytes_transferred", "bigint")
    # Every value reads as text, so only these two can be of a wrong type.
    typed = {"timestamp": "a time", "bytes_transferred": "a whole number"}
    read = data.select(
        "log_id", "body", *[value.alias(c) for c, value in fields.items()],
        v.isNotNull().alias("json"), is_object.alias("object"), *[present(c).alias(f"has_{c}") for c in typed],
    )
    wrong = F.concat_ws(", ", *[
        F.when(F.col(f"has_{c}") & F.col(c).isNull(), F.lit(f"{c}: not {what}")) for c, what in typed.items()
    ])
    fault = (
        F.when(F.col("body").isNull(), "body: missing").when(~F.col("json"), "body: not JSON")
        .when(~F.col("object"), "body: not an object").when(wrong != "", wrong)
    )
    return read.select("log_id", *LOG_COLUMNS, fault.alias("fault"), "body")


def sound(checked: DataFrame) -> DataFrame:
    return checked.filter("fault IS NULL").drop("fault", "body")


def quarantined(checked: DataFrame) -> DataFrame:
    return checked.filter("fault IS NOT NULL").select("log_id", "fault", "body")


def parse_log_json(records: DataFrame) -> DataFrame:
    """The ten log columns of each record; malformed JSON gives a row of NULLs.

    `log_id` identifies the record, so that alerts on single rows survive a replay.
    """
    return records.select(
        _record_id(records).alias("log_id"),
        F.from_json(F.col("value").cast("string"), LOG_MESSAGE).alias("data"),
    ).select("log_id", "data.*")

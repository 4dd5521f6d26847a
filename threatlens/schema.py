"""Record layouts shared by every source, operator and sink."""

from pyspark.sql import types as T

TEXT_FIELDS_REQUIRED = [
    "source_ip", "dest_ip", "protocol", "action", "threat_label", "log_type",
]
TEXT_FIELDS_OPTIONAL = ["user_agent", "request_path"]


def log_schema(timestamp_type: T.DataType) -> T.StructType:
    """The ten-column log record; only the type of the event time differs by source."""
    return T.StructType(
        [T.StructField("timestamp", timestamp_type)]
        + [T.StructField(c, T.StringType()) for c in TEXT_FIELDS_REQUIRED]
        + [T.StructField("bytes_transferred", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in TEXT_FIELDS_OPTIONAL]
    )


# Files carry zone-less wall-clock stamps; messages carry instants ("...Z").
LOG_FILE = log_schema(T.TimestampNTZType())
LOG_MESSAGE = log_schema(T.TimestampType())

LOG_COLUMNS = LOG_FILE.fieldNames()
REQUIRED_COLUMNS = ["timestamp"] + TEXT_FIELDS_REQUIRED

# Lake layout: strings, because the directory names are zero-padded.
LAKE_PARTITIONS = ["year", "month", "day"]
LAKE = T.StructType(
    LOG_FILE.fields + [T.StructField(c, T.StringType()) for c in LAKE_PARTITIONS]
)

ALERT = T.StructType([
    T.StructField("ip_source", T.StringType()),
    T.StructField("bucket_time", T.TimestampNTZType()),
    T.StructField("alert_id", T.StringType()),
    T.StructField("last_seen", T.TimestampNTZType()),
    T.StructField("threat_score", T.IntegerType()),
    T.StructField("attack_types", T.ArrayType(T.StringType())),
    T.StructField("alert_type", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("event_count", T.LongType()),
    T.StructField("bytes_total", T.LongType()),
    T.StructField("user_agents", T.ArrayType(T.StringType())),
    T.StructField("log_sources", T.ArrayType(T.StringType())),
])
ALERT_COLUMNS = ALERT.fieldNames()

"""Raw string logs to the message contract (ISO-UTC stamps, integer bytes, defaults)."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatlens.functions.times import as_of_column, iso_utc

# Accepted stamps (yyyy-MM-dd HH:mm:ss, yyyy-MM-ddTHH:mm:ssZ,
# yyyy-MM-ddTHH:mm:ss; leading zeros optional) and defaults of absent columns.
STAMP_SHAPE = (
    r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}"
    r"(\s+\d{1,2}:\d{1,2}:\d{1,2}|T\d{1,2}:\d{1,2}:\d{1,2}Z?)\z"
)
DEFAULTS = {
    "source_ip": "0.0.0.0",
    "dest_ip": "0.0.0.0",
    "protocol": "HTTP",
    "action": "allowed",
    "threat_label": "benign",
    "log_type": "firewall",
    "user_agent": "",
    "request_path": "/",
}


def parse_stamp(text: Column) -> Column:
    """The stamp as UTC wall-clock time, NULL if it has another shape or no such day.

    The shape decides, then one zone-less cast: no exception per unreadable row.
    """
    plain = F.regexp_replace(F.rtrim(text, F.lit("Z")), r"\s+", " ")
    return F.when(text.rlike(STAMP_SHAPE), plain.try_cast("timestamp_ntz"))


def parse_bytes(text: Column) -> Column:
    """An integer (signs, blanks and digit-group underscores allowed), else 0."""
    is_integer = text.rlike(r"^\s*[+-]?\d+(_\d+)*\s*$")
    number = F.trim(F.translate(text, "_\t\n\r", "")).try_cast("bigint")
    return F.coalesce(F.when(is_integer, number), F.lit(0))


def normalize_raw_logs(raw: DataFrame, as_of: datetime | Column) -> DataFrame:
    """The ten message fields from string columns, and whether the stamp was readable.

    A stamp in no known format passes through unchanged, an empty one becomes `as_of`.
    Text defaults fill absent columns only; an empty cell stays as it is.
    """
    def column(name: str, default: str) -> Column:
        return F.col(name) if name in raw.columns else F.lit(default)

    stamp = column("timestamp", "")
    parsed = parse_stamp(stamp)
    is_empty = stamp.isNull() | (stamp == "")
    text = {name: column(name, default).alias(name) for name, default in DEFAULTS.items()}
    identity = ["log_id"] if "log_id" in raw.columns else []
    return raw.select(
        *identity,
        F.when(is_empty, iso_utc(as_of_column(as_of)))
        .otherwise(F.coalesce(iso_utc(parsed), stamp))
        .alias("timestamp"),
        *[text[c] for c in list(DEFAULTS)[:6]],
        parse_bytes(column("bytes_transferred", "0")).alias("bytes_transferred"),
        text["user_agent"],
        text["request_path"],
        (is_empty | parsed.isNotNull()).alias("stamp_readable"),
    )

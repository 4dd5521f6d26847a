"""Canonical alerts: one layout for all detectors, stable identities, expiry, reports."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threatlens.functions import display
from threatlens.functions.times import as_of_column, utc_wall_clock
from threatlens.operators.detectors import (
    PORT_SCAN_WINDOW,
    brute_force,
    port_scan,
    signature_alerts,
    volume_anomaly,
)
from threatlens.schema import ALERT_COLUMNS, LOG_COLUMNS

# Lifetime of an alert, alerts kept per source, size of the active list.
LIFETIME = "INTERVAL '24' HOUR"
RECENT_ALERTS = 10
ACTIVE_LIST = 100
TOP_SOURCES = 10

IDENTITY = (
    "sha2(concat_ws('|', alert_type, ip_source, CAST(bucket_time AS STRING), row_identity), 256)"
    " AS alert_id"
)
ATTACK_TYPES = "array(alert_type) AS attack_types"


def to_alerts(detections: DataFrame) -> DataFrame:
    """Detector rows in the alert layout, with defaults for absent or NULL fields.

    The identity is a hash of what was detected (type, source, window or row), so a
    replayed or updated detection overwrites its alert instead of adding one. Single-row
    detections are told apart by `log_id`; rows that have none fall back to the row's own
    text, NULLs marked, which merges only rows that are equal throughout.
    """
    columns = set(detections.columns)
    windowed = "window_start" in columns
    start, last = ("window_start", "last_event") if windowed else ("timestamp", "timestamp")
    kind = "attack_type" if "attack_type" in columns else "alert_type"
    own_text = [f"coalesce(concat('=', CAST({c} AS STRING)), '-')" for c in LOG_COLUMNS[2:] if c in columns]
    row_identity = f"array({', '.join(own_text)})"
    if windowed:
        row_identity = "array()"
    elif "log_id" in columns:
        row_identity = f"if(log_id IS NULL, {row_identity}, array(CAST(log_id AS STRING)))"

    def field(name: str, default: str, sql_type: str) -> str:
        value = f"CAST({name} AS {sql_type})" if name in columns else "NULL"
        return f"coalesce({value}, CAST({default} AS {sql_type}))"

    timed = detections.withColumns({
        "bucket_time": utc_wall_clock(detections, start),
        "last_seen": utc_wall_clock(detections, last),
    })
    alerts = timed.selectExpr(
        f"{field('source_ip', "'unknown'", 'STRING')} AS ip_source",
        "bucket_time",
        "last_seen",
        f"{field('threat_score', '50', 'INT')} AS threat_score",
        f"{field(kind, "'UNKNOWN'", 'STRING')} AS alert_type",
        f"{field('severity', "'MEDIUM'", 'STRING')} AS severity",
        f"{field('event_count', '1', 'BIGINT')} AS event_count",
        f"{field('bytes_total', '0', 'BIGINT')} AS bytes_total",
        f"array({field('user_agent', "'unknown'", 'STRING')}) AS user_agents",
        f"array({field('log_type', "'unknown'", 'STRING')}) AS log_sources",
        f"CAST({row_identity} AS ARRAY<STRING>) AS row_identity",
    )
    return alerts.selectExpr(
        *[IDENTITY if c == "alert_id" else ATTACK_TYPES if c == "attack_types" else c for c in ALERT_COLUMNS]
    )


def detect_all(logs: DataFrame, scans: DataFrame | None = None) -> list[DataFrame]:
    """The alert frames of the four detectors; port scans may be found already."""
    found = [detector(logs) for detector in (brute_force, signature_alerts, volume_anomaly)]
    return [to_alerts(d) for d in [*found, port_scan(logs) if scans is None else scans]]


def active_threats(alert_frames: list[DataFrame], as_of: datetime | Column) -> DataFrame:
    """The union of alert frames, without alerts older than 24 hours."""
    union = alert_frames[0]
    for frame in alert_frames[1:]:
        union = union.unionByName(frame)
    return union.filter(F.col("last_seen") > as_of_column(as_of) - F.expr(LIFETIME))


def active_alerts(logs: DataFrame, as_of: datetime | Column, scans: DataFrame | None = None) -> DataFrame:
    """The active alerts of all detectors over a log history of any length.

    Only rows that can belong to a live alert are read: a window with an event after
    the cut-off begins at most one window length before it. A fixed `as_of` reaches the
    Parquet statistics; over the lake, `read_logs` with a first day also prunes directories.
    `scans` are the port scans of the whole history, if they are known.
    """
    cutoff = as_of_column(as_of) - F.expr(LIFETIME)
    readable = F.col("timestamp") > cutoff - F.expr(f"INTERVAL {PORT_SCAN_WINDOW}")
    return active_threats(detect_all(logs.filter(readable), scans), as_of)


def recent_alerts_by_ip(alerts: DataFrame, size: int = RECENT_ALERTS) -> DataFrame:
    """The latest alerts of each source.

    Spark applies a rank limit before the shuffle, so a source with many alerts sends
    at most `size` rows per task.
    """
    newest_first = Window.partitionBy("ip_source").orderBy(F.desc("bucket_time"), "alert_id")
    return alerts.withColumn("recency", F.row_number().over(newest_first)).filter(
        F.col("recency") <= size
    )


def alert_summary_by_ip(alerts: DataFrame) -> DataFrame:
    """Count, best score, bytes and attack types of each source's recent alerts."""
    types_newest_first = F.transform(
        F.sort_array(F.collect_list(F.struct("recency", "attack_types", "alert_type"))),
        lambda a: F.concat(a["attack_types"], F.array(a["alert_type"])),
    )
    return (
        recent_alerts_by_ip(alerts)
        .groupBy("ip_source")
        .agg(
            F.count("*").cast("int").alias("active_alerts"),
            F.max("threat_score").alias("current_threat_score"),
            F.sum("bytes_total").alias("recent_alert_bytes"),
            F.array_distinct(F.flatten(types_newest_first)).alias("recent_attack_types"),
            F.max(F.when(F.col("recency") == 1, F.col("last_seen"))).alias("last_seen"),
        )
    )


def active_alerts_top(alerts: DataFrame, size: int = ACTIVE_LIST) -> DataFrame:
    return alerts.orderBy(F.desc("threat_score"), F.desc("last_seen"), "alert_id").limit(size)


def severity_counts(alerts: DataFrame) -> DataFrame:
    return alerts.agg(
        F.count_if(F.col("severity") == "CRITICAL").alias("critical"),
        F.count_if(F.col("severity") == "HIGH").alias("high"),
        F.count("*").alias("total"),
    )


def alerts_by_severity(alerts: DataFrame, severity: str | None = None) -> DataFrame:
    if severity is None or severity == "ALL":
        return alerts
    return alerts.filter(F.col("severity") == severity)


def attack_type_distribution(alerts: DataFrame) -> DataFrame:
    """Alerts per charted type; types outside the chart count as OTHER, empty ones as 0."""
    kind = F.col("alert_type")
    charted = display.CHARTED_TYPES
    counts = [F.struct(F.lit(t).alias("alert_type"), F.count_if(kind == t).alias("alerts")) for t in charted]
    other = F.count_if(kind.isNull() | ~kind.isin(charted))
    counts.append(F.struct(F.lit("OTHER").alias("alert_type"), other.alias("alerts")))
    return alerts.agg(F.array(*counts).alias("bars")).select(F.inline("bars"))


def top_alert_ips(alerts: DataFrame, size: int = TOP_SOURCES) -> DataFrame:
    """Sources by best score, with a bar width relative to the first."""
    best = (
        alerts.filter(F.col("ip_source") != "")
        .groupBy("ip_source")
        .agg(F.count("*").alias("alerts"), F.max("threat_score").alias("max_score"))
        .orderBy(F.desc("max_score"), "ip_source")
        .limit(size)
    )
    # At most `size` rows are left, so ranking them in one task is bounded.
    ranked = Window.orderBy(F.desc("max_score"), "ip_source")
    top_score = F.first("max_score").over(ranked)
    reference_score = F.when(top_score == 0, 100).otherwise(top_score)
    return best.select(
        F.row_number().over(ranked).alias("rank"),
        "ip_source",
        "alerts",
        "max_score",
        F.round(F.col("max_score") / reference_score * 100).cast("int").alias("bar_percent"),
    )


def alert_board(alerts: DataFrame) -> DataFrame:
    """Alerts as shown to an analyst: labels, readable sizes, score bands."""
    return alerts.select(
        "alert_id",
        F.coalesce("ip_source", F.lit(display.MISSING)).alias("ip_source"),
        display.alert_label(F.col("alert_type")).alias("alert_label"),
        F.coalesce("severity", F.lit(display.MISSING)).alias("severity"),
        F.coalesce("threat_score", F.lit(0)).alias("threat_score"),
        display.score_band(F.col("threat_score")).alias("score_band"),
        F.coalesce("event_count", F.lit(0)).alias("event_count"),
        display.readable_bytes(F.col("bytes_total")).alias("bytes"),
        display.clock_time(F.col("last_seen")).alias("last_seen_time"),
        display.hour_label(F.col("last_seen")).alias("hour_label"),
    )

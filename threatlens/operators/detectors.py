"""Detectors. Each is one DataFrame -> DataFrame function for batch and for streams."""

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from threatlens.functions import scoring
from threatlens.functions.signatures import HISTORY, LIVE

# Tumbling window lengths.
PORT_SCAN_WINDOW = "5 minutes"
BRUTE_FORCE_WINDOW = "1 minute"
VOLUME_WINDOW = "10 seconds"
# Targets are counted exactly to about 380 of a source and window, then within 2 percent.
TARGET_SKETCH = 12


def earliest(*columns: str) -> Column:
    """The given columns of the earliest row, as one struct.

    One ordered minimum serves all columns. Rows that share a time stamp are told
    apart by the values themselves, so the answer never depends on arrival order.
    """
    return F.min(F.struct("timestamp", *columns)).alias("earliest")


def _by_window(logs: DataFrame, duration: str, *keys: str, slide: str | None = None) -> GroupedData:
    """Groups by window and keys; windows tumble, or begin every `slide` and overlap.

    A stream groups by the window struct, which carries the watermark. A batch groups
    by the start alone: one long, cheaper to hash and to sort by. With a slide a row counts
    in several windows; a stream drops each once the watermark has passed its end.
    """
    window = F.window("timestamp", duration, slide or duration)
    if logs.isStreaming:
        return logs.groupBy(window.alias("window"), *keys)
    return logs.groupBy(window["start"].alias("window_start"), *keys)


def _with_bounds(detections: DataFrame, duration: str) -> DataFrame:
    if "window" in detections.columns:
        detections = detections.withColumn("window_start", F.col("window.start"))
    end = F.col("window_start") + F.expr(f"INTERVAL {duration}")
    return detections.withColumn("window_end", end).drop("window", "earliest")


def _tcp(logs: DataFrame) -> DataFrame:
    return logs.filter(F.col("protocol") == "TCP")


def port_scan(logs: DataFrame, slide: str | None = None) -> DataFrame:
    """TCP sources that reach more than 20 distinct targets within five minutes.

    The distinct count makes Spark aggregate by (source, window, target) first, so
    one busy source is spread over the cluster by target.
    """
    per_window = _by_window(_tcp(logs), PORT_SCAN_WINDOW, "source_ip", slide=slide).agg(
        F.count_distinct("dest_ip").alias("distinct_targets"),
        F.count("*").alias("event_count"),
        F.max("timestamp").alias("last_event"),
        earliest("log_type"),
    )
    return port_scan_alerts(per_window)


def port_scan_early(logs: DataFrame, slide: str | None = None) -> DataFrame:
    """Port scans while their window is open, for streams in update mode.

    The targets of a source and window are a mergeable sketch in the state: a few bytes a
    target while there are few, a fixed size beyond. A window is reported as soon as its
    source passes the threshold; the exact form reports it again once it has closed.
    """
    sketch = F.hll_sketch_agg("dest_ip", TARGET_SKETCH)
    per_window = _by_window(_tcp(logs), PORT_SCAN_WINDOW, "source_ip", slide=slide).agg(
        F.hll_sketch_estimate(sketch).alias("distinct_targets"),
        F.count("*").alias("event_count"),
        F.max("timestamp").alias("last_event"),
        earliest("log_type"),
    )
    return port_scan_alerts(per_window)


def port_scan_alerts(per_window: DataFrame) -> DataFrame:
    targets = F.col("distinct_targets")
    return _with_bounds(
        per_window.filter(targets > scoring.PORT_SCAN_TARGETS).withColumns({
            "log_type": F.col("earliest.log_type"),
            "attack_type": F.lit("PORT_SCAN"),
            "threat_score": scoring.port_scan_score(targets),
            "severity": scoring.port_scan_severity(targets),
        }),
        PORT_SCAN_WINDOW,
    )


def port_scan_per_target(logs: DataFrame) -> DataFrame:
    """First stage of the exact streaming form: one row per (source, window, target)."""
    return _by_window(_tcp(logs), PORT_SCAN_WINDOW, "source_ip", "dest_ip").agg(
        F.count("*").alias("events"),
        F.max("timestamp").alias("last_event"),
        earliest("log_type"),
    )


def port_scan_from_targets(per_target: DataFrame) -> DataFrame:
    """Second stage: count the targets; count() skips a NULL target as DISTINCT does."""
    window = "window" if "window" in per_target.columns else "window_start"
    return port_scan_alerts(
        per_target.groupBy(window, "source_ip").agg(
            F.count("dest_ip").alias("distinct_targets"),
            F.sum("events").alias("event_count"),
            F.max("last_event").alias("last_event"),
            F.min("earliest").alias("earliest"),
        )
    )


def brute_force(logs: DataFrame, slide: str | None = None) -> DataFrame:
    """Sources with more than five blocked attempts within one minute."""
    attempts = F.col("blocked_count")
    blocked = logs.filter(F.col("action") == "blocked")
    return _with_bounds(
        _by_window(blocked, BRUTE_FORCE_WINDOW, "source_ip", slide=slide)
        .agg(
            F.count("*").alias("blocked_count"),
            F.sum("bytes_transferred").alias("bytes_total"),
            F.max("timestamp").alias("last_event"),
            earliest("user_agent", "log_type"),
        )
        .filter(attempts > scoring.BRUTE_FORCE_ATTEMPTS)
        .withColumns({
            "user_agent": F.col("earliest.user_agent"),
            "log_type": F.col("earliest.log_type"),
            "threat_score": scoring.brute_force_score(attempts),
            "severity": scoring.brute_force_severity(attempts),
            "alert_type": F.lit("BRUTE_FORCE"),
            "event_count": attempts,
        }),
        BRUTE_FORCE_WINDOW,
    )


def volume_anomaly(logs: DataFrame, slide: str | None = None) -> DataFrame:
    """Sources that move more than 10 MiB within ten seconds."""
    total = F.col("bytes_total")
    return _with_bounds(
        _by_window(logs, VOLUME_WINDOW, "source_ip", slide=slide)
        .agg(
            F.sum("bytes_transferred").alias("bytes_total"),
            F.count("*").alias("event_count"),
            F.max("timestamp").alias("last_event"),
            earliest("log_type", "user_agent", "dest_ip"),
        )
        .filter(total > scoring.VOLUME_BYTES)
        .withColumns({
            "log_type": F.col("earliest.log_type"),
            "user_agent": F.col("earliest.user_agent"),
            "dest_ip": F.col("earliest.dest_ip"),
            "alert_type": F.lit("VOLUME_ANOMALY"),
            "threat_score": scoring.volume_score(total),
            "severity": scoring.volume_severity(total),
        }),
        VOLUME_WINDOW,
    )


def attack_patterns(logs: DataFrame) -> DataFrame:
    """Rows that match a historical signature, with flags, category and score."""
    return (
        logs.filter(HISTORY.any_match())
        .select("*", *HISTORY.flags())
        .withColumns({
            "attack_category": HISTORY.category(),
            "threat_score": HISTORY.score(),
            "severity": F.lit("CRITICAL"),
        })
    )


def most_severe_first(patterns: DataFrame) -> DataFrame:
    identity = [c for c in ("log_id", "source_ip") if c in patterns.columns]
    return patterns.orderBy(F.desc("threat_score"), F.desc("timestamp"), *identity)


def signature_alerts(logs: DataFrame) -> DataFrame:
    """Rows that match a live signature, one alert per row."""
    return (
        logs.filter(LIVE.any_match())
        .select("*", *LIVE.flags())
        .withColumns({
            "alert_type": LIVE.category(),
            "threat_score": LIVE.score(),
            "severity": F.lit("CRITICAL"),
            "event_count": F.lit(1),
            "bytes_total": F.col("bytes_transferred"),
        })
        .drop(*[s.flag for s in LIVE.signatures])
    )

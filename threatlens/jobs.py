"""Batch and streaming jobs for spark-submit.

    spark-submit --py-files threatlens.zip threatlens/jobs.py convert --input raw.csv --lake lake
    ... reputation | port-scan | patterns | volume --lake lake --output results --tables tables
    ... publish --input raw.csv --kafka host:9092        (or --topic-folder folder)
    ... stream --kafka host:9092 --alerts alerts --checkpoints checkpoints
    ... profiles --tables tables --alerts alerts --output profiles
    ... active --alerts alerts --output active | stats --tables tables --output stats
    ... sketch-days --lake lake --tables tables | sketch-range --tables tables --output ranges
    ... timeline --tables tables --output timeline --from-day 20231015 --to-day 20231016

Batch jobs over the lake take --from-day and --to-day (yyyy-mm-dd), which prune
directories, and --as-of, which saves looking for the newest event.

Each job writes its result once and feeds the keyed tables from what it wrote, so
nothing is computed twice.
"""

import argparse
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.functions.times import latest_event
from threatlens.operators import alerts as al
from threatlens.operators import detectors as det
from threatlens.operators import reputation as rep
from threatlens.operators import sketches
from threatlens.operators import volume as vol
from threatlens.plans import serving
from threatlens.session import create_session, delete_folder
from threatlens.sinks import alert_log
from threatlens.sinks import keyed_tables as kt
from threatlens.sources import files, messages
from threatlens.sources.normalize import normalize_raw_logs
from threatlens.streaming import app

# Of an alert, as in the rule of the active list.
LIFETIME = timedelta(hours=24)


def _stored(result: DataFrame, path: str) -> DataFrame:
    files.write_result(result, path)
    return result.sparkSession.read.parquet(path)


def _moment(as_of: str | None) -> datetime | None:
    return datetime.fromisoformat(as_of) if as_of else None


def _lake(spark: SparkSession, lake: str, from_day: str | None, to_day: str | None) -> DataFrame:
    days = [date.fromisoformat(d) if d else None for d in (from_day, to_day)]
    return files.read_logs(spark, lake, *days)


def convert(
    spark: SparkSession,
    input: str,
    lake: str,
    daily: str = "false",
    files_per_day: str | None = None,
    rejected: str | None = None,
) -> None:
    """With `daily` only the days of the input are replaced."""
    rows = files.convert_csv_to_lake(
        spark, input, lake, daily.lower() != "true", int(files_per_day) if files_per_day else None, rejected
    )
    print(f"{rows} rows converted")


def reputation(
    spark: SparkSession, lake: str, output: str, tables: str,
    as_of: str | None = None, from_day: str | None = None, to_day: str | None = None,
) -> None:
    logs = _lake(spark, lake, from_day, to_day)
    report = _stored(rep.top_malicious_ips(logs), f"{output}/ip_reputation")
    rows = kt.ip_reputation_rows(report, _moment(as_of) or latest_event(logs))
    kt.upsert(rows, f"{tables}/ip_reputation", kt.REPUTATION_KEYS)


def port_scan(
    spark: SparkSession, lake: str, output: str, tables: str,
    as_of: str | None = None, from_day: str | None = None, to_day: str | None = None,
) -> None:
    logs = _lake(spark, lake, from_day, to_day)
    scans = det.port_scan(logs).orderBy(F.desc("distinct_targets"), "source_ip", "window_start")
    rows = kt.attack_pattern_rows(
        _stored(scans, f"{output}/port_scans"), _moment(as_of) or latest_event(logs), "PORT_SCAN"
    )
    kt.upsert(rows, f"{tables}/attack_patterns", kt.ATTACK_PATTERN_KEYS, kt.PATTERN_CLUSTER)


def patterns(
    spark: SparkSession, lake: str, output: str, tables: str,
    as_of: str | None = None, from_day: str | None = None, to_day: str | None = None,
) -> None:
    logs = _lake(spark, lake, from_day, to_day)
    # Stored as found: sorting here would run the signatures twice. Reports sort the result.
    found = _stored(det.attack_patterns(logs), f"{output}/attack_patterns")
    rows = kt.attack_pattern_rows(found, _moment(as_of) or latest_event(logs))
    kt.upsert(rows, f"{tables}/attack_patterns", kt.ATTACK_PATTERN_KEYS, kt.PATTERN_CLUSTER)


def volume(
    spark: SparkSession, lake: str, output: str, tables: str,
    from_day: str | None = None, to_day: str | None = None,
) -> None:
    logs = _lake(spark, lake, from_day, to_day)
    staging = f"{output}/staging"
    files.write_result(vol.volume_profile(logs, staging), f"{output}/volume_analysis")
    delete_folder(spark, staging)
    kt.upsert(vol.threat_timeline(logs), f"{tables}/threat_timeline", kt.TIMELINE_KEYS, kt.TIMELINE_CLUSTER)


def sketch_days(
    spark: SparkSession, lake: str, tables: str, from_day: str | None = None, to_day: str | None = None
) -> None:
    """Brings the daily sketches up to date for the given days of the lake."""
    logs = _lake(spark, lake, from_day, to_day)
    sketches.store_days(sketches.volume_by_day(logs), f"{tables}/volume_days")
    sketches.store_days(sketches.targets_by_day(logs), f"{tables}/target_days")


def sketch_range(
    spark: SparkSession, tables: str, output: str, from_day: str | None = None, to_day: str | None = None
) -> None:
    """Volume profile and distinct targets of any range of sketched days."""
    days = [date.fromisoformat(d) if d else None for d in (from_day, to_day)]
    volumes = sketches.read_days(spark, f"{tables}/volume_days", sketches.VOLUME_DAYS, *days)
    targets = sketches.read_days(spark, f"{tables}/target_days", sketches.TARGET_DAYS, *days)
    files.write_result(sketches.volume_of_days(volumes), f"{output}/volume_of_days")
    files.write_result(sketches.targets_of_days(targets), f"{output}/targets_of_days")


def _message_options(kafka: str | None, folder: str | None) -> tuple[str, dict[str, str]]:
    if kafka:
        return "kafka", {"kafka.bootstrap.servers": kafka}
    return "files", {"path": folder}


def publish(
    spark: SparkSession,
    input: str,
    kafka: str | None = None,
    topic_folder: str | None = None,
    topic: str = messages.DEFAULT_TOPIC,
) -> None:
    raw = spark.read.option("header", True).option("escape", '"').csv(input)
    now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    kind, options = _message_options(kafka, topic_folder)
    if kafka:
        options["topic"] = topic
    messages.publish_logs(normalize_raw_logs(raw, now), kind, **options)


def stream(
    spark: SparkSession,
    alerts: str,
    checkpoints: str,
    kafka: str | None = None,
    topic_folder: str | None = None,
    topic: str = messages.DEFAULT_TOPIC,
    max_offsets: str = str(messages.MAX_OFFSETS_PER_TRIGGER),
    delay: str = app.DEFAULT_DELAY,
    files: str = "4",
    **more: str,
) -> None:
    """`quarantine` and `metrics` are folders; `names` lists detectors, comma-separated."""
    kind, options = _message_options(kafka, topic_folder)
    if kafka:
        options |= {"subscribe": topic, "maxOffsetsPerTrigger": max_offsets}
    if "names" in more:
        more["names"] = more["names"].split(",")
    app.run(spark, alerts, checkpoints, kind, delay, files=int(files), **more, **options)


def _live_alerts(spark: SparkSession, alerts: str, as_of: str | None) -> DataFrame:
    """The live alerts of the log; emissions older than their lifetime are not merged."""
    moment = _moment(as_of)
    if moment is None:
        moment = alert_log.newest_event(spark, alerts)
    if moment is None:
        return alert_log.read_alerts(spark, alerts)
    return al.active_threats([alert_log.read_alerts(spark, alerts, moment - LIFETIME)], moment)


def profiles(spark: SparkSession, tables: str, alerts: str, output: str, as_of: str | None = None) -> None:
    flat = serving.threat_profile_flat(
        kt.read_table(spark, f"{tables}/ip_reputation"),
        kt.read_table(spark, f"{tables}/attack_patterns"),
        _live_alerts(spark, alerts, as_of),
    )
    files.write_result(serving.threat_profile(flat), output)


def active(spark: SparkSession, alerts: str, output: str, as_of: str | None = None, severity: str | None = None) -> None:
    live = al.alerts_by_severity(_live_alerts(spark, alerts, as_of), severity)
    files.write_result(al.active_alerts_top(live), output)


def stats(spark: SparkSession, tables: str, output: str) -> None:
    files.write_result(serving.global_stats(kt.read_table(spark, f"{tables}/ip_reputation")), output)


def timeline(
    spark: SparkSession, tables: str, output: str,
    from_day: str | None = None, to_day: str | None = None, as_of: str | None = None,
) -> None:
    """Days as yyyyMMdd; by default the day of `as_of` (today) and the one before."""
    stored = kt.read_table(spark, f"{tables}/threat_timeline")
    moment = _moment(as_of) or datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    files.write_result(vol.timeline_range(stored, moment, from_day, to_day), output)


RANGE = ["as-of", "from-day", "to-day"]
JOBS = {
    "convert": (convert, ["input", "lake"], ["daily", "files-per-day", "rejected"]),
    "reputation": (reputation, ["lake", "output", "tables"], RANGE),
    "port-scan": (port_scan, ["lake", "output", "tables"], RANGE),
    "patterns": (patterns, ["lake", "output", "tables"], RANGE),
    "volume": (volume, ["lake", "output", "tables"], RANGE[1:]),
    "sketch-days": (sketch_days, ["lake", "tables"], RANGE[1:]),
    "sketch-range": (sketch_range, ["tables", "output"], RANGE[1:]),
    "publish": (publish, ["input"], ["kafka", "topic-folder", "topic"]),
    "stream": (stream, ["alerts", "checkpoints"], ["kafka", "topic-folder", "topic", "max-offsets", "delay", "files", "names", "quarantine", "metrics"]),
    "profiles": (profiles, ["tables", "alerts", "output"], ["as-of"]),
    "active": (active, ["alerts", "output"], ["as-of", "severity"]),
    "stats": (stats, ["tables", "output"], []),
    "timeline": (timeline, ["tables", "output"], RANGE),
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="threatlens")
    commands = parser.add_subparsers(dest="job", required=True)
    for name, (_, required, optional) in JOBS.items():
        command = commands.add_parser(name)
        for option in required:
            command.add_argument(f"--{option}", required=True)
        for option in optional:
            command.add_argument(f"--{option}", default=argparse.SUPPRESS)
    arguments = vars(parser.parse_args(argv))
    job = arguments.pop("job")
    JOBS[job][0](create_session(f"threatlens-{job}"), **arguments)


if __name__ == "__main__":
    main()

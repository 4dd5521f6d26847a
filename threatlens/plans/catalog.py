"""The registered queries: every operator over the whole security-log view."""

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.functions.times import as_of_column, latest_event, utc_wall_clock
from threatlens.operators import alerts as al
from threatlens.operators import detectors as det
from threatlens.operators import reputation as rep
from threatlens.operators import sketches
from threatlens.operators import volume as vol
from threatlens.plans import serving
from threatlens.schema import LAKE_PARTITIONS, LOG_COLUMNS
from threatlens.session import shared_folder, stage, tasks_for
from threatlens.sinks import alert_log
from threatlens.sinks import keyed_tables as kt
from threatlens.sources import files, fixtures, messages
from threatlens.sources.normalize import normalize_raw_logs
from threatlens.streaming import live_state
from threatlens.streaming.app import start_detectors

Query = Callable[[SparkSession, str], DataFrame]
LogQuery = Callable[[DataFrame], DataFrame]

# A replay is cut into this many micro-batches or more, in time order, of this many rows or less.
REPLAY_BATCHES, ROWS_PER_BATCH = 3, 20_000_000
# Days over which `spread` deals the logs.
SPREAD_DAYS = 5


def over_logs(query: LogQuery) -> Query:
    return lambda spark, sf_dir: query(fixtures.security_logs(spark, sf_dir))


def over_alerts(query: LogQuery) -> Query:
    return over_logs(lambda logs: query(alerts_of(logs)))


def spread(logs: DataFrame) -> DataFrame:
    """The logs dealt over several days, so that ranges and lifetimes have something to cut."""
    days = F.make_dt_interval(F.col("log_id") % SPREAD_DAYS)
    return logs.withColumn("timestamp", F.col("timestamp") + days)


# --- shared building blocks -------------------------------------------------

def alerts_of(logs: DataFrame) -> DataFrame:
    return al.active_alerts(logs, latest_event(logs))


def ordered_port_scans(logs: DataFrame) -> DataFrame:
    return det.port_scan(logs).orderBy(
        F.desc("distinct_targets"), "source_ip", "window_start"
    )


def reputation_table(logs: DataFrame, as_of: Column | None = None) -> DataFrame:
    as_of = as_of if as_of is not None else latest_event(logs)
    return kt.ip_reputation_rows(rep.top_malicious_ips(logs), as_of)


def pattern_table(logs: DataFrame, as_of: Column | None = None, scans: DataFrame | None = None) -> DataFrame:
    as_of = as_of if as_of is not None else latest_event(logs)
    scans = det.port_scan(logs) if scans is None else scans
    return kt.attack_pattern_rows(det.attack_patterns(logs), as_of).unionByName(
        kt.attack_pattern_rows(scans, as_of, "PORT_SCAN")
    )


def profiles(logs: DataFrame) -> DataFrame:
    """Port scans, which both layers use, are found once and staged: few rows."""
    as_of = latest_event(logs)
    scans = stage(det.port_scan(logs), f"{shared_folder(logs.sparkSession)}/scans")
    return serving.threat_profile_flat(
        reputation_table(logs, as_of), pattern_table(logs, as_of, scans), al.active_alerts(logs, as_of, scans)
    )


def joined_arrays(df: DataFrame) -> DataFrame:
    """Arrays as comma-separated text, so that rows can be compared by value."""
    return df.select(*[
        F.concat_ws(",", f.name).alias(f.name) if f.dataType.typeName() == "array" else f.name
        for f in df.schema.fields
    ])


def lookup_requests(logs: DataFrame) -> DataFrame:
    """Requested addresses as users type them: padded, blank, overlong, unknown."""
    ip = F.col("source_ip")
    return logs.filter(F.col("action") == "blocked").select(
        F.when(F.col("log_id") % 6 == 0, F.concat(F.lit("  "), ip, F.lit(" ")))
        .when(F.col("log_id") % 6 == 1, F.lit("   "))
        .when(F.col("log_id") % 6 == 2, F.repeat(ip, 6))
        .when(F.col("log_id") % 6 == 3, F.concat(F.lit("9"), ip))
        .otherwise(ip)
        .alias("ip")
    )


def raw_strings(logs: DataFrame) -> DataFrame:
    """The logs as untyped text with damaged stamps and sizes, without user agents."""
    n, text = F.col("log_id"), F.col("timestamp").cast("string")
    iso = F.translate(text, " ", "T")
    size = F.col("bytes_transferred").cast("string")
    stamp = (
        F.when(n % 7 == 0, text)
        .when(n % 7 == 1, F.concat(iso, F.lit("Z")))
        .when(n % 7 == 2, iso)
        .when(n % 7 == 3, F.lit(""))
        .when(n % 7 == 4, F.concat(F.lit("on "), text))
        .when(n % 7 == 5, F.lit("2023-13-45 10:00:00"))
    )
    damaged_size = (
        F.when(n % 6 == 0, F.lit(""))
        .when(n % 6 == 1, F.lit("abc"))
        .when(n % 6 == 2, F.concat(size, F.lit(".5")))
        .when(n % 6 == 3, F.concat(F.lit(" "), size, F.lit(" ")))
        .otherwise(size)
    )
    return logs.withColumn("timestamp", stamp).withColumn(
        "bytes_transferred", damaged_size
    ).drop("user_agent")


def attack_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged rows, most severe and newest first.

    A global sort samples its input before it shuffles. Storing the flagged rows first
    keeps that from running the signatures over all logs a second time.
    """
    path = f"{shared_folder(spark)}/attack_patterns"
    files.write_result(det.attack_patterns(fixtures.security_logs(spark, sf_dir)), path)
    return det.most_severe_first(spark.read.parquet(path))


# --- sources and sinks --------------------------------------------------------

def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/csv"
    logs = files.log_columns(fixtures.security_logs(spark, sf_dir))
    logs.write.option("header", True).option(
        "timestampNTZFormat", files.CSV_TIMESTAMP
    ).csv(path)
    return files.read_csv_logs(spark, path)


def lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    logs = files.log_columns(fixtures.security_logs(spark, sf_dir))
    logs.write.option("header", True).option(
        "timestampNTZFormat", files.CSV_TIMESTAMP
    ).csv(f"{folder}/csv")
    files.convert_csv_to_lake(spark, f"{folder}/csv", f"{folder}/lake")
    return files.read_logs(spark, f"{folder}/lake")


def lake_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{shared_folder(spark)}/lake"
    logs = fixtures.security_logs(spark, sf_dir)
    files.write_lake(files.log_columns(logs), root)
    by_day = files.read_logs(spark, root).groupBy(*LAKE_PARTITIONS, "protocol")
    return by_day.agg(
        F.count("*").alias("events"), F.sum("bytes_transferred").alias("total_bytes")
    )


def lake_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of the days of a lake."""
    root = f"{shared_folder(spark)}/lake"
    files.write_lake(files.log_columns(spread(fixtures.security_logs(spark, sf_dir))), root)
    return files.read_logs(spark, root, date(2023, 10, 16), date(2023, 10, 17))


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the results hold after they were written, by key."""
    folder = shared_folder(spark)
    logs = fixtures.security_logs(spark, sf_dir)
    results = {
        "attack_patterns": (det.attack_patterns(logs), ["attack_category", "log_id"], "threat_score"),
        "ip_reputation": (rep.top_malicious_ips(logs), ["source_ip", "log_type"], "total_events"),
        "port_scans": (det.port_scan(logs), ["source_ip", "window_start"], "distinct_targets"),
        "volume_analysis": (vol.volume_profile(logs, folder), vol.GROUP, "p95_bytes"),
    }
    stored = []
    for name, (result, keys, amount) in results.items():
        files.write_result(result, f"{folder}/result={name}")
        key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
        stored.append(
            spark.read.parquet(f"{folder}/result={name}").select(
                F.lit(name).alias("result"), key.alias("key"), F.col(amount).cast("bigint").alias("amount")
            )
        )
    union = stored[0]
    for other in stored[1:]:
        union = union.unionByName(other)
    return union


def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attack-pattern table after three loads; the second repeats keys of the first with
    later stamps and other counts, the third adds the port scans."""
    path = f"{shared_folder(spark)}/attack_patterns"
    logs = fixtures.security_logs(spark, sf_dir)
    as_of = latest_event(logs)
    found = det.attack_patterns(logs)
    early = found.filter(F.col("log_id") % 2 == 0).withColumn("distinct_targets", F.lit(7).cast("bigint"))
    early = kt.attack_pattern_rows(early.withColumn("window_start", F.col("timestamp")), as_of - F.expr("INTERVAL 1 DAY"))
    kt.upsert(early, path, kt.ATTACK_PATTERN_KEYS, kt.PATTERN_CLUSTER)
    late = found.filter((F.col("log_id") % 2 == 1) | (F.col("log_id") % 3 > 0))
    kt.upsert(kt.attack_pattern_rows(late, as_of), path, kt.ATTACK_PATTERN_KEYS, kt.PATTERN_CLUSTER)
    kt.upsert(
        kt.attack_pattern_rows(det.port_scan(logs), as_of, "PORT_SCAN"), path, kt.ATTACK_PATTERN_KEYS, kt.PATTERN_CLUSTER
    )
    return kt.read_table(spark, path)


def stored_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Reputation, patterns and live alerts as the jobs store them."""
    folder = _store_history(spark, sf_dir)
    return (
        kt.read_table(spark, f"{folder}/reputation"),
        kt.read_table(spark, f"{folder}/patterns"),
        stage(alerts_of(fixtures.security_logs(spark, sf_dir)), f"{folder}/alerts"),
    )


def _store_history(spark: SparkSession, sf_dir: str) -> str:
    folder = shared_folder(spark)
    logs = fixtures.security_logs(spark, sf_dir)
    kt.upsert(reputation_table(logs), f"{folder}/reputation", kt.REPUTATION_KEYS)
    kt.upsert(pattern_table(logs), f"{folder}/patterns", kt.ATTACK_PATTERN_KEYS, kt.PATTERN_CLUSTER)
    return folder


def prepared_lookup(spark: SparkSession, sf_dir: str) -> Query:
    """The lookup of requested addresses over sides that are stored once."""
    sides = stored_sides(spark, sf_dir)
    return lambda spark, sf_dir: joined_arrays(
        serving.profile_lookup(lookup_requests(fixtures.security_logs(spark, sf_dir)), *sides)
    )


def profile_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared_lookup(spark, sf_dir)(spark, sf_dir)


def prepared_profile(spark: SparkSession, sf_dir: str) -> Query:
    """The profile of the busiest source, by its address, over tables that are stored once."""
    folder = _store_history(spark, sf_dir)
    logs = fixtures.security_logs(spark, sf_dir)
    kt.upsert(al.alert_summary_by_ip(alerts_of(logs)), f"{folder}/live", ["ip_source"])
    busiest = logs.groupBy("source_ip").count().orderBy(F.desc("count"), "source_ip").first()
    address = busiest.source_ip if busiest else ""
    tables = [f"{folder}/{t}" for t in ("reputation", "patterns", "live")]
    return lambda spark, sf_dir: joined_arrays(serving.profile_of(spark, address, *tables))


def stored_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared_profile(spark, sf_dir)(spark, sf_dir)


def stored_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.global_stats(stored_sides(spark, sf_dir)[0])


def stored_active_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The active list over the alert log, after days of emissions."""
    folder = f"{shared_folder(spark)}/alerts"
    logs = spread(fixtures.security_logs(spark, sf_dir))
    for name, detector in (("brute_force", det.brute_force), ("volume", det.volume_anomaly)):
        alert_log.alert_writer(folder, name, run="batch")(detector(logs), 0)
    alerts = alert_log.read_alerts(spark, folder)
    newest = alerts.agg(F.max("last_seen")).scalar()
    return joined_arrays(al.active_alerts_top(al.active_threats([alerts], newest)))


def stored_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of the timeline table."""
    path = f"{shared_folder(spark)}/timeline"
    logs = spread(fixtures.security_logs(spark, sf_dir))
    kt.upsert(vol.threat_timeline(logs), path, kt.TIMELINE_KEYS, kt.TIMELINE_CLUSTER)
    return vol.timeline_range(kt.read_table(spark, path), latest_event(logs), "20231016", "20231017")


def volume_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The volume profile of two stored days, and whether the rank of its percentile among
    their logs is within the stated error."""
    path = f"{shared_folder(spark)}/volume_days"
    logs = spread(fixtures.security_logs(spark, sf_dir))
    sketches.store_days(sketches.volume_by_day(logs), path)
    first, last = date(2023, 10, 16), date(2023, 10, 17)
    found = sketches.volume_of_days(sketches.read_days(spark, path, sketches.VOLUME_DAYS, first, last))
    found = stage(found, f"{path}_found")
    days = logs.filter(F.to_date("timestamp").between(F.lit(first), F.lit(last))).filter(F.col(vol.SIZE).isNotNull())
    below, at_most = F.count_if(F.col(vol.SIZE) < F.col("p95_bytes")), F.count_if(F.col(vol.SIZE) <= F.col("p95_bytes"))
    ranks = vol.with_group(days, found.select(*vol.GROUP, "p95_bytes"), "inner").groupBy(*vol.GROUP).agg(
        (below / F.count("*")).alias("low"), (at_most / F.count("*")).alias("high")
    )
    close = (F.col("low") - vol.PERCENTILE <= sketches.RANK_ERROR) & (vol.PERCENTILE - F.col("high") <= sketches.RANK_ERROR)
    return vol.with_group(found, ranks, "left").select(
        *vol.GROUP, "avg_bytes", "max_bytes", "event_count", "total_bytes",
        F.coalesce(close, F.col("p95_bytes").isNull()).alias("rank_within_error"),
    )


def target_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suspicious events of every source over stored days, its targets from merged sketches,
    and whether their number is within the stated error."""
    path = f"{shared_folder(spark)}/target_days"
    logs = spread(fixtures.security_logs(spark, sf_dir))
    sketches.store_days(sketches.targets_by_day(logs), path)
    found = sketches.targets_of_days(sketches.read_days(spark, path, sketches.TARGET_DAYS))
    exact = rep.suspicious_by_ip_logtype(logs).select(*sketches.TARGET_GROUP, F.col("unique_targets").alias("exact"))
    close = F.abs(F.col("unique_targets") - F.col("exact")) <= sketches.DISTINCT_ERROR * F.col("exact")
    return found.join(exact, sketches.TARGET_GROUP).select(
        *sketches.TARGET_GROUP, "total_events", "total_bytes", close.alias("targets_within_error")
    )


def json_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/topic"
    messages.publish_logs(fixtures.security_logs(spark, sf_dir), "files", path=path)
    records = messages.read_records(spark, "files", path=path)
    parsed = messages.parse_log_json(records)
    return stored_log(parsed).withColumn(
        "partition", messages.log_type_partition(F.col("log_type")).cast("int")
    )


def stored_log(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("timestamp", utc_wall_clock(parsed, "timestamp")).withColumn(
        "log_id", F.col("log_id").cast("bigint")
    )


def json_parse(logs: DataFrame) -> DataFrame:
    """Records with every 13th body cut short, parsed."""
    records = messages.to_records(logs)
    body = F.col("value").cast("string")
    cut = F.when(F.col("offset") % 13 == 0, F.substring(body, 1, 40)).otherwise(body)
    return stored_log(messages.parse_log_json(records.withColumn("value", F.encode(cut, "UTF-8"))))


def json_quarantine(logs: DataFrame) -> DataFrame:
    """What is set apart of records of which five in thirteen are broken in some way."""
    kind, ip = F.col("log_id") % 13, F.col("source_ip")
    records = messages.to_records(logs.withColumn("log_type", F.coalesce("log_type", F.lit(""))))
    records = records.join(logs.select(F.col("log_id").alias("offset"), "source_ip", "log_id"), "offset")
    body = (
        F.when(kind == 0, F.concat(F.lit('{"source_ip":"'), ip))
        .when(kind == 1, F.concat(F.lit('["'), ip, F.lit('"]')))
        .when(kind == 2, F.concat(F.lit('{"source_ip":"'), ip, F.lit('","timestamp":"soon","bytes_transferred":{}}')))
        .when(kind == 3, F.concat(F.lit('{"source_ip":"'), ip, F.lit('","bytes_transferred":"n/a"}')))
        .when(kind == 4, F.lit(None))
        .otherwise(F.col("value").cast("string"))
    )
    checked = messages.checked_log_json(records.withColumn("value", F.encode(body, "UTF-8")))
    return messages.quarantined(checked).withColumn("log_id", F.col("log_id").cast("bigint"))


def log_type_partition(logs: DataFrame) -> DataFrame:
    return logs.select(
        "log_id", "log_type", messages.log_type_partition(F.col("log_type")).alias("partition")
    )


# --- streams --------------------------------------------------------------------

def _in_time_order(spark: SparkSession, logs: DataFrame, folder: str, close: bool) -> tuple[list[str], int]:
    """The logs cut, in time order, into slices of about equal numbers of rows, and that number.

    The cuts are quantiles, so a burst is spread over slices; the rows are staged once, as
    records, one folder a slice. `close` adds a slice with one quiet TCP row of each log type an
    hour later: windows that are reported when they have closed need a later event.
    """
    rows, last = logs.agg(F.count("*"), F.max("timestamp")).first()
    parts = max(REPLAY_BATCHES, -(-rows // ROWS_PER_BATCH))
    shares = [i / parts for i in range(1, parts)]
    cuts = logs.agg(F.percentile_approx("timestamp", shares, 100 * parts)).first()[0] or []
    number = sum(((F.col("timestamp") > as_of_column(cut)).cast("int") for cut in cuts), F.lit(0))
    messages.stage_records(logs.withColumn("slice", F.coalesce(number, F.lit(0))), "slice", f"{folder}/slices")
    slices, rows_each = [f"{folder}/slices/slice={i}" for i in range(parts)], -(-rows // parts)
    if close and last is not None:
        later = [(t, last + timedelta(hours=1)) for t in messages.LOG_TYPE_PARTITIONS]
        quiet = spark.createDataFrame(later, "log_type string, timestamp timestamp_ntz")
        fixed = {"source_ip": "closing", "protocol": "TCP", "action": "allowed"}
        filled = {c: F.lit(fixed.get(c)).cast(logs.schema[c].dataType) for c in logs.columns if c not in quiet.columns}
        slices.append(f"{folder}/slices/slice={parts}")
        messages.publish_logs(quiet.withColumns(filled).select(logs.columns), "files", path=slices[-1])
    return slices, rows_each


def _take(
    spark: SparkSession, staged: str, folder: str, names: list[str], checkpoints: str, rows: int, **limits: str
) -> None:
    """Brings a slice of about so many rows into the topic, and takes what that holds beyond
    the checkpoints: one micro-batch, without limits."""
    messages.release_records(spark, staged, f"{folder}/topic")
    logs = messages.parse_log_json(messages.read_stream(spark, "files", path=f"{folder}/topic", **limits))
    running = start_detectors(
        logs, f"{folder}/alerts", f"{folder}/{checkpoints}", names, trigger={"availableNow": True},
        partitions=tasks_for(spark, rows),
    )
    for stream in running:
        stream.awaitTermination()


def replay(*names: str, close: bool = False, **limits: str) -> Query:
    """Publishes the logs as messages, slice by slice in time order, lets detectors with the
    default watermark take each slice, and reads the alerts.

    Files arrive as Spark writes them, in parallel; a slice is taken once it is there as a
    whole. With `limits` (for detectors without windows) a slice takes several micro-batches.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = shared_folder(spark)
        slices, rows = _in_time_order(spark, fixtures.security_logs(spark, sf_dir), folder, close)
        for staged in slices:
            _take(spark, staged, folder, list(names), "checkpoints", rows, **limits)
        return joined_arrays(alert_log.read_alerts(spark, f"{folder}/alerts"))

    return query


def stream_live_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live summary of every source, kept by a stream over days of stored alerts."""
    folder = shared_folder(spark)
    logs = spread(fixtures.security_logs(spark, sf_dir))
    detectors = {
        "brute_force": det.brute_force, "volume": det.volume_anomaly, "signatures": det.signature_alerts,
        "port_scan": det.port_scan,
    }
    for name, detector in detectors.items():
        alert_log.alert_writer(f"{folder}/alerts", name, run="batch")(detector(logs), 0)
    live_state.start_live_state(
        spark, f"{folder}/alerts", f"{folder}/live", f"{folder}/checkpoint", {"availableNow": True}, maxFilesPerTrigger="8"
    ).awaitTermination()
    return joined_arrays(live_state.read_live_state(spark, f"{folder}/live"))


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detectors that stop after part of the topic, and start again without their checkpoint."""
    folder, names = shared_folder(spark), ["brute_force", "signatures"]
    (*early, late), rows = _in_time_order(spark, fixtures.security_logs(spark, sf_dir), folder, False)
    for staged in early:
        _take(spark, staged, folder, names, "before", rows)
    _take(spark, late, folder, names, "after", rows)
    return joined_arrays(alert_log.read_alerts(spark, f"{folder}/alerts"))


# --- the catalogue ----------------------------------------------------------------


def queries() -> dict[str, Query]:
    return {
        # filters, projections
        "log_count": over_logs(lambda logs: logs.agg(F.count("*").alias("logs"))),
        "tcp_only": over_logs(lambda logs: logs.filter(F.col("protocol") == "TCP")),
        "blocked_only": over_logs(lambda logs: logs.filter(F.col("action") == "blocked")),
        "suspicious_events": over_logs(rep.suspicious_events),
        "partition_columns": over_logs(files.with_partition_columns),
        "log_type_partition": over_logs(log_type_partition),
        # sources and sinks
        "csv_ingest": csv_ingest,
        "lake_scan": lake_scan,
        "lake_range": lake_range,
        "lake_roundtrip": lake_roundtrip,
        "sink_roundtrip": sink_roundtrip,
        "keyed_upsert": keyed_upsert,
        "json_parse": over_logs(json_parse),
        "json_quarantine": over_logs(json_quarantine),
        "json_publish": json_publish,
        "normalize_raw_logs": over_logs(
            lambda logs: normalize_raw_logs(raw_strings(logs), latest_event(logs))
        ),
        # reputation
        "label_breakdown": over_logs(rep.label_breakdown),
        "suspicious_by_ip_logtype": over_logs(rep.suspicious_by_ip_logtype),
        "malicious_count_by_ip": over_logs(lambda logs: rep.label_count_by_ip(logs, "malicious")),
        "suspicious_count_by_ip": over_logs(lambda logs: rep.label_count_by_ip(logs, "suspicious")),
        "reputation_all_ips": over_logs(rep.reputation),
        "reputation_join": over_logs(rep.reputation_join),
        "top_malicious_ips": over_logs(rep.top_malicious_ips),
        "ip_reputation_table": over_logs(reputation_table),
        # detectors
        "port_scan": over_logs(ordered_port_scans),
        "brute_force_alerts": over_logs(det.brute_force),
        "volume_anomaly_alerts": over_logs(det.volume_anomaly),
        "brute_force_sliding": over_logs(lambda logs: det.brute_force(logs, "20 seconds")),
        "attack_patterns": attack_patterns,
        "signature_alerts": over_logs(det.signature_alerts),
        "attack_category_distribution": over_logs(
            lambda logs: det.attack_patterns(logs).groupBy("attack_category").count()
        ),
        "attack_pattern_table": over_logs(pattern_table),
        # volume and timeline
        "volume_analysis": over_logs(vol.volume_profile),
        "threat_timeline": over_logs(vol.threat_timeline),
        "timeline_full_join": over_logs(vol.timeline_full_join),
        "timeline_range": over_logs(
            lambda logs: vol.timeline_range(
                vol.threat_timeline(spread(logs)), latest_event(logs), "20231016", "20231018"
            )
        ),
        "timeline_last_days": over_logs(
            lambda logs: vol.timeline_range(vol.threat_timeline(spread(logs)), latest_event(spread(logs)))
        ),
        "stored_timeline": stored_timeline,
        "volume_sketches": volume_sketches,
        "target_sketches": target_sketches,
        # alerts
        "active_threats": over_alerts(joined_arrays),
        "active_threats_of_days": over_logs(lambda logs: joined_arrays(alerts_of(spread(logs)))),
        "stored_active_alerts": stored_active_alerts,
        "recent_alerts_by_ip": over_alerts(lambda a: joined_arrays(al.recent_alerts_by_ip(a))),
        "active_alerts_top100": over_alerts(lambda a: joined_arrays(al.active_alerts_top(a))),
        "alert_summary_by_ip": over_alerts(lambda a: joined_arrays(al.alert_summary_by_ip(a))),
        "severity_counts": over_alerts(al.severity_counts),
        "alerts_by_severity": over_alerts(
            lambda a: joined_arrays(al.alerts_by_severity(a, "HIGH"))
        ),
        "attack_type_distribution": over_alerts(al.attack_type_distribution),
        "top_alert_ips": over_alerts(al.top_alert_ips),
        "alert_board": over_alerts(al.alert_board),
        "scenario_alerts": over_logs(
            lambda logs: alerts_of(fixtures.with_hourly_scenario(logs)).drop(
                "attack_types", "user_agents", "log_sources"
            )
        ),
        # profiles
        "ip_attack_types": over_logs(
            lambda logs: joined_arrays(serving.ip_attack_types(pattern_table(logs)))
        ),
        "global_stats": over_logs(lambda logs: serving.global_stats(reputation_table(logs))),
        "recommendation": over_logs(
            lambda logs: profiles(logs).select(
                "ip", "reputation_score", "active_alerts", "recommendation"
            )
        ),
        "threat_profile_flat": over_logs(lambda logs: joined_arrays(profiles(logs))),
        "threat_profile": over_logs(lambda logs: serving.threat_profile_json(profiles(logs))),
        "profile_lookup": profile_lookup,
        "stored_profile": stored_profile,
        "stored_stats": stored_stats,
        # streams
        "stream_brute_force": replay("brute_force"),
        "stream_signature": replay("signatures", maxFilesPerTrigger="16"),
        "stream_volume": replay("volume"),
        "stream_all": replay("brute_force", "signatures", "volume"),
        "stream_port_scan": replay("port_scan", close=True),
        "stream_port_scan_early": replay("port_scan", "port_scan_early"),
        "stream_restart": stream_restart,
        "stream_live_state": stream_live_state,
    }


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["threat_profile"](spark, sf_dir)

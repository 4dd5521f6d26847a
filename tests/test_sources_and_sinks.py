import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from threatlens import jobs
from threatlens.schema import LAKE_PARTITIONS, LOG_COLUMNS
from threatlens.session import create_session, shared_folder
from threatlens.sinks import keyed_tables as kt
from threatlens.sources import files, messages
from threatlens.sources.normalize import normalize_raw_logs

NOW = dt.datetime(2023, 10, 15, 14, 0)
HEADER = ",".join(LOG_COLUMNS)


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture
def csv_file(tmp_path):
    def write(*lines):
        path = tmp_path / "raw.csv"
        path.write_text("\n".join([HEADER, *lines]) + "\n")
        return str(path)

    return write


GOOD = '2023-10-05 14:00:00,1.1.1.1,2.2.2.2,TCP,allowed,benign,ids,12,"a, b",/x'
BAD = "yesterday,1.1.1.2,,TCP,allowed,benign,ids,many,,"


def test_csv_values_and_damage(spark, csv_file):
    logs = files.read_csv_logs(spark, csv_file(GOOD, BAD))
    good, bad = sorted(logs.collect(), key=lambda r: r.source_ip)
    assert good.timestamp == dt.datetime(2023, 10, 5, 14)
    assert (good.bytes_transferred, good.user_agent) == (12, "a, b")
    assert (bad.timestamp, bad.bytes_transferred, bad.user_agent) == (None, None, None)
    missing = {r.source_ip: r.missing_fields for r in files.with_missing_fields(logs).collect()}
    assert missing == {"1.1.1.1": [], "1.1.1.2": ["timestamp", "dest_ip"]}


def test_lake_keeps_padded_days_and_prunes(spark, make_logs, tmp_path):
    root = str(tmp_path / "lake")
    days = [dt.datetime(2023, 9, 30), dt.datetime(2023, 10, 5), dt.datetime(2023, 10, 15)]
    files.write_lake(make_logs(*[{"timestamp": d} for d in days]), root)
    lake = files.read_logs(spark, root)
    assert rows_of(lake, *LAKE_PARTITIONS) == [
        ("2023", "09", "30"), ("2023", "10", "05"), ("2023", "10", "15")
    ]
    october = files.read_logs(spark, root, dt.date(2023, 10, 1), dt.date(2023, 10, 14))
    assert rows_of(october, "day") == [("05",)]
    plan = october._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(concat_ws" in plan


def test_daily_load_replaces_its_days_only(spark, make_logs, tmp_path):
    root = str(tmp_path / "lake")
    files.write_lake(make_logs({"timestamp": NOW}, {"timestamp": NOW - dt.timedelta(days=1)}), root)
    files.write_lake(make_logs({"timestamp": NOW, "source_ip": "new"}), root, replace_all=False)
    assert rows_of(files.read_logs(spark, root), "day", "source_ip") == [
        ("14", "192.168.1.100"), ("15", "new")
    ]


def test_mixed_input_makes_few_files(spark, make_logs, tmp_path):
    root = tmp_path / "lake"
    rows = [{"timestamp": NOW - dt.timedelta(days=i % 3), "dest_ip": f"d{i}"} for i in range(300)]
    files.write_lake(make_logs(*rows).repartition(20), str(root), files_per_day=2)
    for day in ("13", "14", "15"):
        assert 1 <= len(list(root.glob(f"year=2023/month=10/day={day}/*.parquet"))) <= 2
    assert files.read_logs(spark, str(root)).count() == 300


def normalized(spark, column, values):
    raw = spark.createDataFrame([(v,) for v in values], f"{column} string")
    return normalize_raw_logs(raw, NOW).collect()


def test_stamps(spark):
    cases = {
        "2023-10-15 10:00:00": "2023-10-15T10:00:00Z",
        "2023-10-15T10:00:00Z": "2023-10-15T10:00:00Z",
        "2023-10-15T10:00:00": "2023-10-15T10:00:00Z",
        "2023-3-2 1:2:3": "2023-03-02T01:02:03Z",
        "2023-10-15 10:00:00Z": None,
        "2023-02-30 10:00:00": None,
        "2023-10-15 10:00:60": None,
        "2023-10-15": None,
        "soon": None,
    }
    rows = normalized(spark, "timestamp", cases)
    assert [r.timestamp for r in rows] == [good or raw for raw, good in cases.items()]
    assert [r.stamp_readable for r in rows] == [good is not None for good in cases.values()]
    empty = normalized(spark, "timestamp", ["", None])
    assert [r.timestamp for r in empty] == ["2023-10-15T14:00:00Z"] * 2


def test_stamps_ignore_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = normalized(spark, "timestamp", ["2023-03-12 02:30:00"])[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.timestamp == "2023-03-12T02:30:00Z"


def test_sizes(spark):
    cases = {"12": 12, " 12 ": 12, "+5": 5, "-7": -7, "1_000": 1000, "1__0": 0, "12.5": 0, "abc": 0, "": 0}
    assert [r.bytes_transferred for r in normalized(spark, "bytes_transferred", cases)] == list(cases.values())


def test_defaults_fill_absent_columns_only(spark):
    row = normalized(spark, "protocol", [""])[0]
    assert (row.protocol, row.source_ip, row.action, row.log_type) == ("", "0.0.0.0", "allowed", "firewall")
    assert (row.threat_label, row.user_agent, row.request_path, row.bytes_transferred) == ("benign", "", "/", 0)


def test_records_round_trip(spark, make_logs, tmp_path):
    logs = make_logs(
        {"timestamp": NOW, "log_type": "ids", "user_agent": None, "request_path": "/é?q=\"x\""},
        {"log_type": "application"}, {"log_type": "firewall"}, {"log_type": "other"},
    ).withColumn("log_id", F.monotonically_increasing_id())
    messages.publish_logs(logs, "files", path=str(tmp_path / "topic"))
    records = messages.read_records(spark, "files", path=str(tmp_path / "topic"))
    keyed = {(r.key.decode(), r.partition) for r in records.collect()}
    assert keyed == {("ids", 1), ("application", 2), ("firewall", 0), ("other", 0)}
    parsed = messages.parse_log_json(records)
    stamp = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp")
    assert rows_of(parsed, stamp, *LOG_COLUMNS[1:4], "log_type") == rows_of(
        logs, stamp, *LOG_COLUMNS[1:4], "log_type"
    )
    assert parsed.filter("request_path = '/é?q=\"x\"' AND user_agent IS NULL").count() == 1


BODIES = {
    "sound": '{"timestamp":"2023-10-15T10:00:00Z","source_ip":"a","bytes_transferred":5,"new_field":[1]}',
    "text": '{"timestamp":"2023-10-15 10:00:00","source_ip":7,"bytes_transferred":"5"}',
    "sparse": '{"source_ip":null}',
    "cut": '{"source_ip":"a"',
    "list": "[1]",
    "number": "5",
    "wrong": '{"timestamp":"soon","source_ip":"a","bytes_transferred":{"n":5}}',
    "empty": "",
    "null": None,
}


def test_broken_messages_are_set_apart_with_their_text(spark):
    records = spark.createDataFrame(list(BODIES.items()), "offset string, body string").selectExpr("offset", "encode(body, 'UTF-8') AS value")
    checked = messages.checked_log_json(records)
    assert {r.log_id: r.fault for r in checked.collect()} == {
        "sound": None, "text": None, "sparse": None, "cut": "body: not JSON", "list": "body: not an object",
        "number": "body: not an object", "wrong": "timestamp: not a time, bytes_transferred: not a whole number",
        "empty": "body: not JSON", "null": "body: missing",
    }
    assert all(r.body == BODIES[r.log_id] for r in messages.quarantined(checked).collect())
    rows = {r.log_id: r for r in messages.sound(checked).collect()}
    assert set(rows) == {"sound", "text", "sparse"}
    assert [(rows[i].source_ip, rows[i].bytes_transferred) for i in rows if i != "sparse"] == [("a", 5), ("7", 5)]
    assert rows["text"].timestamp == rows["sound"].timestamp
    assert rows["sound"].log_id and messages.sound(checked).columns == ["log_id", *LOG_COLUMNS]


def test_sound_messages_read_as_the_plain_parser_reads_them(spark, make_logs):
    logs = make_logs({}, {"user_agent": None, "bytes_transferred": None}, {"source_ip": 'q"\\é'}).withColumn("log_id", F.lit(1))
    records = messages.to_records(logs)
    assert messages.sound(messages.checked_log_json(records)).collect() == messages.parse_log_json(records).collect()


def test_kafka_records_are_identified_by_offset(spark):
    records = spark.sql(
        "SELECT CAST('ids' AS BINARY) AS key, CAST('{\"source_ip\": \"a\"}' AS BINARY) AS value,"
        " 't' AS topic, 1 AS partition, 7L AS offset UNION ALL"
        " SELECT NULL, CAST('{broken' AS BINARY), 't', 1, 8L"
    )
    rows = {r.log_id: r.source_ip for r in messages.parse_log_json(records).collect()}
    assert rows == {"t-1-7": "a", "t-1-8": None}


def test_upsert_replaces_by_key_and_repeats_safely(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = "source_ip string, score bigint"
    first = spark.createDataFrame([("a", 1), ("b", 2)], schema)
    second = spark.createDataFrame([("b", 3), ("c", 4)], schema)
    for load in (first, second, second):
        kt.upsert(load, path, ["source_ip"])
    assert rows_of(kt.read_table(spark, path), "source_ip", "score") == [("a", 1), ("b", 3), ("c", 4)]


def load(spark, path, *rows):
    kt.upsert(spark.createDataFrame(list(rows), "source_ip string, score bigint"), path, ["source_ip"])


def stored(spark, path):
    return sorted(map(tuple, kt.read_table(spark, path).collect()), key=str)


def test_an_unpublished_snapshot_is_not_read(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        kt.read_table(spark, path)
    load(spark, path, ("a", 1))
    (tmp_path / "table" / "data-of-a-lost-writer").mkdir()
    (tmp_path / "table" / "_snapshots" / "2").touch()  # its writer died before the text
    assert stored(spark, path) == [("a", 1)]
    load(spark, path, ("b", 1))
    assert stored(spark, path) == [("a", 1), ("b", 1)]


def test_loads_need_no_success_file(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        load(spark, str(tmp_path / "table"), ("a", 1))
        load(spark, str(tmp_path / "table"), ("b", 1))
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert stored(spark, str(tmp_path / "table")) == [("a", 1), ("b", 1)]


def test_two_loads_that_saw_the_same_snapshot(spark, tmp_path, monkeypatch):
    path, current = str(tmp_path / "table"), kt._current
    load(spark, path, ("a", 1))
    seen = [current(spark, path)]
    load(spark, path, ("b", 1))
    monkeypatch.setattr(kt, "_current", lambda *args: seen.pop() if seen else current(*args))
    load(spark, path, ("c", 1), ("a", 2))
    assert not seen
    assert stored(spark, path) == [("a", 2), ("b", 1), ("c", 1)]
    assert len(list((tmp_path / "table").glob("data-*"))) == 3


def test_null_keys_are_replaced(spark, tmp_path):
    path = str(tmp_path / "table")
    load(spark, path, (None, 1), ("a", 1))
    load(spark, path, (None, 2))
    assert stored(spark, path) == [("a", 1), (None, 2)]


def test_last_listed_row_wins_a_key(spark):
    report = spark.createDataFrame(
        [("a", "ids", 9), ("a", "firewall", 4), ("a", "application", 4), ("b", "ids", 5)],
        "source_ip string, log_type string, total_events bigint",
    ).withColumns({c: F.lit(1).cast("bigint") for c in ("reputation_score", "unique_targets", "total_bytes")})
    rows = kt.ip_reputation_rows(report, NOW)
    assert rows_of(rows, "source_ip", "log_types", "total_events") == [("a", "firewall", 4), ("b", "ids", 5)]


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(root)
    assert shared_folder(spark) != shared_folder(spark)
    assert shared_folder(spark, "hdfs://other/place").startswith("hdfs://other/place/")
    conf = {"spark.sql.warehouse.dir": "s3a://bucket/warehouse"}
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda key, *default: conf.get(key, *default)))
    assert shared_folder(bare).startswith("s3a://bucket/warehouse/")


def test_a_session_is_in_utc_and_takes_settings(spark):
    made = create_session("another", **{"spark.sql.ansi.enabled": "true"})
    assert made.conf.get("spark.sql.session.timeZone") == "UTC"
    assert made.sparkContext is spark.sparkContext


def test_jobs_from_csv_to_profiles(spark, csv_file, tmp_path):
    lines = []
    for i in range(30):
        lines.append(
            f"2023-10-15 14:00:{i:02d},6.6.6.6,10.0.0.{i},TCP,blocked,"
            f"{['malicious', 'suspicious'][i % 2]},ids,1048576,sqlmap/1.7,/x"
        )
    path = csv_file(*lines)
    lake, out, tables, topic, alerts = (str(tmp_path / n) for n in ("lake", "out", "tables", "topic", "alerts"))
    jobs.main(["convert", "--input", path, "--lake", lake])
    assert files.convert_csv_to_lake(spark, path, lake) == files.read_logs(spark, lake).count() == 30
    jobs.reputation(spark, lake, out, tables)
    jobs.port_scan(spark, lake, out, tables)
    jobs.patterns(spark, lake, out, tables)
    jobs.volume(spark, lake, out, tables)
    jobs.publish(spark, path, topic_folder=topic)
    from threatlens.streaming.app import start_detectors

    stream = messages.parse_log_json(messages.read_stream(spark, "files", path=topic))
    for query in start_detectors(stream, alerts, str(tmp_path / "cp"), delay=None, trigger={"availableNow": True}):
        query.awaitTermination()
    jobs.profiles(spark, tables, alerts, str(tmp_path / "profiles"))
    profile = spark.read.parquet(str(tmp_path / "profiles")).collect()
    assert [r.ip for r in profile] == ["6.6.6.6"]
    assert profile[0].recommendation == "BLOCK"
    assert profile[0].batch_layer.attack_types_detected == ["PORT_SCAN", "TOOL_DETECTED"]
    assert set(profile[0].speed_layer.recent_attack_types) <= {"BRUTE_FORCE", "KNOWN_ATTACK_TOOL", "VOLUME_ANOMALY"}
    assert kt.read_table(spark, f"{tables}/threat_timeline").count() == 1
    assert not (tmp_path / "out" / "staging").exists()

    def report(name, *arguments):
        jobs.main([name, *arguments, "--output", str(tmp_path / name)])
        return spark.read.parquet(str(tmp_path / name)).collect()

    live = report("active", "--alerts", alerts)
    assert {r.ip_source for r in live} == {"6.6.6.6"}
    assert report("active", "--alerts", alerts, "--as-of", "2023-10-17T00:00:00") == []
    assert len(report("active", "--alerts", alerts, "--severity", "HIGH")) < len(live)
    assert [tuple(r) for r in report("stats", "--tables", tables)] == [(1, 1)]
    assert report("timeline", "--tables", tables) == []
    assert len(report("timeline", "--tables", tables, "--from-day", "20231015", "--to-day", "20231015")) == 1
    jobs.reputation(spark, lake, out, tables, as_of="2023-10-16T00:00:00", from_day="2023-10-15", to_day="2023-10-15")
    assert kt.read_table(spark, f"{tables}/ip_reputation").first().last_seen == dt.datetime(2023, 10, 16)


def test_daily_load_and_rejected_rows(spark, csv_file, tmp_path):
    lake, bad = str(tmp_path / "lake"), str(tmp_path / "bad")
    row = "2023-10-{} 14:00:00,{},10.0.0.1,TCP,blocked,benign,ids,1,agent,/x"
    first = csv_file(row.format(15, "a"), row.format(16, "b"))
    jobs.convert(spark, first, lake, files_per_day="2")
    second = csv_file(row.format(16, "c"), row.format("xx", "lost"), row.format(16, ""))
    jobs.convert(spark, second, lake, daily="true", rejected=bad)
    assert rows_of(files.read_logs(spark, lake), "day", "source_ip") == [("15", "a"), ("16", "c")]
    rejected = {tuple(r.missing_fields) for r in spark.read.parquet(bad).collect()}
    assert rejected == {("timestamp",), ("source_ip",)}


@pytest.mark.parametrize("job", ["publish", "stream"])
def test_kafka_jobs_pass_topic_and_limits(spark, csv_file, monkeypatch, job):
    seen = {}
    monkeypatch.setattr(messages, "publish_logs", lambda logs, kind, **o: seen.update(kind=kind, **o))
    monkeypatch.setattr(
        jobs.app, "run", lambda spark, alerts, checkpoints, kind, delay, **o: seen.update(kind=kind, **o)
    )
    common = ["--kafka", "host:9092", "--topic", "t"]
    if job == "publish":
        jobs.main(["publish", "--input", csv_file(GOOD), *common])
        assert seen == {"kind": "kafka", "kafka.bootstrap.servers": "host:9092", "topic": "t"}
    else:
        jobs.main(["stream", "--alerts", "a", "--checkpoints", "c", "--max-offsets", "5", *common])
        assert seen == {
            "kind": "kafka", "kafka.bootstrap.servers": "host:9092", "subscribe": "t", "maxOffsetsPerTrigger": "5",
            "files": 4,
        }

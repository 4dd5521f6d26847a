import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from threatlens.functions.times import utc_instant, utc_wall_clock
from threatlens.operators import alerts as al
from threatlens.operators import detectors as det
from threatlens.schema import LOG_FILE
from threatlens.sinks.alert_log import alert_writer, read_alerts
from threatlens.streaming.app import start_detectors

START = dt.datetime(2023, 10, 15, 14, 0)


def at(n, **fields):
    return {"timestamp": START + dt.timedelta(seconds=n), **fields}


@pytest.fixture
def feed(spark, tmp_path, make_logs):
    """Writes slices of rows as files, in arrival order, and runs detectors over them."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    arrived = []

    def add(*rows):
        target = tmp_path / f"slice{len(arrived)}"
        make_logs(*rows).coalesce(1).write.parquet(str(target))
        part = next(target.glob("part-*.parquet"))
        placed = inbox / f"{len(arrived):03d}.parquet"
        placed.write_bytes(part.read_bytes())
        os.utime(placed, (1_600_000_000 + len(arrived) * 10,) * 2)
        arrived.append(placed)

    def run(*names, delay=None, checkpoints="checkpoints"):
        stream = (
            spark.readStream.schema(LOG_FILE).option("maxFilesPerTrigger", 1).parquet(str(inbox))
        )
        queries = start_detectors(
            stream, str(tmp_path / "alerts"), str(tmp_path / checkpoints), list(names), delay,
            {"availableNow": True}, files=1,
        )
        for query in queries:
            query.awaitTermination()
        return queries, read_alerts(spark, str(tmp_path / "alerts"))

    return add, run


def comparable(alerts):
    return sorted(map(str, alerts.drop("alert_id").collect())), sorted(r.alert_id for r in alerts.collect())


def mixed(seed, n=60):
    return [
        at((i * 37 + seed * 101) % 400, source_ip=f"s{i % 3}", dest_ip=f"d{(i * 7 + seed) % 90}",
           action=["blocked", "allowed"][i % 3 == 0], bytes_transferred=(i % 5) * 2**20,
           user_agent=["nmap", f"agent{seed}", None][i % 3], request_path=f"/p{seed}-{i}")
        for i in range(n)
    ]


def test_streams_equal_batch(feed, make_logs):
    add, run = feed
    slices = [mixed(seed) for seed in (3, 1, 2)]
    for rows in slices:
        add(*rows)
    _, alerts = run("brute_force", "signatures", "volume")
    logs = make_logs(*[r for rows in slices for r in rows])
    batch = [al.to_alerts(d(logs)) for d in (det.brute_force, det.signature_alerts, det.volume_anomaly)]
    expected = batch[0].unionByName(batch[1]).unionByName(batch[2])
    assert expected.count() > 20
    assert comparable(alerts) == comparable(expected)


def test_streaming_port_scan_is_exact_for_closed_windows(feed, make_logs):
    add, run = feed
    scan = [at(i * 2, source_ip="scanner", dest_ip=f"d{i}") for i in range(40)]
    add(*scan[:25], *scan[10:20])
    add(*scan[25:], at(10, source_ip="scanner", dest_ip="d1"))
    add(at(900, source_ip="later"))
    _, alerts = run("port_scan", delay="1 minute")
    rows = alerts.collect()
    assert [(r.ip_source, r.threat_score, r.event_count) for r in rows] == [("scanner", 80, 51)]


def test_early_port_scan_comes_with_the_target_that_passes_and_gives_way_to_the_exact_row(feed, spark, tmp_path):
    add, run = feed
    scan = [at(i * 2, source_ip="scanner", dest_ip=f"d{i}") for i in range(60)]
    quiet = [at(i, source_ip="quiet", dest_ip=f"d{i % 20}") for i in range(50)]
    add(*scan[:20], *quiet)
    add(scan[20], at(3, source_ip="scanner", dest_ip="d1"))
    add(*scan[21:], at(4, source_ip="scanner", dest_ip=None))
    _, alerts = run("port_scan_early", "port_scan", delay="10 minutes")
    assert [(r.ip_source, r.event_count) for r in alerts.collect()] == [("scanner", 62)]
    folder = str(tmp_path / "alerts")
    emissions = spark.read.parquet(folder).orderBy("batch").collect()
    assert [(r.query, r.batch, r.event_count) for r in emissions] == [("port_scan_early", 1, 22), ("port_scan_early", 2, 62)]
    add(at(3600, source_ip="later"))
    _, alerts = run("port_scan_early", "port_scan", delay="10 minutes")
    closed = spark.read.parquet(f"{folder}/query=port_scan").collect()
    assert [r.alert_id for r in closed] == [r.alert_id for r in alerts.collect()] == [emissions[0].alert_id]
    assert [tuple(r) for r in alerts.collect()] == [tuple(r)[:12] for r in closed]


def test_target_sketch_is_exact_while_small_and_close_beyond(make_logs, spark):
    rows = [at(0, source_ip=f"s{n}", dest_ip=f"{n}-{i}") for n in (20, 21, 22, 300) for i in range(n)]
    logs = make_logs(*rows)
    exact = det.port_scan(logs).orderBy("source_ip").collect()
    assert det.port_scan_early(logs).select(det.port_scan(logs).columns).orderBy("source_ip").collect() == exact
    many = spark.range(50_000).selectExpr(
        "TIMESTAMP_NTZ'2023-10-15 14:00:00' AS timestamp", "'busy' AS source_ip", "CAST(id AS STRING) AS dest_ip",
        "'TCP' AS protocol", "'ids' AS log_type",
    )
    assert abs(det.port_scan_early(many).first().distinct_targets / 50_000 - 1) < 0.05


def test_replays_take_logs_that_come_in_bursts(spark, tmp_path):
    import duckdb

    from threatlens.plans import catalog, oracles

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.filter("event_id < 330 OR event_id = 500 OR event_id >= 670").write.parquet(f"{tmp_path}/events.parquet")
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    for name in ("stream_brute_force", "stream_restart"):
        made = catalog.queries()[name](spark, str(tmp_path))
        expected = connection.sql(oracles.oracle_sql()[name])
        picked = expected.select(", ".join(made.columns)).fetchall()
        assert sorted(map(str, map(tuple, made.collect()))) == sorted(map(str, picked)) and picked


def test_a_growing_window_stays_one_alert(feed, spark, tmp_path):
    add, run = feed
    for _ in range(3):
        add(*[at(5, action="blocked")] * 6)
    _, alerts = run("brute_force")
    assert [(r.event_count, r.severity) for r in alerts.collect()] == [(18, "CRITICAL")]
    folder = str(tmp_path / "alerts")
    assert read_alerts(spark, folder, START).count() == 1
    assert read_alerts(spark, folder, START + dt.timedelta(minutes=1)).isEmpty()
    emissions = spark.read.parquet(f"{folder}/query=brute_force")
    assert [r.event_count for r in emissions.orderBy("batch").collect()] == [6, 12, 18]


def test_restart_continues_from_the_checkpoint(feed):
    add, run = feed
    add(*[at(5, action="blocked")] * 6)
    run("brute_force")
    add(*[at(6, action="blocked")] * 6)
    _, alerts = run("brute_force")
    assert [r.event_count for r in alerts.collect()] == [12]


def test_a_new_checkpoint_keeps_what_was_stored(feed, make_logs):
    add, run = feed
    add(*[at(5, action="blocked")] * 12)
    add(*[at(120, action="blocked", source_ip="b")] * 7)
    run("brute_force")
    add(*[at(240, action="blocked", source_ip="c")] * 8)
    _, alerts = run("brute_force", checkpoints="fresh")
    assert sorted((r.ip_source, r.event_count) for r in alerts.collect()) == [("192.168.1.100", 12), ("b", 7), ("c", 8)]


def test_batches_without_alerts_leave_nothing(feed, spark, tmp_path):
    add, run = feed
    add(at(5))
    _, alerts = run("brute_force", "signatures", "volume")
    assert alerts.collect() == [] and not list((tmp_path / "alerts").rglob("*.parquet"))
    assert read_alerts(spark, str(tmp_path / "nowhere")).collect() == []


def test_rows_without_an_id_are_told_apart_by_their_text(make_logs):
    rows = make_logs(
        *[{"user_agent": "nmap", "request_path": f"/{i}"} for i in range(5)],
        {"user_agent": "nmap", "request_path": None}, {"user_agent": "nmap", "request_path": "-"},
        {"user_agent": "nmap", "request_path": "/0"},
    ).selectExpr("CAST(NULL AS STRING) AS log_id", "*")
    ids = [r.alert_id for r in al.to_alerts(det.signature_alerts(rows)).collect()]
    assert len(ids) == 8 and len(set(ids)) == 7


def test_a_replayed_batch_changes_nothing(spark, make_logs, tmp_path):
    write = alert_writer(str(tmp_path / "alerts"), "signatures", run="r")
    batch = det.signature_alerts(make_logs(*[{"user_agent": "nmap", "request_path": f"/{i}"} for i in range(4)]))
    for _ in range(3):
        write(batch, 7)
    assert read_alerts(spark, str(tmp_path / "alerts")).count() == 4


def test_watermark_drops_late_rows_and_state(feed):
    add, run = feed
    add(*[at(5, action="blocked")] * 6)
    add(at(3600, action="blocked"))
    add(at(3601, action="blocked"))
    add(*[at(6, action="blocked")] * 6)
    queries, alerts = run("brute_force", delay="1 minute")
    assert [r.event_count for r in alerts.collect()] == [6]
    assert queries[0].lastProgress["stateOperators"][0]["numRowsTotal"] == 1


def test_without_watermark_late_rows_count(feed):
    add, run = feed
    add(*[at(5, action="blocked")] * 6)
    add(at(3600, action="blocked"))
    add(*[at(6, action="blocked")] * 6)
    queries, alerts = run("brute_force")
    assert [r.event_count for r in alerts.collect()] == [12]


def test_port_scan_needs_a_delay(spark, tmp_path):
    stream = spark.readStream.schema(LOG_FILE).parquet(str(tmp_path))
    with pytest.raises(ValueError):
        start_detectors(stream, "a", "c", ["port_scan"], delay=None)


def test_wall_clock_and_instant_invert_each_other(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2023-03-12 02:30:00.123456' AS t")
        instant = df.select(utc_instant(df, "t").alias("t"))
        back = instant.select(utc_wall_clock(instant, "t").alias("t")).collect()[0].t
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert back == dt.datetime(2023, 3, 12, 2, 30, 0, 123456)


def test_overlapping_windows_count_a_row_in_each(make_logs):
    logs = make_logs(*[at(n, action="blocked") for n in (25, 35, 45, 55, 65, 75, 85)])
    found = det.brute_force(logs, "30 seconds").collect()
    assert sorted((r.window_start.second, r.window_start.minute, r.blocked_count) for r in found) == [(30, 0, 6)]
    assert det.brute_force(logs).collect() == []


def test_progress_is_kept_and_a_failure_stops_all(spark, tmp_path, make_logs):
    from pyspark.errors import StreamingQueryException

    from threatlens.sources import messages
    from threatlens.streaming import app
    from threatlens.streaming.progress import read_progress

    topic, names = str(tmp_path / "topic"), ["brute_force", "signatures"]
    logs = make_logs(*[at(5, action="blocked")] * 6, {"user_agent": "nmap"}).withColumn("log_id", F.expr("uuid()"))
    messages.to_records(logs.withColumn("log_id", F.lit(1))).write.partitionBy("partition").parquet(topic)
    broken = spark.createDataFrame([(None, b"{", 7, 0)], messages.RECORD)
    broken.write.mode("append").partitionBy("partition").parquet(topic)
    run = lambda name, **more: app.run(
        spark, str(tmp_path / name), str(tmp_path / f"{name}-checkpoints"), "files", trigger={"availableNow": True},
        names=names, quarantine=str(tmp_path / f"{name}-bad"), metrics=str(tmp_path / f"{name}-metrics"), path=topic, **more,
    )
    run("whole")
    assert [(r.fault, r.body) for r in spark.read.parquet(str(tmp_path / "whole-bad")).collect()] == [("body: not JSON", "{")]
    rows = {(r.query, r.batch): r for r in read_progress(spark, str(tmp_path / "whole-metrics")).collect()}
    assert {q for q, _ in rows} == {"quarantine", *names}
    first = rows["brute_force", 0]
    assert (first.input_rows, first.alerts, first.failure) == (8, 1, None) and first.delay_ms > 0
    assert rows["signatures", 0].alerts == 1 and rows["brute_force", 0].state_rows == 1
    (tmp_path / "torn").write_text("a file where the alerts should go")
    with pytest.raises(StreamingQueryException):
        run("torn")
    assert not spark.streams.active
    failed = [r for r in read_progress(spark, str(tmp_path / "torn-metrics")).collect() if r.failure]
    assert failed and failed[0].query in names


def test_old_batches_are_merged_and_nothing_changes(feed, spark, tmp_path):
    from threatlens.sinks.alert_log import compact_alerts

    add, run = feed
    for n in range(4):
        add(*[at(5 + n, action="blocked")] * 6, at(90 + n, user_agent="nmap", request_path=f"/{n}"))
    _, alerts = run("brute_force", "signatures", "port_scan_early")
    folder, before = tmp_path / "alerts", sorted(map(str, alerts.collect()))
    assert compact_alerts(spark, str(folder)) == 0
    for batch in folder.glob("query=*/run=*/batch=*"):
        if batch.name != "batch=3":
            os.utime(batch, (1_600_000_000,) * 2)
    assert compact_alerts(spark, str(folder), dt.timedelta(hours=1)) == 6
    assert len(list(folder.glob("query=*/run=*/batch=*"))) == 4
    assert sorted(map(str, read_alerts(spark, str(folder)).collect())) == before
    add(*[at(20, action="blocked")] * 6)
    _, alerts = run("brute_force", "signatures", "port_scan_early")
    assert max(r.event_count for r in alerts.collect()) == 30


def test_a_stream_parses_a_record_once(spark, tmp_path, make_logs, capsys):
    from threatlens.sources import messages

    logs = make_logs(*[at(n, user_agent="nmap", action="blocked") for n in range(8)], {"request_path": "/a' OR 1"})
    path = str(tmp_path / "topic")
    messages.publish_logs(logs.withColumn("log_id", F.monotonically_increasing_id()), "files", path=path)
    stream = messages.parse_log_json(messages.read_stream(spark, "files", path=path))
    names = ["signatures", "brute_force", "volume", "port_scan_early"]
    for query in start_detectors(
        stream, str(tmp_path / "alerts"), str(tmp_path / "cp"), names, None, {"availableNow": True}
    ):
        query.awaitTermination()
        capsys.readouterr()
        query.explain()
        assert capsys.readouterr().out.count("from_json") == 1, query.name
    found = {r.alert_type: r.n for r in read_alerts(spark, str(tmp_path / "alerts")).groupBy("alert_type").agg(F.count("*").alias("n")).collect()}
    assert found == {"KNOWN_ATTACK_TOOL": 8, "SQLI_DETECTED": 1, "BRUTE_FORCE": 1}


def test_state_has_as_many_partitions_as_its_rows_ask_for(spark, tmp_path, monkeypatch):
    from threatlens.plans import catalog
    from threatlens.session import tasks_for

    assert [tasks_for(spark, n) for n in (0, 1, 50_001, 2_000_000, 2_000_001, 12_000_000)] == [1, 1, 2, 4, 5, 24]
    monkeypatch.setattr(catalog, "shared_folder", lambda spark: str(tmp_path))
    catalog.queries()["stream_all"](spark, "/root/testdata/sf0.001")
    for name in ("brute_force", "volume"):
        assert [p.name for p in (tmp_path / "checkpoints" / name / "state" / "0").glob("[0-9]*")] == ["0"]
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_slices_arrive_whole_in_time_order_and_once(spark, tmp_path):
    from threatlens.plans import catalog
    from threatlens.sources import fixtures, messages

    logs = fixtures.security_logs(spark, "/root/testdata/sf0.001").coalesce(1)
    slices, rows = catalog._in_time_order(spark, logs, str(tmp_path), True)
    topic, seen = str(tmp_path / "topic"), 0
    for staged in slices[:-1]:
        messages.release_records(spark, staged, topic)
        there = messages.read_records(spark, "files", path=topic).agg(F.count("*"), F.max("offset"), F.count_distinct("offset")).first()
        assert there[0] == there[1] + 1 == there[2] and abs(there[0] - seen - rows) <= rows * 0.05
        seen = there[0]
    assert seen == logs.count() and len(slices) == 4
    messages.release_records(spark, slices[-1], topic)
    expected = messages.to_records(logs).drop("partition").collect()
    arrived = messages.read_records(spark, "files", path=topic).filter("offset IS NOT NULL").drop("partition").collect()
    assert sorted(map(str, arrived)) == sorted(map(str, expected))
    messages.release_records(spark, slices[0], topic)
    assert messages.read_records(spark, "files", path=topic).count() == seen + 3


def test_replay_of_nothing_finds_nothing(spark, tmp_path):
    from threatlens.plans import catalog

    spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(0).write.parquet(f"{tmp_path}/events.parquet")
    assert catalog.queries()["stream_all"](spark, str(tmp_path)).collect() == []

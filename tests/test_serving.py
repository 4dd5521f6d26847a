import datetime as dt

import pytest
from pyspark.sql import functions as F

from threatlens.functions import display, scoring
from threatlens.operators import alerts as al
from threatlens.operators import detectors as det
from threatlens.plans import serving
from threatlens.schema import ALERT
from threatlens.sources.fixtures import with_hourly_scenario

NOW = dt.datetime(2023, 10, 15, 14, 0)


def alert(ip, minute=0, score=80, kind="BRUTE_FORCE", size=100, severity="HIGH", alert_id=None):
    moment = NOW - dt.timedelta(minutes=minute)
    return (ip, moment, alert_id or f"{ip}-{kind}-{minute}", moment, score, [kind], kind, severity, 1,
            size, ["agent"], ["ids"])


@pytest.fixture
def alerts_frame(spark):
    return lambda *rows: spark.createDataFrame(list(rows), ALERT)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0].v


@pytest.mark.parametrize(
    "history, active, expected",
    [(81, 1, "BLOCK"), (87, 3, "BLOCK"), (85, 0, "MONITOR"), (65, 0, "MONITOR"), (80, 1, "MONITOR"),
     (50, 0, "MONITOR"), (49, 0, "ALLOW"), (0, 0, "ALLOW"), (0, 1, "MONITOR")],
)
def test_recommendation(spark, history, active, expected):
    assert value(spark, scoring.recommendation(F.lit(history), F.lit(active))) == expected


def test_confidence_equals_the_weighted_mean(spark):
    assert value(spark, scoring.confidence(F.lit(80), F.lit(100))) == 0.92
    pairs = spark.range(101 * 101).selectExpr("id DIV 101 AS id", "id % 101 AS live")
    got = pairs.select("id", "live", scoring.confidence(F.col("id"), F.col("live")).alias("c")).collect()
    for r in got:
        weighted = (4 * r.id + 6 * r.live + 5) // 10
        assert r.c == min(1.0, weighted / 100.0)


@pytest.mark.parametrize(
    "size, text",
    [(None, "0 B"), (0, "0 B"), (512, "512.0 B"), (1023, "1023.0 B"), (1024, "1.0 KB"), (1280, "1.3 KB"),
     (1048575, "1024.0 KB"), (15728640, "15.0 MB"), (1610612736, "1.5 GB"), (5 * 1024**4, "5120.0 GB")],
)
def test_readable_bytes(spark, size, text):
    assert value(spark, display.readable_bytes(F.lit(size).cast("bigint"))) == text


def test_labels_and_bands(spark):
    assert value(spark, display.alert_label(F.lit("PORT_SCAN"))) == "🔍 Port Scan"
    assert value(spark, display.alert_label(F.lit("NEW_KIND"))) == "NEW_KIND"
    assert value(spark, display.alert_label(F.lit(None).cast("string"))) == display.MISSING
    bands = [value(spark, display.score_band(F.lit(s))) for s in (80, 79, 60, 59, 40, 39)]
    assert bands == ["critical", "high", "high", "medium", "medium", "low"]
    assert value(spark, display.score_band(F.lit(None).cast("int"))) == "low"


def test_alert_defaults(spark):
    bare = spark.createDataFrame([(NOW,)], "timestamp timestamp_ntz")
    row = al.to_alerts(bare.withColumns({c: F.lit(None).cast("string") for c in ("source_ip", "dest_ip", "user_agent", "request_path")})).collect()[0]
    assert (row.ip_source, row.alert_type, row.severity) == ("unknown", "UNKNOWN", "MEDIUM")
    assert (row.threat_score, row.event_count, row.bytes_total) == (50, 1, 0)
    assert (row.user_agents, row.log_sources, row.attack_types) == (["unknown"], ["unknown"], ["UNKNOWN"])


def test_alert_identity_is_stable_and_distinct(make_logs):
    logs = make_logs({"action": "blocked", "user_agent": "hydra"}, repeat=8).withColumn(
        "log_id", F.monotonically_increasing_id()
    )
    ids = [r.alert_id for f in al.detect_all(logs) for r in f.collect()]
    assert len(ids) == 9 and len(set(ids)) == 9
    assert sorted(ids) == sorted(r.alert_id for f in al.detect_all(logs) for r in f.collect())


def test_alerts_expire_after_a_day(make_logs):
    burst = {"bytes_transferred": 2**30}
    logs = make_logs(
        {**burst, "timestamp": NOW},
        {**burst, "timestamp": NOW - dt.timedelta(hours=24, seconds=1)},
        {**burst, "timestamp": NOW - dt.timedelta(hours=24)},
        {**burst, "timestamp": NOW - dt.timedelta(hours=23, minutes=59, seconds=59)},
    )
    live = al.active_alerts(logs, NOW).collect()
    assert sorted(r.last_seen for r in live) == [NOW - dt.timedelta(hours=23, minutes=59, seconds=59), NOW]


def test_reading_live_rows_only_keeps_whole_windows(make_logs):
    cutoff = NOW - dt.timedelta(hours=24)
    rows = [
        {"source_ip": f"s{i % 3}", "dest_ip": f"d{i}", "timestamp": cutoff + dt.timedelta(seconds=7 * i - 2000),
         "action": ["blocked", "allowed"][i % 2], "bytes_transferred": 2**23, "user_agent": ["nmap", None][i % 2]}
        for i in range(600)
    ]
    logs = make_logs(*rows)
    everything = al.active_threats(al.detect_all(logs), NOW).collect()
    assert len(everything) > 20
    assert sorted(map(str, al.active_alerts(logs, NOW).collect())) == sorted(map(str, everything))


def test_recent_alerts_and_summary(alerts_frame):
    rows = [alert("a", minute=i, score=60 + i, kind=["X", "Y"][i % 2]) for i in range(15)]
    rows.append(alert("b", kind="PORT_SCAN", size=7))
    got = {r.ip_source: r for r in al.alert_summary_by_ip(alerts_frame(*rows)).collect()}
    assert got["a"].active_alerts == 10
    assert (got["a"].current_threat_score, got["a"].recent_alert_bytes) == (69, 1000)
    assert got["a"].recent_attack_types == ["X", "Y"]
    assert got["a"].last_seen == NOW
    assert got["b"].recent_attack_types == ["PORT_SCAN"]


def test_active_list_is_the_true_top(alerts_frame):
    rows = [alert(f"ip{i}", minute=i, score=i % 101) for i in range(300)]
    top = al.active_alerts_top(alerts_frame(*rows)).collect()
    assert len(top) == 100
    assert [r.threat_score for r in top] == sorted((i % 101 for i in range(300)), reverse=True)[:100]


def test_reports(alerts_frame):
    frame = alerts_frame(
        alert("a", severity="CRITICAL", score=95, kind="KNOWN_ATTACK_TOOL"), alert("a", minute=1),
        alert("b", kind="XSS_DETECTED", score=40, severity="MEDIUM"),
    )
    assert tuple(al.severity_counts(frame).collect()[0]) == (1, 1, 3)
    bars = {r.alert_type: r.alerts for r in al.attack_type_distribution(frame).collect()}
    assert bars == {"BRUTE_FORCE": 1, "SQLI_DETECTED": 0, "PORT_SCAN": 0, "KNOWN_ATTACK_TOOL": 1,
                    "VOLUME_ANOMALY": 0, "OTHER": 1}
    top = [tuple(r) for r in al.top_alert_ips(frame).collect()]
    assert top == [(1, "a", 2, 95, 100), (2, "b", 1, 40, 42)]
    assert al.alerts_by_severity(frame, "ALL").count() == 3
    assert al.alerts_by_severity(frame, "MEDIUM").count() == 1


@pytest.fixture
def profile_sides(spark, alerts_frame):
    reputation = spark.createDataFrame(
        [("hot", 87, 1243, 5, 10, "ids", NOW), ("old", 60, 9, 1, 1, "ids", NOW)],
        "source_ip string, score bigint, total_events bigint, unique_targets bigint, total_bytes bigint,"
        " log_types string, last_seen timestamp_ntz",
    )
    patterns = spark.createDataFrame(
        [("TOOL_DETECTED", "hot"), ("PORT_SCAN", "hot"), ("INJECTION", "hot"), ("SQLI", "seen")],
        "attack_type string, source_ip string",
    )
    alerts = alerts_frame(*[alert("hot", minute=i, score=92) for i in range(3)], alert("new", score=70))
    return reputation, patterns, alerts


def test_profile_joins_all_sides(profile_sides):
    flat = serving.threat_profile_flat(*profile_sides)
    got = {r.ip: r for r in flat.collect()}
    assert set(got) == {"hot", "old", "seen", "new"}
    hot = got["hot"]
    assert (hot.recommendation, hot.confidence, hot.active_alerts) == ("BLOCK", 0.9, 3)
    assert hot.attack_types_detected == ["PORT_SCAN", "TOOL_DETECTED"]
    assert (got["old"].recommendation, got["old"].confidence) == ("MONITOR", 0.24)
    assert (got["seen"].recommendation, got["seen"].attack_types_detected) == ("ALLOW", ["SQLI"])
    assert (got["new"].recommendation, got["new"].reputation_score) == ("MONITOR", 0)
    nested = {r.ip: r for r in serving.threat_profile(flat).collect()}
    assert nested["hot"].batch_layer.total_historical_events == 1243
    assert nested["hot"].speed_layer.recent_attack_types == ["BRUTE_FORCE"]


def test_lookup_validates_and_completes(spark, profile_sides):
    requests = spark.createDataFrame(
        [(" hot\t",), ("hot",), ("unknown",), ("",), ("   ",), ("x" * 46,), ("y" * 45,), (None,)], "ip string"
    )
    got = {r.ip: r for r in serving.profile_lookup(requests, *profile_sides).collect()}
    assert set(got) == {"hot", "unknown", "y" * 45}
    assert (got["hot"].recommendation, got["unknown"].recommendation) == ("BLOCK", "ALLOW")
    assert (got["unknown"].confidence, got["unknown"].recent_attack_types) == (0.0, [])


def test_global_stats(profile_sides):
    assert tuple(serving.global_stats(profile_sides[0]).collect()[0]) == (2, 1)


def test_scenario_alerts(make_logs):
    logs = make_logs({"source_ip": "quiet", "timestamp": NOW}).withColumn("log_id", F.lit(1).cast("bigint"))
    replayed = with_hourly_scenario(logs)
    assert replayed.count() == 11
    found = {(r.source_ip, r.event_count, r.threat_score) for r in det.brute_force(replayed).collect()}
    assert found == {("10.10.10.1", 8, 76)}
    tools = [(r.source_ip, r.alert_type) for r in det.signature_alerts(replayed).collect()]
    assert sorted(tools) == [("10.10.10.1", "KNOWN_ATTACK_TOOL")] * 8 + [("10.20.30.40", "KNOWN_ATTACK_TOOL")]
    bursts = [(r.source_ip, r.threat_score, r.severity) for r in det.volume_anomaly(replayed).collect()]
    assert bursts == [("172.16.0.5", 85, "HIGH")]

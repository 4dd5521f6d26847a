import datetime as dt
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threatlens.functions import signatures as sig
from threatlens.operators import detectors as det

START = dt.datetime(2023, 10, 15, 14, 0)


def seconds(n):
    return START + dt.timedelta(seconds=n)


def scan_rows(targets):
    return [
        {"dest_ip": f"10.0.{i // 250}.{i % 250}", "timestamp": seconds(i)} for i in range(targets)
    ]


@pytest.mark.parametrize(
    "targets, score, severity",
    [(21, 61, "MEDIUM"), (25, 65, "MEDIUM"), (50, 90, "MEDIUM"), (51, 91, "HIGH"),
     (100, 100, "HIGH"), (101, 100, "CRITICAL")],
)
def test_port_scan_scores(make_logs, targets, score, severity):
    row = det.port_scan(make_logs(*scan_rows(targets))).collect()[0]
    assert (row.distinct_targets, row.event_count) == (targets, targets)
    assert (row.threat_score, row.severity, row.attack_type) == (score, severity, "PORT_SCAN")
    assert (row.window_start, row.window_end) == (START, seconds(300))


@pytest.mark.parametrize("targets", [5, 20])
def test_port_scan_threshold_is_strict(make_logs, targets):
    assert det.port_scan(make_logs(*scan_rows(targets))).isEmpty()


def test_port_scan_reads_tcp_only(make_logs):
    rows = [{**r, "protocol": p} for r in scan_rows(25) for p in ("HTTP", "SSH")]
    assert det.port_scan(make_logs(*rows)).isEmpty()


def test_port_scan_windows_do_not_mix(make_logs):
    rows = [{**r, "timestamp": seconds(290 + i)} for i, r in enumerate(scan_rows(20))]
    assert det.port_scan(make_logs(*rows)).isEmpty()


def test_port_scan_ignores_missing_targets(make_logs):
    rows = scan_rows(20) + [{"dest_ip": None, "timestamp": seconds(30)}]
    assert det.port_scan(make_logs(*rows)).isEmpty()
    assert det.port_scan_from_targets(det.port_scan_per_target(make_logs(*rows))).isEmpty()


def test_port_scan_in_two_stages_is_the_same(make_logs):
    rows = scan_rows(60) + scan_rows(30) + [{"dest_ip": None, "log_type": "ids"}]
    logs = make_logs(*rows)
    columns = sorted(det.port_scan(logs).columns)
    staged = det.port_scan_from_targets(det.port_scan_per_target(logs)).select(columns).collect()
    assert staged == det.port_scan(logs).select(columns).collect()


@pytest.mark.parametrize(
    "attempts, score, severity",
    [(6, 72, "HIGH"), (8, 76, "HIGH"), (10, 80, "HIGH"), (11, 82, "CRITICAL"), (40, 100, "CRITICAL")],
)
def test_brute_force_scores(make_logs, attempts, score, severity):
    logs = make_logs({"action": "blocked"}, repeat=attempts)
    row = det.brute_force(logs).collect()[0]
    assert (row.event_count, row.threat_score, row.severity) == (attempts, score, severity)
    assert (row.alert_type, row.bytes_total) == ("BRUTE_FORCE", 1024 * attempts)


@pytest.mark.parametrize("attempts", [4, 5])
def test_brute_force_threshold_is_strict(make_logs, attempts):
    assert det.brute_force(make_logs({"action": "blocked"}, repeat=attempts)).isEmpty()


def test_brute_force_counts_blocked_only(make_logs):
    rows = [{"action": "blocked"}] * 3 + [{"action": "allowed"}] * 5
    assert det.brute_force(make_logs(*rows)).isEmpty()


def test_first_values_follow_event_time(make_logs):
    rows = [
        {"action": "blocked", "timestamp": seconds(9 - i), "user_agent": f"agent-{9 - i}"}
        for i in range(9)
    ] + [{"action": "blocked", "timestamp": START, "user_agent": None, "log_type": "ids"}]
    row = det.brute_force(make_logs(*rows)).collect()[0]
    assert (row.user_agent, row.log_type) == (None, "ids")
    assert row.last_event == seconds(9)


MIB = 1024 * 1024


@pytest.mark.parametrize(
    "size, expected",
    [(10 * MIB, None), (10 * MIB + 1, (85, "HIGH")), (15 * MIB, (85, "HIGH")),
     (100 * MIB, (90, "HIGH")), (100 * MIB + 1, (90, "CRITICAL")), (20_000 * MIB, (100, "CRITICAL"))],
)
def test_volume_steps(make_logs, size, expected):
    rows = det.volume_anomaly(make_logs({"bytes_transferred": size})).collect()
    assert [(r.threat_score, r.severity) for r in rows] == ([expected] if expected else [])


def test_volume_sums_within_ten_seconds(make_logs):
    half = {"bytes_transferred": 6 * MIB}
    near = make_logs(half, {**half, "timestamp": seconds(9)}, {"bytes_transferred": None})
    assert det.volume_anomaly(near).collect()[0].event_count == 3
    assert det.volume_anomaly(make_logs(half, {**half, "timestamp": seconds(10)})).isEmpty()


@pytest.mark.parametrize(
    "agent, path, history, live",
    [
        ("sqlmap/1.7", "/admin", ("TOOL_DETECTED", 95), ("KNOWN_ATTACK_TOOL", 95)),
        ("Nikto/2.1.6", "/", ("TOOL_DETECTED", 95), ("KNOWN_ATTACK_TOOL", 95)),
        ("nmap scripting engine", "/", ("TOOL_DETECTED", 95), ("KNOWN_ATTACK_TOOL", 95)),
        ("Mozilla", "/p?id=1 UNION SELECT username,password FROM users--", ("SQLI", 85), ("SQLI_DETECTED", 85)),
        ("Mozilla", "/p?id=1' or '1'='1", ("SQLI", 85), ("SQLI_DETECTED", 85)),
        ("Mozilla", "/search?q=<script>alert(document.cookie)</script>", ("XSS", 75), ("XSS_DETECTED", 75)),
        ("Mozilla", "/download?f=../../etc/passwd", ("LFI", 70), ("LFI_DETECTED", 70)),
        ("Mozilla", "/x?p=%2E%2E%2Fsecret", ("LFI", 70), ("LFI_DETECTED", 70)),
        ("Mozilla", "/q?s=DELETE FROM logs", ("SQLI", 85), None),
        ("Mozilla", "/img?onload=x", ("XSS", 75), None),
        ("Mozilla", "/f?p=/proc/self/environ", ("LFI", 70), None),
        ("sqlmap", None, ("TOOL_DETECTED", 95), ("KNOWN_ATTACK_TOOL", 95)),
        (None, "/a?x=drop  table t", ("SQLI", 85), ("SQLI_DETECTED", 85)),
        (None, None, None, None),
        ("Mozilla/5.0", "/index.html", None, None),
        ("curl/8.0", "/api/v1/users?page=2", None, None),
    ],
)
def test_signatures(make_logs, agent, path, history, live):
    logs = make_logs({"user_agent": agent, "request_path": path})
    found = [(r.attack_category, r.threat_score) for r in det.attack_patterns(logs).collect()]
    assert found == ([history] if history else [])
    alerts = [(r.alert_type, r.threat_score) for r in det.signature_alerts(logs).collect()]
    assert alerts == ([live] if live else [])


def test_unknown_fields_leave_unknown_flags(make_logs):
    row = det.attack_patterns(make_logs({"user_agent": "sqlmap", "request_path": None})).collect()[0]
    assert (row.is_tool, row.is_sqli, row.is_xss, row.is_lfi) == (True, None, None, None)


FRAGMENTS = [
    "sqlmap", "NMAP", "w3af", "Hydra", "nikto", "' OR", "union  select", "1=1--", "drop\ttable",
    "xp_cmdshell", "exec(", "insert into", "DELETE FROM", "<script", "javascript:", "onerror=",
    "alert(", "document.cookie", "eval(", "onload=", "../../", "/etc/passwd", "/etc/shadow",
    "/proc/self", "%2e%2e%2f", "s", "n", "'", "/", ".", "%2", " ", "x",
]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(FRAGMENTS) | st.text(max_size=4), max_size=6).map("".join))
def test_openings_do_not_change_matches(text):
    for signature in sig.HISTORY.signatures + sig.LIVE.signatures:
        plain = re.search(signature.pattern, text, re.ASCII) is not None
        quick = re.search(sig.guarded(signature.pattern, signature.opening), text, re.ASCII)
        assert plain == (quick is not None)


def test_every_alternative_passes_its_opening(spark):
    texts = ["sqlmap", "nikto", "nmap", "masscan", "burpsuite", "dirbuster", "hydra", "metasploit",
             "w3af", "acunetix", "openvas", "' or", "union select", "1=1--", "drop table",
             "xp_cmdshell", "exec(", "insert into", "delete from", "<script", "javascript:",
             "onerror=", "alert(", "document.cookie", "eval(", "onload=", "../../", "/etc/passwd",
             "/etc/shadow", "/proc/self", "%2e%2e%2f"]
    df = spark.createDataFrame([(v,) for t in texts for v in (t, t.upper())], "t string")
    df = df.select(F.col("t").alias("user_agent"), F.col("t").alias("request_path"))
    assert df.filter(sig.HISTORY.any_match()).count() == len(texts) * 2

"""What must hold of the plans, so that they still work on a cluster."""

import re

import pytest

import __spark_entry__ as contract
from threatlens.functions.times import latest_event
from threatlens.operators import alerts as al
from threatlens.operators import detectors as det
from threatlens.operators import reputation as rep
from threatlens.operators import volume as vol
from threatlens.plans import serving
from threatlens.schema import ALERT

SF_DIR = "/root/testdata/sf0.001"
LAZY = [
    "port_scan", "brute_force_alerts", "volume_anomaly_alerts", "signature_alerts", "top_malicious_ips",
    "attack_pattern_table", "volume_analysis", "threat_timeline", "active_threats", "alert_summary_by_ip",
    "threat_profile", "profile_lookup",
]


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture
def lake(spark, make_logs, tmp_path):
    make_logs({}).write.parquet(str(tmp_path / "logs"))
    return spark.read.parquet(str(tmp_path / "logs"))


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_no_python(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert operator not in text


@pytest.mark.parametrize(
    "build, filters, columns",
    [
        (det.port_scan, "EqualTo(protocol,TCP)", {"timestamp", "source_ip", "dest_ip", "protocol", "log_type"}),
        (det.brute_force, "EqualTo(action,blocked)",
         {"timestamp", "source_ip", "action", "log_type", "bytes_transferred", "user_agent"}),
        (rep.suspicious_by_ip_logtype, "In(threat_label, [malicious,suspicious])",
         {"source_ip", "dest_ip", "threat_label", "log_type", "bytes_transferred"}),
        (vol.threat_timeline, "In(threat_label, [benign,malicious,suspicious])", {"timestamp", "threat_label"}),
    ],
)
def test_filters_and_columns_reach_the_scan(lake, build, filters, columns):
    text = plan(build(lake))
    assert filters in text
    assert set(re.findall(r"(\w+):\w+", re.search(r"ReadSchema: struct<(.*?)>", text)[1])) == columns


def test_reputation_scans_once(lake):
    assert plan(rep.reputation(lake)).count("Scan parquet") == plan(rep.reputation_join(lake)).count("Scan parquet") // 3


def test_distinct_targets_are_spread_by_target(lake):
    assert re.search(r"hashpartitioning\(\w+#\d+, source_ip#\d+, dest_ip#\d+", plan(det.port_scan(lake)))


def test_recent_alerts_are_limited_before_the_shuffle(lake):
    text = plan(al.recent_alerts_by_ip(al.active_alerts(lake, latest_event(lake))))
    assert text.count("WindowGroupLimit") >= 2
    assert "Partial" in text


def test_top_reports_do_not_sort_everything(lake):
    assert "TakeOrderedAndProject" in plan(rep.top_malicious_ips(lake))
    assert "TakeOrderedAndProject" in plan(al.active_alerts_top(al.active_alerts(lake, latest_event(lake))))


def test_one_address_reaches_every_stored_side(spark, tmp_path):
    sides = []
    for name, schema in (
        ("reputation", "source_ip string, score bigint, total_events bigint, last_seen timestamp_ntz"),
        ("patterns", "attack_type string, source_ip string"),
        ("alerts", ALERT),
    ):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
        sides.append(spark.read.schema(schema).parquet(str(tmp_path / name)))
    pushed = re.findall(r"PushedFilters: \[(.*?)\]\n", plan(serving.threat_profile_flat(*sides, keys="203.0.113.1")))
    assert sum("EqualTo(source_ip,203.0.113.1)" in p for p in pushed) == 2
    assert sum("EqualTo(ip_source,203.0.113.1)" in p for p in pushed) == 1
    asked = spark.createDataFrame([("203.0.113.1",)], "ip string")
    assert plan(serving.profile_lookup(asked, *sides)).count("LeftSemi") >= 3

import datetime as dt
from random import Random

import pytest
from pyspark.sql import functions as F

from threatlens.operators import reputation as rep
from threatlens.operators import volume as vol

TEN_ROWS = (
    [{"source_ip": "192.168.1.100", "threat_label": "malicious", "dest_ip": f"10.0.0.{i}"} for i in range(5)]
    + [{"source_ip": "192.168.1.200", "threat_label": "suspicious"}] * 3
    + [{"source_ip": "192.168.1.50", "threat_label": "benign"}] * 2
)


def test_bad_labels_only(make_logs):
    rows = rep.suspicious_events(make_logs(*TEN_ROWS)).collect()
    assert len(rows) == 8
    assert "192.168.1.50" not in {r.source_ip for r in rows}


def test_sources_with_one_bad_label_are_left_out(make_logs):
    assert rep.reputation(make_logs(*TEN_ROWS)).isEmpty()


def test_reputation_counts_and_score(make_logs):
    rows = [{"threat_label": "malicious", "dest_ip": "a"}, {"threat_label": "malicious", "dest_ip": "a"},
            {"threat_label": "suspicious", "dest_ip": "b", "bytes_transferred": None},
            {"threat_label": "suspicious", "dest_ip": "c", "log_type": "ids"}, {"threat_label": "benign"}]
    got = {r.log_type: r for r in rep.reputation(make_logs(*rows)).collect()}
    firewall = got["firewall"]
    assert (firewall.total_events, firewall.unique_targets, firewall.total_bytes) == (3, 2, 2048)
    assert (firewall.malicious_count, firewall.suspicious_count) == (2, 2)
    assert got["ids"].malicious_count == 2
    assert {r.reputation_score for r in got.values()} == {100}


def test_joins_give_the_same_reputation(make_logs):
    rows = [
        {"source_ip": f"ip{i % 7}", "dest_ip": f"d{i % 11}", "log_type": ["firewall", "ids"][i % 2],
         "threat_label": ["malicious", "suspicious", "benign"][(i * i) % 3]}
        for i in range(200)
    ]
    logs = make_logs(*rows)
    columns = rep.reputation_join(logs).columns
    assert sorted(rep.reputation(logs).select(columns).collect()) == sorted(
        rep.reputation_join(logs).collect()
    )


def test_top_report_breaks_ties_by_key(make_logs):
    rows = [{"source_ip": f"ip{i:02d}", "threat_label": label} for i in range(15)
            for label in ("malicious", "suspicious")]
    top = rep.top_malicious_ips(make_logs(*rows)).collect()
    assert [r.source_ip for r in top] == [f"ip{i:02d}" for i in range(10)]


@pytest.mark.parametrize("profile", [vol.volume_profile, vol.volume_profile_sketch])
def test_volume_profile(make_logs, profile):
    rows = [{"bytes_transferred": b} for b in list(range(1, 101)) + [None]]
    row = profile(make_logs(*rows)).collect()[0]
    assert (row.event_count, row.total_bytes, row.max_bytes, row.p95_bytes) == (101, 5050, 100, 95)
    assert row.avg_bytes == 50.5


@pytest.mark.parametrize("slices", [4_096, 5])
def test_percentile_is_exact(make_logs, monkeypatch, slices):
    monkeypatch.setattr(vol, "SLICES", slices)
    ordered, holder = [], vol._holder

    def watched(counts, part, rank):
        if part != "bucket":
            ordered.append(counts.groupBy(*vol.GROUP).count().agg(F.max("count")).first()[0])
        return holder(counts, part, rank)

    monkeypatch.setattr(vol, "_holder", watched)
    random = Random(7)
    values = {
        "malicious": [random.randrange(10**12) for _ in range(301)],
        "suspicious": [5_000_000 + random.randrange(900) for _ in range(400)],
        "benign": [random.choice([0, 0, 0, 1, 2]) for _ in range(57)],
        "negative": [-random.randrange(10**6) for _ in range(40)],
        "single": [42],
        "unsized": [None, None],
        None: [3, 1, 2],
    }
    rows = [{"threat_label": k, "bytes_transferred": v} for k, vs in values.items() for v in vs]
    got = {r.threat_label: r for r in vol.volume_profile(make_logs(*rows)).collect()}
    assert set(got) == set(values)
    for label, group in values.items():
        known = sorted(v for v in group if v is not None)
        expected = known[-(-len(known) * 95 // 100) - 1] if known else None
        assert (got[label].p95_bytes, got[label].event_count) == (expected, len(group))
        assert got[label].avg_bytes == (sum(known) / len(known) if known else None)
    assert len(ordered) > 1 and max(ordered) <= slices  # values or slices of a group in one window


def hours(*spec):
    return [
        {"timestamp": dt.datetime(2023, 10, day, hour), "threat_label": label}
        for day, hour, label in spec
    ]


TIMELINE = hours(
    (14, 3, "malicious"), (14, 3, "malicious"), (15, 0, "suspicious"), (15, 10, "benign"),
    (15, 9, "benign"), (13, 23, "malicious"), (15, 11, "other"),
)


def test_timeline(make_logs):
    logs = make_logs(*TIMELINE)
    expected = [
        ("20231013", 23, 1, 0, 0), ("20231014", 3, 2, 0, 0), ("20231015", 0, 0, 1, 0),
        ("20231015", 9, 0, 0, 1), ("20231015", 10, 0, 0, 1),
    ]
    columns = ["event_date", "event_hour", "malicious_count", "suspicious_count", "benign_count"]
    assert [tuple(r) for r in vol.threat_timeline(logs).select(columns).collect()] == expected
    assert [tuple(r) for r in vol.timeline_full_join(logs).select(columns).collect()] == expected


def test_timeline_range(make_logs):
    timeline = vol.threat_timeline(make_logs(*TIMELINE))
    as_of = dt.datetime(2023, 10, 15, 12)

    def dates(*bounds):
        return [(r.event_date, r.event_hour) for r in vol.timeline_range(timeline, as_of, *bounds).collect()]

    assert dates() == [("20231014", 3), ("20231015", 0), ("20231015", 9), ("20231015", 10)]
    assert dates("20231013", "20231013") == [("20231013", 23)]
    assert dates(" ", "20231014") == [("20231014", 3)]

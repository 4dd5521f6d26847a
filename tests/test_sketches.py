"""Stored daily sketches against exact results, and that a new day leaves the others alone."""

import datetime as dt

import pytest

from threatlens.operators import reputation as rep
from threatlens.operators import sketches as sk
from threatlens.operators import volume as vol

DAY = dt.date(2023, 10, 15)


@pytest.fixture
def logs(spark):
    """Sizes that repeat, spread and miss, over three days; one group without any size."""
    return spark.range(60_000).selectExpr(
        "TIMESTAMP_NTZ'2023-10-15 00:00:00' + INTERVAL '1' SECOND * (id * 4) AS timestamp",
        "concat('s', id % 3) AS source_ip", "concat('d', pmod(hash(id), 900 * (1 + id % 3))) AS dest_ip",
        "'TCP' AS protocol", "elt(CAST(id % 4 AS INT) + 1, 'malicious', 'suspicious', 'benign', NULL) AS threat_label",
        "elt(CAST(id % 2 AS INT) + 1, 'ids', 'firewall') AS log_type",
        "CASE WHEN id % 4 = 3 THEN NULL WHEN id % 5 = 0 THEN 1000 ELSE pmod(hash(id, 1), 1000000) END AS bytes_transferred",
    )


def test_percentiles_of_any_days_are_within_the_rank_error(spark, logs, tmp_path):
    sk.store_days(sk.volume_by_day(logs), str(tmp_path))
    for first, last in ((None, None), (DAY, DAY), (DAY + dt.timedelta(1), DAY + dt.timedelta(2))):
        rows = logs
        if first:
            rows = rows.filter(f"CAST(timestamp AS DATE) BETWEEN '{first}' AND '{last}'")
        days = sk.read_days(spark, str(tmp_path), sk.VOLUME_DAYS, first, last)
        found = {tuple(r[:3]): r for r in sk.volume_of_days(days).collect()}
        exact = {tuple(r[:3]): r for r in vol.volume_profile_sketch(rows).collect()}
        assert found.keys() == exact.keys()
        for group, r in found.items():
            e = exact[group]
            assert (r.avg_bytes, r.max_bytes, r.event_count, r.total_bytes) == (e.avg_bytes, e.max_bytes, e.event_count, e.total_bytes)
            label, kind, _ = group
            sizes = sorted(
                x.bytes_transferred for x in rows.filter(
                    f"threat_label <=> {repr(label) if label else 'NULL'} AND log_type = '{kind}' AND bytes_transferred IS NOT NULL"
                ).collect()
            )
            if not sizes:
                assert r.p95_bytes is None
                continue
            low = sum(s < r.p95_bytes for s in sizes) / len(sizes)
            high = sum(s <= r.p95_bytes for s in sizes) / len(sizes)
            assert low - sk.RANK_ERROR <= vol.PERCENTILE <= high + sk.RANK_ERROR


def test_distinct_targets_of_days_are_within_the_error(spark, logs, tmp_path):
    sk.store_days(sk.targets_by_day(logs), str(tmp_path))
    found = {tuple(r[:2]): r for r in sk.targets_of_days(sk.read_days(spark, str(tmp_path), sk.TARGET_DAYS)).collect()}
    exact = {tuple(r[:2]): r for r in rep.suspicious_by_ip_logtype(logs).collect()}
    assert found.keys() == exact.keys()
    for group, r in found.items():
        e = exact[group]
        assert (r.total_events, r.total_bytes) == (e.total_events, e.total_bytes)
        assert abs(r.unique_targets / e.unique_targets - 1) <= sk.DISTINCT_ERROR


def test_a_new_day_costs_that_day_only(spark, logs, tmp_path):
    day = lambda n: logs.filter(f"CAST(timestamp AS DATE) = DATE'{DAY}' + {n}")
    files = lambda: {p.relative_to(tmp_path): p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    for n in (0, 1):
        sk.store_days(sk.volume_by_day(day(n)), str(tmp_path))
    before = files()
    sk.store_days(sk.volume_by_day(day(2)), str(tmp_path))
    assert before.items() <= files().items() and len(files()) == len(before) + 1
    sk.store_days(sk.volume_by_day(day(1)), str(tmp_path))
    assert len(files()) == 3
    whole = sk.volume_of_days(sk.read_days(spark, str(tmp_path), sk.VOLUME_DAYS)).drop("p95_bytes")
    assert sorted(map(str, whole.collect())) == sorted(map(str, vol.volume_profile_sketch(logs).drop("p95_bytes").collect()))
    one = sk.read_days(spark, str(tmp_path), sk.VOLUME_DAYS, DAY, DAY)
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()


def test_no_logs_give_no_rows(spark, logs, tmp_path):
    sk.store_days(sk.volume_by_day(logs.limit(0)), str(tmp_path))
    assert sk.volume_of_days(sk.volume_by_day(logs.limit(0))).collect() == []
    assert sk.targets_of_days(sk.targets_by_day(logs.limit(0))).collect() == []

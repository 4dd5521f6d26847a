"""Keyed tables in parts, and lookups of one address."""

import os
from datetime import timedelta

import pytest

from threatlens.operators import alerts as al
from threatlens.plans import catalog, serving
from threatlens.sinks import keyed_tables as kt
from threatlens.streaming import live_state as ls

SCHEMA = "source_ip string, score bigint"


def files_of(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def table(spark, path, rows, **options):
    kt.upsert(spark.createDataFrame(rows, SCHEMA), str(path), ["source_ip"], **options)


def test_files_of_untouched_parts_stay(spark, tmp_path):
    table(spark, tmp_path, [(f"ip{i}", i) for i in range(400)], parts=8)
    before = files_of(tmp_path)
    table(spark, tmp_path, [("ip7", -1)])
    after = files_of(tmp_path)
    assert before.items() <= after.items() and len(after) == len(before) + 1
    assert kt._snapshot(spark, str(tmp_path))["folders"].keys() == {str(p) for p in range(8)}
    assert len(set(kt._snapshot(spark, str(tmp_path))["folders"].values())) == 2
    stored = {r.source_ip: r.score for r in kt.read_table(spark, str(tmp_path)).collect()}
    assert stored == {f"ip{i}": i if i != 7 else -1 for i in range(400)}
    assert kt.read_table(spark, str(tmp_path)).columns == ["source_ip", "score"]


def test_an_empty_load_makes_an_empty_table(spark, tmp_path):
    table(spark, tmp_path, [])
    assert kt.read_table(spark, str(tmp_path)).collect() == []
    table(spark, tmp_path, [(None, 1)])
    assert kt.read_key(spark, str(tmp_path), source_ip="x").collect() == []
    with pytest.raises(ValueError):
        kt.read_key(spark, str(tmp_path), score=1)


def plan_of(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("rows", [300, 30_000])
def test_one_key_is_one_file_without_a_shuffle_at_any_size(spark, tmp_path, rows):
    table(spark, tmp_path, [(f"ip{i}", i) for i in range(rows)], parts=4)
    found = kt.read_key(spark, str(tmp_path), source_ip="ip123")
    assert [tuple(r) for r in found.collect()] == [("ip123", 123)]
    assert len(found.inputFiles()) == 1
    assert "Exchange" not in plan_of(found.groupBy("source_ip").count())


def test_superseded_snapshots_go_after_their_time(spark, tmp_path):
    for n in range(4):
        table(spark, tmp_path, [(f"ip{i}", n) for i in range(20 if n == 0 else 1)], parts=4)
    kept = files_of(tmp_path)
    old = tmp_path / "data-of-a-lost-writer"
    old.mkdir()
    kt.drop_superseded(spark, str(tmp_path))
    assert files_of(tmp_path) == kept and old.exists()
    for path in [*tmp_path.rglob("*"), tmp_path]:
        os.utime(path, (1_600_000_000,) * 2)
    kt.drop_superseded(spark, str(tmp_path), timedelta(hours=1))
    assert not old.exists() and len(list((tmp_path / "_snapshots").glob("[0-9]*"))) == 1
    assert 0 < len(files_of(tmp_path)) < len(kept)
    stored = {r.source_ip: r.score for r in kt.read_table(spark, str(tmp_path)).collect()}
    assert stored == {f"ip{i}": 3 if i == 0 else 0 for i in range(20)}


def test_profile_of_one_address_equals_the_joined_profiles(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    from threatlens.sources import fixtures

    logs = fixtures.security_logs(spark, sf_dir)
    reputation, patterns, alerts = catalog.stored_sides(spark, sf_dir)
    paths = [str(tmp_path / n) for n in ("reputation", "patterns", "live")]
    kt.upsert(reputation, paths[0], kt.REPUTATION_KEYS)
    kt.upsert(patterns, paths[1], kt.ATTACK_PATTERN_KEYS, kt.PATTERN_CLUSTER)
    kt.upsert(al.alert_summary_by_ip(alerts), paths[2], ["ip_source"])
    profiles = {r.ip: r for r in serving.threat_profile_flat(reputation, patterns, alerts).collect()}
    for ip in [*sorted(profiles)[:2], max(profiles, key=lambda p: profiles[p].active_alerts)]:
        found = serving.profile_of(spark, f" {ip}\t", *paths)
        assert found.collect() == [profiles[ip]]
        assert "Exchange" not in plan_of(found)
    unknown = serving.profile_of(spark, "9.9.9.9", *paths).first()
    assert (unknown.ip, unknown.active_alerts, unknown.recommendation) == ("9.9.9.9", 0, "ALLOW")
    for odd in (None, "", "  ", "x" * 46):
        assert serving.profile_of(spark, odd, *paths).collect() == []
    assert logs.columns[0] == "log_id"


def test_expired_sources_leave_the_stored_live_state(spark, tmp_path):
    rows = [("a", 2, 90, 10, ["X"], 5, 100), ("b", 1, 50, 5, ["Y"], 6, 100)]
    spark.createDataFrame(rows, ls.SUMMARY).write.parquet(f"{tmp_path}/live/run=r/batch=0")
    ls.store_live_state(spark, f"{tmp_path}/live", f"{tmp_path}/table")
    spark.createDataFrame([("a", 0, 0, 0, [], None, 200)], ls.SUMMARY).write.parquet(f"{tmp_path}/live/run=r/batch=1")
    ls.store_live_state(spark, f"{tmp_path}/live", f"{tmp_path}/table")
    stored = {r.ip_source: r.active_alerts for r in kt.read_table(spark, f"{tmp_path}/table").collect()}
    assert stored == {"a": 0, "b": 1}
    assert [r.ip_source for r in ls.read_live_state(spark, f"{tmp_path}/live").collect()] == ["b"]

"""The live state per source against the batch summary after every micro-batch."""

import datetime as dt
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from threatlens.operators import alerts as al
from threatlens.schema import ALERT
from threatlens.sinks.alert_log import EMISSION
from threatlens.streaming import live_state as ls

START = dt.datetime(2023, 10, 15)


def alert(source, n, at, kind="BRUTE_FORCE", length=0, events=6, score=50):
    begun = START + dt.timedelta(seconds=at)
    return (
        source, begun, f"{source}-{kind}-{n}", begun + dt.timedelta(seconds=length), score, [kind], kind, "HIGH",
        events, events * 10, ["agent"], ["ids"],
    )


@pytest.fixture
def live(spark, tmp_path):
    """Stores emissions as the alert log does, follows them, and gives the summaries."""
    stored = []

    def follow(rows, query="brute_force"):
        n = len(stored)
        folder = tmp_path / f"alerts/query={query}/run=r/batch={n}"
        spark.createDataFrame(rows, ALERT).repartition(3).write.parquet(str(folder))
        stored.extend((*r, query, n) for r in rows)
        stream = ls.start_live_state(
            spark, str(tmp_path / "alerts"), str(tmp_path / "live"), str(tmp_path / "checkpoint"), {"availableNow": True}
        )
        stream.awaitTermination()
        return stream, ls.read_live_state(spark, str(tmp_path / "live"))

    def expected():
        """The batch summary over the furthest emission of each alert, now the newest of them."""
        furthest = {}
        for r in stored:
            old = furthest.get(r[2])
            if old is None or (r[3], r[8], r[9]) >= (old[3], old[8], old[9]):
                furthest[r[2]] = r
        rows = spark.createDataFrame([r[:12] for r in furthest.values()], ALERT)
        now = max(r[3] for r in stored)
        return al.alert_summary_by_ip(al.active_threats([rows], now))

    return follow, expected


def same(found, expected):
    columns = ls.SUMMARY_COLUMNS
    assert sorted(map(str, found.select(columns).collect())) == sorted(map(str, expected.select(columns).collect()))


def test_summaries_equal_the_batch_after_every_step(live):
    follow, expected = live
    rng, day = random.Random(5), 24 * 3600
    kinds = [("BRUTE_FORCE", 59), ("VOLUME_ANOMALY", 9), ("PORT_SCAN", 299), ("KNOWN_ATTACK_TOOL", 0)]
    for step in range(4):
        rows = []
        for n in range(120):
            kind, most = rng.choice(kinds)
            at = step * day // 2 + rng.randrange(0, 1200 if n % 3 else day // 2)
            rows.append(alert(f"s{rng.randrange(4)}", f"{step}-{n}", at, kind, rng.randint(0, most), rng.randrange(1, 99), rng.randrange(100)))
        _, found = follow(rows)
        same(found, expected())


def test_a_grown_window_replaces_its_alert_and_exact_rows_replace_estimates(live):
    follow, expected = live
    follow([alert("a", 1, 0, "PORT_SCAN", 100, 30, 70)], "port_scan_early")
    follow([alert("a", 1, 0, "PORT_SCAN", 200, 44, 90), alert("b", 2, 5)], "port_scan_early")
    _, found = follow([alert("a", 1, 0, "PORT_SCAN", 200, 44, 80)], "port_scan")
    rows = {r.ip_source: r for r in found.collect()}
    assert (rows["a"].active_alerts, rows["a"].current_threat_score, rows["a"].recent_alert_bytes) == (1, 80, 440)
    same(found, expected())


def test_state_shrinks_when_alerts_expire(live):
    follow, expected = live
    first, _ = follow([alert(f"s{i}", i, i) for i in range(30)])
    stream, found = follow([alert("late", 1, 24 * 3600 + 100)])
    assert [r.ip_source for r in found.collect()] == ["late"]
    same(found, expected())
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in first.recentProgress) == 30
    assert stream.lastProgress["stateOperators"][0]["numRowsTotal"] < 10
    _, found = follow([alert("s1", "old", 50)])  # expired already: dropped
    assert [r.ip_source for r in found.collect()] == ["late"]


def test_a_busy_source_keeps_a_bounded_list():
    rows = [(f"r{i}", i, i, 1, 1, True, 50, ["A"]) for i in range(5_000)]
    windows = [(f"w{i}", 4_700 + 10 * i, 4_709 + 10 * i, 1, 1, True, 50, ["B"]) for i in range(30)]
    kept = ls.needed(rows + windows)
    assert len(kept) < 60
    # At any later moment the ten newest live alerts are among those kept.
    for now in range(0, 5_100, 7):
        live = sorted((a for a in rows + windows if a[2] > now), key=lambda a: (-a[1], a[0]))[:10]
        assert live == [a for a in kept if a[2] > now][:10]


def test_nothing_stored_reads_as_nothing(spark, tmp_path):
    assert ls.read_live_state(spark, str(tmp_path / "nowhere")).collect() == []
    assert spark.createDataFrame([], EMISSION).select(F.count("*")).first()[0] == 0


def test_a_source_costs_few_calls_of_the_state():
    """What a batch leaves as it is causes no write, and timers are known without listing them."""
    calls, stored = [], []

    class State:
        def get(self):
            calls.append("get")
            return iter(stored)

        def put(self, alerts):
            calls.append("put")
            stored[:] = alerts

        def clear(self):
            calls.append("clear")
            stored.clear()

        def getListState(self, name, schema):
            return self

        def registerTimer(self, at):
            calls.append(("register", at))

        def deleteTimer(self, at):
            calls.append(("delete", at))

        def getCurrentWatermarkInMs(self):
            return now

    state, source, day = State(), ls.RecentAlerts(), 24 * 3600 * 1000
    source.init(state)
    rows = [Row(ip_source="a", **dict(zip(ls.FIELDS, (f"r{i}", i * 1500, i * 1500, 1, 1, True, 50, ["A"])))) for i in range(3)]
    now = 0
    for batch, expected in ((rows[:2], ["get", ("register", day), "put"]), (rows[:1], ["get"]), (rows[2:], ["get", "put"])):
        calls.clear()
        (made,) = source.handleInputRows(("a",), iter(batch), state)
        assert calls == expected and made.active_alerts == min(len(stored), 3)
    now = day + 2  # the second alert expires at day + 1.5 ms, so its timer is at day + 2
    calls.clear()
    (made,) = source.handleExpiredTimer(("a",), state, None)
    assert calls == ["get", ("delete", day), ("register", day + 3), "put"] and made.active_alerts == 1
    now = day + 3
    (made,) = source.handleExpiredTimer(("a",), state, None)
    assert calls[-1] == "clear" and (made.active_alerts, made.last) == (0, None)

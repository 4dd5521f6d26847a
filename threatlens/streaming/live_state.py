"""The live state of every source: its newest alerts, kept in the state store of a stream.

The alert log is the input. Each source holds the alerts that its summary can ever need, and
a timer for the next one to expire; so a dashboard reads one small row per source, and the
state shrinks by itself when a source falls quiet.
"""

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from threatlens.functions.times import EPOCH, utc_instant
from threatlens.operators.alerts import LIFETIME, RECENT_ALERTS
from threatlens.session import delete_folder, path_exists, setting
from threatlens.sinks.alert_log import EARLY_PORT_SCAN, EMISSION
from threatlens.sinks.keyed_tables import last_per_key, upsert

LIFETIME_US = 24 * 3600 * 1_000_000
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# What is kept of an alert. Stamps are microseconds since the epoch.
KEPT = (
    "alert_id string, bucket long, last long, events long, bytes long, exact boolean, score int, types array<string>"
)
FIELDS = [field.split()[0] for field in KEPT.split(", ")]
SUMMARY = (
    "ip_source string, active_alerts int, current_threat_score int, recent_alert_bytes long,"
    " recent_attack_types array<string>, last long, as_of long"
)
SUMMARY_COLUMNS = [
    "ip_source", "active_alerts", "current_threat_score", "recent_alert_bytes", "recent_attack_types", "last_seen",
]


def needed(alerts: list[tuple], size: int = RECENT_ALERTS) -> list[tuple]:
    """The alerts, newest first, that can be among the `size` newest live ones now or later.

    An emission of an alert counts if none is further. An alert is out once `size` others
    begin no earlier and are seen no earlier: it leaves the list before they do. Alerts on
    single rows end where they begin, so at most `size` of them stay, and a window outlasts
    younger alerts by its own length at most; few can.
    """
    furthest = {}
    for a in alerts:
        known = furthest.get(a[0])
        if known is None or a[2:6] > known[2:6]:
            furthest[a[0]] = a
    kept, seen = [], []
    for a in sorted(furthest.values(), key=lambda a: (-a[1], a[0])):
        if len(seen) - bisect_left(seen, a[2]) < size:
            kept.append(a)
            insort(seen, a[2])
    return kept


def summary(source: str, alerts: list[tuple], as_of: int, size: int = RECENT_ALERTS) -> Row:
    """One row over the newest `size` alerts; without any, a row that says so."""
    recent = alerts[:size]
    return Row(
        ip_source=source,
        active_alerts=len(recent),
        current_threat_score=max((a[6] for a in recent), default=0),
        recent_alert_bytes=sum(a[4] for a in recent),
        recent_attack_types=list(dict.fromkeys(t for a in recent for t in a[7])),
        last=recent[0][2] if recent else None,
        as_of=as_of,
    )


def _expiry(alerts: list[tuple]) -> int | None:
    """The millisecond in which the first of the alerts has expired."""
    return -(-(min(a[2] for a in alerts) + LIFETIME_US) // 1000) if alerts else None


def _tuples(frame: pd.DataFrame) -> list[tuple]:
    return [
        (str(i), int(b), int(last), int(e), int(n), bool(x), int(s), [str(t) for t in types])
        for i, b, last, e, n, x, s, types in zip(*(frame[f] for f in FIELDS))
    ]


class RecentAlerts(StatefulProcessor):
    """Per source a list state of needed alerts and one timer, set to the next expiry."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.alerts = handle.getListState("alerts", KEPT)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self._held()
        alerts = needed(held + [tuple(row[f] for f in FIELDS) for row in rows])
        yield self._keep(key[0], held, alerts, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self._held()
        yield self._keep(key[0], held, held, timerValues.getCurrentWatermarkInMs())

    def _held(self) -> list[tuple]:
        return [(*a[:7], list(a[7])) for a in self.alerts.get()]

    def _keep(self, source: str, held: list[tuple], alerts: list[tuple], now_ms: int) -> Row:
        """Every call of the state is a round trip, so only what changes is written."""
        now = now_ms * 1000
        live = [a for a in alerts if a[2] + LIFETIME_US > now]
        before, after = _expiry(held), _expiry(live)
        if before != after:
            if before is not None:
                self.handle.deleteTimer(before)
            if after is not None:
                self.handle.registerTimer(after)
        if live != held:
            if live:
                self.alerts.put(live)
            else:
                self.alerts.clear()
        return summary(source, live, now)

    def close(self) -> None:
        pass


def combined(emissions: DataFrame) -> DataFrame:
    """Emissions as (ip_source, expires_at, ...), cut to what each source needs before the shuffle."""
    stamps = [F.unix_micros(utc_instant(emissions, c)) for c in ("bucket_time", "last_seen")]
    plain = emissions.select(
        "ip_source", "alert_id", stamps[0].alias("bucket"), stamps[1].alias("last"), F.col("event_count").alias("events"),
        F.col("bytes_total").alias("bytes"), (F.col("query") != EARLY_PORT_SCAN).alias("exact"), F.col("threat_score").alias("score"),
        F.concat("attack_types", F.array("alert_type")).alias("types"),
    )

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sources: dict[str, list[tuple]] = {}
            for source, alert in zip(frame["ip_source"], _tuples(frame), strict=True):
                sources.setdefault(source, []).append(alert)
            kept = [(source, *alert) for source, alerts in sources.items() for alert in needed(alerts)]
            yield pd.DataFrame(kept, columns=["ip_source", *FIELDS])

    few = plain.mapInPandas(cut, f"ip_source string, {KEPT}")
    return few.withColumn("expires_at", F.timestamp_micros(F.col("last") + LIFETIME_US))


def live_summaries(emissions: DataFrame) -> DataFrame:
    """A stream of emissions as a stream of summaries, one row per source that changed.

    The event time of an alert is its expiry, and the watermark trails it by the lifetime: the
    watermark is then the newest alert, "now", and the rows that Spark drops as late are the
    alerts that have expired. Files may arrive in any order.
    """
    timed = combined(emissions).withWatermark("expires_at", "24 hours")
    return timed.groupBy("ip_source").transformWithState(RecentAlerts(), SUMMARY, "Update", "EventTime")


def _writer(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        folder = f"{path}/run={run}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(folder)
        if batch.sparkSession.read.schema(SUMMARY).parquet(folder).isEmpty():
            delete_folder(batch.sparkSession, folder)

    return write


def start_live_state(
    spark: SparkSession, alerts: str, path: str, checkpoint: str, trigger: dict | None = None, **source: str
) -> StreamingQuery:
    """Follows the alert log at `alerts` and keeps the summary of every source at `path`."""
    emissions = spark.readStream.schema(EMISSION).options(**source).parquet(alerts)
    with setting(spark, PROVIDER, ROCKSDB):  # list state and timers need it
        return (
            live_summaries(emissions).writeStream.queryName("live_state").outputMode("update")
            .option("checkpointLocation", checkpoint).foreachBatch(_writer(path))
            .trigger(**(trigger or {"processingTime": "0 seconds"})).start()
        )


def _last_changes(spark: SparkSession, path: str) -> DataFrame:
    schema = spark.createDataFrame([], f"{SUMMARY}, run string, batch long").schema
    rows = spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)
    newest = last_per_key(rows, ["ip_source"], F.col("as_of"), F.col("batch"))
    last_seen = F.expr(f"{EPOCH} + INTERVAL '0.000001' SECOND * last")
    return newest.withColumn("last_seen", last_seen).select(*SUMMARY_COLUMNS)


def read_live_state(spark: SparkSession, path: str) -> DataFrame:
    """The summary of every source with a live alert, as its last change left it."""
    return _last_changes(spark, path).filter("active_alerts > 0")


def store_live_state(spark: SparkSession, path: str, table: str) -> None:
    """Brings a keyed table of summaries, for lookups by address, up to date.

    A source whose alerts have all expired keeps a row that says so.
    """
    upsert(_last_changes(spark, path), table, ["ip_source"])


assert LIFETIME == "INTERVAL '24' HOUR"  # as in the rule of the active list

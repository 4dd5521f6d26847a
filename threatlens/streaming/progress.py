"""Progress and latency of the streams, micro-batch by micro-batch."""

import json
import threading
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

OBSERVED = "emitted"
COLUMNS = (
    "query string, run string, batch long, started timestamp, input_rows long, alerts long, newest_event timestamp,"
    " duration_ms long, delay_ms long, state_rows long, dropped_late long, failure string"
)


def observed(detections: DataFrame) -> DataFrame:
    """The detections of a stream, counted per micro-batch on their way, with their newest event."""
    last = "last_event" if "last_event" in detections.columns else "timestamp"
    return detections.observe(OBSERVED, F.count(F.lit(1)).alias("alerts"), F.max(last).cast("timestamp").alias("newest"))


class ProgressLog(StreamingQueryListener):
    """Keeps one row per micro-batch: rows, alerts, and how long after their newest event they
    were emitted. A failed query leaves a row with its error.

    Rows are held until `every` of them are there, then appended to `path`; `flush` writes the
    rest. They are one per micro-batch, however many logs it has read.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every = spark, path, every
        self.rows, self.names, self.lock = [], {}, threading.Lock()

    def onQueryStarted(self, event) -> None:
        with self.lock:
            self.names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        seen = event.progress.observedMetrics.get(OBSERVED)
        started = datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00"))
        duration = p["durationMs"].get("triggerExecution", 0)
        newest = seen["newest"].astimezone() if seen and seen["newest"] else None
        delay = (started + timedelta(milliseconds=duration) - newest) / timedelta(milliseconds=1) if newest else None
        state = p.get("stateOperators") or []
        self._add((
            p["name"], p["runId"], p["batchId"], started, p["numInputRows"], seen["alerts"] if seen else None, newest, duration,
            int(delay) if delay is not None else None, sum(s["numRowsTotal"] for s in state),
            sum(s.get("numRowsDroppedByWatermark", 0) for s in state), None,
        ))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        if event.exception:
            self._add((self.names.get(run), run, None, None, None, None, None, None, None, None, None, event.exception[:2000]))

    def _add(self, row: tuple) -> None:
        with self.lock:
            self.rows.append(row)
            full = len(self.rows) >= self.every
        if full:
            self.flush()

    def flush(self) -> None:
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("append").parquet(self.path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COLUMNS).parquet(path)

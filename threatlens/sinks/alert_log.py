"""The alert store of the streams: an idempotent log of emissions, merged on read.

An updating query emits a window again whenever it grows. Each micro-batch writes its
own directory, so a batch costs what it emits, not the size of the store, and a replayed
batch overwrites its earlier attempt. The directory also names the streaming query's own
id, which its checkpoint keeps: a query with a new checkpoint counts its batches from 0
again, beside the old ones. Readers keep the furthest emission of each alert.
"""

import logging
import uuid
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatlens.functions.times import as_of_column
from threatlens.operators.alerts import to_alerts
from threatlens.schema import ALERT, ALERT_COLUMNS
from threatlens.session import delete_folder, old_names, path_exists
from threatlens.sinks.keyed_tables import last_per_key

ALERT_KEYS = ["alert_id"]
#: The query whose counts are estimates; of equal emissions the exact one counts.
EARLY_PORT_SCAN = "port_scan_early"
EMISSION = T.StructType(
    ALERT.fields
    + [T.StructField("query", T.StringType()), T.StructField("run", T.StringType()), T.StructField("batch", T.LongType())]
)
log = logging.getLogger(__name__)


def alert_writer(path: str, query_name: str, files: int | None = None, run: str | None = None):
    """A foreachBatch function that stores the alerts of a micro-batch and logs their number.

    `files` bounds the files per batch by shuffling the alerts (not the logs); without it
    every state partition writes its own. A batch without alerts leaves nothing behind.
    `run` names the emissions; by default it is the id of the running streaming query.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = run or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not name:
            raise RuntimeError("outside a streaming query, name the run")
        written = Observation()
        alerts = to_alerts(batch).observe(written, F.count("*").alias("alerts"))
        if files:
            alerts = alerts.repartition(files)
        folder = f"{path}/query={query_name}/run={name}/batch={batch_id}"
        alerts.write.mode("overwrite").parquet(folder)
        if not written.get["alerts"]:
            delete_folder(spark, folder)
        log.info("%s, batch %d: %d alerts", query_name, batch_id, written.get["alerts"])

    return write


def read_alerts(spark: SparkSession, path: str, since: datetime | None = None) -> DataFrame:
    """The current state of every alert, or of those last seen after `since`.

    A window only grows: its furthest emission has the newest event, then the most events,
    then exact counts, then the latest batch. So `since` may be applied before merging, where Parquet
    statistics skip the files of older batches.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], ALERT)
    emissions = spark.read.schema(EMISSION).parquet(path)
    if since is not None:
        emissions = emissions.filter(F.col("last_seen") > as_of_column(since))
    return last_per_key(emissions, ALERT_KEYS, *_furthest()).select(*ALERT_COLUMNS)


def _furthest() -> list[Column]:
    exact = F.col("query") != EARLY_PORT_SCAN
    return [F.col("last_seen"), F.col("event_count"), F.col("bytes_total"), exact, F.col("batch")]


def compact_alerts(spark: SparkSession, path: str, age: timedelta = timedelta(days=1), files: int = 4) -> int:
    """Merges the batches of each query that are older than `age`; returns how many were merged.

    Of each alert the furthest emission stays. The merged rows are there before the batches go,
    and merging them twice changes nothing, so a compaction may fail at any point. Streams that
    follow the log must have read what is that old.
    """
    by_query: dict[str, list[str]] = {}
    for name in sorted(old_names(spark, f"{path}/query=*/run=*/batch=*", age, 3)):
        by_query.setdefault(name.split("/")[0], []).append(name)
    merged = 0
    for query, names in by_query.items():
        if len(names) < 2:
            continue
        emissions = spark.read.schema(EMISSION).option("basePath", path).parquet(*[f"{path}/{n}" for n in names])
        newest = max(int(n.rsplit("=", 1)[1]) for n in names)
        rows = last_per_key(emissions, ALERT_KEYS, *_furthest()).select(*ALERT_COLUMNS)
        rows.coalesce(files).write.parquet(f"{path}/{query}/run=compacted-{uuid.uuid4().hex}/batch={newest}")
        for name in names:
            delete_folder(spark, f"{path}/{name}")
        merged += len(names)
    return merged


def newest_event(spark: SparkSession, path: str) -> datetime | None:
    """The newest event of any emission, from one column; None without emissions."""
    if not path_exists(spark, path):
        return None
    return spark.read.schema(EMISSION).parquet(path).agg(F.max("last_seen")).first()[0]

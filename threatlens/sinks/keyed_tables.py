"""Keyed Parquet tables: one row per key, in parts by a hash of the key.

Parquet has no MERGE. An upsert reads the parts its rows belong to, adds the new rows, keeps
the newest row of each key and writes those parts to a folder of its own; files of other
parts stay as they are. It is published by the marker of the next number, which says where
each part lies and is only created if it is not there: of two loads that saw the same
snapshot the second fails to create it, and merges again. Readers of an old snapshot are not
disturbed, and a failed or repeated upsert leaves no trace. What no marker of the last day
refers to is deleted by later loads.

Rows of a part are sorted by the clustering columns and carry Bloom filters on them, so the
rows of one key are found in one folder, without a shuffle, whatever the size of the table.
"""

import json
import uuid
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatlens.functions.times import as_of_column
from threatlens.session import create_marker, delete_folder, delete_old, read_markers

# Parts of a new table, and how long a superseded snapshot stays readable.
PARTS, KEEP = 8, timedelta(hours=24)
PART = "_part"
ATTACK_PATTERN_KEYS = ["attack_type", "source_ip"]
REPUTATION_KEYS = ["source_ip"]
TIMELINE_KEYS = ["event_date", "event_hour"]
# What the rows of a table are looked up by.
PATTERN_CLUSTER, TIMELINE_CLUSTER = ["source_ip"], ["event_date"]


def last_per_key(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The last row of each key in the given order.

    An ordered maximum is combined map-side, so many rows of one key cost no more
    shuffle than one.
    """
    values = [c for c in rows.columns if c not in keys]
    ranked = F.struct(
        *[o.alias(f"order_{i}") for i, o in enumerate(order)],
        F.struct(*values).alias("row"),
    )
    return rows.groupBy(*keys).agg(F.max(ranked).alias("last")).select(*keys, "last.row.*")


def ip_reputation_rows(reputation: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Report rows keyed by source. A source listed with several log types keeps the
    last listed one: the report runs from busy to quiet, then by log type."""
    report_order = (-F.col("total_events"), F.col("log_types"))
    return last_per_key(
        reputation.select(
            "source_ip",
            F.col("reputation_score").alias("score"),
            "total_events",
            "unique_targets",
            "total_bytes",
            F.col("log_type").alias("log_types"),
        ),
        REPUTATION_KEYS,
        *report_order,
    ).withColumn("last_seen", as_of_column(as_of))


def attack_pattern_rows(
    detections: DataFrame, as_of: datetime | Column, attack_type: str | None = None
) -> DataFrame:
    """Detections keyed by (attack type, source).

    Counts are carried only where the detections have them. With several windows of
    one source the last listed wins: the list runs from many targets to few.
    """
    kind = F.lit(attack_type) if attack_type else F.col("attack_category")
    has_counts = "distinct_targets" in detections.columns
    keyed = detections.select(
        kind.alias("attack_type"),
        "source_ip",
        (F.col("distinct_targets") if has_counts else F.lit(None).cast("bigint")).alias("count"),
        (
            F.col("event_count").cast("bigint")
            if "event_count" in detections.columns
            else F.lit(None).cast("bigint")
        ).alias("event_count"),
        *(["window_start"] if has_counts else []),
    )
    if has_counts:
        rows = last_per_key(
            keyed, ATTACK_PATTERN_KEYS, -F.col("count"), F.col("window_start")
        ).drop("window_start")
    else:
        # Without counts the rows of a key are equal: any aggregate will do.
        rows = keyed.groupBy(*ATTACK_PATTERN_KEYS).agg(
            F.max("count").alias("count"), F.max("event_count").alias("event_count")
        )
    return rows.withColumn("last_seen", as_of_column(as_of))


def _current(spark: SparkSession, path: str) -> tuple[int, dict | None]:
    """Number and content of the newest snapshot. A marker without text was never finished."""
    markers = {int(n): text for n, text in read_markers(spark, f"{path}/_snapshots/*").items() if n.isdigit()}
    finished = [n for n, text in markers.items() if text]
    return max(markers, default=0), json.loads(markers[max(finished)]) if finished else None


def _snapshot(spark: SparkSession, path: str) -> dict:
    _, content = _current(spark, path)
    if content is None:
        raise FileNotFoundError(f"no snapshot of a keyed table in {path}")
    return content


def _part(cluster: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*cluster), F.lit(parts)).cast("int")


def _read(spark: SparkSession, path: str, content: dict, parts: list[int] | None = None) -> DataFrame:
    """The rows of all parts, or of some; only their folders are listed."""
    schema = T.StructType.fromJson(content["schema"])
    wanted = [p for p in content["folders"] if parts is None or int(p) in parts]
    folders = [f"{path}/{content['folders'][p]}/{PART}={p}" for p in wanted]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, _snapshot(spark, path))


def read_key(spark: SparkSession, path: str, **key: str) -> DataFrame:
    """The rows of one value of the clustering columns, as one partition.

    One part is read, its file by statistics and Bloom filter. Being one partition, the rows
    join and group without a shuffle.
    """
    content = _snapshot(spark, path)
    if sorted(key) != sorted(content["cluster"]):
        raise ValueError(f"the table is clustered by {content['cluster']}")
    schema = T.StructType.fromJson(content["schema"])
    values = [F.lit(key[c]).cast(schema[c].dataType) for c in content["cluster"]]
    number = F.pmod(F.xxhash64(*values), F.lit(content["parts"])).cast("int")
    # A projection of constants over one row: the optimiser computes it, no job runs.
    part = spark.sql("SELECT 1").select(number).first()[0]
    same = [F.col(c) == v for c, v in zip(content["cluster"], values, strict=True)]
    rows = _read(spark, path, content, [part])
    for condition in same:
        rows = rows.filter(condition)
    return rows.coalesce(1)


def _write(rows: DataFrame, folder: str, cluster: list[str], keys: list[str], parts: int) -> None:
    writer = (
        rows.withColumn(PART, _part(cluster, parts)).repartition(PART)
        .sortWithinPartitions(PART, *cluster, *[k for k in keys if k not in cluster])
        .write.partitionBy(PART)
    )
    for column in cluster:
        if isinstance(rows.schema[column].dataType, T.StringType):
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
            writer = writer.option(f"parquet.bloom.filter.adaptive.enabled#{column}", "true")
    writer.parquet(folder)


def upsert(
    rows: DataFrame, path: str, keys: list[str], cluster: list[str] | None = None, parts: int = PARTS,
    keep: timedelta = KEEP,
) -> None:
    """Replaces or adds rows by key, null keys included. `rows` holds one row per key.

    `cluster` (some of the keys, by default all) and `parts` count when the table is new; later
    loads follow the table. Aim at parts of some hundred megabytes.
    """
    spark = rows.sparkSession
    while True:
        number, content = _current(spark, path)
        content = content or {"parts": parts, "cluster": cluster or keys, "schema": rows.schema.jsonValue(), "folders": {}}
        part = _part(content["cluster"], content["parts"])
        touched = [r[0] for r in rows.select(part).distinct().collect()]
        merged = rows
        if any(str(p) in content["folders"] for p in touched):
            new, old = rows.select(*keys).alias("new"), _read(spark, path, content, touched).alias("old")
            same = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
            merged = old.join(new, same, "left_anti").unionByName(rows)
        folder = f"data-{uuid.uuid4().hex}"
        if touched:
            _write(merged, f"{path}/{folder}", content["cluster"], keys, content["parts"])
        content["folders"] |= {str(p): folder for p in touched}
        if create_marker(spark, f"{path}/_snapshots/{number + 1}", json.dumps(content)):
            break
        delete_folder(spark, f"{path}/{folder}")
    drop_superseded(spark, path, keep)


def drop_superseded(spark: SparkSession, path: str, keep: timedelta = KEEP) -> None:
    """Deletes markers, then parts, that are older than `keep` and that nothing refers to.

    The newest finished marker and every part it or a younger marker names stay. A load that is
    still running has written its folder within `keep`.
    """
    markers = {n: t for n, t in read_markers(spark, f"{path}/_snapshots/*").items() if n.isdigit()}
    finished = [int(n) for n, text in markers.items() if text]
    if len(markers) < 2 or not finished:
        return
    newest = str(max(finished))
    gone = delete_old(spark, f"{path}/_snapshots", "*", keep, {newest, str(max(map(int, markers)))})
    if not gone:
        return
    named = {
        f"{folder}/{PART}={p}" for n, text in markers.items() if n not in gone and text
        for p, folder in json.loads(text)["folders"].items()
    }
    delete_old(spark, path, f"data-*/{PART}=*", keep, named)
    delete_old(spark, path, "data-*", keep, {n.split("/")[0] for n in named})

"""Shards by a consistent-hash ring with virtual nodes and bounded loads."""

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from threatlens.llm.graphs import ranked
from threatlens.session import shared_folder

SHARDS = 24
VIRTUAL_NODES = 128


@dataclass
class Ring:
    """Points of the ring in order, and the shard that owns the arc from each to the next."""

    points: np.ndarray
    owners: np.ndarray

    @classmethod
    def of(cls, shards: int, virtual_nodes: int) -> "Ring":
        named = sorted(
            (xxhash.xxh64_intdigest(f"{shard}/{node}") - 2**63, shard)
            for shard in range(shards)
            for node in range(virtual_nodes)
        )
        return cls(np.array([p for p, _ in named]), np.array([s for _, s in named]))

    def arcs(self, positions: np.ndarray) -> np.ndarray:
        """The arc of each position; before the first point the last arc goes on."""
        return (np.searchsorted(self.points, positions, side="right") - 1) % len(self.points)


def place(counts: np.ndarray, ring: Ring, room: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(arc, first rank, shard, first slot): where each run of an arc's keys goes.

    Keys come in ring order. Those that find their shard full go on clockwise to the next
    arc whose shard has room. There are at most as many runs as arcs and shards together.
    """
    left, filled = room.astype(np.int64).copy(), np.zeros(len(room), dtype=np.int64)
    n = len(counts)
    onward = np.arange(n)

    def with_room(arc: int) -> int:
        seen = []
        while left[ring.owners[arc]] == 0:
            seen.append(arc)
            step = onward[arc]
            arc = int(step) if step != arc else (arc + 1) % n
        onward[seen] = arc
        return arc

    runs = []
    for arc in range(n):
        done = 0
        while done < counts[arc]:
            shard = ring.owners[with_room(arc)]
            take = int(min(left[shard], counts[arc] - done))
            runs.append((arc, done, int(shard), int(filled[shard])))
            left[shard] -= take
            filled[shard] += take
            done += take
    return runs


def shard_by_ring(
    rows: DataFrame,
    key: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    virtual_nodes: int = VIRTUAL_NODES,
    staging: str | None = None,
) -> DataFrame:
    """Per row: key, size, text_crc32, shard, slot. Shard counts differ by one at most.

    A shard takes at most ceil(rows / shards) rows; the first rows % shards shards may take
    that many, the others one less, so the loads are exact. Only the row count of each arc
    reaches the driver, one number per virtual node. Null keys have one ring position like
    any other; a key with very many rows flows over into as many shards as it needs. A null
    text has no bytes and checksum 0. Equal rows get slots of their own. Other columns are
    not read. An empty table gives an empty result.
    """
    ring = Ring.of(shards, virtual_nodes)

    @pandas_udf("int")
    def arc_of(position: pd.Series) -> pd.Series:
        return pd.Series(ring.arcs(position.to_numpy()), dtype="int32")

    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = rows.select(
        F.col(key).alias("key"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col(key).cast("string")).alias("position"),
    ).withColumn("arc", arc_of("position"))
    placed = ranked(
        keyed, "arc", ["position", "key", "text_crc32", "size"], shared_folder(rows.sparkSession, staging)
    )
    counts = np.zeros(len(ring.points), dtype=np.int64)
    for arc, n in placed.groupBy("arc").agg(F.count("*")).collect():
        counts[arc] = n
    total = int(counts.sum())
    room = np.array([total // shards + (s < total % shards) for s in range(shards)])
    runs = np.array(place(counts, ring, room), dtype=np.int64).reshape(-1, 4)

    @pandas_udf("shard int, slot long")
    def run_of(arc: pd.Series, rank: pd.Series) -> pd.DataFrame:
        order = np.lexsort((runs[:, 1], runs[:, 0]))
        arcs, firsts, shard, slot = runs[order].T
        # Runs of one arc stand together; ranks are below the row count of the table.
        wide = np.int64(total + 1)
        at = np.searchsorted(arcs * wide + firsts, arc.to_numpy() * wide + rank.to_numpy(), side="right") - 1
        return pd.DataFrame({
            "shard": shard[at].astype("int32"), "slot": slot[at] + rank.to_numpy() - firsts[at]
        })

    return placed.select("key", "size", "text_crc32", run_of("arc", "rank").alias("at")).select(
        F.col("key").alias(key), "size", "text_crc32", "at.shard", "at.slot"
    )

"""Connected components, ranks and bounded samples, for groups of any size."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threatlens.session import delete_folder, stage


#: Links that one task may finish: 16 bytes each, and as many nodes at most twice.
FEW_LINKS = 500_000


def _finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Smallest reachable node of every node, by union and find in one task."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for frame in frames:
        for a, b in zip(frame["a"].tolist(), frame["b"].tolist(), strict=True):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    yield pd.DataFrame({"node": list(root), "to": [find(x) for x in list(root)]}, dtype="int64")


def connected_components(links: DataFrame, folder: str, few: int = 0) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is the smallest node.

    Once at most `few` links are left, one task ends them: many small jobs cost more.

    Contraction: every node moves to the best of itself and its neighbours, links are
    rewritten to the new nodes, until none is left. "Best" is the smallest number in even
    rounds, which folds a star in one, and the smallest seeded hash in odd rounds, which
    shrinks any graph by a constant share. Only minima and joins: a node with very many
    links is combined before the shuffle, and its join partition can be split.
    Null ends and self links are ignored; no links give no rows.
    """
    spark = links.sparkSession
    a, b = F.least("a", "b"), F.greatest("a", "b")
    edges = stage(
        links.filter("a is not null and b is not null and a <> b")
        .select(a.alias("a"), b.alias("b"))
        .distinct(),
        f"{folder}/edges-0",
    )
    moves = []
    while not edges.isEmpty():
        turn = len(moves)
        if few and edges.count() <= few:
            moves.append(stage(edges.coalesce(1).mapInPandas(_finish, "node long, to long"), f"{folder}/moves-{turn}"))
            delete_folder(spark, f"{folder}/edges-{turn}")
            break

        def best(node: str, turn: int = turn) -> Column:
            place = F.xxhash64(F.lit(turn), F.col(node)) if turn % 2 else F.col(node)
            return F.struct(place.alias("place"), F.col(node).alias("node"))

        both = edges.union(edges.select("b", "a"))
        move = both.groupBy(F.col("a").alias("node")).agg(F.min(best("b")).alias("other"))
        moved = F.least(best("node"), F.col("other"))["node"]
        move = stage(move.select("node", moved.alias("to")), f"{folder}/moves-{turn}")
        first = move.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        second = move.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        rewritten = edges.join(first, "a").join(second, "b").filter("to_a <> to_b")
        edges = stage(
            rewritten.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
            .distinct(),
            f"{folder}/edges-{turn + 1}",
        )
        delete_folder(spark, f"{folder}/edges-{turn}")
        moves.append(move)
    if not moves:
        return spark.createDataFrame([], "node long, component long")
    root = moves[-1]
    for earlier in reversed(moves[:-1]):
        later = root.select(F.col("node").alias("to"), F.col("to").alias("end"))
        root = earlier.join(later, "to", "left").select("node", F.coalesce("end", "to").alias("to"))
    root = stage(root, f"{folder}/roots")
    smallest = root.groupBy("to").agg(F.min("node").alias("component"))
    return root.join(smallest, "to").select("node", "component")


def ranked(rows: DataFrame, group: str, order: list[str], folder: str) -> DataFrame:
    """Adds `rank`, gapless from 0 in each group, also where one group holds most rows.

    A range partitioning by (group, order) cuts large groups; the counts before a
    partition and the rank inside it add up. Rows equal in `order` rank in any order.
    """
    cut = (
        rows.repartitionByRange(group, *order)
        .withColumn("_part", F.spark_partition_id())
    )
    cut = stage(cut, f"{folder}/ranked")
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        cut.groupBy(group, "_part")
        .agg(F.count("*").alias("_n"))
        .select(group, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order))
    return (
        cut.join(before, [group, "_part"])
        .withColumn("rank", F.col("_before") + inside - 1)
        .drop("_part", "_before")
    )


def sampled(rows: DataFrame, place: str, bound: int) -> DataFrame:
    """At most `bound` rows, those with the smallest hash in the column `place`.

    Only about twice the bound is sorted, whatever the table: the hash is cut first, by a
    count of the rows.
    """
    share = min(1.0, 2 * bound / max(rows.count(), 1))
    return rows.filter(low_hash(F.col(place), F.lit(share))).orderBy(place).limit(bound)


def low_hash(place: Column, share: Column) -> Column:
    """Whether a 64-bit hash is in the lowest share of its range."""
    return place.cast("double") <= (share * 2 - 1) * float(2**63)

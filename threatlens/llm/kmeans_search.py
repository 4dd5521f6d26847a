"""Nearest neighbours by inner product through a hierarchical k-means tree."""

import logging
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threatlens.llm.graphs import sampled
from threatlens.session import shared_folder, stage

NEIGHBOURS = 20
#: The tree is fitted on at most this many vectors, and on at most this many numbers.
SAMPLE, SAMPLE_NUMBERS = 20_000, 4_000_000
BRANCHES, TURNS = 16, 8
#: Vectors of the table that a leaf aims at, and the least of the sample that a node splits.
LEAF_ROWS, LEAST_SPLIT = 256, 32
#: Queries that calibrate the visits, and the recall that each half of them has to reach.
CALIBRATED, RECALL, WIDER = 256, 0.94, 1 / 16
#: Numbers in one side of a tile.
TILE_NUMBERS = 131_072
#: Visits of a query up to the end of the first round, and of the next in comparison.
FIRST_VISITS, MORE_VISITS = 2, 4
FOUND = "q long, class_id long, unnamed boolean, first_id long, score double"
log = logging.getLogger(__name__)


@dataclass
class Tree:
    """Centres of all nodes, the root first; a node without children is a leaf."""

    centres: np.ndarray
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest centre, level by level."""
        made, todo = np.zeros(len(x), dtype=np.int64), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            below = self.children[node]
            if not below:
                made[rows] = self.leaf[node]
            elif len(rows):
                nearest = _nearest(x[rows], self.centres[below])
                todo += [(child, rows[nearest == i]) for i, child in enumerate(below)]
        return made

    def visits(self, scores: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first: a priority queue of open nodes by the query's product with their centres."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heappop(queue)
            if not self.children[node]:
                yield self.leaf[node]
            for child in self.children[node]:
                heappush(queue, (-scores[child], child))


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(axis=1) - 2 * (x @ centres.T), axis=1)


def _split(x: np.ndarray, branches: int, rng: np.random.Generator) -> np.ndarray:
    """The part of each vector among k-means clusters."""
    centres = x[rng.choice(len(x), branches, replace=False)]
    for _ in range(TURNS):
        part = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, part, x)
        counts = np.bincount(part, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return _nearest(x, centres)


def grow(sample: np.ndarray, share: float, first_leaf: int = 0) -> Tree:
    """A tree on a sample that is this share of the table; leaves are numbered from first_leaf."""
    rng, centres, tree = np.random.default_rng(1), [sample.mean(axis=0)], Tree(np.empty(0), [[]], [0])
    todo, leaves = [(0, np.arange(len(sample)))], first_leaf
    while todo:
        node, rows = todo.pop()
        parts = []
        if len(rows) >= LEAST_SPLIT and len(rows) / share > LEAF_ROWS:
            part = _split(sample[rows], min(BRANCHES, int(len(rows) / share / LEAF_ROWS) + 1), rng)
            parts = [rows[part == p] for p in np.unique(part)]
        if len(parts) < 2:
            tree.leaf[node] = leaves
            leaves += 1
            continue
        for inside in parts:
            child = len(centres)
            centres.append(sample[inside].mean(axis=0))
            tree.children.append([])
            tree.leaf.append(0)
            tree.children[node].append(child)
            todo.append((child, inside))
    tree.centres = np.stack(centres)
    return tree


@dataclass
class Found:
    """`rows`: query_id, rank, vec_id, score. `visits` and `recall` as calibrated."""

    rows: DataFrame
    visits: int
    recall: float


def prepared(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """uid, vec_id, x of vectors that are not empty or zero and hold finite numbers only."""
    x = F.col("x")
    sound = (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (
        vectors.select(
            F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("vec_id"),
            F.col(vector_col).cast("array<double>").alias("x"),
        )
        .filter(F.coalesce(sound & F.exists(x, lambda v: v != 0), F.lit(False)))
    )


def _best(q: np.ndarray, c: np.ndarray, k: int, bound: np.ndarray | float = -np.inf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, product) of the k largest of each query that reach its bound, ties of the last place too.

    The product of matrices only chooses; what is returned is summed row by row, so equal
    vectors have equal scores wherever they stand.
    """
    rough = np.nan_to_num(q @ c.T, nan=-np.inf)
    last = np.full(len(q), bound)
    if c.shape[0] > k:
        last = np.maximum(last, -np.partition(-rough, k - 1, axis=1)[:, k - 1])
    slack = 1e-12 * np.linalg.norm(q, axis=1) * np.linalg.norm(c, axis=1).max()
    i, j = np.nonzero(rough >= (last - slack)[:, None])
    return i, j, (q[i] * c[j]).sum(axis=1)


def _truth(classes: DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best classes of each calibrating query, by brute force: (q, leaf)."""
    widths = {w: g for w, g in queries.groupby(queries["x"].map(len))}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for width, part in frame.groupby(frame["x"].map(len)):
                if width in widths:
                    asked = widths[width]
                    i, j, score = _best(np.stack(asked["x"].to_list()), np.stack(part["x"].to_list()), k)
                    yield pd.DataFrame({
                        "q": asked["class_id"].to_numpy()[i], "class_id": part["class_id"].to_numpy()[j],
                        "leaf": part["leaf"].to_numpy()[j], "score": score,
                    })

    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "class_id"))
    found = classes.select("class_id", "x", "leaf").mapInPandas(run, "q long, class_id long, leaf long, score double")
    return found.filter("q <> class_id").withColumn("place", place).filter(F.col("place") <= k).select("q", "leaf").toPandas()


def calibrated(trees: dict[int, Tree], queries: pd.DataFrame, truth: pd.DataFrame) -> tuple[int, float]:
    """(visits, recall): leaf visits widened until both halves of the queries reach RECALL."""
    ranks = []
    for q, x in zip(queries["class_id"], queries["x"]):
        tree = trees.get(len(x))
        wanted = truth.loc[truth["q"] == q, "leaf"]
        order = {leaf: n for n, leaf in enumerate(tree.visits(tree.centres @ x))} if tree else {}
        ranks.append(np.array([order.get(leaf, 0) for leaf in wanted], dtype=np.int64))
    halves = [np.concatenate(ranks[i::2]) if ranks[i::2] else np.empty(0) for i in (0, 1)]
    visits = 1
    while True:
        recalls = [float((h < visits).mean()) if len(h) else 1.0 for h in halves]
        if min(recalls) >= RECALL:
            return visits, min(recalls)
        visits += int(visits * WIDER) + 1


def round_of(visit: int) -> int:
    """Rounds grow, so that each sees a few times as much as all before."""
    number, end = 0, FIRST_VISITS
    while visit >= end:
        number, end = number + 1, end * MORE_VISITS
    return number


def _tiles(rows: DataFrame, counts: dict[int, int], each: int, name: str, fields: list[str]) -> DataFrame:
    """(leaf, pack, one array a field): packs of the rows of a leaf, as many as its count asks for."""
    packs = rows.sparkSession.createDataFrame([(leaf, -(-n // each)) for leaf, n in counts.items()], "leaf long, packs int")
    dealt = rows.join(F.broadcast(packs), "leaf").withColumn("pack", F.pmod(F.xxhash64("class_id"), F.col("packs")))
    packed = dealt.groupBy("leaf", "pack").agg(F.collect_list(F.struct(*fields)).alias("rows"))
    return packed.select(
        "leaf", F.col("pack").alias(f"{name}_pack"), *[F.col("rows")[f].alias(f"{name}_{f}") for f in fields]
    )


def search(
    vectors: DataFrame,
    asked: Column | str,
    k: int = NEIGHBOURS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    staging: str | None = None,
) -> Found:
    """The k rows of largest inner product for each row that `asked` (over `vec_id`) picks.

    Every row is a candidate but the query's own; repeated ids are rows of their own. Rows come
    nearest first, ties by the smaller vec_id, null ids last; all candidates come if there are
    fewer. Vectors that are null, empty, zero or hold a null or non-finite component take no
    part; a vector meets vectors of its own length only. Ids are whole numbers. Other columns
    are not read. An empty table, or one without queries, gives no row.

    The tree is fitted on a bounded sample and indexes every vector; equal vectors are one
    class with its k + 1 first rows. A query takes leaves best bin first; how many is widened
    until a bounded set of queries, compared with all rows, reaches RECALL. Leaves are searched
    in tiles of bounded size, so a leaf with very many vectors is spread over many tasks, and in
    rounds: what a query has found bounds what its next leaves may write.
    """
    spark = vectors.sparkSession
    folder = shared_folder(spark, staging)
    rows = stage(prepared(vectors, id_col, vector_col), f"{folder}/vectors")
    member = F.struct(F.col("vec_id").isNull().alias("unnamed"), "vec_id", "uid")
    first = F.row_number().over(Window.partitionBy("x").orderBy(F.col("vec_id").isNull(), "vec_id", "uid"))
    classes = stage(
        rows.withColumn("place", first).filter(F.col("place") <= k + 1)
        .groupBy("x").agg(F.sort_array(F.collect_list(member)).alias("members"))
        .select(F.col("members")[0]["uid"].alias("class_id"), "x", "members"),
        f"{folder}/classes",
    )
    queries = stage(
        rows.filter(asked).select("uid", "vec_id", "x").join(classes.select("class_id", "x"), "x").select("uid", "vec_id", "class_id"),
        f"{folder}/queries",
    )
    widest = classes.agg(F.max(F.size("x"))).first()[0]
    if widest is None:
        return Found(spark.createDataFrame([], "query_id long, rank int, vec_id long, score double"), 0, 1.0)
    bound = max(LEAST_SPLIT, min(SAMPLE, SAMPLE_NUMBERS // widest))
    placed = classes.select("class_id", "x", F.xxhash64("class_id").alias("place"))
    sample = sampled(placed, "place", bound).select("x").toPandas()["x"]
    share = min(1.0, len(sample) / max(classes.count(), 1))
    trees, leaves = {}, 0
    for width, part in sample.groupby(sample.map(len)):
        trees[width] = grow(np.stack(part.to_list()), share, leaves)
        leaves += sum(not c for c in trees[width].children)

    kind = "<f4" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"

    def settle(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            width = frame["x"].map(len)
            leaf = -width.to_numpy(dtype=np.int64)  # a length the sample does not know is a leaf of its own
            for w, tree in trees.items():
                mine = np.flatnonzero(width == w)
                if len(mine):
                    leaf[mine] = tree.assign(np.stack(frame["x"].iloc[mine].to_list()))
            packed = [np.asarray(x, dtype=kind).tobytes() for x in frame["x"]]
            yield frame.assign(first_id=frame["first_id"].astype("Int64"), leaf=leaf, packed=packed)

    settled = stage(
        classes.select("class_id", "x", F.col("members")[0]["unnamed"].alias("unnamed"), F.col("members")[0]["vec_id"].alias("first_id"))
        .mapInPandas(settle, "class_id long, x array<double>, unnamed boolean, first_id long, leaf long, packed binary"),
        f"{folder}/leaves",
    )
    counts = dict(settled.groupBy("leaf").count().collect())
    wanted = settled.join(queries.select("class_id").distinct(), "class_id", "left_semi").select("class_id", "x", "packed")
    picked = sampled(wanted.withColumn("place", F.xxhash64(F.lit(1), "class_id")), "place", CALIBRATED)
    picked = picked.select("class_id", "x").toPandas()
    visits, recall = calibrated(trees, picked, _truth(settled, picked, k))
    log.info("%d leaves, %d visits, recall %.3f on %d queries", leaves, visits, recall, len(picked))

    def traverse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 256):
                taken, some = [], frame.iloc[at : at + 256]
                for x in some["x"]:
                    mine, seen = [], 0
                    for leaf in trees[len(x)].visits(trees[len(x)].centres @ x) if len(x) in trees else [-len(x)]:
                        if len(mine) >= visits and seen > k:
                            break
                        if counts.get(leaf):
                            mine.append((leaf, round_of(len(mine))))
                            seen += counts[leaf]
                    taken.append(mine)
                each = some[["class_id", "packed"]].assign(taken=taken).explode("taken")
                yield each.assign(leaf=[t[0] for t in each["taken"]], round=[t[1] for t in each["taken"]]).drop(columns="taken")

    visited = stage(wanted.mapInPandas(traverse, "class_id long, packed binary, leaf long, round int"), f"{folder}/visits")
    each = max(64, TILE_NUMBERS // widest)
    there = stage(_tiles(settled, counts, each, "c", ["class_id", "unnamed", "first_id", "packed"]), f"{folder}/tiles")
    rounds = {}
    for number, leaf, n in visited.groupBy("round", "leaf").count().collect():
        rounds.setdefault(number, {})[leaf] = n

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        """One tile of queries against one tile of vectors: the group has one row."""
        pair = frame.iloc[0]
        q, c = (np.frombuffer(b"".join(pair[f]), dtype=kind).reshape(len(pair[f]), -1).astype(float) for f in ("q_packed", "c_packed"))
        i, j, score = _best(q, c, k + 1, np.asarray(pair["q_bound"]))
        first_id = pd.array(list(pair["c_first_id"]), dtype="Int64")
        return pd.DataFrame({
            "q": np.asarray(pair["q_class_id"])[i], "class_id": np.asarray(pair["c_class_id"])[j],
            "unnamed": np.asarray(pair["c_unnamed"])[j], "first_id": first_id[j], "score": score,
        })

    def first_of(*order: Column | str) -> Column:
        return F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), *order))

    # A later round writes only what can still enter a query's list.
    best = spark.createDataFrame([], FOUND)
    for number in sorted(rounds):
        bounds = best.groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("bound")).filter(F.col("n") > k)
        bounds = bounds.select(F.col("q").alias("class_id"), "bound")
        turn = visited.filter(F.col("round") == number).join(bounds, "class_id", "left")
        turn = turn.withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
        asking = _tiles(turn, rounds[number], each, "q", ["class_id", "packed", "bound"])
        met = asking.join(there, "leaf").groupBy("leaf", "q_pack", "c_pack").applyInPandas(compare, FOUND)
        best = best.unionByName(met).withColumn("place", first_of("unnamed", "first_id", "class_id"))
        best = stage(best.filter(F.col("place") <= k + 1).drop("place"), f"{folder}/best-{number}")
    members = best.select("q", "class_id", "score").join(classes.select("class_id", "members"), "class_id")
    near = members.select("q", "score", F.explode("members").alias("m")).select("q", "score", "m.*")
    near = near.withColumn("place", first_of("unnamed", "vec_id", "uid")).filter(F.col("place") <= k + 1)
    lists = near.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "uid", "score"))).alias("near"))
    others = F.filter("near", lambda m: m["uid"] != F.col("uid"))
    made = queries.join(lists.withColumnRenamed("q", "class_id"), "class_id").select(
        F.col("vec_id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("rank", "m")
    )
    return Found(made.select("query_id", (F.col("rank") + 1).alias("rank"), "m.vec_id", "m.score"), visits, recall)

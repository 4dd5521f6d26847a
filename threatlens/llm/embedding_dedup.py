"""Near-duplicate embeddings by NN-descent."""

from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threatlens.llm.graphs import FEW_LINKS, connected_components, ranked, sampled
from threatlens.session import shared_folder, stage

THRESHOLD = 0.93
#: Compact vectors only propose; pairs this much below the threshold are verified too.
MARGIN = 0.02
#: Neighbours kept per vector, and how far a list whose members all reach the threshold grows.
NEIGHBOURS, MOST_NEIGHBOURS = 10, 40
#: The first lists: random hyperplane codes, sorted, compared inside a sliding window.
TABLES, CODE_BITS, WINDOW, FROM_WINDOW = 10, 24, 8, 4
ROUNDS = 5
#: A round that adds a smaller share of threshold edges is the last.
GAIN = 0.002
#: Vectors on one side of a tile.
TILE = 2_048
#: Cells of a crowded component: one for each side of so many hyperplanes.
CELL_BITS = 3
#: How far the lists of cells grow: cells are few, and lists that stay full would hide links.
MOST_CELLS = 640
AUDITED = 1_000
RECALL = 0.97
ATTEMPTS = 3


def compact(units: np.ndarray) -> list[bytes]:
    """Unit vectors as signed bytes; only the direction counts."""
    scaled = units * (127 / np.abs(units).max(axis=1, keepdims=True))
    return [row.tobytes() for row in np.rint(scaled).astype(np.int8)]


def expand(vectors: list[bytes]) -> np.ndarray:
    made = np.frombuffer(b"".join(vectors), dtype=np.int8).reshape(len(vectors), -1).astype(np.float32)
    return made / np.linalg.norm(made, axis=1, keepdims=True)


def prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """uid, vec_id, label, and unit: the direction in doubles, null if the vector has none."""
    x = F.col("x")
    scale = F.array_max(F.transform(x, F.abs))
    sound = (F.size(x) > 0) & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    ) & (scale > 0) & F.col("label").isNotNull()
    length = F.sqrt(F.aggregate("y", F.lit(0.0), lambda s, v: s + v * v))
    return (
        vectors.select(
            F.monotonically_increasing_id().alias("uid"),
            F.col(id_col).alias("vec_id"),
            F.col(label_col).alias("label"),
            F.col(vector_col).cast("array<double>").alias("x"),
        )
        .withColumn("y", F.when(F.coalesce(sound, F.lit(False)), F.transform(x, lambda v: v / scale)))
        .select("uid", "vec_id", "label", "x", F.transform("y", lambda v: v / length).alias("unit"))
    )


def first_lists(nodes: DataFrame, seed: int) -> DataFrame:
    """(u, v, cos): neighbours in the order of random hyperplane codes, both ways."""

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for width, part in frame.groupby("width"):
                rng = np.random.default_rng([seed, int(width)])
                units = expand(part["small"].tolist())
                for table in range(TABLES):
                    planes = rng.standard_normal((int(width), CODE_BITS)).astype(np.float32)
                    code = (units @ planes > 0) @ (1 << np.arange(CODE_BITS, dtype=np.int64))
                    yield part.assign(table=table, code=code)

    def slide(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = None
        for frame in frames:
            frame = frame if tail is None else pd.concat([tail, frame], ignore_index=True)
            tail = frame.iloc[-WINDOW:]
            group = frame.groupby(["label", "width", "table"], sort=False).ngroup().to_numpy()
            for width in frame["width"].unique():
                mine = np.flatnonzero(frame["width"].to_numpy() == width)
                units, ids, own = expand(frame["small"].iloc[mine].tolist()), frame["u"].to_numpy()[mine], group[mine]
                near = np.full((len(mine), 2 * WINDOW), -2.0, dtype=np.float32)
                for step in range(1, min(WINDOW, len(mine) - 1) + 1):
                    cos = np.where(own[step:] == own[:-step], np.einsum("ij,ij->i", units[step:], units[:-step]), -2)
                    near[:-step, step - 1] = near[step:, WINDOW + step - 1] = cos
                best = np.argsort(-near, axis=1)[:, :FROM_WINDOW]
                at = np.repeat(np.arange(len(mine)), FROM_WINDOW)
                picked = best.ravel()
                cos = near[at, picked]
                other = np.where(picked < WINDOW, at + picked + 1, at - (picked - WINDOW) - 1)
                real = cos > -2
                yield pd.DataFrame({"u": ids[at[real]], "v": ids[other[real]], "cos": cos[real]})

    order = ["label", "width", "table", "code"]
    label = nodes.schema["label"].dataType.simpleString()
    coded = nodes.mapInPandas(encode, f"u long, label {label}, width int, small binary, table int, code long")
    return (
        coded.repartitionByRange(*order, "u").sortWithinPartitions(*order, "u")
        .mapInPandas(slide, "u long, v long, cos float")
    )


def _top(proposals: DataFrame, most: int, threshold: float) -> DataFrame:
    """Each node's list: its nearest, more of them where all reach the threshold."""
    place = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("cos"), "v"))
    merged = proposals.groupBy("u", "v").agg(F.max("cos").alias("cos"), F.min("fresh").alias("fresh"))
    enlarged = (F.col("place") <= NEIGHBOURS) | (F.col("cos") >= threshold - MARGIN)
    return merged.withColumn("place", place).filter(F.col("place") <= most).filter(enlarged)


def _local_join(lists: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """(u, v, cos) among the neighbours of one node, where the pair improves the list of u."""
    ways = lists.select(F.col("u").alias("node"), F.col("v").alias("near"), "fresh")
    back = lists.select(F.col("v").alias("node"), F.col("u").alias("near"), "fresh")
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("fresh"), F.xxhash64("node", "near")))
    around = (
        ways.union(back).groupBy("node", "near").agg(F.max("fresh").alias("fresh"))
        .withColumn("place", place).filter(F.col("place") <= 2 * most)
    )
    worst = lists.groupBy("u").agg(F.min("cos").alias("least"), F.count("*").alias("n"))
    bars = nodes.select("u", "small").join(worst, "u", "left").select(
        F.col("u").alias("near"), "small",
        F.when(F.col("n") >= NEIGHBOURS, F.col("least")).otherwise(-2.0).cast("float").alias("bar"),
    )
    met = around.join(bars, "near").groupBy("node").agg(
        F.collect_list(F.struct("near", "small", "bar", "fresh")).alias("members")
    ).filter(F.exists("members", lambda m: m["fresh"]))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = []
            for members in frame["members"]:
                ids = np.array([m["near"] for m in members])
                bar = np.array([m["bar"] for m in members], dtype=np.float32)
                fresh = np.array([m["fresh"] for m in members])
                units = expand([bytes(m["small"]) for m in members])
                cos = units @ units.T
                np.fill_diagonal(cos, -2)
                i, j = np.nonzero((cos > bar[:, None]) & (fresh[:, None] | fresh[None, :]))
                made.append((ids[i], ids[j], cos[i, j]))
            if made:
                u, v, cos = (np.concatenate(x) for x in zip(*made, strict=True))
                yield pd.DataFrame({"u": u, "v": v, "cos": cos}).drop_duplicates(["u", "v"])

    return met.select("members").mapInPandas(run, "u long, v long, cos float")


def descend(
    nodes: DataFrame, seed: int, threshold: float, folder: str, most_neighbours: int = MOST_NEIGHBOURS
) -> DataFrame:
    """Neighbour lists (u, v, cos) refined through neighbours of neighbours, those of every round."""
    lists = stage(
        _top(first_lists(nodes, seed).withColumn("fresh", F.lit(True)), NEIGHBOURS, threshold), f"{folder}/lists-0"
    )
    most, edges = NEIGHBOURS, lists.filter(F.col("cos") >= threshold - MARGIN).count()
    seen = lists
    for turn in range(1, ROUNDS + 1):
        saturated = lists.filter((F.col("place") == most) & (F.col("cos") >= threshold))
        grows = most < most_neighbours and not saturated.isEmpty()
        most = min(2 * most, most_neighbours) if grows else most
        found = _local_join(lists, nodes, most).withColumn("fresh", F.lit(True))
        known = lists.select("u", "v", "cos", F.lit(False).alias("fresh"))
        lists = stage(_top(known.unionByName(found), most, threshold), f"{folder}/lists-{turn}")
        seen = seen.unionByName(lists)
        before, edges = edges, lists.filter(F.col("cos") >= threshold - MARGIN).count()
        if not grows and edges - before <= GAIN * edges:
            break
    return seen.groupBy("u", "v").agg(F.max("cos").alias("cos"))


def _verified(lists: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    near = lists.filter(F.col("cos") >= threshold - MARGIN).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    first = classes.select(F.col("class_id").alias("a"), F.col("unit").alias("x"))
    second = classes.select(F.col("class_id").alias("b"), F.col("unit").alias("y"))
    cosine = F.aggregate(F.zip_with("x", "y", lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    return near.join(first, "a").join(second, "b").filter(cosine >= threshold).select("a", "b")


def _blocks(members: DataFrame, group: str, folder: str, tile: int) -> DataFrame:
    """(group, block, ids, copies, packed): the vectors of a group in blocks of bounded size.

    `members` has class_id, group, unit and copies. A group of any size is spread over tasks.
    """
    placed = ranked(members.select("class_id", group), group, ["class_id"], folder)
    placed = placed.withColumn("block", F.floor(F.col("rank") / tile))

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(packed=[np.asarray(u, dtype="<f8").tobytes() for u in frame["unit"]]).drop(columns="unit")

    kind = members.schema[group].dataType.simpleString()
    packed = members.select("class_id", "copies", "unit").mapInPandas(pack, "class_id long, copies long, packed binary")
    rows = F.collect_list(F.struct("class_id", "copies", "packed"))
    blocks = packed.join(placed, "class_id").groupBy(F.col(group).cast(kind).alias(group), "block").agg(rows.alias("rows"))
    return stage(
        blocks.select(
            group, "block", F.col("rows.class_id").alias("ids"), F.col("rows.copies").alias("copies"),
            F.col("rows.packed").alias("packed"),
        ),
        f"{folder}/blocks",
    )


def _sides(blocks: DataFrame, group: str, side: str) -> DataFrame:
    """The blocks with their columns named after the side they take in a tile."""
    return blocks.select(*[F.col(c).alias(f"{c}_{side}") for c in (group, "block", "ids", "copies", "packed")])


def _products(pair: pd.Series) -> np.ndarray:
    x, y = (np.frombuffer(b"".join(pair[f"packed_{s}"])).reshape(len(pair[f"ids_{s}"]), -1) for s in "ab")
    return x @ y.T


def _complete(classes: DataFrame, components: DataFrame, threshold: float, folder: str, tile: int = TILE) -> DataFrame:
    """(class_id, linked): copies of other classes linked to each class of a component.

    Links never leave a component, so every pair inside one is compared, block against block;
    a tile gives one number per class, not its pairs, and vectors travel packed, a block at a
    time.
    """
    members = components.withColumnRenamed("node", "class_id").join(classes.select("class_id", "unit", "copies"), "class_id")
    blocks = _blocks(members, "component", folder, tile)
    a, b = _sides(blocks, "component", "a"), _sides(blocks, "component", "b")
    pairs = a.join(b, (F.col("component_a") == F.col("component_b")) & (F.col("block_a") <= F.col("block_b")))

    def tally(frame: pd.DataFrame) -> pd.DataFrame:
        pair = frame.iloc[0]
        linked = _products(pair) >= threshold
        same = pair["block_a"] == pair["block_b"]
        if same:
            np.fill_diagonal(linked, False)
        made = [pd.DataFrame({"class_id": pair["ids_a"], "linked": linked @ np.asarray(pair["copies_b"])})]
        if not same:
            made.append(pd.DataFrame({"class_id": pair["ids_b"], "linked": linked.T @ np.asarray(pair["copies_a"])}))
        return pd.concat(made)

    counted = pairs.groupBy("component_a", "block_a", "block_b").applyInPandas(tally, "class_id long, linked long")
    return counted.groupBy("class_id").agg(F.sum("linked").alias("linked"))


def _dot(x: str, y: str) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)


def _angle(x: str, y: str) -> Column:
    return F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), _dot(x, y))))


def links_between(
    classes: DataFrame, components: DataFrame, threshold: float, folder: str, crowd: int = MOST_NEIGHBOURS, tile: int = TILE
) -> DataFrame:
    """(a, b): links between crowded components, whose vectors' lists are full of each other.

    A component of more than `crowd` classes is cut into cells by a few hyperplanes; a cell is
    a ball around one of its vectors. The descent goes on between the balls. Two balls can
    hold a link only if their centres are no further apart than both radii and the angle of
    the threshold; of such balls all vectors are compared, block against block, and a tile
    gives its best pair if that is a link. Vectors of smaller components have room in their
    lists, and what the descent finds for them stands.
    """
    sizes = components.groupBy("component").agg(F.count("*").alias("n")).filter(F.col("n") > crowd)
    if sizes.limit(2).count() < 2:
        return components.sparkSession.createDataFrame([], "a long, b long")
    members = (
        components.join(sizes.select("component"), "component").withColumnRenamed("node", "class_id")
        .join(classes.select("class_id", "label", "unit", "copies"), "class_id")
    )

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            code = np.zeros(len(frame), dtype=np.int64)
            widths = frame["unit"].map(len).to_numpy()
            for width in np.unique(widths):
                mine = np.flatnonzero(widths == width)
                planes = np.random.default_rng([7, int(width)]).standard_normal((int(width), CELL_BITS))
                code[mine] = (np.stack(frame["unit"].iloc[mine].to_list()) @ planes > 0) @ (1 << np.arange(CELL_BITS))
            yield frame.assign(code=code)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members.schema.fields)
    members = stage(members.mapInPandas(encode, f"{kinds}, code long"), f"{folder}/crowded")
    centres = members.groupBy("component", "code").agg(
        F.min_by(F.struct("class_id", "label", "unit"), F.xxhash64("class_id")).alias("centre")
    ).select("component", "code", F.col("centre.class_id").alias("cell"), F.col("centre.label").alias("label"), F.col("centre.unit").alias("centre"))
    centres = stage(centres, f"{folder}/centres")
    inside = members.join(centres.select("component", "code", "cell", "centre"), ["component", "code"])
    radii = inside.groupBy("cell").agg(F.max(_angle("unit", "centre")).alias("radius"))
    cells = stage(centres.join(radii, "cell"), f"{folder}/cells")
    widest = cells.agg(F.max("radius"), F.countDistinct("component")).first()
    if widest[1] < 2:
        return members.sparkSession.createDataFrame([], "a long, b long")
    reach = float(np.arccos(threshold))
    low = float(np.cos(min(np.pi, reach + 2 * widest[0])))
    nodes = stage(_nodes(cells.select(F.col("cell").alias("class_id"), "label", F.col("centre").alias("unit"))), f"{folder}/cell-nodes")
    near = descend(nodes, 0, low, f"{folder}/between", MOST_CELLS)
    ends = [
        cells.select(F.col("cell").alias(c), *[F.col(f).alias(f"{f}_{c}") for f in ("component", "centre", "radius")]) for c in "uv"
    ]
    met = near.join(ends[0], "u").join(ends[1], "v").filter(F.col("component_u") != F.col("component_v"))
    met = met.filter(_angle("centre_u", "centre_v") <= F.col("radius_u") + F.col("radius_v") + F.lit(reach + 1e-6))
    met = met.select(F.least("u", "v").alias("cell_a"), F.greatest("u", "v").alias("cell_b")).distinct()
    own = inside.select("class_id", "cell", "unit", "copies")
    blocks = _blocks(own, "cell", folder, tile)
    pairs = met.join(_sides(blocks, "cell", "a"), "cell_a").join(_sides(blocks, "cell", "b"), "cell_b")

    def best(frame: pd.DataFrame) -> pd.DataFrame:
        pair = frame.iloc[0]
        cos = _products(pair)
        i, j = np.unravel_index(np.argmax(cos), cos.shape)
        ends = sorted((int(pair["ids_a"][i]), int(pair["ids_b"][j])))
        return pd.DataFrame({"a": ends[:1], "b": ends[1:]} if cos[i, j] >= threshold else {"a": [], "b": []}, dtype="int64")

    return pairs.groupBy("cell_a", "block_a", "cell_b", "block_b").applyInPandas(best, "a long, b long")


def _nodes(classes: DataFrame) -> DataFrame:
    """(u, label, width, small): compact vectors of the classes."""

    def shrink(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for width, part in frame.groupby(frame["unit"].map(len)):
                yield pd.DataFrame({
                    "u": part["class_id"], "label": part["label"], "width": int(width),
                    "small": compact(np.stack(part["unit"].to_list())),
                })

    label = classes.schema["label"].dataType.simpleString()
    return classes.select("class_id", "label", "unit").mapInPandas(shrink, f"u long, label {label}, width int, small binary")


def audit_recall(
    classes: DataFrame, linked: DataFrame, components: DataFrame, threshold: float, audited: int = AUDITED
) -> float:
    """Share of the links of a bounded, hashed set of classes that were found, by brute force.

    Half of the set is drawn from all classes, half from those in crowded components.
    """
    crowded = components.groupBy("component").agg(F.count("*").alias("n")).filter(F.col("n") > MOST_NEIGHBOURS)
    inside = components.join(crowded.select("component"), "component").select(F.col("node").alias("class_id"))
    hashed = classes.select("class_id", "label", "unit").withColumn("place", F.xxhash64("class_id"))
    picked = sampled(hashed, "place", audited // 2).union(
        sampled(hashed.join(inside, "class_id", "left_semi"), "place", audited // 2)
    )
    queries = picked.select("class_id", "label", "unit").toPandas().drop_duplicates("class_id", ignore_index=True)
    if queries.empty:
        return 1.0
    units = queries["unit"].map(len)

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros(len(queries), dtype=np.int64)
        for frame in frames:
            for (label, width), part in frame.assign(width=frame["unit"].map(len)).groupby(["label", "width"]):
                asked = np.flatnonzero(((queries["label"] == label) & (units == width)).to_numpy())
                if not len(asked):
                    continue
                x = np.stack(queries["unit"].iloc[asked].to_list())
                near = x @ np.stack(part["unit"].to_list()).T >= threshold
                near &= queries["class_id"].to_numpy()[asked][:, None] != part["class_id"].to_numpy()[None, :]
                totals[asked] += near @ part["copies"].to_numpy()
        yield pd.DataFrame({"class_id": queries["class_id"], "there": totals})

    there = classes.select("class_id", "label", "unit", "copies").mapInPandas(search, "class_id long, there long")
    sums = (
        there.groupBy("class_id").agg(F.sum("there").alias("there"))
        .join(linked, "class_id", "left")
        .agg(F.sum("there"), F.sum(F.coalesce("linked", F.lit(0)))).first()
    )
    return sums[1] / sums[0] if sums[0] else 1.0


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    staging: str | None = None,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of equal, non-null labels and equal length are linked by a cosine, in doubles,
    of at least `threshold`. Null, empty and zero vectors and those with a null or
    non-finite component have no link. component_id is the smallest id reachable, itself
    included; kept marks it. Equal vectors are one class for the search and count as links
    to each other. Null ids never name a component; repeated rows are vectors of their own.
    Other columns are not read. An empty table gives no row.

    NN-descent proposes threshold edges, which are verified and joined to components. It goes
    on between components too crowded for their lists, until no link is left between them; all
    pairs inside a component are then compared exactly. A brute-force audit of a bounded
    set of vectors measures the recall; below RECALL the descent is repeated from other
    first lists and the edges are united, and if that does not help an error is raised.
    """
    folder = shared_folder(vectors.sparkSession, staging)
    rows = stage(prepared(vectors, id_col, vector_col, label_col), f"{folder}/vectors")
    sound = rows.filter(F.col("unit").isNotNull())
    classes = stage(
        sound.groupBy("label", "x").agg(
            F.min("uid").alias("class_id"), F.count("*").alias("copies"), F.first("unit").alias("unit"),
            F.min("vec_id").alias("first_id"),
        ),
        f"{folder}/classes",
    )

    nodes = stage(_nodes(classes), f"{folder}/nodes")
    edges = None
    for attempt in range(ATTEMPTS):
        own = f"{folder}/attempt-{attempt}"
        found = _verified(descend(nodes, attempt, threshold, own), classes, threshold)
        edges = stage(found if edges is None else edges.union(found).distinct(), f"{own}/edges")
        components = stage(connected_components(edges, own, FEW_LINKS), f"{own}/components")
        for turn in count():
            more = stage(links_between(classes, components, threshold, f"{own}/between-{turn}"), f"{own}/links-{turn}")
            if more.isEmpty():
                break
            edges = stage(edges.union(more).distinct(), f"{own}/more-edges-{turn}")
            components = stage(connected_components(edges, f"{own}/joined-{turn}", FEW_LINKS), f"{own}/components-{turn}")
        linked = stage(_complete(classes, components, threshold, own), f"{own}/linked")
        recall = audit_recall(classes, linked, components, threshold)
        if recall >= RECALL:
            break
    else:
        raise RuntimeError(f"recall {recall:.3f} of the audited vectors after {ATTEMPTS} descents, {RECALL} is asked for")
    grouped = (
        classes.join(components.withColumnRenamed("node", "class_id"), "class_id", "left")
        .join(linked, "class_id", "left")
        .select(
            "label", "x", "first_id", F.coalesce("component", "class_id").alias("component"),
            (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        )
    )
    smallest = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = grouped.join(smallest, "component").select("label", "x", "n_links", "component_id")
    placed = sound.select("vec_id", "label", "x").join(known, ["label", "x"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(F.col("unit").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return placed.union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )

import math

import numpy as np
import pytest

from threatlens.llm import embedding_dedup as ed


def slow(rows, threshold=0.93):
    """(links, smallest id reachable) of each row, all pairs compared in doubles."""
    units = []
    for _, v, label in rows:
        good = v is not None and len(v) > 0 and label is not None and all(x is not None and math.isfinite(x) for x in v)
        x = np.array(v, dtype=float) if good else None
        units.append(x / np.linalg.norm(x) if good and np.linalg.norm(x) > 0 else None)
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= threshold:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted((str(d), n, str(least.get(find(i)))) for i, ((d, *_), n) in enumerate(zip(rows, links, strict=True)))


def check(frame, rows):
    made = ed.near_duplicates(frame).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in made) == slow(rows)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in made)


def test_all_embeddings_as_brute_force(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    check(frame, [(r.vec_id, r.embedding, r.label) for r in frame.collect()])


def test_clusters_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = []

    def add(v, label, vec_id=-1):
        rows.append((len(rows) if vec_id == -1 else vec_id, None if v is None else [None if x is None else float(x) for x in v], label))

    for label, size in ((0, 120), (1, 30), (2, 5)):
        centre = rng.standard_normal(24)
        for _ in range(size):
            add(centre + 0.1 * rng.standard_normal(24), label)
    for _ in range(150):
        add(rng.standard_normal(24), int(rng.integers(3)))
    copy = rng.standard_normal(24)
    for label in (0, 0, 0, 1, None):
        add(copy, label)
    add(copy * 3, 0)
    add(copy, 0, None)
    add(copy[:7], 0)
    add(copy[:7], 0)
    for odd in (None, [], [0.0] * 24, [None] * 24, [math.nan] * 24, [math.inf] + [1.0] * 23):
        add(odd, 0)
    add(rng.standard_normal(24), 0, 3)
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, uid int, unit int")
    rounded = [(d, None if v is None else [None if x is None else float(np.float32(x)) for x in v], n) for d, v, n in rows]
    check(frame, rounded)


def test_no_vectors(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert ed.near_duplicates(frame).collect() == []


def test_lists_that_are_full_of_links_grow(spark):
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(16)
    rows = [(i, (centre + 0.03 * rng.standard_normal(16)).tolist(), 0) for i in range(90)]
    vectors = ed.prepared(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), "vec_id", "embedding", "label")
    small = ed.compact(np.array([r.unit for r in vectors.orderBy("vec_id").collect()]))
    nodes = spark.createDataFrame([(i, 0, 16, s) for i, s in enumerate(small)], "u long, label int, width int, small binary")
    from threatlens.session import shared_folder

    sizes = ed.descend(nodes, 0, 0.93, shared_folder(spark)).groupBy("u").count().collect()
    assert max(r["count"] for r in sizes) > ed.NEIGHBOURS


def crowded(centres, noise, rng, size=100):
    """Groups of near-equal vectors around each of the centres, and random ones."""
    rows = [c + noise * rng.standard_normal(c.shape[0]) for c in centres for _ in range(size)]
    rows += list(rng.standard_normal((300, centres[0].shape[0])))
    return [(i, [float(x) for x in v], 0) for i, v in enumerate(rows)]


def turned(first, other, degrees):
    """The unit vector so far from `first`, towards `other`."""
    first = first / np.linalg.norm(first)
    other = other - (other @ first) * first
    other /= np.linalg.norm(other)
    return np.cos(np.radians(degrees)) * first + np.sin(np.radians(degrees)) * other


def test_links_between_crowded_groups_are_found(spark):
    rng = np.random.default_rng(11)
    first = turned(rng.standard_normal(48), rng.standard_normal(48), 0)
    rows = crowded([first, turned(first, rng.standard_normal(48), 18.6)], 0.006, rng)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    check(frame, rows)
    made = {r.vec_id: r for r in ed.near_duplicates(frame).collect()}
    assert all((made[i].n_links, made[i].component_id) == (199, 0) for i in range(200))


def test_a_chain_of_crowded_groups_is_one_component(spark):
    rng = np.random.default_rng(12)
    centres = [turned(rng.standard_normal(48), rng.standard_normal(48), 0)]
    for _ in range(4):
        centres.append(turned(centres[-1], rng.standard_normal(48), 18.6))
    rows = crowded(centres, 0.006, rng, 70)
    check(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), rows)


def test_a_recall_below_the_bound_raises(spark, monkeypatch):
    rng = np.random.default_rng(13)
    rows = crowded([rng.standard_normal(16)], 0.02, rng, 30)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(ed, "descend", lambda nodes, *args: nodes.sparkSession.createDataFrame([], "u long, v long, cos float"))
    with pytest.raises(RuntimeError):
        ed.near_duplicates(frame)

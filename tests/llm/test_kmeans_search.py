import math
from collections import defaultdict

import numpy as np

from threatlens.llm import kmeans_search as ks
from threatlens.llm import queries

ASKED = "vec_id % 20 = 0"


def slow(rows, k):
    """Sorted lists of (score, vec_id) of each query row, over rows (vec_id, vector)."""
    sound = [
        (i, d, np.array(v, dtype=float)) for i, (d, v) in enumerate(rows)
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    made = []
    for i, d, q in sound:
        if d is not None and d % 20 == 0:
            others = [(-float((q * x).sum()), e is None, e) for j, e, x in sound if j != i and len(x) == len(q)]
            best = sorted(others, key=lambda o: (o[0], o[1], o[2] or 0))[:k]
            made.append((d, [(e, -s) for s, _, e in best]))
    return made


def lists(found):
    made = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        made[r.query_id].append((r["rank"], r.vec_id, r.score))
    return made


def test_recall_against_all_rows(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    made, hits, total = lists(queries.op12_kmeans_search(spark, sf_dir).collect()), 0, 0
    for query, best in slow(rows, 20):
        assert [r for r, _, _ in made[query]] == list(range(1, 21))
        assert made[query] == sorted(made[query], key=lambda m: (-m[2], m[1]))
        exact = dict(best)
        assert all(abs(exact[e] - s) < 1e-12 for _, e, s in made[query] if e in exact)
        hits, total = hits + sum(e in exact for _, e, _ in made[query]), total + 20
    assert hits / total >= 0.9


def test_small_table_with_odd_vectors_is_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(70)]
    copy = rng.standard_normal(6).tolist()
    rows += [(i, copy) for i in range(100, 160)] + [(None, copy), (100, copy), (300, (2 * np.array(copy)).tolist())]
    rows += [(400, [1.0, 2.0]), (401, [3.0, -1.0]), (420, [5.0])]
    rows += [(440, None), (460, []), (480, [0.0] * 6), (500, [None] * 6), (520, [math.nan] * 6), (540, [math.inf] * 6)]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, place int, leaf int")
    made = ks.search(frame, ASKED, k=7).rows.collect()
    found = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in made)
    expected = sorted(
        (d, n + 1, e, round(s, 9)) for d, best in slow(rows, 7) for n, (e, s) in enumerate(best)
    )
    assert found == expected


def test_tree_widens_until_recall_and_keeps_every_vector(spark):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((40, 16)) * 3
    vectors = np.concatenate([c + 0.3 * rng.standard_normal((60, 16)) for c in centres])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    found = ks.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), ASKED)
    tree = ks.grow(vectors, 1.0)
    leaves = {leaf for leaf, below in zip(tree.leaf, tree.children) if not below}
    assert len(leaves) > 16 and set(tree.assign(vectors)) <= leaves
    assert set(tree.visits(tree.centres @ vectors[0])) == leaves
    assert found.recall >= ks.RECALL and found.visits < len(leaves) / 2
    made = lists(found.rows.collect())
    share = [len({e for _, e, _ in made[d]} & {e for e, _ in best}) / 20 for d, best in slow(rows, 20)]
    assert np.mean(share) >= 0.9


def test_no_vectors_and_no_queries(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ks.search(empty, ASKED).rows.collect() == []
    some = spark.createDataFrame([(1, [1.0, 2.0]), (3, [2.0, 1.0])], "vec_id long, embedding array<double>")
    assert ks.search(some, ASKED).rows.collect() == []
    alone = spark.createDataFrame([(20, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert ks.search(alone, ASKED).rows.collect() == []

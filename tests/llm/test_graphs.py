import random
from collections import Counter

from threatlens.llm.graphs import connected_components, ranked
from threatlens.session import shared_folder


def test_components_of_paths_stars_and_random_links(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 60)]
    links += [(rng.randrange(500, 600), rng.randrange(500, 600)) for _ in range(70)]
    links += [(7, 7), (1, 0), (0, 1)]
    root = {n: n for pair in links for n in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    frame = spark.createDataFrame([*links, (None, 4)], "a long, b long")
    linked = {n for a, b in links if a != b for n in (a, b)}
    for few in (0, 40, 10**6):
        made = dict(connected_components(frame, shared_folder(spark), few).collect())
        assert made == {n: find(n) for n in linked}


def test_no_links_no_components(spark):
    none = spark.createDataFrame([(1, 1)], "a long, b long")
    assert connected_components(none, shared_folder(spark)).count() == 0


def test_ranks_of_a_hot_group(spark):
    rows = [("hot", i % 50, i) for i in range(900)] + [("cold", i, i) for i in range(9)] + [(None, 1, i) for i in range(4)]
    made = ranked(spark.createDataFrame(rows, "g string, o long, x long").repartition(7), "g", ["o", "x"], shared_folder(spark)).collect()
    by = Counter(r.g for r in made)
    for g, n in by.items():
        if g is not None:
            own = sorted((r.rank, r.o, r.x) for r in made if r.g == g)
            assert [r[0] for r in own] == list(range(n))
            assert [r[1:] for r in own] == sorted(r[1:] for r in own)
    assert by["hot"] == 900 and by["cold"] == 9

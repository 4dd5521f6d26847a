import itertools

import numpy as np
import pytest

from threatlens.llm import decontamination as dc


def best_stretch(equal, least):
    """(equal words, -start) of the best stretch by trying all of them."""
    best = None
    for a in range(len(equal)):
        for b in range(a + least, len(equal) + 1):
            same = sum(equal[a:b])
            if same * 5 >= (b - a) * 4 and (best is None or same > best):
                best = same
    return best


def slow(documents, items):
    found = {}
    for d, text in documents:
        words = dc.words_of(text)
        for i, item in items:
            code = dc.words_of(item)
            if i is None or len(code) < dc.ITEM_WORDS:
                continue
            least = min(dc.MATCH_WORDS, len(code))
            here = {w: [k for k, x in enumerate(words) if x == w] for w in set(code)}
            lines = {k - j for j, w in enumerate(code) for k in here[w]}
            for line in lines:
                equal = [0 <= line + j < len(words) and words[line + j] == w for j, w in enumerate(code)]
                if sum(equal) * 5 >= least * 4:
                    same = best_stretch(equal, least)
                    if same:
                        found[d, i] = max(same, found.get((d, i), 0))
    return found


def test_masks_meet_every_pair_of_exchanged_words():
    for bad in itertools.combinations(range(dc.MATCH_WORDS), 2):
        assert any(
            not any(mask[b - at] == "1" for b in bad if 0 <= b - at < len(mask))
            for mask in dc.MASKS
            for at in range(dc.MATCH_WORDS - len(mask) + 1)
        ), bad


@pytest.mark.parametrize("block_words", [250_000, 300])
def test_all_documents_as_brute_force(spark, sf_dir, block_words):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    made = dc.overlaps(docs, items, ["doc_id"], block_words=block_words)
    made = {(r.doc_id, x.item_id) for r in made.collect() for x in r.overlaps}
    expected = slow([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert made == set(expected) and made


def test_exchanged_words_short_items_and_odd_rows(spark, odd_documents, no_documents):
    long_item = " ".join(f"w{i}" for i in range(40))
    changed = " ".join("other" if i % 7 == 3 else f"W{i}," for i in range(40))
    broken = " ".join("other" if i % 3 == 0 else f"w{i}" for i in range(40))
    items = [(1, long_item), (2, "five words make an item"), (3, "too short"), (None, long_item), (4, None), (1, long_item), (5, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = [
        (10, f"before {changed} after"), (11, broken), (12, "Five words, make an ITEM!"), (13, "too short"),
        (14, None), (15, ""), (10, f"before {changed} after"), (None, long_item),
        (16, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"), (17, " ".join(f"w{i}" for i in range(20, 33))),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = dc.contaminated(frame, benchmark).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in rows) == [
        ("10", 1), ("10", 1), ("12", 2), ("17", 1), ("None", 1)
    ]
    first = next(r for r in rows if r.doc_id == 10)
    assert (first.start, first.words, first.equal) == (1, 40, 34)
    assert dc.contaminated(odd_documents, benchmark).collect() == []
    assert dc.contaminated(no_documents, benchmark).collect() == []
    assert dc.contaminated(frame, benchmark.limit(0)).collect() == []


def test_a_match_never_joins_two_texts():
    words = [f"w{i}" for i in range(80)]
    index = dc.SeedIndex.of([(1, " ".join(words))])
    found = index.search([" ".join(words[:40]), " ".join(words[40:])])
    assert [[x[1:3] for x in f] for f in found] == [[(0, 40)], [(0, 40)]]
    assert np.all(dc.seed_hashes(np.zeros(2, np.uint64), "11111") == [])


def test_a_benchmark_of_a_million_words_is_joined_by_a_fixed_plan(spark):
    rng = np.random.default_rng(5)
    items = [(i, " ".join(f"w{x}" for x in rng.integers(0, 50_000, 100))) for i in range(10_000)]
    docs = [(d, " ".join(f"w{x}" for x in rng.integers(0, 50_000, 60))) for d in range(200)]
    planted = {}
    for d, item in enumerate(rng.integers(0, 10_000, 40).tolist()):
        words = items[item][1].split()[10:50]
        words[5] = words[20] = "exchanged"
        planted[1000 + d] = item
        docs.append((1000 + d, f"some {' '.join(words)} text"))
    docs.append((2000, None))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    asked = lambda n: spark.createDataFrame(items[:n], "item_id long, text string")
    made = dc.overlaps(frame, asked(10_000), ["doc_id"])
    assert {r.doc_id: [x.item_id for x in r.overlaps] for r in made.collect() if r.overlaps} == {d: [i] for d, i in planted.items()}
    assert made.count() == len(docs)
    plans = [dc.overlaps(frame, asked(n), ["doc_id"])._jdf.queryExecution().executedPlan().toString() for n in (3_000, 10_000)]
    assert len({p.count("MapInArrow") for p in plans}) == 1

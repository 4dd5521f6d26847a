import itertools
import random
from collections import Counter

import pytest

from threatlens.llm import paragraph_dedup as pd_
from threatlens.llm import queries


def slow(documents, least_words, similarity=0.8):
    """All pairs of paragraphs compared; sorted (doc_id, paragraph, start, end, group, removed)."""
    rows = []
    for row, (d, text) in enumerate(documents):
        at = 0
        for n, line in enumerate((text or "").split("\n")):
            words = line.lower().split()
            if len(words) >= max(least_words, 1):
                rows.append((d, n, at, at + len(line), pd_.shingles_of(words), tuple(words), row))
            at += len(line) + 1
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = rows[i][4], rows[j][4]
        same = len(a & b)
        if rows[i][5] == rows[j][5] or same >= similarity * (len(a) + len(b) - same):
            root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    return [[rows[i] for i in members] for members in groups.values() if len({rows[i][6] for i in members}) > 1]


def check(made, documents, least_words):
    expected = slow(documents, least_words)
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3])
    assert sorted([(r.doc_id, r.paragraph, r.start, r.end) for r in made], key=order) == sorted(
        [r[:4] for g in expected for r in g], key=order
    )
    by = {}
    for r in made:
        by.setdefault(r.component_id, []).append(r)
    key = lambda rows: sorted((str(r[0]), r[1], r[2]) for r in rows)
    assert sorted(key([(r.doc_id, r.paragraph, r.start) for r in g]) for g in by.values()) == sorted(key(g) for g in expected)
    for g in by.values():
        kept = [r for r in g if not r.removed]
        assert len(kept) == 1
        assert order((kept[0].doc_id, kept[0].paragraph, 0, 0))[:3] == min(order((r.doc_id, r.paragraph, 0, 0))[:3] for r in g)


@pytest.mark.parametrize("least_words", [50, 8])
def test_all_documents_as_brute_force(spark, sf_dir, least_words):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made = pd_.repeated_paragraphs(docs, least_words=least_words).collect()
    check(made, [(r.doc_id, r.text) for r in docs.collect()], least_words)


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(400)}" for _ in range(90)]
    docs = []
    for i in range(150):
        words = base.copy()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(90)] = f"x{rng.randrange(99)}"
        docs.append((i, " ".join(words) + "\nshort line\n" + " ".join(f"u{i}-{k}" for k in range(60))))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    check(pd_.repeated_paragraphs(frame).collect(), docs, 50)


def test_odd_rows(odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    check(pd_.repeated_paragraphs(odd_documents, least_words=3).collect(), rows, 3)
    assert pd_.repeated_paragraphs(no_documents).collect() == []


def test_bands_meet_the_recall():
    bands = pd_.bands_for()
    assert (1 - 0.8**pd_.ROWS_PER_BAND) ** bands <= pd_.MISSED < (1 - 0.8**pd_.ROWS_PER_BAND) ** (bands - 1)


def cut_up(text):
    return [tuple(map(int, s)) for s in zip(*pd_.segments_of(text, pd_._Numbers()), strict=True)]


def slow_passages(documents, least_words):
    """Runs of segments that occur in several rows, by plain counting."""
    cut = [(d, cut_up(t)) for d, t in documents]
    counts = Counter(x for _, segments in cut for x in {s[3] for s in segments})
    made = []
    for d, segments in cut:
        run = []
        for s in [*segments, None]:
            if s and counts[s[3]] > 1:
                run.append(s)
            elif run:
                if sum(x[2] for x in run) >= least_words:
                    made.append((d, run[0][0], run[-1][1], sum(x[2] for x in run)))
                run = []
    return made


def test_passages_as_plain_counting(spark, sf_dir, odd_documents, no_documents):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for frame in (docs, odd_documents):
        made = pd_.repeated_passages(frame).collect()
        rows = [(r.doc_id, r.text) for r in frame.collect()]
        assert sorted(map(str, [(r.doc_id, r.start, r.end, r.words) for r in made])) == sorted(map(str, slow_passages(rows, pd_.PASSAGE_WORDS)))
    assert pd_.repeated_passages(no_documents).collect() == []


def test_planted_passages_are_found_inside_other_text(spark):
    rng = random.Random(12)

    def prose(n):
        return " ".join(rng.choice("abcdefghij") + str(rng.randrange(3000)) for _ in range(n))

    passages = [prose(rng.randrange(51, 90)) for _ in range(40)]
    stock = prose(13)
    docs = [(i, f"{prose(30)} {stock}\n{prose(40)}") for i in range(200)]
    planted = {}
    for i, passage in enumerate(passages):
        for k in range(3):
            planted[1000 + 3 * i + k] = passage
            docs.append((1000 + 3 * i + k, f"{prose(rng.randrange(60))} {passage} {prose(rng.randrange(60))}"))
    made = pd_.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    texts = dict(docs)
    assert not [r for r in made if r.doc_id < 1000]
    assert len({r.doc_id for r in made}) >= 0.98 * len(planted)
    for r in made:
        assert texts[r.doc_id][r.start : r.end] in planted[r.doc_id]
    kept = [r.doc_id for r in made if not r.removed]
    assert kept and all(d % 3 == 1000 % 3 for d in kept)


def test_segments_cover_every_word():
    for text in ("a b  c\n\n d\te" * 30, "", " \n ", None, "x\x85y\x1cz w " * 9, "one"):
        made = cut_up(text)
        assert [w for s, e, _, _ in made for w in text[s:e].split()] == (text or "").split()
        assert all(len(text[s:e].split()) == n for s, e, n, _ in made)


def test_passages_side_by_side_keep_one_copy(spark):
    rng = random.Random(21)

    def prose(n):
        return " ".join(rng.choice("abcdefghij") + str(rng.randrange(3000)) for _ in range(n))

    licence, stock = prose(30), prose(9)
    fresh = [prose(40) for _ in range(12)]
    docs = [(0, f"{licence}\n{prose(20)}"), (1, f"{prose(20)}\n{stock}\n{prose(20)}")]
    for i, passage in enumerate(fresh):
        docs += [(10 + 2 * i + k, f"{prose(5 + k)}\n{licence}\n{passage}\n{stock}\n{prose(7)}") for k in range(2)]
    rows = pd_.passage_copies(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).collect()
    removed = {(r.doc_id, s) for r in rows if r.removed for s in range(r.start, r.end)}
    repeated, left = Counter(), Counter()
    for d, text in docs:
        for start, _, _, digest in cut_up(text):
            repeated[digest] += 1
            left[digest] += (d, start) not in removed
    again = [digest for digest, n in repeated.items() if n > 1]
    assert len(again) > 50 and all(left[digest] == 1 for digest in again)
    assert Counter(r.component_id for r in rows if not r.removed) == dict.fromkeys({r.component_id for r in rows}, 1)


def test_the_copy_that_stays_is_in_no_removed_paragraph(spark):
    words = [f"w{i}" for i in range(80)]
    changed = [*words[:30], "x30", *words[31:]]
    docs = [(2, " ".join(changed)), (1, " ".join(words)), (3, f"{' '.join(f'u{i}' for i in range(90))} {' '.join(changed)}")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    lines = pd_.repeated_paragraphs(frame).collect()
    assert sorted((r.doc_id, r.removed) for r in lines) == [(1, False), (2, True)]
    gone = spark.createDataFrame([(r.row, r.paragraph) for r in lines if r.removed], "row long, paragraph long")
    rows = pd_.passage_copies(frame, gone=gone).collect()
    text = dict(docs)
    removed = {r.doc_id: text[r.doc_id][r.start : r.end] for r in rows if r.removed}
    assert "x30" not in removed.get(3, "") and any(r.doc_id == 2 and r.removed for r in rows)


def test_the_query_compares_short_lines_and_lines_of_one_row(spark, tmp_path):
    near = [f"n{i}" for i in range(24)]
    docs = [
        (1, "five words stand right here\n" + " ".join(near)),
        (2, "own line\nfive words stand right here\n" + " ".join([*near, "more"])),
        (3, "said twice in one row\nother words are in here\nsaid twice in one row"),
    ]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = [r for r in queries.op6_paragraphs(spark, str(tmp_path)).collect() if r.kind == "paragraph"]
    assert sorted((r.doc_id, r.words, r.removed) for r in rows) == [
        (1, 5, False), (1, 24, False), (2, 5, True), (2, 25, True), (3, 5, False), (3, 5, True)
    ]


def test_the_filter_before_the_exact_check_loses_no_pair(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(400):
        n = rng.randrange(4, 400)
        a = {f"s{rng.randrange(10**6)}" for _ in range(n)}
        b = set(rng.sample(sorted(a), len(a) - rng.randrange(len(a) // 9 + 1))) | {f"t{i}" for i in range(rng.randrange(len(a) // 9 + 1))}
        if len(a & b) >= 0.8 * len(a | b):
            pairs.append((len(a), pd_.signature(a, 20)[1], len(b), pd_.signature(b, 20)[1]))
    frame = spark.createDataFrame(pairs, "shingles_a long, sketch_a array<long>, shingles_b long, sketch_b array<long>")
    assert len(pairs) > 200 and frame.filter(pd_._may_be_similar(0.8)).count() == len(pairs)
    assert pd_.bands_for() == pd_.bands_for(missed=1e-3)


def test_small_buckets_need_no_leaders(spark, monkeypatch):
    rng, rounds = random.Random(3), []
    made = pd_._with_leaders
    monkeypatch.setattr(pd_, "_with_leaders", lambda *a: rounds.append(a) or made(*a))
    docs = []
    for g in range(60):
        words = [f"g{g}w{rng.randrange(900)}" for _ in range(60)]
        docs += [(5 * g + i, " ".join([*words[: 55 + i], f"x{i}"])) for i in range(5)]
    check(pd_.repeated_paragraphs(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs, 50)
    assert not rounds


def test_words_are_those_of_split_and_lower():
    odd = ["İstanbul x  y\n ΑΣ ΟΔΟΣ. a\x1cb　c\x85d\n\n zz", "", " \n\t ", "ha " * 300, "one\n\ntwo  three "]
    numbers = {}
    words = pd_._words(odd)
    at = 0
    for text in odd:
        for word in text.split():
            assert text[words.starts[at] : words.ends[at]] == word
            assert numbers.setdefault(word.lower(), words.hashes[at]) == words.hashes[at]
            at += 1
    assert at == len(words.hashes) and len(set(numbers.values())) == len(numbers)
    assert words.line_words.tolist() == [len(line.split()) for text in odd for line in text.split("\n")]

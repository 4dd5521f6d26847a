import random
import re
import zlib
from collections import Counter

import duckdb

from threatlens.llm import queries
from threatlens.llm import spelling_variants as sv


def test_query_equals_sql(spark, sf_dir):
    made = queries.op11_spelling(spark, sf_dir)
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    expected = connection.sql(queries.oracle_sql()["op11_spelling"])
    assert made.columns == expected.columns
    assert sorted(map(str, map(tuple, made.collect()))) == sorted(map(str, expected.fetchall()))


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def slow(counts):
    form, made = {}, {}
    for w, n in counts.items():
        others = [(-m, v) for v, m in counts.items() if near(w, v)]
        best = min(others, default=None)
        form[w] = best[1] if best and -best[0] >= 2 * n else None
        made[w] = (n, len(others))
    rows = []
    for w, (n, n_near) in made.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, n_near, counts[form[w]] if form[w] is not None else None))
    return sorted(rows, key=str)


def check(spark, counts):
    frame = spark.createDataFrame([(w, n, 1, 2) for w, n in counts.items()], "word string, n long, place int, at int")
    assert sorted(map(tuple, sv.spelling_forms(frame).collect()), key=str) == slow(counts)


def test_random_words_as_all_pairs(spark):
    rng = random.Random(3)
    words = {"".join(rng.choices("abéÿ𝛼", k=rng.randrange(0, 7))): rng.randrange(1, 40) for _ in range(500)}
    check(spark, words)


def test_chains_ties_runs_and_long_words(spark):
    chain = {"a" * k: 2**k for k in range(1, 24)}
    check(spark, chain | {"b" * 3000: 5, "b" * 3001: 10, "b" * 2999 + "c": 10} | {f"letter{c}": 7 for c in "abcdefghij"} | {"letter": 14})


def test_no_words_and_null_words(spark):
    frame = spark.createDataFrame([(None, 4), ("alone", None), ("alone", 3)], "word string, n long")
    assert [tuple(r) for r in sv.spelling_forms(frame).collect()] == [("alone", None, "alone", 3, 0, None)]
    assert sv.spelling_forms(frame.limit(0)).collect() == []


def test_odd_documents_are_counted_and_damaged(spark, odd_documents, no_documents):
    counts = Counter()
    for r in odd_documents.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{word}".encode())
            counts[word[: h % len(word)] + word[h % len(word) + 1 :] if h % 97 == 0 else word] += 1
    assert {r.word: r.n for r in sv.words_of(odd_documents).collect()} == counts
    assert sv.words_of(no_documents).collect() == []
    many = spark.createDataFrame([(i, f"W{'ord' * (i % 50)}") for i in range(3000)], "doc_id long, text string")
    assert any("ord" * 3 not in r.word and r.n < 5 for r in sv.words_of(many).collect())

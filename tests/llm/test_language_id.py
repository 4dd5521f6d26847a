import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from threatlens.llm import language_id as li
from threatlens.llm import queries

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return li.Pieces.load(PATH)


def segmentations(word, known):
    """All ways to cut a word into pieces; single letters may be unknown."""
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if n == 1 or word[:n] in known:
            for rest in segmentations(word[n:], known):
                yield [word[:n], *rest]


def test_forward_sums_all_segmentations(pieces):
    at = {n: i for i, n in enumerate(pieces.names)}
    rng = np.random.default_rng(0)
    p = np.vstack([rng.random((len(at), 2)) / len(at), [[li.UNKNOWN_LETTER] * 2]])
    words = ["the", "thonation", "straße", "élève", "字x", "a"]
    counts = np.array([3.0, 1, 2, 1, 1, 5])
    made, used = li.forward(pieces, p, words), li.expected_counts(pieces, p[:, 1], words, counts)
    expected = np.zeros(len(p))
    for i, word in enumerate(words):
        ways = [[at.get(x, len(at)) for x in s] for s in segmentations("▁" + word, at)]
        weights = np.array([math.prod(p[w, 1]) for w in ways])
        assert made[i, 1] == pytest.approx(math.log(weights.sum()))
        assert made[i, 0] == pytest.approx(math.log(sum(math.prod(p[w, 0]) for w in ways)))
        for way, weight in zip(ways, weights / weights.sum(), strict=True):
            for piece in way:
                expected[piece] += counts[i] * weight
    assert used == pytest.approx(expected)


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = li.train(docs.filter(li.fold() != 1), PATH)
    made = li.identify(docs, model, ["doc_id", "lang"]).collect()
    held_out = [r for r in made if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(made) == docs.count()
    assert sum(r.lang == r.lang_pred for r in held_out) >= 0.97 * len(held_out)
    assert all(0 <= r.score <= 1 for r in made)


def test_odd_rows(spark, sf_dir, odd_documents, no_documents):
    model = li.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), PATH)
    made = li.identify(odd_documents, model, ["doc_id", "text", "label"]).collect()
    assert len(made) == odd_documents.count()
    for r in made:
        letters = any(map(str.isalpha, r.text or ""))
        assert (r.lang_pred != li.UNKNOWN) == letters
        assert letters or r.score == 0
    assert li.identify(no_documents, model, ["doc_id"]).collect() == []


def test_without_labels_everything_is_unknown(no_documents, odd_documents):
    model = li.train(no_documents, PATH)
    assert model.languages == []
    assert {(r.lang_pred, r.score) for r in li.identify(odd_documents, model, ["doc_id"]).collect()} == {("und", 0.0)}


def test_the_sample_is_bounded(spark):
    rows = [(i, "wort " * 3, "de") for i in range(300)] + [(i, "word", "en") for i in range(300, 320)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = li._sample(docs, "doc_id", "lang", 50).groupBy("lang").count().collect()
    assert dict(map(tuple, sample)) == {"de": 50, "en": 20}


def plain_model(texts, known):
    """Piece probabilities of each language by expectation maximisation, word by word."""
    counts = {lang: Counter(w for t in some for w in li.words_of(t)) for lang, some in texts.items()}
    longest, model = max(map(len, known)), {}

    def arcs(word):
        marked = "▁" + word
        for i in range(len(marked)):
            for j in range(i + 1, min(len(marked), i + longest) + 1):
                if marked[i:j] in known or j == i + 1:
                    yield i, j, marked[i:j]

    def forward(word, p):
        total = [1.0] + [0.0] * (len(word) + 1)
        for i, j, piece in arcs(word):
            total[j] += total[i] * p.get(piece, li.UNKNOWN_LETTER)
        return total

    for lang, words in counts.items():
        p = dict.fromkeys(known, 1 / len(known))
        for _ in range(li.ROUNDS):
            used = Counter()
            for word, n in words.items():
                total, back = forward(word, p), [0.0] * (len(word) + 1) + [1.0]
                ways = list(arcs(word))
                for i, j, piece in reversed(ways):
                    back[i] += p.get(piece, li.UNKNOWN_LETTER) * back[j]
                for i, j, piece in ways:
                    used[piece] += n * total[i] * p.get(piece, li.UNKNOWN_LETTER) * back[j] / total[-1]
            mass = sum(used[x] + li.SMOOTHING for x in known)
            p = {x: (used[x] + li.SMOOTHING) / mass for x in known}
        model[lang] = p
    cache = {lang: {} for lang in model}

    def score(text):
        sums = {}
        for lang, p in model.items():
            for w in li.words_of(text):
                if w not in cache[lang]:
                    cache[lang][w] = math.log(forward(w, p)[-1])
            sums[lang] = sum(cache[lang][w] for w in li.words_of(text))
        best = max(sums, key=lambda k: (sums[k], [-ord(c) for c in k]))
        return best, 1 / sum(math.exp(v - sums[best]) for v in sums.values())

    return score


def test_the_whole_query_as_plain_python(spark, tmp_path, pieces):
    docs = [r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if len(r.text or "") < 1500][:120]
    rows = [(r.doc_id, r.text, r.lang) for r in docs] + [(10_001, None, "de"), (10_002, "12 !", "fr"), (10_003, "und noch", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    texts = {}
    for d, text, lang in rows:
        if zlib.crc32(str(d).encode()) % 3 != 1 and text is not None and lang is not None:
            texts.setdefault(lang, []).append(text)
    texts = {lang: some for lang, some in texts.items() if any(map(li.words_of, some))}
    score, known = plain_model(texts, set(pieces.names)), dict((d, t) for d, t, _ in rows)
    made = queries.op5_language_id(spark, str(tmp_path)).collect()
    assert len(made) == len(rows)
    for r in made:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if any(map(str.isalpha, known[r.doc_id] or "")):
            lang, posterior = score(known[r.doc_id])
            assert r.score == pytest.approx(posterior, abs=1e-6)
            assert r.lang_pred == lang or posterior < 0.51
        else:
            assert (r.lang_pred, r.score) == ("und", 0.0)

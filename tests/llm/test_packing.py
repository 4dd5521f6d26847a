import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from threatlens.llm.packing import fill, pack_documents, plan_windows
from threatlens.llm.tokens import WordBpe

PATH = public_tokenizers.path("word_bpe_49k.json")


def reference_ids(text):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def check(pieces, docs, ids=True):
    expected = Counter()
    for d, t in docs:
        whole = reference_ids(t)
        for s in range(0, len(whole), 4096):
            expected[d, s, tuple(whole[s : s + 4096]), len(whole)] += 1
    by_crc = Counter((d, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes()), n) for (d, s, x, n), k in expected.items() for _ in range(k))
    assert Counter((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces) == by_crc
    if ids:
        assert Counter((p.doc_id, p.start, tuple(np.frombuffer(p.ids, "<u4").tolist()), p.doc_tokens) for p in pieces) == expected
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    return len(sequences)


def test_fill_is_the_best_sum():
    rng = random.Random(5)
    for _ in range(60):
        counts = {rng.randrange(1, 40): rng.randrange(1, 3) for _ in range(4)}
        room = rng.randrange(0, 90)
        used = fill(counts, room)
        assert all(0 < k <= counts[n] for n, k in used.items())
        items = [n for n, c in counts.items() for _ in range(c)]
        sums = {0}
        for n in items:
            sums |= {s + n for s in sums}
        assert sum(n * k for n, k in used.items()) == max(s for s in sums if s <= room)


def test_windows_use_up_the_counts():
    counts = {n: 1 + n % 7 for n in range(1, 60)} | {33: 100_000, 100: 3}
    total = Counter()
    for repeats, window in plan_windows(counts, 100):
        assert sum(n * k for n, k in window.items()) <= 100
        total.update({n: repeats * k for n, k in window.items()})
    assert total == counts


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = pack_documents(docs, PATH).collect()
    sequences = check(pieces, [(r.doc_id, r.text) for r in docs.collect()])
    assert sequences <= 1 + sum(p.length for p in pieces) / 4096 + 1


def test_odd_rows(odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    check(pack_documents(odd_documents, PATH).collect(), rows)
    bare = pack_documents(odd_documents, PATH, with_ids=False)
    assert "ids" not in bare.columns
    check(bare.collect(), rows, ids=False)
    assert pack_documents(no_documents, PATH).collect() == []


def test_words_encode_as_whole_texts():
    texts = [
        "It's the dog's <|endoftext|> 12th of May!!", "ÉÈ çà Straße İ ǅ", "á combining", "日本語 text", "ΟΔΟΣ",
        "x\x1cy\x85z\xa0w", "tab\tnew\nline  two", "it’s — fine", "w" * 3000, "😀😀 ok", "'s't 'RE", "",
    ]
    encoder = WordBpe(PATH)
    for text in texts:
        made = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert [*made, 2] == reference_ids(text), text

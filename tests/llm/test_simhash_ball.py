import itertools
import random

import numpy as np
import xxhash

from threatlens.llm import simhash_ball as ball


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] * bool(word)
            word = ""
        else:
            word += c
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= 3:
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in prints}


def expected(rows):
    prints = [(d, slow_fingerprint(t)) for d, t in rows]
    component = slow_components({p for _, p in prints})
    first = {}
    for d, p in prints:
        if d is not None:
            first[component[p]] = min(d, first.get(component[p], d))
    return sorted(((d, f"{p:016x}", first.get(component[p])) for d, p in prints), key=str)


def test_all_documents_as_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made = sorted(map(tuple, ball.simhash_groups(docs).collect()), key=str)
    assert made == expected([(r.doc_id, r.text) for r in docs.collect()])
    assert len({c for *_, c in made}) < len(made)


def test_odd_rows(spark, odd_documents, no_documents):
    made = sorted(map(tuple, ball.simhash_groups(odd_documents).collect()), key=str)
    assert made == expected([(r.doc_id, r.text) for r in odd_documents.collect()])
    assert ball.simhash_groups(no_documents).collect() == []


def test_every_kind_of_difference_meets(spark):
    rng = random.Random(7)
    prints = set()
    for _ in range(60):
        centre = rng.getrandbits(64)
        prints.add(centre)
        for size in (1, 2, 3, 4):
            bits = rng.sample(range(64), size)
            prints.add(centre ^ sum(1 << b for b in bits))
            low, width = rng.choice(ball.BLOCKS)  # the whole difference in one block
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(low, low + width), size)))
    dense = rng.getrandbits(64)
    prints |= {dense ^ (1 << a) ^ (1 << b) for a in range(0, 64, 5) for b in range(0, 64, 7) if a != b}
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    links = ball.fingerprint_links(frame).collect()
    found = {p: p for p in prints}

    def find(x):
        while found[x] != x:
            x = found[x]
        return x

    for a, b in links:
        a, b = a % 2**64, b % 2**64
        assert 0 < (a ^ b).bit_count() <= 3
        found[max(find(a), find(b))] = min(find(a), find(b))
    assert {p: find(p) for p in prints} == slow_components(prints)

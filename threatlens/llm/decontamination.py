"""Benchmark decontamination by spaced seeds over words."""

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatlens.session import shared_folder, stage

WORD = re.compile(r"\w+")
#: Fixed masks; a 0 is a word that may differ. Together they hit every stretch of 13 words
#: with any two of them exchanged (tested).
MASKS = ("11111", "110111", "1110101", "11001101")
#: A match has at least so many words, or the whole item if that is shorter.
MATCH_WORDS = 13
#: Items below this are too short to tell and are never reported.
ITEM_WORDS = 5
#: One differing word costs as much as four equal ones: at least 80 % of a match is equal.
MISMATCH = -4
#: A benchmark of so many words at most is sent to every task as one index; a larger one is joined.
BLOCK_WORDS = 250_000
#: Bits (as a power of two) of the filter that document seeds pass before they are joined.
FILTER_BITS = 26
CHUNK_CHARACTERS = 4_000_000

OVERLAPS = "array<struct<item_id: bigint, start: bigint, words: bigint, equal: bigint>>"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _number(word: str) -> int:
    return xxhash.xxh64_intdigest(word) | 1


def _factors(mask: str) -> list[tuple[int, np.uint64]]:
    """Sampled positions, each with an odd factor of its own."""
    return [(i, np.uint64(xxhash.xxh64_intdigest(f"{mask}/{i}") | 1)) for i, bit in enumerate(mask) if bit == "1"]


def seed_hashes(numbers: np.ndarray, mask: str) -> np.ndarray:
    """A hash of the sampled words at every position where the mask fits."""
    fits = len(numbers) - len(mask) + 1
    made = np.zeros(max(fits, 0), dtype=np.uint64)
    for i, factor in _factors(mask):
        made += numbers[i : i + fits] * factor if fits > 0 else made
    return made


@dataclass
class SeedIndex:
    """The seeds of one block of items, by mask: sorted hashes, their item and position."""

    words: dict[str, int]
    items: list[tuple[int, np.ndarray]]
    seeds: list[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]

    @classmethod
    def of(cls, items: list[tuple[int, str | None]]) -> "SeedIndex":
        split = [(i, words) for i, t in items if i is not None and len(words := words_of(t)) >= ITEM_WORDS]
        numbers = {w: _number(w) for _, words in split for w in words}
        coded = [(i, np.array([numbers[w] for w in words], dtype=np.uint64)) for i, words in split]
        found = defaultdict(list)
        widest = max(map(len, MASKS))
        for n, (_, code) in enumerate(coded):
            # Short items also have one seed of all their words.
            for mask in [*MASKS, *(["1" * len(code)] if len(code) < widest else [])]:
                for at, h in enumerate(seed_hashes(code, mask).tolist()):
                    found[mask].append((h, n, at))
        seeds = []
        for mask, rows in found.items():
            rows.sort()
            hashes, item, at = (np.array(x, dtype=t) for x, t in zip(zip(*rows, strict=True), (np.uint64, np.int64, np.int64), strict=True))
            bits = max(20, (8 * len(rows)).bit_length())
            maybe = np.zeros(1 << bits, dtype=bool)
            maybe[hashes >> np.uint64(64 - bits)] = True
            seeds.append((mask, hashes, item, at, maybe, bits))
        return cls(numbers, coded, seeds)

    def search(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """For each text the best match with each item: (item, first word, words, equal words)."""
        made: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        gap = [0] * max((len(m) for m, *_ in self.seeds), default=1)
        code, starts = [], []
        for text in texts:  # a gap keeps masks inside one text
            starts.append(len(code))
            code += [self.words.get(w, 0) for w in words_of(text)]
            code += gap
        numbers, begins = np.array(code, dtype=np.uint64), np.array([*starts, len(code)])
        lines = set()  # (item, where its first word would be, document)
        for mask, hashes, item, at, maybe, bits in self.seeds:
            here = seed_hashes(numbers, mask)
            hits = np.flatnonzero(maybe[here >> np.uint64(64 - bits)])
            first = np.searchsorted(hashes, here[hits], side="left")
            last = np.searchsorted(hashes, here[hits], side="right")
            inside = np.searchsorted(begins, hits, side="right") - 1
            for hit, a, b, document in zip(*(x.tolist() for x in (hits, first, last, inside)), strict=True):
                lines.update((n, hit - i, document) for n, i in zip(item[a:b].tolist(), at[a:b].tolist(), strict=True))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for n, line, document in lines:
            number, words = self.items[n]
            low = max(line, starts[document])
            high = min(line + len(words), int(begins[document + 1]) - len(gap))
            equal = numbers[low:high] == words[low - line : high - line]
            match = self._longest(equal, min(MATCH_WORDS, len(words)))
            if match:
                key, start = (document, number), low + match[0] - starts[document]
                best[key] = max(best.get(key, (0, 0, 0)), (match[2], -start, match[1]))
        for (document, number), (same, start, length) in sorted(best.items()):
            made[document].append((number, -start, length, same))
        return made

    @staticmethod
    def _longest(equal: np.ndarray, least: int) -> tuple[int, int, int] | None:
        """The longest stretch that is equal enough: (start, length, equal words)."""
        if int(equal.sum()) * (1 - MISMATCH) < -MISMATCH * least:
            return None
        sums = np.concatenate([[0], np.cumsum(np.where(equal, 1, MISMATCH))])
        lowest = np.minimum.accumulate(sums).tolist()
        highest = np.maximum.accumulate(sums[::-1])[::-1].tolist()
        start, end, best = 0, 0, (0, 0)
        while end < len(lowest):  # a stretch from the lowest sum so far to a sum not below
            if highest[end] >= lowest[start]:
                best = max(best, (end - start, -start))
                end += 1
            else:
                start += 1
                end = max(end, start)
        length, start = best[0], -best[1]
        if length < least:
            return None
        return start, length, int(equal[start : start + length].sum())


def overlaps(
    documents: DataFrame,
    benchmark: DataFrame,
    carry: list[str],
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
    staging: str | None = None,
) -> DataFrame:
    """The carried columns of every row and `overlaps`, its matches with benchmark items.

    A match is a stretch of at least 13 words, or a whole shorter item, in which at least
    80 % of the words are equal in place. Words are runs of letters, digits and underscores
    in lower case. Of each item a text shows its best match (most equal words, then the
    first). Null texts match nothing; null items and items below five words are never
    reported; of repeated item ids the best match is shown once; an empty benchmark matches
    nothing. A carried column must not be called `overlaps`.

    A benchmark of at most `block_words` words goes to all tasks as one index, and documents are
    not shuffled. A larger one stays a table: its seeds and those of the documents that pass a
    filter of fixed size are joined, and the hits are verified on the executors. The plan and
    what the driver holds are the same for a benchmark of any size.
    """
    items = benchmark.select(F.col(item_id_col).cast("long").alias("i"), F.col(item_text_col).alias("t"))
    words = items.agg(F.sum(F.size(F.split(F.coalesce("t", F.lit("")), r"\W+")))).first()[0] or 0
    if words > block_words:
        return _joined(documents, items, carry, text_col, staging)
    index = SeedIndex.of([tuple(r) for r in items.collect()])  # at most block_words words
    kinds = [f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in carry]
    names = ("item_id", "start", "words", "equal")
    struct = pa.list_(pa.struct([(n, pa.int64()) for n in names]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, len(carry)):
                found = index.search(part.column(len(carry)).to_pylist())
                made = []
                for matches in found:
                    best = {}
                    for x in (dict(zip(names, m, strict=True)) for m in matches):
                        y = best.get(x["item_id"])
                        if y is None or (x["equal"], -x["start"]) > (y["equal"], -y["start"]):
                            best[x["item_id"]] = x
                    made.append([best[k] for k in sorted(best)])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(made, struct)], [*carry, "overlaps"])

    rows = documents.select(*carry, F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, ", ".join([*kinds, f"overlaps {OVERLAPS}"]))


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about CHUNK_CHARACTERS of text."""
    start = size = 0
    for i, n in enumerate(pa.compute.binary_length(batch.column(column)).to_pylist()):
        size += n or 0
        if size > CHUNK_CHARACTERS or i == len(batch) - 1:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0


def _numbers_of(text: str | None) -> np.ndarray:
    return np.array([_number(w) for w in words_of(text)], dtype=np.uint64)


def _item_seeds(items: DataFrame) -> DataFrame:
    """(hash, n, at): the seeds of items (n, t), those of short whole items included."""
    widest = max(map(len, MASKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for n, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                code = _numbers_of(text)
                if len(code) >= ITEM_WORDS:
                    for mask in [*MASKS, *(["1" * len(code)] if len(code) < widest else [])]:
                        h = _tagged(seed_hashes(code, mask), mask)
                        made.append((h, np.full(len(h), n), np.arange(len(h))))
            h, n, at = (np.concatenate(c) for c in zip(*made, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n), pa.array(at)], ["hash", "n", "at"])

    return items.select("n", "t").mapInArrow(run, "hash long, n long, at long")


def _tagged(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Hashes of different masks must not meet."""
    x = hashes ^ np.uint64(xxhash.xxh64_intdigest(mask))
    return (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)


def _filter_of(seeds: DataFrame) -> np.ndarray:
    """A bit for every high part of a hash that occurs: FILTER_BITS decide its size, not the seeds."""
    placed = seeds.select(F.shiftrightunsigned("hash", 64 - FILTER_BITS).alias("place"))
    words = placed.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(place % 64 AS INT)))").alias("bits")
    )
    frame = words.toPandas()
    made = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    made[frame["word"].to_numpy()] = frame["bits"].to_numpy()
    return np.unpackbits(made.view(np.uint8), bitorder="little").view(bool)


def _joined(documents: DataFrame, items: DataFrame, carry: list[str], text_col: str, staging: str | None) -> DataFrame:
    """`overlaps` for a benchmark of any size: seeds against seeds."""
    spark = documents.sparkSession
    folder = shared_folder(spark, staging)
    items = stage(items.filter("i is not null").withColumn("n", F.monotonically_increasing_id()), f"{folder}/items")
    seeds = stage(_item_seeds(items), f"{folder}/seeds")
    rows = stage(
        documents.select(F.monotonically_increasing_id().alias("_row"), *carry, F.col(text_col).alias("_text")), f"{folder}/rows"
    )
    maybe = spark.sparkContext.broadcast(_filter_of(seeds))
    # Short items have a seed of all their words as well.
    masks = [*MASKS, *("1" * w for w in range(ITEM_WORDS, max(map(len, MASKS))))]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = maybe.value
        for batch in batches:
            made = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                code = _numbers_of(text.as_py())
                for mask in dict.fromkeys(masks):
                    h = _tagged(seed_hashes(code, mask), mask)
                    at = np.flatnonzero(there[h >> np.uint64(64 - FILTER_BITS)])
                    made.append((h[at], np.full(len(at), row), at))
            h, row, at = (np.concatenate(c) for c in zip(*made, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(row), pa.array(at)], ["hash", "_row", "hit"])

    hits = rows.select("_row", "_text").mapInArrow(find, "hash long, _row long, hit long").join(seeds, "hash")
    # A line: where the first word of an item would stand in the row.
    lines = hits.select("_row", "n", (F.col("hit") - F.col("at")).alias("line")).distinct()
    pairs = lines.groupBy("_row", "n").agg(F.collect_list("line").alias("lines"))
    both = pairs.join(items, "n").join(rows.select("_row", "_text"), "_row").select("_row", "i", "t", "_text", "lines")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, last = [], (None, None)
            for row, item, t, text, starts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last[0] != row:
                    last = (row, _numbers_of(text))
                words, numbers, best = _numbers_of(t), last[1], None
                for line in starts:
                    low, high = max(line, 0), min(line + len(words), len(numbers))
                    equal = numbers[low:high] == words[low - line : high - line]
                    match = SeedIndex._longest(equal, min(MATCH_WORDS, len(words)))
                    if match:
                        found = (match[2], -(low + match[0]), match[1])
                        best = found if best is None else max(best, found)
                if best:
                    made.append((row, item, -best[1], best[2], best[0]))
            columns = zip(*made, strict=True) if made else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["_row", "item_id", "start", "words", "equal"]
            )

    found = both.mapInArrow(verify, "_row long, item_id long, start long, words long, equal long")
    best = found.groupBy("_row", "item_id").agg(F.max(F.struct("equal", (-F.col("start")).alias("s"), "words")).alias("b"))
    match = F.struct("item_id", (-F.col("b.s")).alias("start"), F.col("b.words").alias("words"), F.col("b.equal").alias("equal"))
    listed = best.groupBy("_row").agg(F.sort_array(F.collect_list(match)).alias("overlaps"))
    none = F.expr(f"cast(array() as {OVERLAPS})")
    return rows.join(listed, "_row", "left").select(*carry, F.coalesce("overlaps", none).alias("overlaps"))


def contaminated(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document row and benchmark item found in it; clean documents have none."""
    found = overlaps(documents, benchmark, [id_col])
    return found.select(id_col, F.inline("overlaps"))

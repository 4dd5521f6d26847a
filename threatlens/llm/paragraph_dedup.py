"""Repeated text across documents.

Paragraphs (lines) are compared by MinHash bands and exact verification. A passage that
stands inside other text is no paragraph of its own: it is found as a run of small segments,
cut at places that only the words around them decide, that occur elsewhere as well.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threatlens.llm.graphs import FEW_LINKS, connected_components
from threatlens.session import delete_folder, shared_folder, stage

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Of two paragraphs at the similarity itself, this share may be missed by the bands.
MISSED = 1e-3
#: Many rows: paragraphs that share half of their text should rarely meet.
ROWS_PER_BAND = 6
#: (from so many shingles on, rows per band). A short paragraph cannot hold a passage that many
#: others hold, so fewer rows, and with them fewer bands, will do. A pair meets in the bands for
#: the smaller of its sets.
BANDINGS = ((4, 3), (48, 5))
#: Parities of the numbers of shingles in so many 64-bit groups of hash buckets. A shingle of only
#: one set changes one parity, so two sets differ in at least as many shingles as in parities.
SKETCH_LONGS = 4
#: Sets this small are similar to no other set: one shingle more or less is too much.
LONE_SHINGLES = 3
#: Members of each large bucket that all others are compared with, in so many rounds at most,
#: before pairs across components. A bucket is large if its pairs outnumber these comparisons.
LEADERS, LEADING_ROUNDS = 8, 3
LARGE_BUCKET = 2 * LEADERS + 1
#: Shorter paragraphs are headings and stock phrases that documents may share.
LEAST_WORDS = 50
#: A segment ends where the hash of two neighbouring words is the smallest for so many words
#: to either side. Runs of repeated segments are passages from so many words on.
SEGMENT_REACH = 5
PASSAGE_WORDS = 18


def bands_for(similarity: float = SIMILARITY, rows: int = ROWS_PER_BAND, missed: float = MISSED) -> int:
    """The fewest bands of so many rows with (1 - similarity ** rows) ** bands <= missed."""
    return int(np.ceil(np.log(missed) / np.log1p(-(similarity**rows))))


def words_of(paragraph: str) -> list[str]:
    return paragraph.lower().split()


def shingles_of(words: list[str]) -> set[str]:
    """Distinct five-word shingles; of fewer words, the whole sequence."""
    if len(words) < SHINGLE_WORDS:
        return {" ".join(words)}
    return set(map(" ".join, zip(*(words[i:] for i in range(SHINGLE_WORDS)), strict=False)))


def hashes_of(shingles: set[str]) -> np.ndarray:
    return np.array([xxhash.xxh32_intdigest(s) for s in shingles], dtype=np.uint32)


def minima(hashes: np.ndarray, n: int) -> np.ndarray:
    """The smallest value of each of n hash functions, in 32 bits."""
    rng = np.random.default_rng(1)
    factors = rng.integers(1, 1 << 32, n, dtype=np.uint32) | np.uint32(1)
    shifts = rng.integers(0, 1 << 32, n, dtype=np.uint32)
    least = np.full(n, np.iinfo(np.uint32).max, dtype=np.uint32)
    for i in range(0, len(hashes), 4096):
        least = np.minimum(least, (hashes[i : i + 4096, None] * factors + shifts).min(axis=0))
    return least


def signature(
    shingles: set[str], bands: int, rows: int = ROWS_PER_BAND, similarity: float = SIMILARITY
) -> tuple[list[int], list[int]]:
    """One key per band, its number and minima hashed; and the parities.

    A set that can only be similar to an equal one has one key, of the whole set.
    """
    hashes = hashes_of(shingles)
    if len(shingles) <= LONE_SHINGLES and len(shingles) < similarity * (len(shingles) + 1):
        keys = [xxhash.xxh64_intdigest("\n".join(sorted(shingles)), bands)]
    else:
        least = minima(hashes, bands * rows)
        keys = [xxhash.xxh64_intdigest(least[b * rows : (b + 1) * rows].tobytes(), b) for b in range(bands)]
    return np.array(keys, dtype=np.uint64).view(np.int64).tolist(), sketch_of(hashes)


def sketch_of(hashes: np.ndarray) -> list[int]:
    odd = (np.bincount(hashes % np.uint32(64 * SKETCH_LONGS), minlength=64 * SKETCH_LONGS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).tolist()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _digests(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One 64-bit digest of each run of so many values, of their order too; no run is empty."""
    first = np.cumsum(sizes) - sizes
    place = np.arange(1, len(values) + 1) - np.repeat(first, sizes)
    mixed = _mixed(values + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return _mixed(np.add.reduceat(mixed, first)) if len(first) else mixed


class _Words(NamedTuple):
    """The words of some texts, in order; places are code points within their text."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    lines: np.ndarray  # of each word its line, counted over all texts
    line_texts: np.ndarray  # of each line its text
    line_starts: np.ndarray
    line_ends: np.ndarray
    line_words: np.ndarray


#: Code points that `str.split` takes for blanks; none is higher.
BLANKS = np.array([chr(c).isspace() for c in range(0x3002)])


def _found(texts: list[str]) -> _Words:
    """Words as `str.split` finds them, hashed by their code points, all texts at once."""
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le"), dtype=np.uint32)
    blank = BLANKS[np.minimum(codes, len(BLANKS) - 1)]
    edges = np.diff(np.r_[True, blank, True].astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    hashes = _digests(codes[~blank].astype(np.uint64), ends - starts)
    breaks = np.flatnonzero(codes == 10)
    lines = np.searchsorted(breaks, starts)
    lengths = np.array([len(text) + 1 for text in texts])
    begins = np.cumsum(lengths) - lengths
    line_starts, line_ends = np.r_[0, breaks + 1], np.r_[breaks, len(codes)]
    line_texts = np.searchsorted(begins, line_starts, side="right") - 1
    of_word, of_line = begins[line_texts[lines]], begins[line_texts]
    return _Words(
        hashes, starts - of_word, ends - of_word, lines, line_texts, line_starts - of_line, line_ends - of_line,
        np.bincount(lines, minlength=len(line_starts)),
    )


def _words(texts: list[str]) -> _Words:
    """The words of texts, hashed in lower case."""
    lowered = [text.lower() for text in texts]
    words = _found(lowered)
    if list(map(len, lowered)) != list(map(len, texts)):  # places are those of the texts themselves
        words = _found(texts)._replace(hashes=words.hashes)
    return words


def _classes(words: _Words, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The lines of at least so many words, and their classes: digests of their words."""
    chosen = np.flatnonzero(words.line_words >= max(least_words, 1))
    inside = (words.line_words >= max(least_words, 1))[words.lines]
    return chosen, _digests(words.hashes[inside], words.line_words[chosen]).view(np.int64)


def _portions(texts: pa.Array, most: int = 1_000_000) -> Iterator[list[str]]:
    """The texts in turn, so many that they have about `most` characters; null is empty."""
    portion, size = [], 0
    for value in texts:
        portion.append(value.as_py() or "")
        size += len(portion[-1])
        if size >= most or len(portion) >= 500:
            yield portion
            portion, size = [], 0
    if portion:
        yield portion


def band_keys(
    words: np.ndarray, counts: np.ndarray, similarity: float = SIMILARITY, missed: float = MISSED
) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of every band of every line, of so many word hashes each: two lines meet if they share a key.

    All lines are hashed at once. Lines of fewer words than a shingle can only equal each other
    and have no key.
    """
    ends = np.cumsum(counts)
    shingles = np.zeros(max(len(words) - SHINGLE_WORDS + 1, 0), dtype=np.uint64)
    for k in range(SHINGLE_WORDS):
        shingles += words[k : k + len(shingles)] * np.uint64(xxhash.xxh64_intdigest(str(k)) | 1)
    of_line = np.repeat(np.arange(len(counts)), counts)[: len(shingles)]
    inside = np.arange(len(shingles)) + SHINGLE_WORDS <= ends[of_line] if len(shingles) else np.zeros(0, dtype=bool)
    hashes, of_line = _mixed(shingles[inside]), of_line[inside]
    # Line and the upper 40 bits in one number: equal shingles of a line are neighbours.
    sets = np.sort((of_line.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    sets = sets[np.r_[True, sets[1:] != sets[:-1]][: len(sets)]]
    hashes, of_line = sets << np.uint64(24), (sets >> np.uint64(40)).astype(np.int64)
    known, first, sizes = np.unique(of_line, return_index=True, return_counts=True)
    found_lines, found_keys = [], []
    # Sets that can only be similar to equal ones: one key, of the whole set.
    lone = sizes < BANDINGS[0][0]
    if lone.any():
        sums = np.add.reduceat(_mixed(hashes + np.uint64(1)), first)
        found_lines.append(known[lone])
        found_keys.append(_mixed(sums[lone]))
    for n, (least, rows) in enumerate(BANDINGS):
        most = BANDINGS[n + 1][0] if n + 1 < len(BANDINGS) else np.inf
        mine = (sizes >= least) & (similarity * sizes < most)
        if not mine.any():
            continue
        chosen = np.repeat(mine, sizes)
        values, starts = (hashes[chosen] >> np.uint64(32)).astype(np.uint32), np.r_[0, np.cumsum(sizes[mine])[:-1]]
        rng = np.random.default_rng(n)
        for band in range(bands_for(similarity, rows, missed)):
            key = np.full(int(mine.sum()), xxhash.xxh64_intdigest(f"{n}/{band}"), dtype=np.uint64)
            for _ in range(rows):
                factor, shift = rng.integers(0, 1 << 32, 2, dtype=np.uint32)
                least_value = np.minimum.reduceat(values * (factor | np.uint32(1)) + shift, starts)
                key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + least_value)
            found_lines.append(known[mine])
            found_keys.append(key)
    if not found_keys:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(found_lines), np.concatenate(found_keys).view(np.int64)


LINES = "array<struct<paragraph: bigint, start: bigint, end: bigint, words: bigint, class_id: bigint>>"
SEGMENTS = "array<struct<n: int, paragraph: int, start: int, end: int, words: int, digest: bigint>>"


def scanned(documents: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", least_words: int = SHINGLE_WORDS) -> DataFrame:
    """Each row of the documents once, numbered: row, doc_id, its lines and its segments, no text.

    Lines of enough words come with their class, a digest of their words. Everything that
    speaks of rows by number reads this one stored table.
    """
    line_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("paragraph", "start", "end", "words", "class_id")]))
    segment_type = pa.list_(pa.struct([*[(n, pa.int32()) for n in ("n", "paragraph", "start", "end", "words")], ("digest", pa.int64())]))

    def listed(columns: list[np.ndarray], lengths: np.ndarray, kind: pa.ListType) -> pa.ListArray:
        fields = [pa.array(c, f.type) for c, f in zip(columns, kind.value_type, strict=True)]
        inner = pa.StructArray.from_arrays(fields, fields=list(kind.value_type))
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)], pa.int32()), inner, type=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = 0
            for texts in _portions(whole.column(2)):
                words, batch = _words(texts), whole.slice(at, len(texts))
                at += len(texts)
                chosen, classes = _classes(words, least_words)
                number = np.arange(len(words.line_texts)) - np.searchsorted(words.line_texts, words.line_texts)
                lines = [x[chosen] for x in (number, words.line_starts, words.line_ends, words.line_words)]
                line_counts = np.bincount(words.line_texts[chosen], minlength=len(texts))
                segments, counts = _segments(words, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), listed([*lines, classes], line_counts, line_type),
                     listed(segments, counts, segment_type)],
                    ["row", "doc_id", "lines", "segments"],
                )

    kind = documents.schema[id_col].dataType.simpleString()
    source = documents.select(F.monotonically_increasing_id(), id_col, text_col)
    return stage(source.mapInArrow(run, f"row long, doc_id {kind}, lines {LINES}, segments {SEGMENTS}"), f"{folder}/scan")


def _fresh(classes: np.ndarray, sent: set[int]) -> list[int]:
    """Where the classes stand that were not sent yet, as far as that is kept."""
    if len(sent) > 400_000:
        sent.clear()
    fresh = []
    for i, number in enumerate(classes.tolist()):
        if number not in sent:
            sent.add(number)
            fresh.append(i)
    return fresh


def _keys(documents: DataFrame, text_col: str, least_words: int, similarity: float) -> DataFrame:
    """(key, class_id) of every class; a task sends a class once, however often it stands there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = set()
        for batch in batches:
            for texts in _portions(batch.column(0)):
                words = _words(texts)
                chosen, classes = _classes(words, least_words)
                fresh = np.array(_fresh(classes, sent), dtype=np.int64)
                chosen, classes = chosen[fresh], classes[fresh]
                asked = np.zeros(len(words.line_words), dtype=bool)
                asked[chosen] = True
                line, key = band_keys(words.hashes[asked[words.lines]], words.line_words[chosen], similarity)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(classes[line])], ["key", "class_id"])

    return documents.select(text_col).mapInArrow(run, "key long, class_id long")


def _meeting(keys: DataFrame) -> DataFrame:
    """The distinct (key, class_id) of keys that several classes share.

    One shuffle: sorted keys stream by, and a key stays if a neighbour has it too, so most of
    them end here and nothing but the last one is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, number, met = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), False

        def packed(chosen: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(key[: len(chosen)][chosen]), pa.array(number[: len(chosen)][chosen])], ["key", "class_id"])

        for batch in batches:
            key, number = (np.r_[x, batch.column(i).to_numpy()] for i, x in ((0, key[-1:]), (1, number[-1:])))
            if not len(key):
                continue
            fresh = np.r_[True, (key[1:] != key[:-1]) | (number[1:] != number[:-1])]
            key, number = key[fresh], number[fresh]
            shared = key[1:] == key[:-1]
            before, after = np.r_[met, shared], np.r_[shared, False]
            yield packed((before | after)[:-1])
            met = bool(before[-1])
        if met:
            key, number = key[-1:], number[-1:]
            yield packed(np.array([True]))

    return keys.repartition("key").sortWithinPartitions("key", "class_id").mapInArrow(run, "key long, class_id long")


def _bodies(documents: DataFrame, classes: DataFrame, text_col: str, least_words: int) -> DataFrame:
    """class_id, shingles, sketch, body of the given classes, found again by their digests."""

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = set()
        for batch in batches:
            for texts in _portions(batch.column(0)):
                words = _words(texts)
                chosen, classes = _classes(words, least_words)
                fresh = _fresh(classes, sent)
                places = (x[chosen[fresh]].tolist() for x in (words.line_texts, words.line_starts, words.line_ends))
                bodies = [" ".join(words_of(texts[text][a:b])) for text, a, b in zip(*places, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(classes[fresh]), pa.array(bodies, pa.string())], ["class_id", "body"])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [hashes_of(shingles_of(body.as_py().split(" "))) for body in batch.column(1)]
            sketches = pa.array([sketch_of(h) for h in hashes], pa.list_(pa.int64()))
            counts = pa.array([len(h) for h in hashes], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts, sketches, batch.column(1)], ["class_id", "shingles", "sketch", "body"])

    lines = documents.select(text_col).mapInArrow(again, "class_id long, body string")
    asked = lines.join(classes, "class_id", "left_semi").groupBy("class_id").agg(F.first("body").alias("body"))
    return asked.mapInArrow(measured, "class_id long, shingles long, sketch array<long>, body string")


def _similar(pairs: DataFrame, bodies: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of classes whose shingle sets have at least this Jaccard similarity."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            known: dict[int, set[str]] = {}

            def shingles(key: int, body: str, known: dict = known) -> set[str]:
                if key not in known:
                    if len(known) > 2_000:
                        known.clear()
                    known[key] = shingles_of(body.split(" "))
                return known[key]

            kept = []
            for a, b, body_a, body_b in frame.itertuples(index=False):
                x, y = shingles(a, body_a), shingles(b, body_b)
                same = len(x & y)
                kept.append(same >= similarity * (len(x) + len(y) - same))
            yield frame.loc[kept, ["a", "b"]]

    first = bodies.select(F.col("class_id").alias("a"), F.col("body").alias("body_a"))
    second = bodies.select(F.col("class_id").alias("b"), F.col("body").alias("body_b"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "body_a", "body_b").mapInPandas(run, "a long, b long")


def _may_be_similar(similarity: float) -> Column:
    """Of classes a and b: what the numbers of shingles and the parities allow. No similar pair is
    lost: at most (1 - s) / (1 + s) of all shingles of two similar sets are in one of them only."""
    fewer, more = F.least("shingles_a", "shingles_b"), F.greatest("shingles_a", "shingles_b")
    apart = sum(
        (F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i])) for i in range(SKETCH_LONGS)), F.lit(0)
    )
    most = (fewer + more) * F.lit((1 - similarity) / (1 + similarity)) + F.lit(1e-6)
    return (fewer >= F.lit(similarity) * more - F.lit(1e-6)) & (apart <= most)


def repeated_paragraphs(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_words: int = LEAST_WORDS,
    similarity: float = SIMILARITY,
    staging: str | None = None,
    inside_rows: bool = False,
    scan: DataFrame | None = None,
) -> DataFrame:
    """One row per paragraph with a copy or near-copy in another row: where, its cluster, removed.

    With `inside_rows` also those whose copies are all in their own row.

    Columns: row (its number in the scan), doc_id, paragraph (line number from 0), start, end (code points, end
    exclusive), words, class_id (equal word sequences), component_id (clusters of classes
    with a Jaccard similarity of five-word shingles of at least `similarity`), removed. Of
    each cluster the first paragraph by (doc_id, paragraph) stays, a null doc_id last.
    Paragraphs of fewer than `least_words` words are not compared; null and empty texts
    have none. Repeated rows repeat their paragraphs. Other columns are not read. `scan` is the
    table of `scanned` over the same documents and least_words, where rows have their numbers.

    Equal paragraphs are one class. Pairs of a small bucket are compared, if numbers of shingles
    and parities allow. In a large one all classes are compared with a few of them, which links
    large groups with a few pairs per member; buckets that still mix components have other
    leaders, some rounds more. Large buckets whose classes are then
    still in different components have the pairs across them compared too, so a group never has
    all its pairs emitted. Only classes that share a bucket have their texts and facts fetched.
    """
    folder = shared_folder(documents.sparkSession, staging)
    scan = scanned(documents, folder, id_col, text_col, least_words) if scan is None else scan
    found = scan.select("row", "doc_id", F.inline("lines"))
    shared = stage(_meeting(_keys(documents, text_col, least_words, similarity)), f"{folder}/shared")
    bodies = stage(_bodies(documents, shared.select("class_id").distinct(), text_col, least_words), f"{folder}/bodies")
    facts = ("class_id", "shingles", "sketch")
    met = stage(shared.join(bodies.select(*facts), "class_id").select("key", *facts), f"{folder}/met")
    delete_folder(met.sparkSession, f"{folder}/shared")
    large = met.groupBy("key").count().filter(F.col("count") > LARGE_BUCKET).select("key")
    large = stage(large, f"{folder}/large-keys")
    small = _pairs(met.join(large, "key", "left_anti"), facts, F.lit(True), similarity)
    links = stage(_similar(small, bodies, similarity), f"{folder}/small")
    crowd = stage(met.join(large, "key", "left_semi"), f"{folder}/large")
    for turn in range(LEADING_ROUNDS + 1):
        near = stage(connected_components(links, f"{folder}/near-{turn}", FEW_LINKS), f"{folder}/near-components-{turn}")
        rest = stage(_mixed_buckets(crowd, near), f"{folder}/mixed-{turn}")
        # Another round pays while pairs outnumber comparisons with leaders.
        sizes = rest.groupBy("key").agg(F.count("*").alias("n"))
        members, pairs = sizes.agg(F.sum("n"), F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()
        if turn == LEADING_ROUNDS or (pairs or 0) <= LEADERS * (members or 0):
            break
        found_links = _similar(_with_leaders(rest, turn, facts, similarity), bodies, similarity)
        links = stage(links.union(found_links), f"{folder}/stars-{turn}")
    if members:
        apart = F.col("component_a") != F.col("component_b")
        across = _pairs(rest, (*facts, "component"), apart, similarity)
        links = stage(links.union(_similar(across, bodies, similarity)), f"{folder}/links")
    clusters = connected_components(links, f"{folder}/all", FEW_LINKS)

    classes = found.groupBy("class_id").agg(F.count("*").alias("copies"))
    repeated = (
        classes.join(clusters.withColumnRenamed("node", "class_id"), "class_id", "left")
        .filter("copies > 1 or component is not null")
        .select("class_id", F.coalesce("component", "class_id").alias("component_id"))
    )
    rows = found.join(repeated, "class_id").withColumn("uid", F.struct("row", "paragraph"))
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "paragraph", "uid")
    first = (
        rows.groupBy("component_id")
        .agg(F.min(order)["uid"].alias("first_uid"), F.min("row").alias("low"), F.max("row").alias("high"), F.count("*").alias("n"))
        .filter(F.lit(inside_rows) & F.expr("n > 1") | F.expr("low < high"))
    )
    return rows.join(first, "component_id").select(
        "row", "doc_id", "paragraph", "start", "end", "words", "class_id", "component_id",
        (F.col("uid") != F.col("first_uid")).alias("removed"),
    )


def _with_leaders(members: DataFrame, turn: int, facts: tuple[str, ...], similarity: float) -> DataFrame:
    """(a, b): the members of each bucket with a few of them, of other components, if they may be similar.

    Any members may lead; several, since few of a large group are similar to a given one.
    """
    columns = (*facts, "component")
    leading = [F.min_by(F.struct(*columns), F.xxhash64("class_id", F.lit(turn * LEADERS + i))) for i in range(LEADERS)]
    leaders = members.groupBy("key").agg(F.array_distinct(F.array(*leading)).alias("leaders"))
    leader = leaders.select(F.col("key").alias("key_a"), F.inline("leaders")).select("key_a", *[F.col(c).alias(f"{c}_a") for c in columns])
    member = members.select("key", *[F.col(c).alias(f"{c}_b") for c in columns])
    apart = F.col("component_a") != F.col("component_b")
    return (
        member.join(leader, (F.col("key") == F.col("key_a")) & apart & _may_be_similar(similarity))
        .select(F.least("class_id_a", "class_id_b").alias("a"), F.greatest("class_id_a", "class_id_b").alias("b"))
        .distinct()
    )


def _pairs(members: DataFrame, columns: tuple[str, ...], also: Column, similarity: float) -> DataFrame:
    """(a, b): the members of each bucket that may be similar, each pair once."""
    one = members.select(F.col("key").alias("key_a"), *[F.col(c).alias(f"{c}_a") for c in columns])
    other = members.select(F.col("key").alias("key_b"), *[F.col(c).alias(f"{c}_b") for c in columns])
    pair = (F.col("key_a") == F.col("key_b")) & (F.col("class_id_a") < F.col("class_id_b")) & also
    met = one.join(other, pair & _may_be_similar(similarity))
    return met.select(F.col("class_id_a").alias("a"), F.col("class_id_b").alias("b")).distinct()


def _mixed_buckets(met: DataFrame, near: DataFrame) -> DataFrame:
    """The members, with their components, of buckets that hold several components."""
    placed = met.join(near.withColumnRenamed("node", "class_id"), "class_id", "left").withColumn(
        "component", F.coalesce("component", "class_id")
    )
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    return placed.join(mixed.select("key"), "key")


#: What `segments_of` takes besides a text; words are hashed all at once now, and none is kept.
_Numbers = dict


def segments_of(text: str | None, numbers: dict[str, int] | None = None) -> tuple[np.ndarray, ...]:
    """Starts, ends, numbers of words and digests of the segments of a text, in code points.

    Segments end with a line, and where the words say so.
    """
    return tuple(_segments(_words([text or ""]), 1)[0][2:])


def _segments(words: _Words, texts: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(n, line, start, end, words, digest) of the segments, by column, and how many each text has."""
    n, of_text = len(words.hashes), words.line_texts[words.lines]
    # Neighbours of one text; texts stand so far apart that none reaches into the next.
    inside = of_text[1:] == of_text[:-1]
    places = np.arange(n) + SEGMENT_REACH * of_text
    pairs = np.full(n + SEGMENT_REACH * texts, np.iinfo(np.uint64).max, dtype=np.uint64)
    pairs[places[:-1][inside]] = (words.hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + words.hashes[1:])[inside]
    lowest = np.ones(len(pairs), dtype=bool)
    for k in range(1, SEGMENT_REACH + 1):
        lowest[k:] &= pairs[k:] < pairs[:-k]
        lowest[:-k] &= pairs[:-k] <= pairs[k:]
    last = np.flatnonzero(np.r_[lowest[places[:-1]] & inside | (words.lines[1:] != words.lines[:-1]), True][:n])
    first = np.r_[0, last[:-1] + 1][: len(last)]
    counts = np.bincount(of_text[first], minlength=texts)
    number = np.arange(len(first)) - np.repeat(np.cumsum(counts) - counts, counts)
    lines = words.lines[first] - np.searchsorted(words.line_texts, of_text[first])
    sizes = last - first + 1
    digests = _digests(words.hashes, sizes).view(np.int64)
    return [number, lines, words.starts[first], words.ends[last], sizes, digests], counts


def _copies(segments: DataFrame) -> DataFrame:
    """The segments (digest, row, ...) that stand in several rows, found as `_meeting` finds keys.

    Sorted, they stream by. Held are only those of one digest that so far are all of one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, passed = [], None
        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([*held, batch]).combine_chunks()
            digest, row = (table.column(i).to_numpy() for i in (0, 1))
            starts = np.flatnonzero(np.r_[True, digest[1:] != digest[:-1]])
            ends = np.r_[starts[1:], len(digest)]
            several = row[starts] != row[ends - 1]
            several[0] |= passed is not None and digest[0] == passed
            held, passed = ([], digest[-1]) if several[-1] else (table.slice(starts[-1]).to_batches(), None)
            yield from table.filter(pa.array(np.repeat(several, ends - starts))).to_batches()

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in segments.schema.fields)
    return segments.repartition("digest").sortWithinPartitions("digest", "row").mapInArrow(run, kinds)


def _pieces(scan: DataFrame, gone: DataFrame | None, folder: str) -> DataFrame:
    """One row per piece of a run of repeated segments, with the run it is part of and its words."""
    segments = scan.select("row", "doc_id", F.inline("segments"))
    copies = _copies(segments.select("digest", "row", "doc_id", "n", "paragraph", "start", "end", "words"))
    if gone is None:
        copies = copies.withColumn("gone", F.lit(False))
    else:
        lost = gone.select("row", F.col("paragraph").cast("int").alias("paragraph"), F.lit(True).alias("gone")).distinct()
        copies = copies.join(lost, ["row", "paragraph"], "left").withColumn("gone", F.coalesce("gone", F.lit(False)))
    copies = stage(copies.drop("paragraph"), f"{folder}/copies")
    # The copy of each segment that stays; neighbours that stay in one row are one passage.
    at = F.min(F.struct("gone", "row", "n"))
    stays = copies.groupBy("digest").agg(at.alias("at")).select("digest", "at.row", "at.n")
    in_row = Window.partitionBy("row").orderBy("n")
    homes = stage(
        stays.withColumn("home", F.col("n") - F.row_number().over(in_row))
        .withColumn("component_id", F.min("digest").over(Window.partitionBy("row", "home")))
        .select("digest", F.col("row").alias("home_row"), F.col("n").alias("home_n"), "component_id"),
        f"{folder}/homes",
    )
    same = Window.partitionBy("row", "component_id", "removed").orderBy("n")
    return (
        copies.join(homes, "digest")
        .withColumn("removed", (F.col("row") != F.col("home_row")) | (F.col("n") != F.col("home_n")))
        .withColumn("run", F.col("n") - F.row_number().over(in_row))
        .withColumn("run_words", F.sum("words").over(Window.partitionBy("row", "run")))
        .withColumn("piece", F.col("n") - F.row_number().over(same))
        .groupBy("row", "run", "component_id", "removed", "piece")
        .agg(
            F.first("doc_id").alias("doc_id"), F.min("start").cast("long").alias("start"), F.max("end").cast("long").alias("end"),
            F.sum("words").alias("words"), F.first("run_words").alias("run_words"),
        )
    )


def passage_copies(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_words: int = PASSAGE_WORDS,
    gone: DataFrame | None = None,
    staging: str | None = None,
    scan: DataFrame | None = None,
) -> DataFrame:
    """One row per copy of a passage: doc_id, start, end, words, component_id, removed.

    A run of neighbouring segments of one row that each occur in another row too, of at least
    `least_words` words together, is cut where the copy that stays changes. Of each segment one
    copy stays, the first in the order of the table. Neighbouring segments that stay in one row are
    one component, and so are all their copies: exactly one row of a component is not removed.
    It is listed even if its own run is shorter. `gone` has (row, paragraph) of paragraphs that
    are removed otherwise, as numbered over the same scan by `repeated_paragraphs`: a copy in one
    stays only if no other does. Some words at the ends of a passage may lie in segments with
    the text around it. Null and empty texts have no passage; repeated rows repeat theirs. Other
    columns are not read.
    """
    folder = shared_folder(documents.sparkSession, staging)
    scan = scanned(documents, folder, id_col, text_col) if scan is None else scan
    pieces = stage(_pieces(scan, gone, folder), f"{folder}/pieces")
    found = pieces.filter(F.col("run_words") >= least_words)
    short = pieces.filter((F.col("run_words") < least_words) & ~F.col("removed"))
    listed = found.union(short.join(found.filter("removed").select("component_id").distinct(), "component_id", "left_semi").select(pieces.columns))
    return listed.select("doc_id", "start", "end", "words", "component_id", "removed")


def repeated_passages(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_words: int = PASSAGE_WORDS,
    staging: str | None = None,
) -> DataFrame:
    """One row per whole run of `passage_copies`: doc_id, start, end, words, component_id, removed.

    component_id is the smallest of its pieces. removed says that some piece of the run is removed;
    others of it may be the copy that stays, so text is deleted by `passage_copies`, never by run.
    """
    folder = shared_folder(documents.sparkSession, staging)
    return (
        _pieces(scanned(documents, folder, id_col, text_col), None, folder)
        .filter(F.col("run_words") >= least_words)
        .groupBy("row", "run")
        .agg(
            F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("end").alias("end"),
            F.sum("words").alias("words"), F.min("component_id").alias("component_id"), F.bool_or("removed").alias("removed"),
        )
        .drop("row", "run")
    )

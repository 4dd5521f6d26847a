"""Near-duplicates by SimHash fingerprints, linked through balls that meet in the middle."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatlens.llm.graphs import connected_components
from threatlens.session import shared_folder, stage

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 3
#: The 64 bits in three blocks: (lowest bit, width). Two blocks are at most 43 bits wide.
BLOCKS = ((0, 21), (21, 22), (43, 21))
KEPT_BITS = 43


def fingerprint(text: str | None) -> int:
    """SimHash of a whole text as unsigned 64 bits; zero if it has no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only
    if not words:
        return 0
    shingles = (
        map(b" ".join, zip(*(words[i:] for i in range(SHINGLE_WORDS)), strict=False))
        if len(words) >= SHINGLE_WORDS
        else [b" ".join(words)]
    )
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, carry: list[str], text_col: str = "text") -> DataFrame:
    """The carried columns of every row and its fingerprint: the long with the same 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(carry))
            made = np.array([fingerprint(x.as_py()) for x in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(made.view(np.int64))], [*carry, "fingerprint"]
            )

    kinds = [f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in carry]
    rows = documents.select(*carry, F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, ", ".join([*kinds, "fingerprint long"]))


def _without(block: int, prints: np.ndarray) -> np.ndarray:
    """The bits outside one block, closed up."""
    low, width = (np.uint64(x) for x in BLOCKS[block])
    below = prints & ((np.uint64(1) << low) - np.uint64(1))
    return ((prints >> (low + width)) << low) | below


def _inside(block: int, prints: np.ndarray) -> np.ndarray:
    low, width = (np.uint64(x) for x in BLOCKS[block])
    return (prints >> low) & ((np.uint64(1) << width) - np.uint64(1))


def ball_variants(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all variants and their fingerprints.

    Half the radius is one and a half bits. The odd bit is taken out by leaving out one of
    three blocks in turn; of what is left, every variant within one bit is a key.
    """
    keys = []
    for block, (_, width) in enumerate(BLOCKS):
        left = _without(block, prints)
        tag = np.uint64(block << KEPT_BITS)
        flips = np.uint64(1) << np.arange(64 - width, dtype=np.uint64)
        keys += [left | tag, ((left[:, None] ^ flips[None, :]) | tag).ravel()]
    repeats = [part for _, width in BLOCKS for part in (prints, np.repeat(prints, 64 - width))]
    return np.concatenate(keys), np.concatenate(repeats)


def bucket_links(key: int, prints: np.ndarray) -> list[tuple[int, int]]:
    """Links that join all members of one bucket that are joined at all, not all its pairs.

    Members differ in at most two of the kept bits, so those with the same left-out block
    are linked, and so are those whose blocks differ in one bit: one link per block value
    and flip is enough. Pairs whose whole difference lies in the block have the same kept
    bits; they meet in the balls of one and two bits around their block values. Every other
    pair within three bits meets in one of these ways in another bucket.
    """
    block = int(key) >> KEPT_BITS
    centre = np.uint64(int(key) & ((1 << KEPT_BITS) - 1))
    inside, exact = _inside(block, prints), _without(block, prints) == centre
    width = BLOCKS[block][1]
    head: dict[int, int] = {}
    links = []
    for value, member in zip(inside.tolist(), prints.tolist(), strict=True):
        if head.setdefault(value, member) != member:
            links.append((head[value], member))
    flips = [1 << i for i in range(width)]
    for value, member in head.items():
        links += [(member, head[value ^ f]) for f in flips if value < value ^ f and value ^ f in head]
    at_centre = dict(zip(inside[exact].tolist(), prints[exact].tolist(), strict=True))
    if len(at_centre) > 1:
        near: dict[int, int] = {}
        for value, member in at_centre.items():
            for point in [value, *(value ^ f for f in flips)]:
                if near.setdefault(point, member) != member:
                    links.append((near[point], member))
        for value, member in at_centre.items():
            for i, f in enumerate(flips):
                for g in flips[i + 1 :]:
                    if (other := near.get(value ^ f ^ g, member)) != member:
                        links.append((other, member))
    return links


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints that span every group within RADIUS bits."""
    names = ["key", "fingerprint"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_numpy().view(np.uint64)
            for start in range(0, len(found), 2_000):
                keys, members = ball_variants(found[start : start + 2_000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(members.view(np.int64))], names
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(keys: np.ndarray, members: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.r_[0, cuts], np.r_[cuts, len(keys)]
            many = np.flatnonzero(ends - starts > 1)
            links = [x for i in many for x in bucket_links(keys[starts[i]], members[starts[i] : ends[i]])]
            pairs = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        held = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]  # a bucket that may go on
        for batch in batches:
            if not len(batch):
                continue
            keys = batch.column(0).to_numpy()
            members = batch.column(1).to_numpy().view(np.uint64)
            if len(held[0][0]) and keys[-1] == held[0][0][0]:
                held.append((keys, members))
                continue
            last = int(np.searchsorted(keys, keys[-1]))
            ready = [*held, (keys[:last], members[:last])]
            held = [(keys[last:], members[last:])]
            if sum(len(k) for k, _ in ready):
                yield linked(*(np.concatenate(x) for x in zip(*ready, strict=True)))
        if len(held[0][0]):
            yield linked(*(np.concatenate(x) for x in zip(*held, strict=True)))

    variants = prints.select("fingerprint").mapInArrow(emit, "key long, fingerprint long")
    met = variants.repartition("key").sortWithinPartitions("key").mapInArrow(meet, "a long, b long")
    verified = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    return met.distinct().filter(verified)


def components(prints: DataFrame, folder: str) -> DataFrame:
    """(fingerprint, component) for every distinct fingerprint."""
    distinct = stage(prints.select("fingerprint").distinct(), f"{folder}/distinct")
    groups = connected_components(fingerprint_links(distinct), folder)
    return distinct.join(groups.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", F.coalesce("component", "fingerprint").alias("component")
    )


def simhash_groups(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    staging: str | None = None,
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    Null and empty texts have fingerprint zero and are linked like any other. Copies and
    repeated rows share a fingerprint and are compared once. component_id is the smallest
    non-null id reachable, null only if all are null. Other columns are not read, so their
    names cannot clash. An empty table gives an empty result.
    """
    folder = shared_folder(documents.sparkSession, staging)
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    prints = stage(fingerprints(rows, ["doc_id"]), f"{folder}/prints")
    first = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"))
    placed = stage(components(prints, folder).join(first, "fingerprint"), f"{folder}/placed")
    smallest = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    component = placed.join(smallest, "component").select("fingerprint", "component_id")
    return prints.join(component, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    documents: DataFrame,
    carry: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    staging: str | None = None,
) -> DataFrame:
    """The carried columns (the id among them) of one row of each group.

    The row with the smallest id stays, a null id last; of rows with the same id one stays.
    Carried columns must not be called fingerprint, component or uid.
    """
    folder = shared_folder(documents.sparkSession, staging)
    rows = stage(
        fingerprints(documents, carry, text_col).withColumn("uid", F.monotonically_increasing_id()),
        f"{folder}/rows",
    )
    prints = rows.select(F.col(id_col).alias("id"), "uid", "fingerprint")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "uid")
    first = (
        prints.groupBy("fingerprint").agg(F.min(order).alias("first"))
        .join(components(prints, folder), "fingerprint")
        .groupBy("component").agg(F.min("first")["uid"].alias("uid"))
    )
    return rows.join(first, "uid", "left_semi").select(*carry)

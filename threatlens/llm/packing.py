"""Packing of token sequences by minimum bin slack."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from threatlens.llm.graphs import ranked
from threatlens.llm.tokens import WordBpe
from threatlens.session import shared_folder, stage

CAPACITY = 4096
END_ID = 2


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available lengths whose sum is the largest not above `room`.

    Subset sums as one bitset: bit s is set if some multiset sums to s. Counts go in by
    binary splitting, longest first, and stop when `room` itself is reached. The bitset
    before each step tells, going back, how often the step was used.
    """
    if room <= 0:
        return {}
    full, reached, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left, chunk = min(counts[length], room // length), 1
        while left:
            chunk = min(chunk, left)
            steps.append((length, chunk, reached))
            reached |= (reached << (length * chunk)) & full
            left -= chunk
            chunk *= 2
        if reached >> room & 1:
            break
    total, used = reached.bit_length() - 1, {}
    for length, chunk, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + chunk
            total -= length * chunk
    return used


def plan_windows(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(repeats, {length: how many}): windows that use up all counts.

    The longest length left opens a window, `fill` closes it, and the window is repeated
    while the counts last. Each window halves the count of one length at least, so there
    are at most capacity * log2(rows) of them, whatever the table.
    """
    left, windows = {n: c for n, c in counts.items() if c}, []
    while left:
        longest = max(left)
        others = left | {longest: left[longest] - 1}
        window = fill({n: c for n, c in others.items() if c}, capacity - longest)
        window[longest] = window.get(longest, 0) + 1
        repeats = min(left[n] // k for n, k in window.items())
        windows.append((repeats, window))
        for n, k in window.items():
            left[n] -= repeats * k
            if not left[n]:
                del left[n]
    return windows


def _pieces(documents: DataFrame, id_col: str, text_col: str, path: str, capacity: int, end_id: int) -> DataFrame:
    end = np.array([end_id], dtype="<u4").tobytes()
    names = ["doc_id", "start", "length", "doc_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordBpe(path)
        for batch in batches:
            rows, size = [], 0
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py() or "") + end
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    rows.append((doc.as_py(), start, len(piece) // 4, n, piece))
                    size += len(piece)
                if size > 16_000_000:
                    yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*rows, strict=True))], names)
                    rows, size = [], 0
            if rows:
                columns = [*zip(*rows, strict=True)]
                kinds = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    kind = documents.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, doc_tokens long, ids binary"
    return documents.select(id_col, text_col).mapInArrow(run, schema)


def pack_documents(
    documents: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = True,
    staging: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids_crc32, sequence_id, offset, ids.

    A document is its ids and `end_id`, cut at multiples of the capacity; a null or empty
    text is `end_id` alone. Full pieces are sequences, the others are packed. Sequence
    numbers and offsets are gapless. `ids` holds little-endian unsigned 32-bit ids; without
    `with_ids` it is left out and only the checksum made from it is kept. Repeated rows are
    packed like different ones. Other columns are not read. An empty table gives no piece.

    Only the number of pieces of each length, capacity numbers at most, reaches the driver;
    the plan made from it says which ranks of a length go where.
    """
    folder = shared_folder(documents.sparkSession, staging)
    made = _pieces(documents, id_col, text_col, tokenizer_path, capacity, end_id).withColumn(
        "ids_crc32", F.crc32("ids")
    )
    made = stage(
        (made if with_ids else made.drop("ids")).withColumn("piece", F.monotonically_increasing_id()),
        f"{folder}/pieces",
    )
    placed = ranked(made.drop("ids"), "length", ["doc_id", "start", "piece"], folder)
    counts = dict(made.groupBy("length").agg(F.count("*")).collect())

    # Rows of the plan: from this rank on, length, k of it in each window, number of the
    # first window, where the length begins there.
    rows, used, sequence = [], dict.fromkeys(counts, 0), 0
    for repeats, window in plan_windows(counts, capacity):
        offset = 0
        for length, k in sorted(window.items(), reverse=True):
            rows.append((length, used[length], k, sequence, offset))
            used[length] += repeats * k
            offset += length * k
        sequence += repeats
    plan = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    wide = np.int64(sum(counts.values()) + 1)

    @pandas_udf("sequence_id long, offset long")
    def where(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        lengths, firsts, k, first_sequence, first_offset = plan.T
        length, rank = length.to_numpy(), rank.to_numpy()
        at = np.searchsorted(lengths * wide + firsts, length * wide + rank, side="right") - 1
        window, place = np.divmod(rank - firsts[at], k[at])
        return pd.DataFrame({
            "sequence_id": first_sequence[at] + window, "offset": first_offset[at] + place * length
        })

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "at.sequence_id", "at.offset"]
    packed = placed.withColumn("at", where("length", "rank")).select("piece", *columns)
    if not with_ids:
        return packed.drop("piece")
    return packed.join(made.select("piece", "ids"), "piece").drop("piece")

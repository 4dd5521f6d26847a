"""Language identification by unigram pieces, summed over all segmentations."""

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import sentencepiece
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threatlens.llm.graphs import low_hash
from threatlens.session import shared_folder, stage

UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
#: Longer words are cut at every so many letters, so that no product underflows.
LONGEST_WORD = 40
WORD_START = "▁"
UNKNOWN_LETTER = 1e-7
SMOOTHING = 0.01
#: The bound of the training sample.
DOCUMENTS_PER_LANGUAGE = 1_000
ROUNDS = 4
CHUNK_CHARACTERS = 4_000_000
CACHED_WORDS = 250_000


def words_of(text: str | None) -> list[str]:
    """Lower-cased words with a mark at their start; long ones in several parts."""
    found = WORD.findall((text or "").lower())
    if any(len(w) > LONGEST_WORD for w in found):
        found = [w[i : i + LONGEST_WORD] for w in found for i in range(0, len(w), LONGEST_WORD)]
    return found


@dataclass
class Pieces:
    """The lower-case letter pieces of a fixed vocabulary, found by rolling hashes."""

    names: list[str]
    hashes: np.ndarray = field(init=False)
    order: np.ndarray = field(init=False)
    maybe: np.ndarray = field(init=False)
    longest: int = field(init=False)

    STEP = np.uint64(0x9E3779B97F4A7C15)

    def __post_init__(self) -> None:
        made = np.zeros(len(self.names), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for i, name in enumerate(self.names):
                for c in name:
                    made[i] = made[i] * self.STEP + np.uint64(ord(c))
        self.order = np.argsort(made)
        self.hashes = made[self.order]
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[self.hashes >> np.uint64(44)] = True
        self.longest = max(map(len, self.names))

    @classmethod
    def load(cls, path: str) -> "Pieces":
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = {model.id_to_piece(i) for i in range(model.get_piece_size())}
        kept = [n for n in names if n == n.lower() and (n.removeprefix(WORD_START).isalpha() or n == WORD_START)]
        return cls(sorted(kept))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose hash is a piece, and those pieces."""
        rows = np.flatnonzero(self.maybe[hashes >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[rows]), len(self.hashes) - 1)
        right = self.hashes[at] == hashes[rows]
        return rows[right], self.order[at[right]]

    def lattice(self, letters: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, piece) for words of one length; letters has a row per word.

        A single letter that is no piece is the piece after the last.
        """
        n = letters.shape[1]
        for start in range(n):
            hashes = np.zeros(len(letters), dtype=np.uint64)
            for end in range(start + 1, min(n, start + self.longest) + 1):
                hashes = hashes * self.STEP + letters[:, end - 1]
                rows, piece = self.find(hashes)
                if end == start + 1 and len(rows) < len(letters):
                    whole = np.full(len(letters), len(self.names))
                    whole[rows] = piece
                    rows, piece = np.arange(len(letters)), whole
                if len(rows):
                    yield start, end, rows, piece


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indices, letters) of the words of each length, their start marked."""
    groups = defaultdict(list)
    for i, word in enumerate(words):
        groups[len(word)].append(i)
    for n, members in groups.items():
        joined = "".join(WORD_START + words[i] for i in members)
        letters = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(-1, n + 1)
        yield np.array(members), letters.astype(np.uint64)


def forward(pieces: Pieces, probability: np.ndarray, words: list[str]) -> np.ndarray:
    """Log probability of each word in each language, summed over all its segmentations.

    `probability` has a row per piece and one for an unknown letter, a column per language.
    """
    made = np.zeros((len(words), probability.shape[1]))
    for members, letters in by_length(words):
        total = np.zeros((letters.shape[1] + 1, len(members), probability.shape[1]))
        total[0] = 1.0
        for start, end, rows, piece in pieces.lattice(letters):
            total[end][rows] += total[start][rows] * probability[piece]
        made[members] = np.log(total[-1])
    return made


def expected_counts(
    pieces: Pieces, probability: np.ndarray, words: list[str], counts: np.ndarray
) -> np.ndarray:
    """How often each piece is used in words seen so often, over all segmentations."""
    made = np.zeros(len(pieces.names) + 1)
    for members, letters in by_length(words):
        n = letters.shape[1]
        arcs = [*pieces.lattice(letters)]
        before, after = np.zeros((n + 1, len(members))), np.zeros((n + 1, len(members)))
        before[0] = after[n] = 1.0
        for start, end, rows, piece in arcs:
            before[end][rows] += before[start][rows] * probability[piece]
        for start, end, rows, piece in reversed(arcs):
            after[start][rows] += probability[piece] * after[end][rows]
        weight = counts[members] / before[n]
        for start, end, rows, piece in arcs:
            used = before[start][rows] * probability[piece] * after[end][rows] * weight[rows]
            np.add.at(made, piece, used)
    return made


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: Pieces
    probability: np.ndarray


def _sample(labelled: DataFrame, id_col: str, lang_col: str, bound: int) -> DataFrame:
    """At most `bound` documents of each language, those with the smallest hashed ids."""
    place = F.xxhash64(F.col(id_col).cast("string"))
    keys = labelled.select(F.col(lang_col).alias("lang"), place.alias("place"))
    # Of a language with many rows only the low hashes, about twice the bound, are ranked.
    share = F.lit(0.0)
    for lang, n in keys.groupBy("lang").count().collect():  # one row per language
        share = F.when(F.col("lang") == lang, min(1.0, 2 * bound / n)).otherwise(share)
    low = keys.filter(low_hash(F.col("place"), share))
    window = Window.partitionBy("lang").orderBy("place")
    first = low.withColumn("n", F.row_number().over(window)).filter(F.col("n") <= bound)
    limits = first.groupBy("lang").agg(F.max("place").alias("place")).collect()
    within = F.lit(False)
    for lang, limit in limits:  # one row per language
        within = within | ((F.col(lang_col) == lang) & (place <= limit))
    return labelled.filter(within)


def train(
    labelled: DataFrame,
    vocabulary_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    documents_per_language: int = DOCUMENTS_PER_LANGUAGE,
    rounds: int = ROUNDS,
    staging: str | None = None,
) -> LanguageModel:
    """Piece probabilities of every language of `labelled`, by expectation maximisation.

    Rows with a null label, id or text are not learned from. Whole texts of a bounded
    sample give word counts; each round sums expected piece counts over all segmentations
    on the executors, and only one number per piece and language comes back. No labelled
    row gives a model without languages, which predicts `und`.
    """
    folder = shared_folder(labelled.sparkSession, staging)
    pieces = Pieces.load(vocabulary_path)
    usable = labelled.dropna(subset=[id_col, text_col, lang_col])

    def count(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lang, texts in frame.groupby("lang", sort=False)["text"]:
                found = pd.Series([w for t in texts for w in words_of(t)], dtype=object).value_counts()
                yield pd.DataFrame({"lang": lang, "word": found.index, "n": found.to_numpy()})

    sample = _sample(usable, id_col, lang_col, documents_per_language).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )
    seen = stage(
        sample.mapInPandas(count, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n")),
        f"{folder}/words",
    )
    languages = sorted(r.lang for r in seen.select("lang").distinct().collect())
    probability = np.full((len(pieces.names) + 1, len(languages)), 1 / len(pieces.names))
    probability[-1] = UNKNOWN_LETTER
    for _ in range(rounds if languages else 0):

        def expect(frames: Iterable[pd.DataFrame], now: np.ndarray = probability) -> Iterator[pd.DataFrame]:
            totals = np.zeros_like(now)
            for frame in frames:
                for lang, part in frame.groupby("lang", sort=False):
                    k = languages.index(lang)
                    for i in range(0, len(part), 50_000):
                        some = part.iloc[i : i + 50_000]
                        totals[:, k] += expected_counts(
                            pieces, now[:, k], some["word"].tolist(), some["n"].to_numpy(dtype=float)
                        )
            piece, k = np.nonzero(totals)
            yield pd.DataFrame({"piece": piece, "language": k, "used": totals[piece, k]})

        sums = (
            seen.mapInPandas(expect, "piece int, language int, used double")
            .groupBy("piece", "language")
            .agg(F.sum("used").alias("used"))
            .toPandas()
        )
        used = np.zeros_like(probability)
        used[sums["piece"], sums["language"]] = sums["used"]
        used = used[:-1] + SMOOTHING
        probability = np.vstack([used / used.sum(axis=0), probability[-1:]])
    return LanguageModel(languages, pieces, probability)


class _Scores(dict):
    """Word to its row of log probabilities; new words wait until `settle`."""

    def __init__(self, model: LanguageModel) -> None:
        self.model, self.waiting = model, []
        self.table = np.zeros((0, len(model.languages)))

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self.table) + len(self.waiting)
        self.waiting.append(word)
        return at

    def settle(self) -> np.ndarray:
        made = [self.table]
        for i in range(0, len(self.waiting), 50_000):
            made.append(forward(self.model.pieces, self.model.probability, self.waiting[i : i + 50_000]))
        self.waiting, self.table = [], np.concatenate(made)
        return self.table

    def forget(self) -> None:
        self.clear()
        self.table = self.table[:0]


def predict_texts(model: LanguageModel, texts: Iterable[str | None], scores: _Scores | None = None) -> tuple[list, list]:
    """Predicted language and its posterior, with equal priors, for each text."""
    scores = _Scores(model) if scores is None else scores
    rows, lengths, known = [], [], []
    for text in texts:
        words = words_of(text)
        known.append(bool(words) and bool(model.languages) and any(map(str.isalpha, text)))
        lengths.append(len(words))
        rows.append(np.fromiter(map(scores.__getitem__, words), dtype=np.int64, count=len(words)))
    if not model.languages:
        return [UNKNOWN] * len(rows), [0.0] * len(rows)
    table = scores.settle()
    at = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
    document = np.repeat(np.arange(len(rows)), lengths)
    likely = np.stack(
        [np.bincount(document, weights=table[at, k], minlength=len(rows)) for k in range(table.shape[1])], axis=1
    )
    best = likely.argmax(axis=1)
    posterior = 1 / np.exp(likely - likely.max(axis=1, keepdims=True)).sum(axis=1)
    if len(scores) > CACHED_WORDS:
        scores.forget()
    return (
        [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)],
        [float(p) if k else 0.0 for p, k in zip(posterior, known, strict=True)],
    )


def identify(
    documents: DataFrame, model: LanguageModel, carry: list[str], text_col: str = "text"
) -> DataFrame:
    """The carried columns of every row, and lang_pred and score of its whole text.

    A text that is null or has no letter is `und` with score 0. Only the text is an input
    of the prediction. Repeated rows are predicted alike. A carried column must not be
    called lang_pred or score; other columns are not read.
    """
    at = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _Scores(model)
        for batch in batches:
            texts = batch.column(at)
            ends, size = [], 0
            for i, n in enumerate(pa.compute.binary_length(texts).to_pylist()):
                size += n or 0
                if size > CHUNK_CHARACTERS or i == len(texts) - 1:
                    ends.append(i + 1)
                    size = 0
            start = 0
            for end in ends:
                languages, score = predict_texts(model, texts.slice(start, end - start).to_pylist(), scores)
                part = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:at], pa.array(languages, pa.string()), pa.array(score, pa.float64())],
                    [*carry, "lang_pred", "score"],
                )
                start = end

    kinds = [f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in carry]
    chosen = documents.select(*carry, F.col(text_col).alias("_text"))
    return chosen.mapInArrow(run, ", ".join([*kinds, "lang_pred string", "score double"]))


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; fold 1 is held out. Null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3

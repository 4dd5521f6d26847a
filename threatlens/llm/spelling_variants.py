"""Spelling variants: exact neighbours of a dictionary by pairs of trie nodes."""

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatlens.session import shared_folder, stage

#: Maximal runs of these are words.
RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LETTERS, LEAST_COUNT, DAMAGE = 5, 3, 97
#: A word's form is this many times as frequent.
RATIO = 2
#: Nodes above this depth lie in several subtries and are numbered by their letters.
STEM = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int | None = DAMAGE) -> DataFrame:
    """(word, n): distinct runs of letters of all texts, A-Z lower-cased, and how often each stands.

    With `damage`, a run whose crc32 of `<id>:<run>` it divides loses one code point, at that
    checksum modulo its length; a null id is written as nothing. Counts are combined before
    the shuffle, so a word of a third of all text costs one row a task.
    """
    runs = F.explode(F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(RUN), F.lit(0)))
    said = documents.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), runs.alias("word"))
    if damage:
        said = said.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word").cast("binary")))
        at = (F.col("h") % F.length("word")).cast("int")
        shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        said = said.withColumn("word", F.when(F.col("h") % damage == 0, shorter).otherwise(F.col("word")))
    return said.groupBy("word").agg(F.count("*").alias("n"))


def dictionary(counts: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    return counts.filter((F.length("word") >= least_letters) & (F.col("n") >= least_count))


def _stem_number(stem: str) -> int:
    """A negative number of its own for each of the first letters of a word, none included."""
    number = 0
    for letter in stem:
        number = (number << 21) | (ord(letter) + 1)
    return -1 - number


def _numbered(words: DataFrame, spelled: Column) -> DataFrame:
    """(word, n, place, nodes): the trie nodes of all beginnings of `spelled`, the empty one first.

    Words are range-partitioned by their first letters, so a subtrie below them lies in one
    partition, and sorted; the path of the last word is all a task has to hold. Places follow
    the order of `spelled`.
    """

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, last, fresh, row, first = [], "", 0, 0, None
        for frame in frames:
            all_nodes = []
            for part, word in zip(frame["part"].tolist(), frame["spelled"]):
                first = part << 40 if first is None else first
                same = 0
                while same < min(len(last), len(word)) and last[same] == word[same]:
                    same += 1
                path = path[: same + 1]
                while len(path) <= len(word):
                    if len(path) <= STEM:
                        path.append(_stem_number(word[: len(path)]))
                    else:
                        path.append(first + fresh)
                        fresh += 1
                last = word
                all_nodes.append(np.array(path, dtype=np.int64))
            yield frame[["word", "n"]].assign(place=first + row + np.arange(len(frame)), nodes=all_nodes)
            row += len(frame)

    stem = F.substring(spelled, 1, STEM)
    spread = words.select("word", "n", spelled.alias("spelled"), stem.alias("stem")).repartitionByRange("stem")
    ordered = spread.sortWithinPartitions("stem", "spelled").withColumn("part", F.spark_partition_id().cast("long"))
    return ordered.select("word", "n", "spelled", "part").mapInPandas(walk, "word string, n long, place long, nodes array<long>")


def trie_pairs(words: DataFrame, folder: str) -> DataFrame:
    """(word_id, n, left, right, whole, last): every way to see a word with nothing or one letter left out.

    left is the node of what stands before, right the node (in the trie of reversed words) of
    what stands after. `whole` pairs leave nothing out. `last` marks the letter that ends a
    run of equal letters: leaving out any of the run gives the same word. word_id follows the
    order of the words.
    """
    forward = _numbered(words, F.col("word"))
    backward = _numbered(words, F.reverse("word")).select("word", F.reverse("nodes").alias("after"))
    both = stage(forward.join(backward, "word"), f"{folder}/tries")
    at = F.col("at")
    letter = F.substring("word", at + 1, F.lit(1))
    shared = both.withColumn("at", F.explode(F.sequence(F.lit(0), F.length("word"))))
    skipped = shared.filter(at < F.length("word")).select(
        F.col("place").alias("word_id"), "n", F.get("nodes", at).alias("left"), F.get("after", at + 1).alias("right"),
        F.lit(False).alias("whole"), (letter != F.substring("word", at + 2, F.lit(1))).alias("last"),
    )
    kept = shared.select(
        F.col("place").alias("word_id"), "n", F.get("nodes", at).alias("left"), F.get("after", at).alias("right"),
        F.lit(True).alias("whole"), F.lit(False).alias("last"),
    )
    return skipped.union(kept)


def _meetings(pairs: DataFrame) -> DataFrame:
    """(word_id, n, n_near, best) of the words that meet others in a pair of nodes.

    A pair is met by at most one whole word and by words that differ in one letter, so a group
    is no larger than the alphabet. Each member takes the count and the best of the others:
    the two best of the group are enough, and no pair of words is written.
    """
    member = F.struct((-F.col("n")).alias("less"), "word_id")
    grouped = pairs.groupBy("left", "right").agg(
        F.sort_array(F.collect_list(F.when(~F.col("whole"), F.struct(member.alias("m"), "last")))).alias("skips"),
        F.max(F.when(F.col("whole"), member)).alias("full"),
    ).filter((F.size("skips") > 1) | (F.col("full").isNotNull() & F.exists("skips", lambda s: s["last"])))
    skips, full = F.col("skips"), F.col("full")
    first, second = F.get(skips, F.lit(0))["m"], F.get(skips, F.lit(1))["m"]
    shorter = F.transform(skips, lambda s: F.struct(
        s["m"].alias("m"),
        (F.size(skips) - 1 + (s["last"] & full.isNotNull()).cast("int")).alias("n_near"),
        F.least(
            F.when(s["m"] == first, second).otherwise(first), F.when(s["last"], full)
        ).alias("best"),
    ))
    longer = F.filter(skips, lambda s: s["last"])
    of_full = F.array(F.struct(full.alias("m"), F.size(longer).alias("n_near"), F.get(longer, F.lit(0))["m"].alias("best")))
    return grouped.select(F.explode(F.concat(shorter, of_full)).alias("x")).select(
        F.col("x.m.word_id").alias("word_id"), F.col("x.n_near").alias("n_near"), F.col("x.best").alias("best")
    ).filter("word_id is not null and best is not null")


def roots(forms: DataFrame, folder: str) -> DataFrame:
    """(word_id, root): the last of the forms that follow each other from a word.

    A form is at least RATIO times as frequent, so a chain has at most the logarithm of the
    largest count, and doubling the steps reaches its end in the logarithm of that.
    """
    steps = stage(forms.select("word_id", F.col("form_id").alias("root")), f"{folder}/steps-0")
    top = forms.agg(F.max("form_n")).first()[0] or 1
    for turn in range(ceil(log2(max(2, log2(top) / log2(RATIO) + 1)))):
        onward = steps.select(F.col("word_id").alias("root"), F.col("root").alias("end"))
        steps = stage(
            steps.join(onward, "root", "left").select("word_id", F.coalesce("end", "root").alias("root")),
            f"{folder}/steps-{turn + 1}",
        )
    return steps


def spelling_forms(words: DataFrame, ratio: int = RATIO, staging: str | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of `words` (word, n), words distinct.

    Two words are near if one inserted, deleted or replaced code point makes one the other.
    A word's form is its near word of largest n (ties: the first in code-point order), if that
    n is at least `ratio` times the word's own, else null; root follows the forms to the last,
    and is the word itself without one. Words of any length are compared whole. A null word
    or count is left out; the empty word has its place in the trie. Other columns are not read.
    No row gives no row.
    """
    folder = shared_folder(words.sparkSession, staging)
    words = stage(words.select("word", "n").filter("word is not null and n is not null"), f"{folder}/words")
    pairs = stage(trie_pairs(words, folder), f"{folder}/pairs")
    near = _meetings(pairs).groupBy("word_id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    tries = words.sparkSession.read.parquet(f"{folder}/tries")
    named = tries.select("word", "n", F.col("place").alias("word_id"))
    form_n = -F.col("best.less")
    judged = stage(
        named.join(near, "word_id", "left").select(
            "word_id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(form_n >= ratio * F.col("n"), F.col("best.word_id")).alias("form_id"),
            F.when(form_n >= ratio * F.col("n"), form_n).alias("form_n"),
        ),
        f"{folder}/judged",
    )
    last = roots(judged.filter("form_id is not null"), folder)
    form = judged.select(F.col("word_id").alias("form_id"), F.col("word").alias("form"))
    root = judged.select(F.col("word_id").alias("root_id"), F.col("word").alias("root"))
    return (
        judged.join(last.withColumnRenamed("root", "root_id"), "word_id", "left")
        .join(form, "form_id", "left").join(root, "root_id", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    )

"""Personal data: fixed formats, and generated candidates chosen by gradient boosting."""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threatlens.llm.graphs import low_hash
from threatlens.session import shared_folder, stage

KINDS = ["email", "ip", "card", "phone"]
#: The base formats. Emails are found from their "@" outwards.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY_DIGIT = re.compile(r"[0-9]")

#: Generators of candidates: loose forms of the kinds, and what they usually stand for.
GENERATORS = [
    (0, re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63})*")),
    (1, re.compile(r"(?<![0-9])[0-9]{1,4}(?:[.,:][0-9]{1,4}){2,5}")),
    (2, re.compile(r"(?<![0-9])[0-9](?:[ ./-]{0,2}[0-9]){11,22}(?![0-9])")),
    (3, re.compile(r"(?<![0-9+])(?:\+|00)?[(]?[0-9]{1,5}(?:[ ().-]{1,2}[0-9]{2,5}){1,6}(?![0-9])")),
]
HINTS = re.compile(r"(mail|contact|phone|tel|call|fax|mobile|card|visa|ip|host|addr)\W*$", re.IGNORECASE)
NEAR = 24

#: The bound of the training sample, dealt evenly to kinds and labels, and how sure an added
#: span must be. Scores are counted in so many bins.
SAMPLE = 20_000
SCORE_BINS = 1_000
TREES, DEPTH, SEED = 12, 4, 1
PRECISION = 0.98


def digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def luhn(number: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in number[-2::-2]]
    return (sum(map(int, number[-1::-2])) + sum(doubled)) % 10 == 0


def _small(part: str) -> bool:
    short = part.lstrip(".").lstrip("0")
    return len(short) <= 3 and int(short or 0) <= 255


def emails(text: str) -> list[tuple[int, int]]:
    made, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1)
        if start < at and domain:
            made.append((start, domain.end()))
            end = domain.end()
        at = text.find("@", max(at + 1, end))
    return made


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base formats, by kind, then start."""
    made = [(0, *span) for span in emails(text)]
    if ANY_DIGIT.search(text):
        for m in IP.finditer(text):
            if all(map(_small, m.group().split("."))):
                made.append((1, *m.span()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16 and 16 <= len(n := digits(m.group())) <= 19 and luhn(n):
                made.append((2, *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= len(digits(m.group())) <= 15:
                    made.append((3, *m.span()))
    return made


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of one candidate."""
    span = text[start:end]
    number = digits(span)
    groups = re.findall("[0-9]+", span)
    letters = sum(map(str.isalpha, span))
    before, after = text[max(0, start - NEAR) : start], text[end : end + NEAR]
    return [
        *(float(kind == k) for k in range(len(KINDS))),
        float(len(span)), float(len(number)), float(letters), float(len(span) - len(number) - letters),
        float(len(groups)), float(max(map(len, groups), default=0)), float(min(map(len, groups), default=0)),
        float(span[0] == "+"), float("(" in span), float(span.count(".")), float(span.count("-")), float(span.count("@")),
        float(bool(number) and luhn(number)), float(bool(groups) and all(map(_small, groups))),
        float(len(set(number))), float(number[:1] == "0"),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:].isspace()), float(after[:1].isspace()),
        float(len(digits(before))), float(len(digits(after))), float(bool(HINTS.search(before))),
    ]


def disguises(kind: int, span: str) -> list[str]:
    """A base span as people also write it: other signs and separators, no prefix."""
    if kind == 0:
        local, domain = span.rsplit("@", 1)
        return [
            f"{local} @ {domain}", f"{local}(at){domain}", f"{local} [at] {domain.replace('.', ' [dot] ')}",
            f"{local}@{domain.replace('.', '(dot)')}",
        ]
    if kind == 1:
        return [span.replace(".", c) for c in (",", ":")]
    if kind == 2:
        fours = [digits(span)[i : i + 4] for i in range(0, len(digits(span)), 4)]
        return [c.join(fours) for c in (".", "/", "  ", " - ")]
    return [span[1:], f"00{span[1:]}", re.sub("[() -]+", ".", span[1:]), re.sub("[(). -]+", "-", span[1:])]


def spoilt(kind: int, span: str) -> list[str]:
    """What only looks like a base span: no domain, a part too large or missing, a wrong check digit.

    Of phone numbers the texts hold enough look-alikes.
    """
    if kind == 0:
        return [f"{span.rsplit('@', 1)[0]} @ {span.rsplit('@', 1)[1].split('.')[0]}"]
    if kind == 1:
        parts = span.split(".")
        return [",".join([str(256 + int(parts[0]) % 700), *parts[1:]]), ":".join(parts[:3])]
    if kind == 2:
        number = digits(span)
        wrong = number[:-1] + str((int(number[-1]) + 1 + len(set(number)) % 8) % 10)
        return [".".join(wrong[i : i + 4] for i in range(0, len(wrong), 4))]
    return []


def examples_of(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, list[float]]]:
    """(kind, label, features): disguised and spoilt base spans in the text around them, as proposed there."""
    made = []
    for kind, start, end in base:
        left, right = text[max(0, start - NEAR - 8) : start], text[end : end + NEAR + 8]
        for label, written in ((1, disguises(kind, text[start:end])), (2, spoilt(kind, text[start:end]))):
            for new in written:
                near, middle = left + new + right, range(len(left), len(left) + len(new))
                if any(s < middle.stop and e > middle.start for _, s, e in base_spans(near)):
                    continue
                for m in dict(GENERATORS)[kind].finditer(near):
                    if m.start() < middle.stop and m.end() > middle.start:
                        made.append((kind, label, features(near, kind, *m.span())))
                        break
    return made


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, list[float]]]:
    """(kind, start, end, label, features): label 0 for a proposal apart from all base spans.

    Proposals that only overlap a base span are part of it or a worse cut of it: left out.
    Examples that are not in the text have label 1 (disguised) or 2 (spoilt) and no place.
    """
    spans = set()
    mail, number = "@" in text or "(at)" in text or "[at]" in text, bool(ANY_DIGIT.search(text))
    taken = sorted((s, e) for _, s, e in base)
    starts = np.array([s for s, _ in taken], dtype=np.int64)
    ends = np.maximum.accumulate([e for _, e in taken]) if taken else np.zeros(0, np.int64)
    for kind, pattern in GENERATORS:
        if mail if kind == 0 else number:
            for m in pattern.finditer(text):
                earlier = int(np.searchsorted(starts, m.end())) - 1
                if earlier < 0 or ends[earlier] <= m.start():
                    spans.add((kind, *m.span()))
    made = [(k, s, e, 0, features(text, k, s, e)) for k, s, e in sorted(spans)]
    return made + [(k, -1, -1, label, f) for k, label, f in examples_of(text, base)]


SPANS = "array<struct<kind: int, start: int, end: int>>"
CANDIDATES = "array<struct<kind: int, start: int, end: int, label: int, features: array<float>>>"


def _generate(documents: DataFrame, carry: list[str], text_col: str) -> DataFrame:
    n = len(carry)
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    candidate = pa.struct([*span, ("label", pa.int32()), ("features", pa.list_(pa.float32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, proposed = [], []
            for value in batch.column(n):
                text = value.as_py() or ""
                found = base_spans(text)
                base.append([dict(zip(("kind", "start", "end"), x, strict=True)) for x in found])
                names = ("kind", "start", "end", "label", "features")
                proposed.append([dict(zip(names, x, strict=True)) for x in candidates(text, found)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(base, pa.list_(span)), pa.array(proposed, pa.list_(candidate))],
                [*carry, "base", "candidates"],
            )

    kinds = [f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in carry]
    schema = ", ".join([*kinds, f"base {SPANS}", f"candidates {CANDIDATES}"])
    return documents.select(*carry, F.col(text_col).alias("_text")).mapInArrow(run, schema)


def _sample(examples: DataFrame, bound: int) -> DataFrame:
    """Of each kind and label at most `bound` examples, those with the smallest hash `place`."""
    share = F.lit(0.0)
    for kind, label, n in examples.groupBy("kind", "label").count().collect():  # two rows per kind
        share = F.when((F.col("kind") == kind) & (F.col("label") == label), min(1.0, 2 * bound / n)).otherwise(share)
    nth = F.row_number().over(Window.partitionBy("kind", "label").orderBy("place"))
    return examples.filter(low_hash(F.col("place"), share)).withColumn("nth", nth).filter(F.col("nth") <= bound).drop("nth")


def _calibrated(model: GBTClassificationModel, held_out: DataFrame, precision: float) -> dict[int, int]:
    """Per kind the lowest bin of scores from which on the held-out precision is high enough.

    All held-out examples are scored by the executors; the driver gets their counts by bin.
    """
    bins = (
        model.transform(held_out).groupBy("kind", _bin().alias("bin"))
        .agg(F.count("*").alias("n"), F.sum("label").alias("right"))
    )
    above = Window.partitionBy("kind").orderBy(F.desc("bin"))
    good = F.sum("right").over(above) >= F.lit(precision) * F.sum("n").over(above)
    rows = bins.select("kind", "bin", good.alias("good")).filter("good").groupBy("kind").agg(F.min("bin")).collect()
    return dict(map(tuple, rows))  # one row per kind


def _score() -> Column:
    return vector_to_array("probability")[1]


def _bin() -> Column:
    return F.floor(_score() * SCORE_BINS).cast("int")


def find_personal_data(
    documents: DataFrame,
    carry: list[str],
    text_col: str = "text",
    sample: int = SAMPLE,
    precision: float = PRECISION,
    staging: str | None = None,
) -> DataFrame:
    """The carried columns of every row, `base` and `added` spans: (kind, start, end).

    Positions are code points, ends exclusive; kind counts in KINDS. Base spans always
    stay. Boosted trees learn from a bounded, hashed sample of examples, as many of each kind and
    label, by format and context: base spans written in other ways (`disguises`) against
    proposals without a hint apart from base spans and spoilt ones (`spoilt`), so what decides is
    not the base format itself. Examples with equal kind, label and features are one. A quarter of all, by hash, is
    held out, and all of it calibrates a threshold for each kind. Proposals that pass are added,
    of overlapping ones the best (then the first). Without examples of both labels nothing is
    added, nor of a kind that has no base span among the held-out examples: tables with a few
    spans of a kind may have none. Null texts are empty; repeated rows are scanned alike; nulls
    and other columns do no harm. A carried column must not be called base, added or uid.
    """
    folder = shared_folder(documents.sparkSession, staging)
    found = stage(
        _generate(documents, carry, text_col).withColumn("uid", F.monotonically_increasing_id()), f"{folder}/found"
    )
    every = found.select("uid", F.explode("candidates").alias("c")).select("uid", "c.*")
    # Proposals after a hint may well be personal data: they teach nothing. The others are
    # shown with and without one, so that a hint alone decides nothing either.
    known = every.filter((F.col("label") > 0) | (F.element_at("features", -1) == 0)).select(
        "kind", (F.col("label") == 1).cast("int").alias("label"), "features"
    )
    hinted = F.concat(F.slice("features", 1, F.size("features") - 1), F.array(F.lit(1.0).cast("float")))
    known = known.union(known.filter("label = 0").withColumn("features", hinted))
    examples = stage(
        known.distinct().withColumn("place", F.xxhash64("kind", "label", "features"))
        .withColumn("held_out", F.pmod(F.xxhash64("place"), F.lit(4)) == 0),
        f"{folder}/examples",
    )
    training = stage(
        _sample(examples.filter("not held_out"), max(sample // (2 * len(KINDS)), 1))
        .withColumn("features", array_to_vector("features")), f"{folder}/sample"
    )
    if training.select("label").distinct().count() < 2:
        return found.select(*carry, "base", F.expr(f"cast(array() as {SPANS})").alias("added"))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(training)
    held_out = examples.filter("held_out").withColumn("features", array_to_vector("features"))
    limits = _calibrated(model, held_out, precision)

    limit = F.lit(SCORE_BINS + 1)
    for kind, low in limits.items():
        limit = F.when(F.col("kind") == kind, low).otherwise(limit)
    proposals = every.filter("label = 0").withColumn("features", array_to_vector("features"))
    passed = (
        model.transform(proposals).withColumn("p", _score()).filter(_bin() >= limit)
        .groupBy("uid")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("p")).alias("p"), "start", "end", "kind"))).alias("passed"))
    )

    def keep(chosen: Column, c: Column) -> Column:
        apart = F.forall(chosen, lambda x: (x["end"] <= c["start"]) | (x["start"] >= c["end"]))
        one = F.array(F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
        return F.when(apart, F.concat(chosen, one)).otherwise(chosen)

    none = F.expr(f"cast(array() as {SPANS})")
    added = F.coalesce(F.sort_array(F.aggregate("passed", none, keep)), none)
    return found.join(passed, "uid", "left").select(*carry, "base", added.alias("added"))


def as_text(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
        ), ","
    )

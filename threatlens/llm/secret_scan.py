"""Secrets in texts: fixed formats, and tokens that pass a battery of randomness tests."""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threatlens.session import shared_folder, stage

#: The base formats, and what a match must have to count.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
#: A run matched as a whole: a shorter one fails and holds no other match.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
KINDS = ["assign", "access", "hex", "random"]

#: Whole runs of token characters; base64 may end in padding.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}"
DIGITS, UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Encodings from narrow to wide: the first one whose alphabet holds the token is inferred.
ENCODINGS = [
    ("^[0-9a-f]+$", DIGITS + LOWER[:6]),
    ("^[0-9A-F]+$", DIGITS + UPPER[:6]),
    ("^[A-Z2-7]+$", UPPER + DIGITS[2:8]),
    ("^[0-9a-z]+$", DIGITS + LOWER),
    ("^[0-9A-Z]+$", DIGITS + UPPER),
    ("^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER),
    ("^[0-9A-Za-z+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("^[0-9A-Za-z_-]+$", UPPER + LOWER + DIGITS + "-_"),
]
#: Lower ends of the length classes; false discoveries are controlled in each.
LENGTH_CLASSES = [16, 20, 32, 48, 96]
BINS = 100
FALSE_DISCOVERIES = 0.05


def matches(text: Column, pattern: str, *groups: int) -> Column:
    """Array of (start, end, g0, g...) of the leftmost non-overlapping matches, in code points.

    The text is split at the matches; the lengths of the parts and of the matches add up to
    the positions. Texts without a match are only tested.
    """
    found = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, *groups)]
    parts = F.arrays_zip(F.split(text, pattern).alias("gap"), *[f.alias(f"g{i}") for i, f in enumerate(found)])
    values = [f"g{i}" for i in range(len(found))]
    empty = "cast(array() as array<struct<start: int, end: int, " + ", ".join(f"{v}: string" for v in values) + ">>)"

    def step(done: Column, part: Column) -> Column:
        start = done["at"] + F.length(part["gap"])
        end = start + F.coalesce(F.length(part["g0"]), F.lit(0))
        one = F.struct(start.alias("start"), end.alias("end"), *[part[v].alias(v) for v in values])
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(one)).alias("spans"))

    walked = F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.expr(empty).alias("spans")), step)["spans"]
    return F.when(text.rlike(pattern), F.filter(walked, lambda m: m["g0"].isNotNull())).otherwise(F.expr(empty))


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, by a rational approximation (error 1.5e-7)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    half = poly * F.exp(-x * x) / 2
    return F.when(z >= 0, half).otherwise(1 - half)


def tested(tokens: Column) -> Column:
    """Each (start, end, g0) that has an inferred encoding, with its length, p value and a hash.

    Under "uniform and independent over the encoding's alphabet": chi-squared of the letter
    counts, with its exact mean and variance, so that short tokens count; runs above and
    below the middle of the alphabet; serial correlation of neighbours. The three p values
    are combined by Fisher's method. Every step is a pass of its own, so that nothing is
    computed twice.
    """
    lettered = F.filter(tokens, lambda m: m["g0"].rlike("[A-Za-z]"))

    def bare(m: Column) -> Column:
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), F.rtrim(m["g0"], F.lit("=")).alias("token"))

    def encoded(m: Column) -> Column:
        alphabet = F.lit(None).cast("string")
        for pattern, letters in reversed(ENCODINGS):
            alphabet = F.when(m["token"].rlike(pattern), letters).otherwise(alphabet)
        return F.struct(*[m[c].alias(c) for c in ("start", "end", "token")], alphabet.alias("alphabet"))

    def counted(m: Column) -> Column:
        n = F.length(m["token"])
        letters = F.split(m["token"], "")
        squares = F.aggregate(
            F.array_distinct(letters),
            F.lit(0).cast("double"),
            lambda s, c: s + F.pow((n - F.length(F.replace(m["token"], c, F.lit("")))).cast("double"), F.lit(2.0)),
        )
        values = F.transform(letters, lambda c: (F.instr(m["alphabet"], c) - 1).cast("double"))
        return F.struct(
            m["start"].alias("start"), m["end"].alias("end"), n.alias("n"), F.xxhash64(m["token"]).alias("h"),
            F.length(m["alphabet"]).alias("size"), squares.alias("squares"), values.alias("values"),
        )

    def measured(m: Column) -> Column:
        n, x = m["n"], m["values"]
        middle = m["size"] / 2
        mean = F.aggregate(x, F.lit(0.0), lambda s, v: s + v) / n
        pairs = F.arrays_zip(F.slice(x, 1, n - 1).alias("a"), F.slice(x, 2, n - 1).alias("b"))
        return F.struct(
            *[m[c].alias(c) for c in ("start", "end", "n", "h", "size", "squares")],
            mean.alias("mean"), pairs.alias("pairs"), x.alias("values"),
            F.size(F.filter(x, lambda v: v >= middle)).alias("high"),
            (1 + F.size(F.filter(pairs, lambda p: (p["a"] >= middle) != (p["b"] >= middle)))).alias("runs"),
        )

    def scored(m: Column) -> Column:
        n, size = m["n"].cast("double"), m["size"].cast("double")
        chi = size / n * m["squares"] - n
        z_chi = (chi - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)
        both = m["high"] * (n - m["high"])
        expected = 1 + 2 * both / n
        spread = (expected - 1) * (expected - 2) / (n - 1)
        z_runs = F.when(spread > 0, (m["runs"] - expected) / F.sqrt(spread)).otherwise(9.0)
        top = F.aggregate(m["pairs"], F.lit(0.0), lambda s, p: s + (p["a"] - m["mean"]) * (p["b"] - m["mean"]))
        base = F.aggregate(m["values"], F.lit(0.0), lambda s, v: s + (v - m["mean"]) * (v - m["mean"]))
        z_serial = F.when(base > 0, (top / base + 1 / n) * F.sqrt(n)).otherwise(9.0)
        return F.struct(
            *[m[c].alias(c) for c in ("start", "end", "n", "h")],
            _tail(z_chi).alias("uniform"), (2 * _tail(F.abs(z_runs))).alias("runs"),
            (2 * _tail(F.abs(z_serial))).alias("serial"),
        )

    def combined(m: Column) -> Column:
        x = F.lit(0.0)
        for c in ("uniform", "runs", "serial"):
            x = x - F.log(F.greatest(m[c], F.lit(1e-30)))
        return F.struct(*[m[c].alias(c) for c in ("start", "end", "n", "h")], x.alias("x"))

    def final(m: Column) -> Column:  # upper tail of chi-squared with 6 degrees at 2x
        p = F.exp(-m["x"]) * (1 + m["x"] + m["x"] * m["x"] / 2)
        return F.struct(*[m[c].alias(c) for c in ("start", "end", "n", "h")], p.alias("p"))

    known = F.filter(F.transform(F.transform(lettered, bare), encoded), lambda m: m["alphabet"].isNotNull() & (F.length(m["token"]) >= LENGTH_CLASSES[0]))
    steps = known
    for step in (counted, measured, scored, combined, final):
        steps = F.transform(steps, step)
    return steps


def _class(n: Column) -> Column:
    return sum(((n >= low).cast("int") for low in LENGTH_CLASSES[1:]), F.lit(0))


def _bin(p: Column) -> Column:
    return F.least(F.floor(p * BINS), F.lit(BINS - 1)).cast("int")


def thresholds(found: DataFrame, rate: float = FALSE_DISCOVERIES) -> dict[int, int]:
    """Per length class the lowest p bin from which tokens are reported as random.

    p values of random tokens are uniform, so twice the number of those above one half
    estimates how many there are. What lies above a bin beyond their share is false; the
    lowest bin whose false share is at most `rate` is taken, none if there is none. Every token
    counts once, however many copies of it there are.
    """
    bins = (
        found.select(F.explode("tokens").alias("t"))
        .select("t.h", _class(F.col("t.n")).alias("length_class"), _bin(F.col("t.p")).alias("bin"))
        .distinct()
        .groupBy("length_class", "bin")
        .agg(F.count("*").alias("n"))
    )
    group = Window.partitionBy("length_class")
    above = F.sum("n").over(group.orderBy(F.desc("bin")))
    random = 2 * F.sum(F.when(F.col("bin") >= BINS // 2, F.col("n")).otherwise(0)).over(group)
    false = 1 - random * (1 - F.col("bin") / BINS) / above
    rows = (
        bins.select("length_class", "bin", false.alias("false"))
        .filter(F.col("false") <= rate)
        .groupBy("length_class")
        .agg(F.min("bin"))
        .collect()
    )
    return dict(map(tuple, rows))  # one row per length class


def scan(documents: DataFrame, carry: list[str], text_col: str = "text", staging: str | None = None) -> DataFrame:
    """The carried columns of every row and `secrets`: (start, order, kind, end), by start and kind.

    Positions are code points, the end exclusive. Null texts are empty. Base kinds are all
    kept; a token is added as kind `random` if it overlaps none of them and its p value
    passes the threshold of its length class, learned from all distinct tokens.
    Runs without a letter are numbers: they have no inferred encoding. Rows are never shuffled or joined: repeated rows
    and null ids are rows like others. A carried column must not be called `secrets`.
    """
    folder = shared_folder(documents.sparkSession, staging)
    text = F.coalesce(F.col(text_col), F.lit(""))
    assign = F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["g1"]) >= ASSIGN_VALUE)

    def kind(found: Column, order: int) -> Column:
        return F.transform(found, lambda m: F.struct(
            m["start"].alias("start"), F.lit(order).alias("order"), F.lit(KINDS[order]).alias("kind"), m["end"].alias("end")
        ))

    base = F.concat(kind(assign, 0), kind(matches(text, ACCESS), 1), kind(matches(text, HEX), 2))
    found = stage(
        documents.select(*carry, base.alias("base"), tested(matches(text, TOKEN)).alias("tokens")),
        f"{folder}/found",
    )
    lowest = thresholds(found)

    def passes(t: Column) -> Column:
        limit = F.lit(BINS)
        for length_class, low in lowest.items():
            limit = F.when(_class(t["n"]) == length_class, low).otherwise(limit)
        apart = F.forall("base", lambda b: (b["end"] <= t["start"]) | (b["start"] >= t["end"]))
        return (_bin(t["p"]) >= limit) & apart

    added = kind(F.filter("tokens", passes), 3)
    return found.select(*carry, F.sort_array(F.concat("base", added)).alias("secrets"))


def as_text(secrets: Column) -> Column:
    return F.array_join(
        F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(text: Column, secrets: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span of the secrets replaced by a mark; overlaps get one mark."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(so_far: Column, s: Column) -> Column:
        fresh = s["start"] >= so_far["at"]
        before = F.substring(text, so_far["at"] + 1, s["start"] - so_far["at"])
        return F.struct(
            F.greatest(so_far["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(so_far["done"], before, F.lit(mark))).otherwise(so_far["done"]).alias("done"),
        )

    ended = F.aggregate(secrets, start, step, lambda a: F.concat(a["done"], F.substring(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(secrets) > 0, ended).otherwise(text)

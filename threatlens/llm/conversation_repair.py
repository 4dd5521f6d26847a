"""Repairs damaged conversations by lightest derivations (Knuth's agenda)."""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatlens.llm.graphs import ranked
from threatlens.session import shared_folder, stage

#: White space of the contract: space, tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
#: What an edit costs: a new role, a deletion, an insertion, and a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows that one task derives at once, and spans that one task joins.
BLOCK, FAN = 512, 64
#: `(s?(ua)+)?` over role initials: nothing yet, after s, after u, after a.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
STATES, WHOLE = range(4), (0, 3)
ROLES = {"u": "user", "a": "assistant"}
WAYS = "array<struct<p:int,q:int,cost:long,audit:string,made:string>>"
SPAN = (
    "key string, block long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
    f"low long, high long, turns long, first_turn long, last_turn long, ways {WAYS}"
)
COUNTS = ["blank", "duplicate", "truncated", "illegal"]


@dataclass
class Repair:
    """`conversations`: one row each, with counts, cost and audit. `rows`: what they are now."""

    conversations: DataFrame
    rows: DataFrame


def damaged(rows: DataFrame) -> DataFrame:
    """The damage of the contract, decided by crc32(`conv_id:turn`) % 20; nulls are one space."""
    said = rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    )
    place = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(place[0], F.lit(":"), place[1]).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return (
        said.withColumn("kind", kind).filter("kind <> 0")
        .withColumn("copies", F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        .withColumn("copy", F.explode("copies"))
        .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))
    )


def edits(initial: str, fault: str) -> list[tuple[str, str, int]]:
    """(letter, initial made, cost) of every edit a row allows: axioms with one derivation each."""
    if fault in ("blank", "duplicate"):
        return [("D", "-", DELETE)]
    extra = TRUNCATED if fault == "truncated" else 0
    kept = [("K", initial, extra)] if initial in ("s", "u", "a") else []
    return [("D", "-", DELETE), *kept, ("R", "u", REROLE + extra), ("R", "a", REROLE + extra)]


def lightest(rows: list[tuple[str, str]], start: int, every: bool) -> list[tuple[int, int, str, str]]:
    """(state, cost, audit, initials made): lightest derivations over rows of (initial, fault).

    An item says: the first i rows, edited, lead from `start` to state q. Hyperedges join it
    with an edit of row i to an item of i + 1 rows, or with an insertion to one of i rows. Items
    leave the agenda by (cost, i, audit). Costs are not negative and i grows where a cost is 0,
    so an edge is never lighter than what it is made of. Of two audits of one item and one cost
    neither begins the other (the rest would be insertions, which cost), so what follows keeps
    their order. The first popped derivation of an item is therefore its lightest, and the
    search ends with the first whole conversation unless `every` end state is asked for.
    """
    allowed = [edits(*row) for row in rows]
    agenda, final, found = [(0, 0, "", start, "")], set(), []
    while agenda:
        cost, i, audit, q, made = heappop(agenda)
        if (i, q) in final:
            continue
        final.add((i, q))
        if i == len(rows):
            if every or q in WHOLE:
                found.append((q, cost, audit, made))
            if found and not every:
                break
        for x in ROLES:
            if (q, x) in STEP:
                heappush(agenda, (cost + INSERT, i, audit + "I", STEP[q, x], made + x))
        for letter, x, price in allowed[i] if i < len(rows) else []:
            to = q if x == "-" else STEP.get((q, x))
            if to is not None:
                heappush(agenda, (cost + price, i + 1, audit + letter, to, made + x))
    return found


def span_of(key: str, block: int, rows: list, whole: int) -> dict:
    """A block of consecutive rows (rank, initial, fault, turn) as one span."""
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    initials = [r["initial"] for r in rows]
    # A first block that is not full is the whole conversation.
    alone = block == 0 and len(rows) < whole
    ways = [
        (p, *way)
        for p in (STATES if block else STATES[:1])
        for way in lightest([(r["initial"], r["fault"]) for r in rows], p, not alone)
    ]
    return {
        "key": key, "block": block,
        **{f: sum(r["fault"] == f for r in rows) for f in COUNTS[:3]},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "first": initials[0], "last": initials[-1],
        "low": min(turns, default=None), "high": max(turns, default=None), "turns": len(set(turns)),
        "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
        "ways": [dict(zip(("p", "q", "cost", "audit", "made"), w)) for w in ways],
    }


def joined(a: dict, b: dict) -> dict:
    """Two neighbouring spans as one: states meet, costs add up, audits follow each other."""
    best = {}
    for x in a["ways"]:
        for y in b["ways"]:
            if x["q"] == y["p"]:
                way = (x["cost"] + y["cost"], x["audit"] + y["audit"], x["made"] + y["made"])
                at = (x["p"], y["q"])
                best[at] = min(way, best.get(at, way))
    known = [t for t in (a["low"], b["low"]) if t is not None]
    top = [t for t in (a["high"], b["high"]) if t is not None]
    same = a["last_turn"] is not None and a["last_turn"] == b["first_turn"]
    return {
        "key": a["key"], "block": a["block"],
        **{f: a[f] + b[f] for f in COUNTS},
        "illegal": a["illegal"] + b["illegal"] + (a["last"] + b["first"] not in ("su", "ua", "au")),
        "first": a["first"], "last": b["last"],
        "low": min(known, default=None), "high": max(top, default=None), "turns": a["turns"] + b["turns"] - same,
        "first_turn": b["first_turn"] if a["first_turn"] is None else a["first_turn"],
        "last_turn": a["last_turn"] if b["last_turn"] is None else b["last_turn"],
        "ways": [{"p": p, "q": q, "cost": c, "audit": t, "made": m} for (p, q), (c, t, m) in best.items()],
    }


def _spans(lean: DataFrame, folder: str, block: int, fan: int) -> DataFrame:
    """One span per conversation: blocks of rows first, then blocks of spans, level by level."""
    columns = [c.split()[0] for c in SPAN.split(", ")]

    def frame_of(made: list[dict]) -> pd.DataFrame:
        frame = pd.DataFrame(made, columns=columns)
        whole = ["low", "high", "first_turn", "last_turn"]
        return frame.assign(**{c: frame[c].astype("Int64") for c in whole})

    def derive(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame_of([span_of(*r, block) for r in zip(frame["key"], frame["block"].tolist(), frame["rows"])])

    def unite(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = []
            for number, spans in zip(frame["block"].tolist(), frame["spans"]):
                one, *others = [s.asDict(True) if hasattr(s, "asDict") else s for s in spans]
                for other in others:
                    one = joined(one, other)
                made.append({**one, "block": number})
            yield frame_of(made)

    rows = lean.groupBy("key", F.floor(F.col("rank") / block).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "initial", "fault", "turn"))).alias("rows")
    )
    spans, level = stage(rows.mapInPandas(derive, SPAN), f"{folder}/spans-0"), 0
    while spans.filter("block > 0").limit(1).count():
        level += 1
        number = F.floor(F.col("block") / fan).alias("number")
        inner = F.struct("block", *[c for c in columns if c != "block"])
        packs = spans.groupBy("key", number).agg(F.array_sort(
            F.collect_list(inner), lambda x, y: F.when(x["block"] < y["block"], -1).otherwise(1)
        ).alias("spans"))
        spans = stage(
            packs.select("key", F.col("number").alias("block"), "spans").mapInPandas(unite, SPAN), f"{folder}/spans-{level}"
        )
    return spans


def _moves(whole: DataFrame) -> DataFrame:
    """(key, letter, made, rank, place) of every edit; inserts have no rank, deletions no place."""

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for key, audit, made in zip(frame["key"], frame["audit"], frame["made"]):
                rank = place = 0
                for at in range(0, len(audit), 100_000):
                    letters, initials = list(audit[at : at + 100_000]), list(made[at : at + 100_000])
                    reads = np.array([x != "I" for x in letters])
                    writes = np.array([x != "-" for x in initials])
                    yield pd.DataFrame({
                        "key": key, "letter": letters, "made": initials,
                        "rank": pd.Series(rank + np.cumsum(reads) - 1, dtype="Int64").where(reads),
                        "place": pd.Series(place + np.cumsum(writes) - 1, dtype="Int64").where(writes),
                    })
                    rank, place = rank + int(reads.sum()), place + int(writes.sum())

    return whole.select("key", "audit", "made").mapInPandas(
        spread, "key string, letter string, made string, rank long, place long"
    )


def _key() -> Column:
    """A text for every conv_id, the null one too, that joins and groups can use."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key")


def repair(rows: DataFrame, staging: str | None = None, block: int = BLOCK, fan: int = FAN) -> Repair:
    """The cheapest repair of every conversation of `rows` (conv_id, turn, role, text).

    `conversations` has conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit; `rows`
    has conv_id, place (from 0), letter (K, R or I), role, text of what is left, in order.
    Rows follow each other by turn (nulls first), then role and the digest of the text, so
    ties have one order; repeated rows are duplicates after the first. Null roles or texts are
    one space, a null conv_id is a conversation like any other, and its rows stay together. A
    role without an initial can only be given a new one or be deleted. Texts and roles of any
    length pass through whole; other columns are not read. No row gives no conversation.

    A conversation of any length is cut into blocks; each block gives its lightest derivation
    between every two states, and neighbouring spans are joined level by level, so that no task
    reads more than a block of rows or a fan of spans. Only the audit grows with a conversation.
    """
    folder = shared_folder(rows.sparkSession, staging)
    text, role = F.coalesce(F.col("text"), F.lit(" ")), F.coalesce(F.col("role"), F.lit(" "))
    said = rows.select(
        _key(), "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.sha2(text, 256).alias("digest"),
    )
    placed = stage(ranked(said, "key", ["turn", "role", "digest"], folder), f"{folder}/placed")
    firsts = placed.groupBy("key", "role", "digest").agg(F.min("rank").alias("first"))
    bare = F.rtrim("text", F.lit(BLANKS))
    fault = (
        F.when(bare == "", "blank").when(F.col("rank") > F.col("first"), "duplicate")
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated").otherwise("")
    )
    lean = placed.select(
        "key", "role", "digest", "rank", "turn", F.substring("role", 1, 1).alias("initial"), bare.alias("text")
    ).withColumn("text", F.substring("text", -1, 1)).join(firsts, ["key", "role", "digest"])
    spans = _spans(lean.select("key", "rank", "turn", "initial", fault.alias("fault")), folder, block, fan)
    best = F.array_min(F.transform(
        F.filter("ways", lambda w: (w["p"] == 0) & w["q"].isin(*WHOLE)),
        lambda w: F.struct(w["cost"].alias("cost"), w["audit"].alias("audit"), w["made"].alias("made")),
    ))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    whole = stage(
        spans.withColumn("best", best).select(
            "key", gaps.alias("gaps"), *COUNTS, F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit"),
            F.col("best.made").alias("made"),
        ),
        f"{folder}/whole",
    )
    ids = placed.filter("rank = 0").select("key", "conv_id")
    given = F.when(F.col("made") == "u", ROLES["u"]).otherwise(ROLES["a"])
    left = (
        _moves(whole).filter("place is not null")
        .join(placed.select("key", "rank", "role", "text"), ["key", "rank"], "left")
        .select(
            "key", "place", "letter",
            F.when(F.col("letter") == "K", F.col("role")).otherwise(given).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
    )
    return Repair(
        ids.join(whole, "key").select("conv_id", "gaps", *COUNTS, "cost", "audit"),
        ids.join(left, "key").select("conv_id", "place", "letter", "role", "text"),
    )


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) over `role:text` lines in order.

    A digest is sequential by nature: the rows of one conversation stream through one task,
    sorted on disk, and only the running digest is held.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, digest = None, None
        for frame in frames:
            made = []
            for here, at, line in zip(frame["key"], frame["place"], frame["line"]):
                if here != key:
                    made += [(key, digest.hexdigest())] if digest else []
                    key, digest = here, hashlib.sha256()
                digest.update((line if at == 0 else "\n" + line).encode())
            yield pd.DataFrame(made, columns=["key", "repaired_sha256"], dtype=str)
        if digest:
            yield pd.DataFrame({"key": [key], "repaired_sha256": [digest.hexdigest()]})

    lines = rows.select(_key(), "place", F.concat("role", F.lit(":"), "text").alias("line"))
    made = lines.repartition("key").sortWithinPartitions("key", "place").mapInPandas(run, "key string, repaired_sha256 string")
    conv_id = F.when(F.col("key") != "", F.substring("key", 2, 2**31 - 1)).cast(kind)
    return made.select(conv_id.alias("conv_id"), "repaired_sha256")

import hashlib
import random
from collections import defaultdict
from functools import cache

import duckdb

from threatlens.llm import conversation_repair as cr
from threatlens.llm import queries

COLUMNS = "conv_id long, turn long, role string, text string"


def test_query_equals_sql(spark, sf_dir):
    made = queries.op13_repair(spark, sf_dir)
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    expected = connection.sql(queries.oracle_sql()["op13_repair"])
    assert made.columns == expected.columns
    assert sorted(map(tuple, made.collect())) == sorted(expected.fetchall())


def slow(rows):
    """(counts, cost, audit, lines) by trying every edit, rows as (turn, role, text) in order."""
    seen, marked = set(), []
    for _, role, text in rows:
        bare = text.rstrip(cr.BLANKS)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        marked.append((role, text, fault))

    @cache
    def rest(i, q, inserted):
        best = []
        if i == len(marked) and q in (0, 3):
            best.append((0, "", ()))
        if inserted < 2:
            for x, role in cr.ROLES.items():
                if (q, x) in cr.STEP:
                    best += [(c + 3, "I" + a, (f"{role}:", *o)) for c, a, o in rest(i, cr.STEP[q, x], inserted + 1)]
        if i < len(marked):
            role, text, fault = marked[i]
            best += [(c + 4, "D" + a, o) for c, a, o in rest(i + 1, q, 0)]
            if fault in ("", "truncated"):
                extra = 3 * (fault == "truncated")
                ways = [("R", x, r, 3) for x, r in cr.ROLES.items()] + ([("K", role[:1], role, 0)] if role else [])
                for letter, x, r, price in ways:
                    if (q, x) in cr.STEP:
                        best += [(c + price + extra, letter + a, (f"{r}:{text}", *o)) for c, a, o in rest(i + 1, cr.STEP[q, x], 0)]
        return [min(best)] if best else []

    cost, audit, lines = rest(0, 0, 0)[0]
    turns = [t for t, _, _ in rows if t is not None]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[sum(f == kind for _, _, f in marked) for kind in ("blank", "duplicate", "truncated")],
        sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:])),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def check(spark, rows, **sizes):
    clashing = "key string, rank int, made string, place int"
    frame = spark.createDataFrame([(*r, "k", 1, "m", 2) for r in rows], f"{COLUMNS}, {clashing}")
    made = cr.repair(frame, **sizes)
    digests = {r.conv_id: r.repaired_sha256 for r in cr.digests(made.rows).collect()}
    found = {r.conv_id: (*r[1:], digests.get(r.conv_id, hashlib.sha256().hexdigest())) for r in made.conversations.collect()}
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        groups[conv].append((turn, role, text))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest())
    assert found == {conv: slow(sorted(g, key=order)) for conv, g in groups.items()}


def test_random_conversations_as_every_edit_tried(spark):
    rng = random.Random(2)
    texts = ["Fine.", "cut off", "  ", "", "Again!", "é?", "ok. \n", "x" * 3000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "useless"]
    rows = [
        (conv, rng.choice([None, *range(6)]), rng.choice([*roles, None]), rng.choice([*texts, None]))
        for conv in [*range(60), None]
        for _ in range(rng.randrange(1, 7))
    ]
    check(spark, rows)
    check(spark, rows, block=2, fan=2)


def test_long_conversation_in_blocks_and_levels(spark):
    rng = random.Random(7)
    rows = [(i, t, "user" if t % 2 == 0 else "assistant", f"Turn {t} of {i}.") for i in (1, 2) for t in range(90)]
    hot = [r if rng.random() < 0.7 else (*r[:2], rng.choice(["user", "tool"]), rng.choice(["", "cut", r[3]])) for r in rows]
    check(spark, hot, block=4, fan=3)
    check(spark, [(1, 0, "user", "Same.")] * 40 + [(3, None, "assistant", "Alone")], block=4, fan=3)


def test_no_rows_and_dropped_conversations(spark, tmp_path):
    empty = spark.createDataFrame([], COLUMNS)
    made = cr.repair(empty)
    assert made.conversations.collect() == [] and made.rows.collect() == [] and cr.digests(made.rows).collect() == []
    rows = [(i, t, None if i % 3 else "user", None if t else "Hi.") for i in range(200) for t in ((0, None) if i % 7 else (0,))] + [(None, None, None, None)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op13_repair(spark, str(tmp_path)).collect()
    assert sorted(str(r.conv_id) for r in found) == sorted({str(r[0]) for r in rows})
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    expected = connection.sql(queries.oracle_sql()["op13_repair"]).fetchall()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    assert any(r.audit == "" and r.repaired_sha256 == hashlib.sha256().hexdigest() for r in found)

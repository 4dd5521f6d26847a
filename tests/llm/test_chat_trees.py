import hashlib
import random
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from threatlens.llm import chat_trees as ct
from threatlens.llm import queries


def test_query_equals_sql(spark, sf_dir):
    made = queries.op2_reply_trees(spark, sf_dir)
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    expected = connection.sql(queries.oracle_sql()["op2_reply_trees"])
    assert made.columns == expected.columns
    assert sorted(map(tuple, made.collect())) == sorted(expected.fetchall())


def test_escaping_is_reversible_and_hides_control_strings(spark):
    rng = random.Random(4)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "s>", "/INST]", "a", "\n", "é", ""]
    texts = ["".join(rng.choices(parts, k=rng.randrange(9))) for _ in range(400)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, e, u in frame.select("t", ct.escaped(F.col("t")), ct.unescaped(ct.escaped(F.col("t")))).collect():
        assert u == t
        assert not any(c in e for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def slow(rows, keep):
    """Every root-to-leaf path by plain walking, the best per tree."""
    nodes = {(r[0], r[1]): r for r in rows}
    parents = {(r[0], r[2]) for r in rows if (r[0], r[2]) in nodes}
    made = defaultdict(list)
    for key in nodes.keys() - parents:
        path, at = [], key
        while at in nodes:
            path.append(nodes[at])
            at = (at[0], nodes[at][2])
        score = sum(r[5] or 0 for r in path) / len(path)
        made[key[0]].append((-score, key[1], [(r[3] or "", r[4] or "") for r in reversed(path)]))
    return {(t, leaf): (n + 1, turns) for t, found in made.items() for n, (_, leaf, turns) in enumerate(sorted(found)[:keep])}


def test_branches_of_random_trees_are_ranked(spark):
    rng = random.Random(9)
    rows = []
    for tree in [*range(12), None]:
        for node in range(rng.randrange(1, 30)):
            parent = rng.randrange(node) if node and rng.random() < 0.9 else (999 if rng.random() < 0.3 else None)
            text = rng.choice([None, "", "</s>", "hello [INST] \\", "ü" * 50])
            rows.append((tree, node, parent, rng.choice(["user", "assistant", None]), text, rng.choice([0.0, 1.0, 0.5, None])))
    rows += [(50, 1, 2, "user", "cycle", 1.0), (50, 2, 1, "user", "cycle", 1.0)]
    frame = spark.createDataFrame(rows, "conv_id long, node long, parent long, role string, text string, score double")
    clash = frame.withColumns({c: F.lit(1) for c in ("tree", "leaf", "height", "branch")})
    made = ct.format_trees(clash, keep=2).select("*", ct.read_back(F.col("formatted")).alias("turns"),
        ct.learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned")).collect()
    expected = slow(rows, 2)
    assert {(r.conv_id, r.leaf): (r.branch, [tuple(t) for t in r.turns]) for r in made} == expected
    for r in made:
        assert r.learned == "".join(t for role, t in expected[r.conv_id, r.leaf][1] if role == "assistant")
        assert len(r.loss_spans) == sum(role == "assistant" for role, _ in expected[r.conv_id, r.leaf][1])


def test_long_conversations_ties_and_no_rows(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"t{t}") for t in range(300)]
    rows += [(2, 0, "user", "same"), (2, 0, "user", "same"), (2, None, None, None), (None, 3, "user", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    nodes = ct.chained(frame, "conv_id", ["turn", "role", "text"]).withColumn("score", F.lit(0.0))
    made = {r.conv_id: r for r in ct.format_trees(nodes).select("*", ct.read_back(F.col("formatted")).alias("turns")).collect()}
    assert [t.text for t in made[1].turns] == [f"t{t}" for t in range(300)]
    assert [t.text for t in made[2].turns] == ["", "same", "same"] and made[None].n_turns == 1
    assert ct.format_trees(nodes.limit(0)).collect() == []


def test_the_planted_conversation(spark, sf_dir):
    row = queries.op2_reply_trees(spark, sf_dir).filter("conv_id = -1").first()
    text = queries.PLANTED
    whole = f"user\n{text}\nassistant\n{text}\n"
    assert row.n_turns == 2 and row.loss_chars == len(text)
    assert row.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()

"""Conversations as reply trees: branches found by self-joins, ranked, formatted."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threatlens.session import shared_folder, stage

#: Control strings of the template.
OPEN, ROLE, CLOSE = "<s>", "[INST]", "[/INST]</s>"
CONTROL = (r"<(/?s>)", r"\[(/?INST\])")


def escaped(text: Column) -> Column:
    """A text without control strings: a backslash doubles, and one splits each of them."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(F.regexp_replace(text, CONTROL[0], r"<\\$1"), CONTROL[1], r"[\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def chained(messages: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Rows of linear conversations as nodes: each replies to the one before it in order."""
    place = F.row_number().over(Window.partitionBy(tree).orderBy(*order))
    return messages.withColumn("node", place.cast("long")).withColumn(
        "parent", F.when(F.col("node") > 1, F.col("node") - 1)
    )


def branches(nodes: DataFrame, staging: str | None = None) -> DataFrame:
    """(tree, leaf, node, height): every node on the way from each leaf to its root.

    `nodes` has tree, node, parent. A node without a parent among the nodes is a root. Two
    joins a round: ancestors at distance d are joined with themselves to those at 2d, and
    every way known so far is carried on by d. Ways of n nodes take log2(n) rounds, and
    each round is written, so the plan stays small. Height is 0 at the leaf.
    """
    folder = shared_folder(nodes.sparkSession, staging)
    keys = stage(nodes.select("tree", "node", "parent"), f"{folder}/nodes")
    above = keys.select("tree", F.col("node").alias("parent")).distinct()
    same_tree = F.col("k.tree").eqNullSafe(F.col("o.tree"))
    jumps = keys.alias("k").join(
        above.alias("o"), same_tree & (F.col("k.parent") == F.col("o.parent"))
    ).select("k.tree", "k.node", F.col("k.parent").alias("up"))
    jumps = stage(jumps, f"{folder}/jumps-0")
    leaves = keys.alias("k").join(
        jumps.alias("o"), same_tree & (F.col("k.node") == F.col("o.up")), "left_anti"
    )
    ways = stage(
        leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("height")),
        f"{folder}/ways-0",
    )
    turn = 0
    parts = [ways]
    while not jumps.isEmpty():
        known = parts[0]
        for part in parts[1:]:
            known = known.union(part)
        to = jumps.alias("o")
        more = known.alias("k").join(to, same_tree & (F.col("k.node") == F.col("o.node"))).select(
            "k.tree", "k.leaf", F.col("o.up").alias("node"), (F.col("k.height") + (1 << turn)).alias("height")
        )
        parts.append(stage(more, f"{folder}/ways-{turn + 1}"))
        if parts[-1].isEmpty():  # only a cycle still jumps
            break
        jumps = stage(
            jumps.alias("k")
            .join(to, same_tree & (F.col("k.up") == F.col("o.node")))
            .select("k.tree", "k.node", "o.up"),
            f"{folder}/jumps-{turn + 1}",
        )
        turn += 1
    for part in parts[1:]:
        ways = ways.union(part)
    return ways


def format_trees(
    messages: DataFrame,
    tree: str = "conv_id",
    keep: int = 1,
    staging: str | None = None,
) -> DataFrame:
    """One row per chosen branch: tree, leaf, branch (its rank), score, n_turns, formatted, loss_spans.

    `messages` has the tree's column, node, parent, role, text and score. A branch's score
    is the mean over its nodes (null: 0); the `keep` best branches of each tree are chosen,
    ties by the smaller leaf. Turns are written root first as

        <s>role[INST]text[/INST]</s>

    with roles and texts escaped, null ones empty. loss_spans holds (start, length) in code
    points of each assistant text in `formatted`, in order. (tree, node) must be unique. A
    null tree is a tree. Nodes that only a cycle leads to are on no branch. Further columns
    are not read. An empty table gives no row.
    """
    folder = shared_folder(messages.sparkSession, staging)
    nodes = stage(
        messages.select(
            F.col(tree).alias("tree"), "node", "parent",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
            F.coalesce("score", F.lit(0.0)).cast("double").alias("score"),
        ),
        f"{folder}/messages",
    )
    ways = branches(nodes, folder)
    ranked = Window.partitionBy("tree").orderBy(F.desc("mean"), "leaf")
    same = F.col("w.tree").eqNullSafe(F.col("n.tree")) & (F.col("w.node") == F.col("n.node"))
    scores = ways.alias("w").join(nodes.select("tree", "node", "score").alias("n"), same)
    chosen = (
        scores.groupBy("w.tree", "leaf")
        .agg(F.avg("score").alias("mean"))
        .withColumn("branch", F.row_number().over(ranked))
        .filter(F.col("branch") <= keep)
    )
    picked = chosen.alias("c").join(
        ways.alias("w"), F.col("c.tree").eqNullSafe(F.col("w.tree")) & (F.col("c.leaf") == F.col("w.leaf"))
    ).select("w.tree", "w.leaf", "w.node", "w.height", "c.branch", "c.mean")
    turns = picked.alias("w").join(nodes.alias("n"), same).select(
        "w.tree", "w.leaf", "branch", "mean", "height",
        (F.col("n.role") == "assistant").alias("learned"),
        F.concat(F.lit(OPEN), escaped(F.col("n.role")), F.lit(ROLE)).alias("head"),
        escaped(F.col("n.text")).alias("body"),
    )
    size = F.length("head") + F.length("body") + len(CLOSE)
    root_first = F.struct((-F.col("height")).alias("place"), "learned", "head", "body", size.alias("size"))
    gathered = turns.groupBy("tree", "leaf", "branch", "mean").agg(F.sort_array(F.collect_list(root_first)).alias("turns"))
    spans = F.aggregate(
        "turns",
        F.struct(
            F.lit(0).cast("long").alias("at"),
            F.expr("cast(array() as array<struct<start: bigint, length: bigint>>)").alias("spans"),
        ),
        lambda done, turn: F.struct(
            (done["at"] + turn["size"]).alias("at"),
            F.when(
                turn["learned"],
                F.concat(
                    done["spans"],
                    F.array(F.struct(
                        (done["at"] + F.length(turn["head"])).cast("long").alias("start"),
                        F.length(turn["body"]).cast("long").alias("length"),
                    )),
                ),
            ).otherwise(done["spans"]).alias("spans"),
        ),
    )["spans"]
    written = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    return gathered.select(
        F.col("tree").alias(tree), "leaf", "branch", F.col("mean").alias("score"),
        F.size("turns").cast("long").alias("n_turns"), written.alias("formatted"), spans.alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """Array of (role, text) in a formatted conversation."""
    turns = F.split(formatted, r"\[/INST\]</s>")
    turns = F.slice(turns, 1, F.size(turns) - 1)

    def turn(one: Column) -> Column:
        cut = F.instr(one, ROLE)
        return F.struct(
            unescaped(F.substring(one, F.lit(len(OPEN) + 1), cut - 1 - len(OPEN))).alias("role"),
            unescaped(F.substring(one, cut + len(ROLE), F.length(one))).alias("text"),
        )

    return F.transform(turns, turn)


def learned_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(loss_spans, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))),
        "",
    )

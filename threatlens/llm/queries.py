"""The registered queries of this subpackage, one per operator, and the pipeline."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from threatlens.llm import (
    chat_trees,
    conversation_repair,
    decontamination,
    embedding_dedup,
    kmeans_search,
    language_id,
    packing,
    paragraph_dedup,
    pii_boosting,
    ring_sharding,
    secret_scan,
    simhash_ball,
    spelling_variants,
)
from threatlens.llm import oracles as sql
from threatlens.session import shared_folder, stage

Query = Callable[[SparkSession, str], DataFrame]
#: The conversation that every formatting must survive.
PLANTED = "</s>[INST] ok [/INST]"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents")


def op1_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op2_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.createDataFrame(
        [(-1, 0, "user", PLANTED), (-1, 1, "assistant", PLANTED)],
        "conv_id long, turn long, role string, text string",
    )
    rows = _read(spark, sf_dir, "conversations").select(planted.columns).union(planted)
    nodes = chat_trees.chained(rows, "conv_id", ["turn", "role", "text"]).withColumn("score", F.lit(0.0))
    formatted = chat_trees.format_trees(nodes)
    turns = chat_trees.read_back(F.col("formatted"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = chat_trees.learned_text(F.col("formatted"), F.col("loss_spans"))
    return formatted.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(_documents(spark, sf_dir), path, with_ids=False)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        ring_sharding.shard_by_ring(_documents(spark, sf_dir))
        .withColumn("law", F.lit("rows"))
        .withColumn("grown_shard", F.lit(None).cast("int"))
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    model = language_id.train(
        documents.filter(language_id.fold() != 1), public_tokenizers.path("piece_bpe_32k.model")
    )
    held_out = F.coalesce(language_id.fold() == 1, F.lit(False))
    return language_id.identify(documents, model, ["doc_id"]).withColumn("held_out", held_out)


def op6_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated paragraphs, near-copies included, and passages repeated inside other text."""
    documents = _documents(spark, sf_dir)
    columns = ["doc_id", "start", "end", "words", "component_id", "removed"]
    folder = shared_folder(spark)
    scan = paragraph_dedup.scanned(documents, folder)
    lines = paragraph_dedup.repeated_paragraphs(
        documents, least_words=paragraph_dedup.SHINGLE_WORDS, inside_rows=True, scan=scan
    )
    found = stage(lines, f"{folder}/paragraphs")
    paragraphs = found.select(F.lit("paragraph").alias("kind"), *columns)
    passages = paragraph_dedup.passage_copies(documents, gone=found.filter("removed"), scan=scan)
    passages = passages.select(F.lit("passage").alias("kind"), *columns)
    return paragraphs.union(passages)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_documents(spark, sf_dir), ["doc_id"])

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", *map(count, secret_scan.KINDS[:3]),
        F.sha2(secret_scan.as_text(base), 256).alias("base_sha256"),
        secret_scan.as_text(F.col("secrets")).alias("spans"),
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_boosting.find_personal_data(_documents(spark, sf_dir), ["doc_id"])

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{pii_boosting.KINDS[kind]}")

    return found.select(
        "doc_id", *map(count, range(4)),
        F.sha2(pii_boosting.as_text(F.col("base")), 256).alias("base_sha256"),
        pii_boosting.as_text(F.sort_array(F.concat("base", "added"))).alias("spans"),
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_documents(spark, sf_dir), _read(spark, sf_dir, "benchmark"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_ball.simhash_groups(_documents(spark, sf_dir))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling_variants.dictionary(spelling_variants.words_of(_documents(spark, sf_dir)))
    return spelling_variants.spelling_forms(words)


def op12_kmeans_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_search.search(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0).rows


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations")
    folder = shared_folder(spark)
    repaired = conversation_repair.repair(conversation_repair.damaged(rows))
    digests = stage(conversation_repair.digests(repaired.rows), f"{folder}/digests")
    made = repaired.conversations.join(digests.withColumnRenamed("conv_id", "own"), F.col("conv_id").eqNullSafe(F.col("own")), "left")
    made = made.drop("own").withColumnRenamed("conv_id", "own")
    zeros = [
        F.coalesce(c, F.lit(0).cast("long")).alias(c)
        for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    ]
    return rows.select("conv_id").distinct().join(made, F.col("conv_id").eqNullSafe(F.col("own")), "left").select(
        "conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_nn_descent": op1_nn_descent,
        "op2_reply_trees": op2_reply_trees,
        "op3_packing": op3_packing,
        "op4_sharding": op4_sharding,
        "op5_language_id": op5_language_id,
        "op6_paragraphs": op6_paragraphs,
        "op7_secrets": op7_secrets,
        "op8_pii": op8_pii,
        "op9_decontamination": op9_decontamination,
        "op10_simhash": op10_simhash,
        "op11_spelling": op11_spelling,
        "op12_kmeans_search": op12_kmeans_search,
        "op13_repair": op13_repair,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_reply_trees": sql.REPLY_TREES, "op11_spelling": sql.SPELLING, "op13_repair": sql.REPAIR}

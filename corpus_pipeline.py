"""A corpus pipeline over documents: five stages, each one operator, each on what is left."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.llm import decontamination, language_id, packing, secret_scan, simhash_ball
from threatlens.session import shared_folder, stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A text is kept if its best language is at least this likely.
LEAST_SCORE = 0.5


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no letter, or no language clearly the best.

    Learned from the labelled rows of its own input. Without any label nothing can be told
    apart, and every text with a letter stays.
    """
    model = language_id.train(docs, public_tokenizers.path("piece_bpe_32k.model"))
    if not model.languages:
        return docs.select(COLUMNS).filter(F.col("text").rlike(r"\p{L}"))
    found = language_id.identify(docs, model, COLUMNS)
    return found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash group: the smallest doc_id, null ones last."""
    return simhash_ball.keep_one(docs, COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.overlaps(docs, benchmark, COLUMNS, text_col="text").filter(F.size("overlaps") == 0).select(COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; n_chars follows the text."""
    found = secret_scan.scan(docs, COLUMNS)
    clean = F.when(F.size("secrets") > 0, secret_scan.redacted(F.col("text"), F.col("secrets"))).otherwise(F.col("text"))
    found = found.withColumn("text", clean)
    return found.select(
        "doc_id", "text", "lang", "source",
        F.when(F.size("secrets") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of 4096 tokens; one row per piece."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


STAGES = [
    ("language id", languages),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("secret scan", secrets),
    ("packing", packed),
]

#: SQL has neither the models, the fingerprints nor the tokenizer; tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again in the shared folder."""
    folder = shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"{folder}/stage-{i}")
    return docs

import pytest

#: Nulls in every column, empty, blank and repeated rows, ties, one long text, clashing names.
ODD = [
    (1, "Plain words here, and more of them to read today", "en", "a", 48),
    (1, "Plain words here, and more of them to read today", "en", "a", 48),
    (2, None, None, None, None),
    (None, "no id at all but some words", "en", "b", 3),
    (3, "", "en", "", 0),
    (4, " \n\t ", "de", "b", 4),
    (5, "plain WORDS here, and more of them to read today", None, "a", 48),
    (6, "123 456 !!", "fr", "c", 10),
    (7, "long text with é and ß " * 9000, "de", "c", 207000),
]


@pytest.fixture
def odd_documents(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    clashing = ["id", "rank", "key", "piece", "node", "component_id", "fingerprint", "length", "arc", "label"]
    return rows.withColumns({c: F.lit(1) for c in clashing})


@pytest.fixture
def no_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"

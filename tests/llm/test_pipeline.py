from collections import Counter, defaultdict

import pytest
from test_decontamination import slow as slow_matches
from test_packing import check as check_packed
from test_secret_scan import base as base_secrets
from test_simhash_ball import expected as simhash_expected

import corpus_pipeline as cp
from threatlens.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def run(spark, sf_dir, tmp_path_factory):
    """Whole documents and odd rows through every stage: the input of each, and the result."""
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select(cp.COLUMNS).collect()]
    rows += [
        (9001, None, None, None, None), (9002, "", "en", "x", 0), (9003, "12 34 !!", "en", "x", 8), (None, rows[0][1], "en", "x", 1),
        rows[1], (9004, "key token=abcdef0123456789 " + rows[2][1], None, "x", None),
    ]
    folder = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    docs, tables = spark.read.parquet(f"{folder}/documents.parquet"), []
    for i, (_, function) in enumerate(cp.STAGES):
        tables.append(docs.collect())
        function(spark, docs, str(folder)).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        assert i == len(cp.STAGES) - 1 or docs.columns == cp.COLUMNS
    return [*tables, docs.collect()], str(folder)


def test_language_stage_drops_what_has_no_letter_and_keeps_clean_documents(run):
    before, after = run[0][0], run[0][1]
    kept = Counter(map(tuple, after))
    dropped = Counter(map(tuple, before)) - kept
    assert all(not any(map(str.isalpha, r[1] or "")) for r in dropped)
    assert {9001, 9002, 9003} <= {r[0] for r in dropped}
    assert not kept - Counter(map(tuple, before))


def test_one_document_of_each_group_stays(run):
    before, after = run[0][1], run[0][2]
    groups = defaultdict(list)
    for d, print_, component in simhash_expected([(r.doc_id, r.text) for r in before]):
        groups[component].append(d)
    assert sorted(r.doc_id for r in after) == sorted(min(d for d in g if d is not None) for g in groups.values())
    assert not Counter(map(tuple, after)) - Counter(map(tuple, before))


def test_benchmark_passages_go(run, spark):
    before, after = run[0][2], run[0][3]
    items = [tuple(r) for r in spark.read.parquet(f"{run[1]}/benchmark.parquet").collect()]
    bad = {d for d, _ in slow_matches([(r.doc_id, r.text) for r in before], items)}
    assert Counter(map(tuple, after)) == Counter(tuple(r) for r in before if r.doc_id not in bad)


def test_secrets_are_replaced(run):
    before, after = run[0][3], {r.doc_id: r for r in run[0][4]}
    assert len(after) == len(before)
    for r in before:
        spans, made = base_secrets(r.text), after[r.doc_id]
        if not spans:
            assert tuple(made) == tuple(r) or "[SECRET]" in made.text
        else:
            expected, at = "", 0
            for start, _, _, end in spans:
                if start >= at:
                    expected += r.text[at:start] + "[SECRET]"
                at = max(at, end)
            assert made.text == expected + r.text[at:] and made.n_chars == len(made.text)
        assert not base_secrets(made.text)


def test_everything_left_is_packed_and_run_is_the_stages(run, spark):
    before, after = run[0][4], run[0][5]
    check_packed(after, [(r.doc_id, r.text) for r in before], ids=False)
    again = queries.queries()["pipeline"](spark, run[1])
    facts = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert Counter(tuple(r[c] for c in facts) for r in again.collect()) == Counter(tuple(r[c] for c in facts) for r in after)


def test_an_empty_table_passes_every_stage(spark, run, sf_dir):
    docs = spark.createDataFrame([], SCHEMA)
    for _, function in cp.STAGES:
        docs = function(spark, docs, sf_dir)
        assert docs.collect() == []


def test_registered_names_and_columns():
    assert [n for n in queries.queries() if n != "pipeline"] == sorted(
        (n for n in queries.queries() if n != "pipeline"), key=lambda n: int(n[2:].split("_")[0])
    )
    assert len(queries.queries()) == 11

"""The registered queries against their SQL twins, and the pipeline."""

from __future__ import annotations

import pytest
from compare import difference, duck
from odd_documents import clashing, documents, odd_docs, odd_rows, prepared  # noqa: F401
from orestar.llm import (
    decontamination,
    exact_dedup,
    line_dedup,
    lm_scoring,
    mask_search,
    mixing,
    near_dedup,
    periodic_runs,
    quality,
    registry,
    secret_scan,
    toxicity,
)

import __spark_entry__ as driver
import corpus_pipeline


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_all_are_registered():
    names = [n for n in driver.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert driver.queries()["pipeline"]


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_same_result(spark, sf_dir, connection, name):
    assert difference(registry.queries()[name](spark, sf_dir), connection, registry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["op1_quality_classifier", "op2_toxicity", "op5_source_mixing", "op6_secret_scan", "op11_lm_scoring", "op13_periodic_runs"])
def test_a_row_per_document(spark, sf_dir, name):
    ids = [r.doc_id for r in registry.queries()[name](spark, sf_dir).select("doc_id").collect()]
    assert sorted(ids) == list(range(200))


def _labels(spark):
    rows = [(i, i % 2, i % 2) for i in range(1, 13)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


OPERATORS = {
    "quality": lambda spark, docs: quality.quality(docs, _labels(spark)),
    "toxicity": lambda spark, docs: toxicity.toxicity(docs, _labels(spark)),
    "decontamination": lambda spark, docs: decontamination.contamination(docs, spark.createDataFrame([(1, "beta gamma delta")], "item_id int, text string")),
    "mixture": lambda spark, docs: mixing.mixture(docs),
    "secrets": lambda spark, docs: secret_scan.scan_secrets(docs),
    "lines": lambda spark, docs: line_dedup.deduplicate_lines(docs),
    "exact": lambda spark, docs: exact_dedup.exact_groups(docs),
    "near": lambda spark, docs: near_dedup.near_duplicates(docs),
    "language": lambda spark, docs: lm_scoring.language_scores(docs),
    "search": lambda spark, docs: mask_search.top_documents(docs, spark.createDataFrame([(1, "beta gamma delta")], "item_id int, text string")),
    "runs": lambda spark, docs: periodic_runs.run_report(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_of_any_name_are_let_be(spark, odd_docs, name):
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(OPERATORS[name](spark, clashing(odd_docs))) == rows(OPERATORS[name](spark, odd_docs))


def test_stages_keep_columns_of_any_name(spark, odd_docs, tmp_path):
    _labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "Beta gamma delta epsilon zeta eta theta iota kappa lambda")], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = clashing(odd_docs)
    for name, stage in corpus_pipeline.STAGES:
        plain = stage(spark, odd_docs, str(tmp_path))
        wide = stage(spark, docs, str(tmp_path))
        assert wide.columns[: len(docs.columns)] == docs.columns
        assert wide.count() == plain.count(), name


def test_stages_hand_on_documents(spark, tmp_path, odd_rows):
    """Every stage on the odd rows, read back as the next one's input."""
    docs = documents(spark, odd_rows)
    spark.createDataFrame([(1, "Beta gamma delta epsilon zeta eta theta iota kappa lambda")], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    columns, before = docs.columns, len(odd_rows)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        kept = stage(spark, docs, str(tmp_path))
        kept.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert docs.columns == columns
            assert docs.count() <= before
            before = docs.count()
    assert docs.columns[: len(columns)] == columns


def test_pipeline_removes_what_its_operators_find(spark, sf_dir):
    last = corpus_pipeline.run(spark, sf_dir)
    assert last.columns == ["doc_id", "text", "lang", "source", "n_chars", "mix_copy", "mix_shard", "mix_order"]
    kept = {r.doc_id for r in last.select("doc_id").distinct().collect()}
    found = registry.queries()
    dropped = {r.doc_id for r in found["op9_exact_dedup"](spark, sf_dir).where("NOT kept").collect()}
    leaks = {r.doc_id for r in found["op3_benchmark_decontamination"](spark, sf_dir).where("contaminated").collect()}
    toxic = {r.doc_id for r in found["op2_toxicity"](spark, sf_dir).where("flagged").collect()}
    # A copy may stay if the one that would have stayed was toxic.
    assert not kept & leaks and not kept & toxic
    assert len(kept & dropped) <= len(toxic)

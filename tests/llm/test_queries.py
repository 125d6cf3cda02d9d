"""The registered queries and the pipeline on the smallest tables."""

from pathlib import Path

import pytest

import corpus_pipeline
from ludoshelf.llm.common import stage
from ludoshelf.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle_compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


def test_all_operators():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    assert compare(connect(SF_DIR), QUERIES[name](spark, SF_DIR), ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op7_decontaminate", "op13_spelling_variants"}))
def test_a_row_for_every_row(spark, name):
    table = "pages" if name == "op2_url_filter" else "documents"
    assert QUERIES[name](spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


@pytest.mark.parametrize("name", ["op2_url_filter", "op6_line_dedup", "op7_decontaminate", "op11_fingerprints"])
def test_native_plans(spark, name):
    text = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_pipeline_stages(spark):
    docs, staged = spark.read.parquet(f"{SF_DIR}/documents.parquet"), stage(spark)
    columns, before = docs.columns, docs.count()
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        docs = staged(function(spark, docs, SF_DIR), f"pipeline_{k}")
        assert 0.5 * before < docs.count() <= before
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert "taken" in docs.columns


def test_pipeline_on_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, function in corpus_pipeline.STAGES[:-1]:
            out = function(spark, docs, SF_DIR)
            assert out.columns == docs.columns
            out.count()

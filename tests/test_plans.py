"""Physical plans: what must and must not be in them."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from ludoshelf.operators import keyed
from ludoshelf.plans.reports import all_reports

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")
LAZY = sorted(set(all_reports()) - {"game_assembly", "diagnostics_union", "landing_stream", "latest_upsert"})


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins(spark, name):
    text = plan(queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(queries()["id_keyset"](spark, SF_DIR))
    assert "GreaterThan(l_partkey,500)" in text and "ReadSchema: struct<l_partkey:bigint>" in text
    assert "TakeOrderedAndProject" in text
    assert "In(event_type, [purchase,view])" in plan(queries()["catalogue_kind"](spark, SF_DIR))


def test_rank_limit_runs_before_the_shuffle(spark):
    text = plan(keyed.top_k(spark.range(10).withColumn("k", F.col("id") % 3), ["k"], [F.col("id")], 2))
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_grouping_sets_share_one_scan(spark):
    text = plan(queries()["rating_summary"](spark, SF_DIR))
    assert text.count("documents.parquet") == 1 and "Expand" in text


def test_pages_are_tokenized_once(spark):
    for name in ("tag_rank", "html_pivot", "html_blocks", "zip_pairs"):
        assert plan(queries()[name](spark, SF_DIR)).count("ArrowEvalPython") == 1, name

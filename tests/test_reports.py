"""Every report against its SQL on the smallest tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ludoshelf.plans.reports import all_reports
from tests.oracle_compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(all_reports()))
def test_report_equals_sql(spark, duck, name):
    assert compare(duck, queries()[name](spark, SF_DIR), oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0

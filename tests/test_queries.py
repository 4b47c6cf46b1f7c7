"""Every registered batch query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
from clickweave.plans.batch import QUERIES
from clickweave.plans.oracle import ORACLE
from clickweave.plans.streams import STREAMS
from compare import spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"

needs_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not there")


def test_every_query_has_its_sql():
    assert {*QUERIES, *STREAMS} == set(ORACLE)
    assert set(ORACLE) <= set(driver.queries()) & set(driver.oracle_sql())
    assert all(name.startswith("op") or name == "pipeline" for name in set(driver.queries()) - set(ORACLE) - {"output_table"})


@needs_tables
@pytest.mark.parametrize("name", [*QUERIES, "stream_update_24h"])
def test_query(spark, name):
    assert spark_rows(driver.queries()[name](spark, SF_DIR)) == sql_rows(SF_DIR, driver.oracle_sql()[name])


@needs_tables
def test_entry(spark):
    result = driver.entry(spark)
    assert result.count() == 188
    assert result.filter("attributed_click_id IS NOT NULL").count() == 3

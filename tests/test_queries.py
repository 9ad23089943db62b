"""Every driver query against its SQL on the smallest test tables."""

from __future__ import annotations

import __spark_entry__ as driver
import pytest
from oracle_check import difference, duck

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


NAMES = sorted(query.__name__ for query in driver.QUERIES)


def test_keys_match():
    assert set(NAMES) <= set(driver.queries())
    assert set(NAMES) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    ours = driver.queries()[name](spark, SMALL).toPandas()
    assert difference(ours, con.execute(driver.oracle_sql()[name]).df()) is None


def test_loading_keys_leave_no_databases(spark):
    for name in ("ingest_row_counts", "gold_tables"):
        driver.queries()[name](spark, SMALL).collect()
    before = [d.name for d in spark.catalog.listDatabases()]
    for name in ("ingest_row_counts", "gold_tables"):
        driver.queries()[name](spark, SMALL).collect()
    assert [d.name for d in spark.catalog.listDatabases()] == before

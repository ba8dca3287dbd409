"""Every registered query against DuckDB, over whole tables."""

from __future__ import annotations

import pytest
from compare import duckdb_bag, spark_bag

import __spark_entry__ as driver
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


# The training-data queries have tests of their own.
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert spark_bag(driver.queries()[name](spark, SF_DIR)) == duckdb_bag(
        SF_DIR, driver.oracle_sql()[name]
    )


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_gives_one_row_per_valid_conversation(spark):
    result = driver.entry(spark)
    assert result.columns == ["conv_id", "split", "dialogue"]
    assert result.count() == 6

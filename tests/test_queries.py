"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from millrace.oracles import CHECKED_DIR, ORACLES
from millrace.queries import QUERIES
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def connection():
    return connect(CHECKED_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, connection, name):
    df = driver.queries()[name](spark, CHECKED_DIR)
    assert differences(df, connection, driver.oracle_sql()[name]) == ""


def test_every_query_has_an_oracle_and_rows(connection):
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql())
    for name, sql in ORACLES.items():
        assert connection.execute(f"select count(*) from ({sql})").fetchone()[0] > 0, name


def test_entry(spark):
    lines = driver.entry(spark)
    keys = lines.groupBy("l_orderkey", "l_linenumber").count()
    assert lines.count() == keys.count() > 0
    assert keys.agg(F.max("count")).first()[0] == 1

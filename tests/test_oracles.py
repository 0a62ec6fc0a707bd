"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, llm, oracle_sql, queries
from ledgerloom.testing import compare, duck_tables

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_tables(duckdb.connect(), SF_DIR)


def test_every_query_has_an_oracle_or_says_that_it_has_none():
    assert set(QUERIES) - set(ORACLES) == (llm.WITHOUT_SQL if llm else set())
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR).toArrow()
    assert compare(got, duck.sql(ORACLES[name]).to_arrow_table(), allow_empty=True) is None


def test_entry_has_the_view_columns(spark):
    assert len(entry(spark).columns) == 36

"""Every query against its SQL oracle."""

from __future__ import annotations

import os

import pytest
from check import comparable, connect, oracle_rows

import __spark_entry__ as entry
from vitaelake.plans.oracle import oracle_sql
from vitaelake.plans.queries import QUERIES

SF_DIR = f"/root/testdata/sf{os.environ.get('TEST_SF', '0.001')}"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    columns, expected = oracle_rows(db, SQL[name])
    assert sorted(df.columns) == sorted(columns)
    assert comparable(df.columns, df.collect()) == comparable(columns, expected)


def test_only_the_approximate_search_has_no_sql():
    assert set(QUERIES) - set(SQL) == {"match_vectors_approx"}


def test_entry(spark):
    assert entry.entry(spark).count() > 0

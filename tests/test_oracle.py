"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest
from oracle import connect, differences

import __spark_entry__ as entry_points

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, TWINS = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    if name not in TWINS:
        assert QUERIES[name](spark, SF_DIR).count() > 0
        return
    assert differences(spark, connection, name, QUERIES[name], TWINS[name], SF_DIR) is None


def test_entry_has_rows_and_a_stable_schema(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["_row_id", "input", "target"]
    assert df.count() > 0

"""Every registered query against its plain SQL over whole tables."""

import os

import pytest

import __spark_entry__ as entry_point
from tests.oracle_check import connect, differences

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted([*entry_point.QUERIES, *entry_point.FILE_QUERIES, *entry_point.RUN_QUERIES]))
def test_query_equals_sql(spark, con, name):
    assert differences(entry_point.queries()[name](spark, SF_DIR), con, entry_point.oracle_sql()[name]) == []


def test_entry_has_rows_and_stable_schema(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["ip", "hostName", "user", "description", "macAddress"]
    assert df.count() > 0

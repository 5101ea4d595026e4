"""Physical plans of all registered queries, with joins planned as for large sides."""

import re

import pytest

import __spark_entry__ as entry_point

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def large_sides(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry_point.QUERIES))
def test_no_cross_join_python_or_single_task(large_sides, name):
    text = plan(entry_point.queries()[name](large_sides, SF_DIR))
    assert not re.findall("CartesianProduct|BroadcastNestedLoopJoin|Exchange SinglePartition|EvalPython|InPandas|MapInArrow", text)


def test_network_lookup_joins_on_blocks(large_sides):
    text = plan(entry_point.queries()["cidr_first_match"](large_sides, SF_DIR))
    assert re.search(r"SortMergeJoin \[bits#\d+, block#\d+L\], \[cast\(bits|SortMergeJoin \[cast\(bits|SortMergeJoin \[bits", text)


def test_scans_read_only_needed_columns(spark):
    text = plan(entry_point.queries()["extract_domains"](spark, SF_DIR))
    assert re.search(r"ReadSchema: struct<url:string>", text)
    text = plan(entry_point.queries()["valid_registrations"](spark, SF_DIR))
    assert "PushedFilters: [" in text and "html" not in text

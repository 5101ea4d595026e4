"""Registered queries over whole tables against their SQL, and the plan of the native one."""

import re

import pytest

from netaudit.llm.queries import LLM_ORACLE, LLM_QUERIES
from tests.oracle_check import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(LLM_QUERIES[name](spark, SF), connect(SF), LLM_ORACLE[name]) == []


def test_one_query_per_operator():
    assert sorted(LLM_QUERIES, key=lambda n: int(re.sub(r"\D", "", n.split("_")[0]) or 99))[-1] == "pipeline"
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES if n != "pipeline") == list(range(1, 14))


def test_native_query_runs_no_python(spark):
    plan = LLM_QUERIES["op7_chat_formatting"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.findall("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin|Exchange SinglePartition", plan)

"""Running values against a plain loop, over one and two chunk levels."""

import random

import pytest
from pyspark.sql import functions as F

from netaudit.operators.scan import lines_since, ordered_scan


@pytest.mark.parametrize("levels", [[], ["chunk"], ["part", "chunk"]])
def test_running_values(spark, levels):
    rng = random.Random(5)
    rows = [
        (f, i // 60, i // 7, i, rng.choice([None, None, i]), rng.choice([0, 1]), rng.random() < 0.07)
        for f in "ab" for i in range(300)
    ]
    df = spark.createDataFrame(rows, "f string, part long, chunk long, pos long, v long, x long, m boolean").repartition(5)
    out = ordered_scan(
        df, ["f"], levels, "pos",
        carry={"c": F.col("v")}, carry_before={"cb": F.col("v")}, total={"t": F.col("x")},
        total_before={"tb": F.col("x")}, ahead={"a": F.col("v")}, since={"s": lines_since(F.col("m"))},
    )
    got = {(r.f, r.pos): (r.c, r.cb, r.t, r.tb, r.a, r.s) for r in out.collect()}
    expected = {}
    for f in "ab":
        mine, c, t, s = [r for r in rows if r[0] == f], None, 0, 0
        for i, r in enumerate(mine):
            cb, tb, sb = c, t, s
            c = r[4] if r[4] is not None else c
            t += r[5]
            s = 0 if r[6] else s + 1
            expected[f, r[3]] = (c, cb, t, tb, mine[i + 1][4] if i + 1 < len(mine) else None, sb)
    assert got == expected


def test_plan_has_no_whole_sequence_window(spark):
    df = spark.range(10).selectExpr("'f' f", "id div 3 chunk", "id pos", "id v")
    plan = ordered_scan(df, ["f"], ["chunk"], "pos", total={"t": F.col("v")})._jdf.queryExecution().toString()
    rows_window = [l for l in plan.split("\n") if "windowspecdefinition" in l and "pos" in l]
    assert rows_window and all("chunk" in l for l in rows_window)


def test_rows_are_not_broadcast_to_their_chunks(spark):
    """A table of a few compressed bytes may hold many rows; only the chunks' summaries move."""
    df = spark.range(10).selectExpr("'f' f", "id div 3 chunk", "id pos", "id v")
    plan = ordered_scan(df, ["f"], ["chunk"], "pos", total={"t": F.col("v")})._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan

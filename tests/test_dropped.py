"""Counts of what is left out, without a pass of their own."""

from pyspark.sql import functions as F

from netaudit.operators.dropped import counted, counting
from netaudit.session import checkpointed


def test_counts_come_with_the_pass(spark):
    rows = spark.range(1000).select(F.col("id"))
    with counting() as dropped:
        kept = counted(rows, "odd", F.col("id") % 2 == 1).filter("id % 2 = 0")
        again = counted(rows, "odd", F.col("id") % 2 == 1)
        empty = counted(rows.filter("id < 0"), "none", F.lit(True))
        assert checkpointed(kept).count() == 500 and checkpointed(empty).count() == 0
        assert again is rows
        assert dict(map(tuple, dropped.table(spark).collect())) == {"odd": 500, "none": 0}
    assert counted(rows, "odd", F.lit(True)) is rows


def test_jobs_do_not_share_counts(spark):
    rows = spark.range(10)
    for n in (3, 7):
        with counting() as dropped:
            checkpointed(counted(rows, "small", F.col("id") < n))
            assert [tuple(r) for r in dropped.table(spark).collect()] == [("small", n)]

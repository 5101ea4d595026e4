"""Positions over the whole table against a sort in one place."""

import random

from pyspark.sql import functions as F

from netaudit.operators.positions import with_positions


def test_positions_equal_a_sort(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", "b", "é", None, f"k{i}"]), rng.randrange(5), {"m": str(rng.randrange(3))}) for i in range(5000)]
    df = spark.createDataFrame(rows, "k string, n int, cells map<string,string>").repartition(9)
    got = sorted(with_positions(df, [F.desc("n"), F.asc_nulls_first("k")]).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(5000))
    want = sorted(rows, key=lambda r: (-r[1], r[0] is not None, (r[0] or "").encode(), r[2]["m"]))
    assert [(r.k, r.n, r.cells) for r in got] == want


def test_a_hot_key_is_in_many_ranges(spark):
    df = spark.range(20_000).select(F.lit("one").alias("k"), F.col("id"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in df.orderBy("k", "id").groupBy(F.spark_partition_id()).count().collect()]
        got = with_positions(df, [F.col("k")])
        assert got.filter("position <> id").count() == 0 and max(sizes) < 12_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_no_rows(spark):
    assert with_positions(spark.range(0), [F.col("id")]).collect() == []

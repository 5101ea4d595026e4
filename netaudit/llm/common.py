"""Helpers the operators share: tables, stored steps, small id filters and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from netaudit.session import checkpointed, ship_package

__all__ = ["bit_table", "checkpointed", "components", "in_bit_table", "only_ids", "shipped", "small_batches", "spare", "split_by_ids", "table", "without_ids"]

#: Words of 64 bits in the id filter, whatever the data: 1 MB.
FILTER_WORDS = 1 << 17


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipped(job):
    """Send the package to the executors before a job, whose first argument is the session, runs Python there."""
    @wraps(job)
    def run(spark: SparkSession, *args):
        ship_package(spark)
        return job(spark, *args)

    return run


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Hand rows to Python in small batches inside, as each is a whole text or two."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def spare(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, in any capitals."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _place(key: Column) -> tuple[Column, Column]:
    h = F.xxhash64(key)
    return F.pmod(F.shiftrightunsigned(h, 8), F.lit(FILTER_WORDS)), F.pmod(h, F.lit(64)).cast("int")


def split_by_ids(df: DataFrame, key: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose ``key`` is surely not in the one column of ``ids``, and those whose key may be.

    A bit table of fixed size goes to every task, so nothing is shuffled.
    """
    own_word, own_bits = spare(df, "_word"), spare(df, "_bits")
    word, bit = _place(F.col(ids.columns[0]))
    bits = ids.groupBy(word.alias(own_word)).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias(own_bits))
    bits = F.broadcast(checkpointed(bits))
    word, bit = _place(F.col(key))
    hit = F.call_function("shiftrightunsigned", F.col(own_bits), bit).bitwiseAND(F.lit(1)) == 1
    marked = df.withColumn(own_word, word)
    sure = marked.join(bits, own_word, "left").filter(~F.coalesce(hit, F.lit(False))).drop(own_word, own_bits)
    return sure, marked.join(bits, own_word).filter(hit).drop(own_word, own_bits)


def without_ids(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in the one column of ``ids``; null keys stay.

    Only the rows that may be among the ids are shuffled.
    """
    sure, near = split_by_ids(df, key, ids)
    own = spare(df, "_id")
    unwanted = ids.select(F.col(ids.columns[0]).alias(own)).distinct()
    return sure.unionByName(near.join(unwanted.hint("shuffle_merge"), F.col(key) == F.col(own), "left_anti"))


def only_ids(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in the one column of ``ids``, read by one shuffle of few rows.

    A bit table leaves out nearly all other rows before the exact semi-join shuffles the rest.
    """
    _, near = split_by_ids(df, key, ids)
    own = spare(df, "_id")
    wanted = ids.select(F.col(ids.columns[0]).alias(own)).distinct()
    return near.join(wanted.hint("shuffle_merge"), F.col(key) == F.col(own), "left_semi")


def bit_table(keys: DataFrame, bits: int) -> np.ndarray:
    """Table of ``2 ** bits`` bits, whatever the data, with those set that the first bits of the one column of hashes name."""
    cell = F.shiftrightunsigned(keys.columns[0], 64 - bits)
    bit = cell.bitwiseAND(F.lit(63)).cast("int")
    words = keys.groupBy(F.shiftrightunsigned(cell, 6).cast("long").alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"))
    found = words.toArrow()  # bounded by the table
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[np.array(found["word"])] = np.array(found["bits"])
    return out.view(np.uint64)


def in_bit_table(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be among the table's; never false for one that is."""
    cell = hashes >> np.uint64(64 - 6 - len(table).bit_length() + 1)
    return (table[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))) & np.uint64(1) == 1


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for the undirected edges ``a, b`` (any two long columns, in this order).

    The component is the smallest node reachable. Large stars and small stars take turns until
    the edges stay as they are. Nodes in no edge between two different nodes are left out.
    Hot nodes are aggregated before the shuffle; only a count and a checksum reach the driver.
    """
    first, second = edges.columns[:2]
    now = edges.select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b")).filter("a != b").distinct()
    now = checkpointed(now)
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        )
        then = checkpointed(small)
        after = _state(then)
        if after == state:
            break
        now, state = then, after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )

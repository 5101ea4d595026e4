"""Rows with their place in an order over the whole table.

A sort puts rows in ranges; a row's place is the number of rows in the ranges before, one count
per range, and its place in its own. No task holds more than a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from netaudit.operators.scan import ordered_scan
from netaudit.session import checkpointed

# The id that Spark gives a row: its partition, and below that its number in it.
_IN_PARTITION = 33
#: Ranges whose counts are added up together.
_RANGES = 1000


def with_positions(rows: DataFrame, order: Sequence[Column], position: str = "position") -> DataFrame:
    """Rows with their zero-based ``position`` in ``order``.

    Rows that are alike in it follow each other by their other columns, which splits a hot key
    too. The sorted rows are written out once, then each range is counted.
    """
    ties = [F.to_json(c) if kind.startswith("map") else F.col(c) for c, kind in rows.dtypes]
    numbered = rows.orderBy(*order, *ties).withColumn("_id", F.monotonically_increasing_id())
    stored = checkpointed(numbered.select(
        "*", F.shiftright("_id", _IN_PARTITION).alias("_range"), (F.col("_id") - F.shiftleft(F.shiftright("_id", _IN_PARTITION), _IN_PARTITION)).alias("_place")
    ).drop("_id"))
    counts = stored.groupBy("_range").agg(F.count("*").alias("_rows"), F.floor(F.col("_range") / _RANGES).alias("_ranges"))
    starts = ordered_scan(checkpointed(counts), [], ["_ranges"], "_range", total_before={"_start": F.col("_rows")}).select("_range", "_start")
    return stored.join(starts, "_range").withColumn(position, F.col("_start") + F.col("_place")).drop("_range", "_place", "_start")

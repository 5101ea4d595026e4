"""Counts of the rows that a job leaves out because they have no defined result.

Operators say what they leave out with ``counted``. Inside ``counting`` that becomes an
observation of the rows as they pass by, in the job's own pass; outside it costs nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

_active: ContextVar[Dropped | None] = ContextVar("dropped", default=None)


class Dropped:
    """What the operators of a job have left out, known when its output is written."""

    def __init__(self):
        self.observations: dict[str, Observation] = {}

    def observe(self, rows: DataFrame, what: str, left_out: Column) -> DataFrame:
        """The rows, with a count on them. An input that is looked at twice is counted once."""
        if what in self.observations:
            return rows
        self.observations[what] = Observation(f"{what} {uuid.uuid4().hex}")
        return rows.observe(self.observations[what], F.count_if(left_out).alias("rows"))

    def table(self, spark: SparkSession) -> DataFrame:
        """``what, rows``, one row per kind. To be called after the job's output is written."""
        found = [(what, int(o.get.get("rows", 0))) for what, o in sorted(self.observations.items())]
        return spark.createDataFrame(found, "what string, rows long")


def counted(rows: DataFrame, what: str, left_out: Column) -> DataFrame:
    active = _active.get()
    return rows if active is None else active.observe(rows, what, left_out)


@contextmanager
def counting() -> Iterator[Dropped]:
    token = _active.set(Dropped())
    try:
        yield _active.get()
    finally:
        _active.reset(token)

"""Sinks: register snapshots, report tables, trend, review records and MAC matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from netaudit.plans.trend import sorted_trend
from netaudit.sinks.namedfiles import write_documents, write_keyed_lines
from netaudit.sinks.versions import write_registers


def write_register(register: DataFrame, path: str, fmt: str = "json") -> int:
    """Register snapshot as a new version of ``path``, the last folder being its name. Null fields are left out in JSON."""
    root, _, name = path.rstrip("/").rpartition("/")
    return write_registers(register.sparkSession, root, {name: register}, fmt)


def export_unless_empty(register: DataFrame, path: str, fmt: str = "json") -> bool:
    """Publish a new version only if there is anything to write."""
    if register.isEmpty():
        return False
    write_register(register, path, fmt)
    return True


def write_reports(rows: DataFrame, yyyymm: str, path: str) -> None:
    """Report rows by period, report and table; other periods at ``path`` stay.

    Rows of a table are brought together, and large tables split again by size, so that files
    are few. ``place`` gives the row order inside a table.
    """
    named = rows.hint("rebalance", "report", "table").select(F.lit(yyyymm).alias("yyyymm"), "report", "table", "place", "cells")
    (
        named.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("yyyymm", "report", "table")
        .parquet(path)
    )


def write_trend(ranked: DataFrame, series: DataFrame, yyyymm: str, path: str) -> None:
    """The trend table without its rank column, in output order with each row's ``position``, and the chart series."""
    table = sorted_trend(ranked).drop("applicationsRank").orderBy("position")
    table.write.mode("overwrite").parquet(f"{path}/{yyyymm}/trend")
    series.write.mode("overwrite").parquet(f"{path}/{yyyymm}/series")


def record_name(header: str) -> Column:
    """Name of the document of a period."""
    return F.concat(F.lit(f"{header} "), "yyyymm", F.lit(".md"))


def write_review_records(records: DataFrame, header: str, path: str) -> None:
    """One text document per period, named ``<header> <yyyymm>.md``; existing ones stay."""
    write_documents(records.select(record_name(header).alias("name"), "text"), path)


def write_mac_matches(matches: DataFrame, path: str) -> None:
    """Match lines (``file:line``) by MAC, in files of bounded size with an index of the MACs."""
    lines = matches.select("mac", F.concat_ws(":", "file", "line").alias("value"))
    write_keyed_lines(lines, "mac", "value", ["value"], path)

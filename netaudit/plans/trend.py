"""Bandwidth trend of the top applications over thirteen months, and its chart series.

Trend rows are ``application, size, bandwidth, yyyymm``: ``size`` is the text of the report
and ``bandwidth`` its megabytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from netaudit.constants import (
    CHART_APPLICATIONS,
    TOP_APPLICATIONS,
    TOTAL_TITLE,
    TRAFFIC_STATISTICS,
    XML_SINCE,
)
from netaudit.functions.dates import trend_periods
from netaudit.functions.text import mb_to_gb, size_to_mb, token
from netaudit.operators.positions import with_positions
from netaudit.operators.shaping import size_cell
from netaudit.sources.lines import csv_sections

# Rows of the two sections of the sectioned CSV report, and the total's rank.
STATISTICS_ROWS, APPLICATION_ROWS = 8, 30
TOTAL_RANK = 99


def _trend_row(application: Column, size: Column) -> list[Column]:
    return [application.alias("application"), size.alias("size"), size_to_mb(size).alias("bandwidth"), F.col("yyyymm")]


def trend_of_csv(lines: DataFrame, period: Column) -> DataFrame:
    """Trend rows of sectioned CSV reports; ``period`` gives the month of a ``file``.

    A report without total has a total row without size.
    """
    cells = csv_sections(lines, {
        "total": (f"###{TRAFFIC_STATISTICS}###", STATISTICS_ROWS),
        "top": (f"###{TOP_APPLICATIONS}###", APPLICATION_ROWS),
    })
    is_total = F.col("section") == "total"
    second, third = token(F.col("cells"), 2), token(F.col("cells"), 3)
    counts = ~is_total | (second == TOTAL_TITLE)
    rows = cells.groupBy("file", "section", F.when(~is_total, F.col("row_no")).alias("row")).agg(
        F.min_by(F.struct(second.alias("application"), third.alias("size")), F.when(counts, F.col("row_no"))).alias("r")
    )
    application = F.when(is_total, F.lit(TOTAL_TITLE)).otherwise(F.col("r.application"))
    return rows.withColumn("yyyymm", period).select(*_trend_row(application, F.col("r.size")))


def trend_of_xml(rows: DataFrame) -> DataFrame:
    """Trend rows of XML reports: ``rows`` is the long table with a ``yyyymm`` column."""
    def cell(name: str) -> Column:
        return F.try_element_at("cells", F.lit(name))

    totals = rows.filter((F.col("table") == TRAFFIC_STATISTICS) & (cell("Summary") == TOTAL_TITLE))
    totals = totals.groupBy("yyyymm").agg(F.min_by(cell("Statistics"), "place").alias("size"))
    top = size_cell(rows.filter(F.col("table") == TOP_APPLICATIONS), ["yyyymm"])
    both = top.select("yyyymm", cell("Application").alias("application"), "size").unionByName(
        totals.select("yyyymm", F.lit(TOTAL_TITLE).alias("application"), "size")
    )
    size = F.translate("size", ",", "")
    return both.select(*_trend_row(F.col("application"), size))


def reader_of(yyyymm: Column, xml_since: str = XML_SINCE) -> Column:
    """Which reader a month takes: ``csv`` or ``xml``."""
    return F.when(yyyymm < xml_since, F.lit("csv")).otherwise(F.lit("xml"))


def in_window(yyyymm: Column, period: str) -> Column:
    """Whether a month is among the thirteen up to ``period``."""
    return yyyymm.isin(trend_periods(period))


def with_ranks(trend: DataFrame) -> DataFrame:
    """Add ``applicationsRank``, the number of rows of the application; the total has a fixed one.

    Rows without application are counted together and kept.
    """
    ranks = trend.groupBy(F.col("application").alias("counted")).agg(F.count("*").alias("rows"))
    rank = F.when(F.col("application") == TOTAL_TITLE, TOTAL_RANK).otherwise(F.col("rows")).cast("int")
    same = F.col("application").eqNullSafe(F.col("counted"))
    return trend.join(ranks, same).withColumn("applicationsRank", rank).drop("rows", "counted")


def sorted_trend(ranked: DataFrame) -> DataFrame:
    """Trend rows with their ``position`` in the output: by the rank of the application, its name and the month."""
    return with_positions(ranked, [F.desc("applicationsRank"), F.col("application"), F.col("yyyymm")])


def chart_series(trend: DataFrame, applications: Sequence[str] = CHART_APPLICATIONS) -> DataFrame:
    """Gigabytes per month and application: the total, the listed ones and the sum of the others.

    Rows without application are among the others. A month's sum of them is null if any size is null.
    """
    gigabytes = trend.select("application", "yyyymm", mb_to_gb(F.col("bandwidth")).alias("bandwidth"))
    listed = F.coalesce(F.col("application").isin([TOTAL_TITLE, *applications]), F.lit(False))
    complete = F.count("*") == F.count("bandwidth")
    others = (
        gigabytes.filter(~listed)
        .groupBy("yyyymm")
        .agg(F.when(complete, F.sum("bandwidth")).alias("bandwidth"))
        .withColumn("application", F.lit("others"))
    )
    return gigabytes.filter(listed).unionByName(others)

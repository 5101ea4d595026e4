"""Review records still missing: which periods have none, and their texts."""

from __future__ import annotations

import time
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from netaudit.functions.dates import (
    calendar_year,
    calendar_yyyymm,
    fiscal_year,
    fiscal_year_of,
    japanese_weekday,
)
from netaudit.functions.text import name_part
from netaudit.session import checkpointed
from netaudit.sources.lines import base_name, decoded_name, read_lines, number_lines


def read_calendar(spark: SparkSession, path: str, columns: int = 13) -> DataFrame:
    """Review calendar: CSV, three leading rows, read by position as texts."""
    names = [f"c{i}" for i in range(1, columns + 1)]
    cells = F.from_csv("line", F.lit(", ".join(f"{n} string" for n in names)))
    rows = number_lines(read_lines(spark, path)).filter("line_no > 3").withColumn("row", cells)
    # The calendar's columns 1, 11 and 13.
    return rows.select(
        F.col("row.c1").alias("targetYm"), F.col("row.c11").alias("name"), F.col("row.c13").alias("eventDate")
    )


def of_fiscal_year(calendar: DataFrame, today: date) -> DataFrame:
    """Calendar rows of the fiscal year that holds ``today``, with ``fiscalYear``."""
    year = calendar.withColumn("fiscalYear", fiscal_year(F.col("targetYm")))
    return year.filter(F.col("fiscalYear") == fiscal_year_of(today))


#: Folder below a folder of documents that keeps the names found, with the time of the folder's last change before.
PRODUCED = "_produced"
PRODUCED_SCHEMA = "name string, changed long"
#: Milliseconds after which a change cannot be one of the same time that is still going on.
SETTLED = 2000


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _changed(spark: SparkSession, path: str) -> int | None:
    """When names were last added to or taken from a folder; None if there is no folder."""
    place, system = _place(spark, path)
    return system.getFileStatus(place).getModificationTime() if system.exists(place) else None


def list_names(spark: SparkSession, path: str) -> DataFrame:
    """Names of the files of a folder, without reading them: ``name``."""
    files = spark.read.format("binaryFile").load(path).select(base_name(decoded_name(F.col("path"))).alias("name"))
    return files.filter(~F.startswith("name", F.lit("_")) & ~F.startswith("name", F.lit(".")))


def produced_names(spark: SparkSession, path: str) -> DataFrame:
    """Names of the documents of a folder, which is listed once for each change of it.

    What a listing finds is added to the folder's list under the time of the last change; while
    that time stays the list is read instead. A change of the last moments is not trusted, and
    where a store does not tell when a folder was changed it is listed each time.
    """
    if _changed(spark, path) is None:
        return spark.createDataFrame([], "name string")
    listed = f"{path.rstrip('/')}/{PRODUCED}"
    place, system = _place(spark, listed)
    system.mkdirs(place)
    changed = _changed(spark, path)
    known = spark.read.schema(PRODUCED_SCHEMA).json(listed).filter(F.col("changed") == changed)
    if changed and not known.isEmpty():
        return known.filter("name is not null").select("name").distinct()
    found = checkpointed(list_names(spark, path))
    if changed and time.time() * 1000 - changed > SETTLED:
        # The row without name tells that the folder was listed, though it may be empty.
        noted = found.unionByName(spark.createDataFrame([(None,)], "name string")).withColumn("changed", F.lit(changed))
        noted.write.mode("append").json(listed)
    return found


def produced_periods(spark: SparkSession, path: str, header: str, extension: str = ".md") -> DataFrame:
    """Periods that have a record: files ``<header> yyyymm<extension>``.

    A folder that does not exist yet has no records.
    """
    named = F.regexp_extract("name", rf"^\Q{header}\E (\d{{6}})\Q{extension}\E", 1)
    return produced_names(spark, path).select(named.alias("yyyymm")).filter(F.col("yyyymm") != "").distinct()


def with_event(calendar: DataFrame) -> DataFrame:
    """Add ``yyyymm``, ``year`` and the event's month and day texts."""
    parts = F.split("eventDate", "/", -1)
    return calendar.select(
        "*",
        calendar_yyyymm(F.col("targetYm")).alias("yyyymm"),
        calendar_year(F.col("targetYm")).alias("year"),
        F.get(parts, F.lit(0)).alias("eventMonth"),
        F.get(parts, F.lit(1)).alias("eventDay"),
    )


def missing_periods(calendar: DataFrame, produced: DataFrame) -> DataFrame:
    """Calendar rows whose period has no record yet."""
    return with_event(calendar).join(produced.select("yyyymm"), "yyyymm", "left_anti")


def not_yet_converted(sources: DataFrame, outputs: DataFrame, name: str = "name") -> DataFrame:
    """Inputs whose output name does not exist."""
    return sources.join(outputs.select(name), name, "left_anti")


def _or_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit(" "))


def review_text(creator: str, approver: str, participants: str) -> Column:
    """Text of one review record from the columns of :func:`with_event`."""
    last_name = name_part(F.lit(approver), 1)
    year, month, day = F.col("year"), F.col("eventMonth"), F.col("eventDay")
    weekday = F.coalesce(japanese_weekday(year, month, day), F.lit(""))
    # Headings and sentences of the record, line by line.
    return F.concat_ws(
        "\n",
        F.lit("様式番号:ISF27-8<br><br>  "),
        F.lit("# UTMレポートレビュー記録  "),
        F.format_string("承認:%s<br>", last_name),
        F.format_string("確認:%s<br>", last_name),
        F.lit(f"作成:{creator}<br>"),
        F.lit("## 実施日時"),
        F.format_string("%s年%s月%s日（%s）13:30〜14:00", year, _or_blank(month), _or_blank(day), weekday),
        F.lit("## 参加者"),
        F.lit(f"{approver}、{participants}"),
        F.lit("## 対象期間"),
        F.format_string("%s年%s月", F.substring("yyyymm", 1, 4), F.col("yyyymm").substr(F.lit(5), F.length("yyyymm"))),
        F.lit("## 問題点"),
        F.lit("定型の手順に沿って確認、対応を実施した。特記すべき問題点は存在しなかった。"),
        F.lit("## 改善点・対応策"),
        F.lit("特になし。"),
        F.lit("## 今後の対応課題・対応中の課題"),
        F.lit("特になし"),
        F.lit("## 責任者確認"),
        F.format_string("%s年%s月%s日　%s", year, _or_blank(month), _or_blank(day), last_name),
    )


def review_records(missing: DataFrame, creator: str, approver: str, participants: str) -> DataFrame:
    """One text document per missing period: ``yyyymm, text``."""
    return missing.select("yyyymm", review_text(creator, approver, participants).alias("text"))

"""Derived input files in the scratch folder, and queries that go through the readers, jobs and sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from netaudit import constants as C
from netaudit.functions import net
from netaudit.plans import jobs, review
from netaudit.registry import inputs
from netaudit.registry.inputs import ip10, mac_of, table, text
from netaudit.session import scratch_folder
from netaudit.sinks import namedfiles, tables as sinks
from netaudit.sources import lines, registers, xmlreports

# Fixed values of the registered runs.
STAMP = "1999-08-01"
REVIEW_DAY = date(1998, 6, 15)
APPROVER, CREATOR, PARTICIPANTS = "Yamada Taro", "Suzuki", "Sato、Tanaka"
HEADER = "UTMレポートレビュー記録"

#: Rows that one task sorts for a file.
RANGE_ROWS = 1 << 19


def new_folder(spark: SparkSession) -> str:
    return f"{scratch_folder(spark).rstrip('/')}/netaudit-files-{uuid.uuid4().hex}"


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration())


def write_files(rows: DataFrame, folder: str, encoding: str = "UTF-8") -> str:
    """Write ``file, chunk, pos, line`` rows as text files of these names, in order; a name may hold folders.

    Rows are sorted in ranges of bounded size, each by a task of its own, and written out as text. A file in one
    range is that text; the texts of a larger one are read in order by one task, which keeps none
    of it, so that each name is one file of any size.
    """
    spark = rows.sparkSession
    made = f"{folder}.parts-{uuid.uuid4().hex}"
    # A number of ranges, as sizes after compression say little of rows that are alike.
    ranges = 1 + rows.count() // RANGE_ROWS
    ranged = rows.select("file", "chunk", "pos", "line").repartitionByRange(ranges, "file", "chunk", "pos").withColumn("range", F.spark_partition_id())
    # Null lines are empty ones.
    ordered = ranged.sortWithinPartitions("file", "range", "chunk", "pos").select("file", "range", F.coalesce("line", F.lit("")).alias("line"))
    ordered.write.partitionBy("file", "range").option("maxRecordsPerFile", 0).text(f"{made}/ranges")
    system, path = _system(spark, made), spark._jvm.org.apache.hadoop.fs.Path

    def parts_of(place) -> list:
        return [s.getPath() for s in system.listStatus(place) if s.getPath().getName().startswith("part-")]

    for status in system.listStatus(path(f"{made}/ranges")):
        name = status.getPath().getName()
        if not name.startswith("file="):
            continue
        folders = sorted((s.getPath() for s in system.listStatus(status.getPath())), key=lambda p: int(p.getName().removeprefix("range=")))
        parts = [parts_of(f) for f in folders]
        if any(len(p) != 1 for p in parts):
            raise ValueError(f"{name} has {[len(p) for p in parts]} parts in its ranges")
        if len(parts) == 1 and encoding == "UTF-8":
            part = parts[0][0]
        else:
            part = _in_one(spark, [p.toString() for [p] in parts], f"{made}/{uuid.uuid4().hex}", encoding, parts_of, path)
        target = path(folder, unquote(name.removeprefix("file=")))
        system.mkdirs(target.getParent())
        system.rename(part, target)
    system.mkdirs(path(folder))
    system.delete(path(made), True)
    return folder


def _in_one(spark: SparkSession, parts: list[str], to: str, encoding: str, parts_of: Callable, path: Callable):
    """One file of the lines of texts, in their order, and its path. A union keeps the order of what it unites."""
    texts = [spark.read.schema("line string").option("lineSep", "\n").text(part) for part in parts]
    whole = reduce(DataFrame.union, texts).coalesce(1)
    if encoding == "UTF-8":
        whole.write.text(to)
    else:
        whole.write.options(encoding=encoding, sep="\u0001", quote="", quoteAll=False, emptyValue="", maxRecordsPerFile=0).csv(to)
    [part] = parts_of(path(to))
    return part


def _lines(rows: DataFrame, file: Column, pos: Column, line: Column) -> DataFrame:
    return rows.select(file.alias("file"), F.lit(0).cast("long").alias("chunk"), pos.cast("long").alias("pos"), line.alias("line"))


def report_files(spark, sf, reports: Iterable[str] = C.REPORT_NAMES) -> str:
    """The seven reports over the customers, and a file that is none of them."""
    key = F.col("c_custkey")
    names = [*reports, "Other Thing"]
    customers = table(spark, sf, "customer").withColumn("report", inputs.by_rest(key, list(names)))
    row = text("<id><User_or_IP_>", ip10(key), "</User_or_IP_><Note>n", key % 5, "</Note></id>")
    element = F.when(
        F.col("report") == C.USER_REPORT,
        text(f'<{C.USER_SECTION} name="', key % 5, ": ", ip10(key), f' u"><table name="{C.TOP_DESTINATIONS}">', row, f"</table></{C.USER_SECTION}>"),
    ).otherwise(text(f'<table name="{C.TERMINAL_TABLE}">', row, "</table>"))
    name = text(F.col("report"), f"-{STAMP}_1234.xml")
    body = _lines(customers, name, key, element)
    ends = customers.select(name.alias("file")).distinct()
    frame = [_lines(ends, F.col("file"), F.lit(p), F.lit(x)) for p, x in ((-1, "<r>"), (1 << 40, "</r>"))]
    return write_files(body.unionByName(frame[0]).unionByName(frame[1]), new_folder(spark))


def read_report_files(spark, sf):
    """Files listed, found complete and read; the file that is no report is left out."""
    folder = report_files(spark, sf)
    xmlreports.check_complete(xmlreports.list_reports(spark, folder))
    rows = xmlreports.read_reports(spark, folder).select("report", "table", "cells")
    counted = rows.select("report", F.col("table").alias("table_name"), F.explode("cells").alias("column_name", "value"))
    return counted.groupBy("report", "table_name", "column_name", "value").agg(F.count("*").alias("cells"))


def listed_files(spark, sf):
    """Names and kinds of the files in the folder."""
    listed = xmlreports.list_reports(spark, report_files(spark, sf))
    return listed.select(lines.base_name(F.col("file")).alias("file"), "report", "known")


def read_lease_files(spark, sf):
    """One lease file per nation, every second one in UTF-16."""
    cells = inputs.lease_cells(spark, sf)
    rows = cells.select(text(F.col("file"), ".txt").alias("file"), "chunk", "pos", F.array_join("cells", "\t").alias("line"))
    odd = F.substring_index(F.substring_index("file", ".", 1), "-", -1).cast("int") % 2 == 1
    folder = new_folder(spark)
    write_files(rows.filter(~odd), folder)
    write_files(rows.filter(odd), folder, "UTF-16")
    return registers.read_leases(spark, folder).drop("seq")


def read_config_file(spark, sf):
    """The one configuration of a folder, next to a file of another name; its numbered lines."""
    customers = table(spark, sf, "customer")
    rows = _lines(customers, F.lit("FIREWL01_1999-08.conf"), F.col("c_custkey"), text("set name ", F.col("c_name")))
    named = rows.unionByName(rows.withColumn("file", F.lit("other.conf")))
    found = lines.number_lines(lines.read_config(spark, write_files(named, new_folder(spark))))
    return found.select(lines.base_name(F.col("file")).alias("file"), "line_no", "line")


def read_vpn_files(spark, sf):
    """Lines of the logs of three months and of the running log."""
    user = F.col("user_id")
    events = table(spark, sf, "events")
    name = inputs.by_rest(user, ["vpn199806.log", "vpn199807.log", "vpn199809.log", "access.log", "access.log.1"])
    folder = write_files(_lines(events, name, F.col("event_id"), text("user ", user, " ", F.col("event_type"))), new_folder(spark))
    found = lines.read_vpn_lines(spark, folder, ["199806", "199807", "199808"])
    return found.groupBy(lines.base_name(F.col("file")).alias("file"), "line").agg(F.count("*").alias("lines"))


def register_snapshots(spark, sf):
    """A snapshot written, kept when the next one is empty, and read back; null fields stay null."""
    folder = new_folder(spark)
    denied = inputs.denied_register(spark, sf).drop("seq")
    kept = [sinks.export_unless_empty(df, folder) for df in (denied, denied.limit(0))]
    back = registers.read_register(spark, folder, registers.DENY_SCHEMA)
    return back.select("ip", "hostName", "macAddress", F.lit(kept[0]).alias("written"), F.lit(kept[1]).alias("replaced"))


def parameter_files(spark, sf):
    """S14, S21 and the leading rows of S17: parameters by list, settings, and a register without its first two rows."""
    key = F.col("s_suppkey")
    suppliers = table(spark, sf, "supplier")
    folder = new_folder(spark)
    body = _lines(suppliers, F.lit("parameters.csv"), key, text("list_", key % 3, ",\" 10.", key % 256, ".", F.floor(key / 256), ".0/24 \""))
    write_files(body.unionByName(_lines(spark.range(1), F.lit("parameters.csv"), F.lit(-1), F.lit("ID,Item"))), f"{folder}/parameters")
    found = registers.parameter_items(registers.read_parameters(spark, f"{folder}/parameters"), "list_1").select(F.lit("parameter").alias("kind"), F.col("Item").alias("value"))
    write_files(_lines(suppliers, F.lit("settings.csv"), key, text("item", key, ",", F.col("s_name"))), f"{folder}/settings")
    settings = registers.read_settings(spark, f"{folder}/settings").select(F.lit("setting").alias("kind"), text(F.col("itemName"), "=", F.col("data")).alias("value"))
    write_files(_lines(suppliers, F.lit("users.csv"), key, text("u", key)), f"{folder}/users")
    users = registers.without_leading_rows(registers.read_register(spark, f"{folder}/users", "user string", fmt="csv"))
    return found.unionByName(settings).unionByName(users.select(F.lit("user").alias("kind"), F.col("user").alias("value")))


def review_loop(spark, sf):
    """The records missing in a fiscal year are written; a second run finds them and adds none."""
    folder = new_folder(spark)
    calendar = inputs.calendar(spark, sf)
    pos = F.substring_index("targetYm", "年", 1).cast("int") * 12 + F.regexp_extract("targetYm", "(\\d+)月", 1).cast("int")
    line = F.concat_ws(",", F.col("targetYm"), *[F.lit("")] * 9, F.col("name"), F.lit(""), F.coalesce("eventDate", F.lit("")))
    body = _lines(calendar, F.lit("calendar.csv"), pos, line)
    titles = [_lines(spark.range(1), F.lit("calendar.csv"), F.lit(i - 3), F.lit("title")) for i in range(3)]
    write_files(body.unionByName(titles[0]).unionByName(titles[1]).unionByName(titles[2]), f"{folder}/calendar")
    args = (f"{folder}/calendar", f"{folder}/records", HEADER, REVIEW_DAY, CREATOR, APPROVER, PARTICIPANTS, f"{folder}/records")
    jobs.missing_reviews(spark, *args)
    due = review.of_fiscal_year(review.read_calendar(spark, args[0]), REVIEW_DAY)
    left = review.missing_periods(due, review.produced_periods(spark, args[1], HEADER)).count()
    jobs.missing_reviews(spark, *args)
    records = spark.read.text(args[1], wholetext=True).select(lines.base_name(lines.decoded_name(F.col("_metadata.file_path"))).alias("file"), F.col("value").alias("text"))
    return records.select("file", "text", F.lit(left).cast("long").alias("missing"))


def mac_files(spark, sf):
    """K6, C14: switch tables searched for the customers' MACs; lines read back by MAC through the index."""
    folder = new_folder(spark)
    switch = inputs.switch_lines(spark, sf)
    write_files(switch.withColumn("file", text(F.col("file"), ".txt")), f"{folder}/switch")
    macs = table(spark, sf, "customer").select(mac_of(F.col("c_custkey")))
    macs.write.text(f"{folder}/macs")
    jobs.write_mac_search(spark, f"{folder}/macs", f"{folder}/switch", f"{folder}/found")
    found = macs.select(net.mac_search_key(F.col(macs.columns[0])))
    return namedfiles.read_keyed_lines(spark, f"{folder}/found", found).select(F.col("key").alias("mac"), F.col("line").alias("value"))


def month_reports(spark, sf) -> DataFrame:
    """Bandwidth reports of all months, CSV and from 1999 on XML, as ``file, chunk, pos, line``; names hold the folders of the months."""
    monthly = jobs.checkpointed(inputs.monthly_applications(spark, sf))
    csv, xml = monthly.filter("yyyymm < '199901'"), monthly.filter("yyyymm >= '199901'")
    month = F.col("yyyymm")
    before, behind = jobs.MONTH_FOLDER.split("{}")
    stamp = text(before, month, f"{behind}/{C.BANDWIDTH_REPORT}-", F.substring(month, 1, 4), "-", F.substring(month, 5, 2), "-01-1234")
    csv_lines = inputs.csv_report_lines(csv).withColumnRenamed("file", "yyyymm").withColumn("file", text(stamp, ".csv"))
    elements = inputs.xml_report_column(xml).select(text(stamp, "_9.xml").alias("file"), F.lit(0).cast("long").alias("chunk"), F.col("at").cast("long").alias("pos"), F.col("xml").alias("line"))
    ends = elements.select("file").distinct()
    for pos, line in ((-1, "<r>"), (1 << 40, "</r>")):
        elements = elements.unionByName(_lines(ends, F.col("file"), F.lit(pos), F.lit(line)))
    return csv_lines.select("file", "chunk", "pos", "line").unionByName(elements)


def trend_files(spark, sf):
    """Thirteen months of report files, CSV and XML, read by the job; its trend table."""
    folder, period = new_folder(spark), "199907"
    write_files(month_reports(spark, sf), folder)
    jobs.bandwidth_report(spark, folder, period, f"{folder}/out", xml_since="199901")
    return spark.read.parquet(f"{folder}/out/{period}/trend").select("application", "size", "bandwidth", "yyyymm")


FILE_QUERIES = {
    f.__name__: f
    for f in [read_report_files, listed_files, read_lease_files, read_config_file, read_vpn_files, register_snapshots, parameter_files, review_loop, mac_files, trend_files]
}

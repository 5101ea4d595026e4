"""Report tables with identities joined on, shaped for output."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from netaudit import constants as C
from netaudit.functions.net import extract_ip
from netaudit.operators.shaping import SIZE_COLUMNS
from netaudit.sources.xmlreports import TOP10_DESTINATIONS

IDENTITY = ["hostName", "user", "description", "macAddress"]


@dataclass(frozen=True)
class KeyColumn:
    """Where a table's address is: in a whole cell, or as the first address in one."""

    report: str
    table: str
    column: str
    extract: bool = False


# The join column of each report table.
KEY_COLUMNS = [
    KeyColumn(C.ADMIN_EVENTS, "Login Summary", "Login_Interface", extract=True),
    KeyColumn(C.ADMIN_EVENTS, "List of Failed Logins", "Login_Source", extract=True),
    KeyColumn(C.BANDWIDTH_REPORT, "Top 30 Users by Bandwidth and Sessions", "User_or_IP_"),
    KeyColumn(C.BANDWIDTH_REPORT, "Top 30 Destination by Bandwidth and Sessions", "Hostname_or_IP_"),
    KeyColumn(C.CLIENT_REPUTATION, "レピュテーションスコアの上位ユーザー", "User__or_IP_"),
    KeyColumn(C.CLIENT_REPUTATION, " 直近2期間にスコアが増加した上位ユーザー", "User__or_IP_"),
    KeyColumn(C.CLIENT_REPUTATION, "レピュテーションスコアの大きい上位デバイス", "Device2"),
    KeyColumn(C.TERMINALS_DATACENTER, C.TERMINAL_TABLE, "User_or_IP_"),
    KeyColumn(C.TERMINALS_CENTER, C.TERMINAL_TABLE, "User_or_IP_"),
    KeyColumn(C.TERMINALS_VPN, C.TERMINAL_TABLE, "User_or_IP_"),
]
TERMINAL_REPORTS = [C.TERMINALS_DATACENTER, C.TERMINALS_CENTER, C.TERMINALS_VPN]

# Columns of the per-user destinations in the output, and one of the size columns.
REQUIRED_COLUMNS = [
    "rank", "usage", "ip", "hostName", "user", "description", "macAddress", "Destination", "destinationHost", "Application",
]
DESTINATION_COLUMNS = [*REQUIRED_COLUMNS, *SIZE_COLUMNS]


def cell(name: str) -> Column:
    return F.try_element_at("cells", F.lit(name))


def in_table(report: str, table: str) -> Column:
    return F.col("report").eqNullSafe(report) & F.col("table").eqNullSafe(table)


def add_cells(values: dict[str, Column]) -> Column:
    """Cells with the values set; null values are left out, like columns that hold only nulls."""
    pairs = [part for name, value in values.items() for part in (F.lit(name), value)]
    kept = F.map_filter("cells", lambda key, _: ~key.isin(list(values)))
    return F.map_concat(kept, F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull()))


def section_rank(section: Column) -> Column:
    """Text before the first colon of a section name."""
    return F.split_part(section, F.lit(":"), F.lit(1))


def section_usage(section: Column) -> Column:
    """Amount after ``Usage: `` in a section name, else null."""
    # Fixed value: how a section name gives its usage.
    return F.nullif(F.regexp_extract(section, "Usage: ([0-9.]+ [A-Za-z]+)", 1), F.lit(""))


def left_join_identity(rows: DataFrame, key: Column, identities: DataFrame, columns: list[str]) -> DataFrame:
    """Left join on an address. Rows without one get keys that match nothing, spread over all tasks.

    Identities are as many as the addresses of the data, so they are merged, not broadcast.
    """
    spread = F.concat(F.lit("?"), (F.abs(F.xxhash64("place")) % 4096).cast("string"))
    found = identities.select(F.col("ip").alias("_ip"), *[F.col(c).alias(f"_{c}") for c in columns])
    return rows.withColumn("_key", F.coalesce(key, spread)).join(found.hint("merge"), F.col("_key") == F.col("_ip"), "left").drop("_key", "_ip")


DEVICE = next(spec for spec in KEY_COLUMNS if spec.column == "Device2")


def plain_device_table(rows: DataFrame) -> DataFrame:
    """The device table (``report, table``) if any of its rows has a plain ``Device`` cell: at most one row."""
    with_device = rows.filter(in_table(DEVICE.report, DEVICE.table) & F.map_contains_key("cells", "Device"))
    return with_device.select("report", "table").distinct().withColumn("plain_device", F.lit(True))


def key_cells(rows: DataFrame) -> DataFrame:
    """Add ``key``, the address to look up, and write extracted addresses into an ``ip`` cell.

    The device table is read by its plain column where it has one. That is one fact, so it
    is broadcast.
    """
    keyed = rows.join(F.broadcast(plain_device_table(rows)), ["report", "table"], "left")
    key, extracted = F.lit(None).cast("string"), F.lit(False)
    for spec in KEY_COLUMNS:
        value = cell(spec.column)
        if spec == DEVICE:
            value = F.when(F.col("plain_device"), cell("Device")).otherwise(value)
        if spec.extract:
            value = extract_ip(value, anywhere=True)
            extracted = extracted | in_table(spec.report, spec.table)
        key = F.when(in_table(spec.report, spec.table), value).otherwise(key)
    keyed = keyed.withColumn("key", key).drop("plain_device")
    return keyed.withColumn("cells", F.when(extracted, add_cells({"ip": F.col("key")})).otherwise(F.col("cells")))


def _named(columns: list[str]) -> dict[str, Column]:
    return {c: F.col(f"_{c}") for c in columns}


def enrich(rows: DataFrame, identities: DataFrame) -> DataFrame:
    """Report rows with identity cells. Tables without a join column stay as they are.

    ``rows`` is the long table ``report, table, place, cells``. Each address row multiplies
    by its identities. Per-user destinations are looked up twice: the destination, of which
    only the host is kept, and the address in the section name.
    """
    kept = ["report", "table", "place", "cells"]
    rows = rows.select(*kept)
    destination = in_table(C.USER_REPORT, TOP10_DESTINATIONS)
    has_key = reduce(Column.__or__, [in_table(spec.report, spec.table) for spec in KEY_COLUMNS])
    keyed = left_join_identity(key_cells(rows.filter(has_key)), F.col("key"), identities, IDENTITY)
    keyed = keyed.withColumn("cells", add_cells(_named(IDENTITY)))

    section = cell("rank")
    visits = left_join_identity(rows.filter(destination), cell("Destination"), identities, ["hostName"])
    visits = visits.withColumn("cells", add_cells({
        "destinationHost": F.col("_hostName"),
        "ip": extract_ip(section, anywhere=True),
        "usage": section_usage(section),
        "rank": section_rank(section),
    })).drop("_hostName")
    visits = left_join_identity(visits, cell("ip"), identities, IDENTITY)
    visits = visits.withColumn("cells", add_cells(_named(IDENTITY)))
    others = rows.filter(~(has_key | destination))
    return others.unionByName(keyed.select(*kept)).unionByName(visits.select(*kept))


def distinct_rows(rows: DataFrame) -> DataFrame:
    """One row per distinct cells of a table, at the first place."""
    entries = F.array_sort(F.map_entries("cells"))
    firsts = rows.withColumn("entries", entries).groupBy("report", "table", "entries").agg(F.min("place").alias("place"))
    return firsts.select("report", "table", "place", F.map_from_entries("entries").alias("cells"))


def with_one_size(rows: DataFrame) -> DataFrame:
    """Only the fixed columns of the per-user destinations, with the first size column that any of them has.

    Which one is a single fact about the table, so it is broadcast.
    """
    destination = in_table(C.USER_REPORT, TOP10_DESTINATIONS)
    first, second = SIZE_COLUMNS
    sized = rows.filter(destination & F.map_contains_key("cells", first)).select("report", "table").distinct().withColumn("sized", F.lit(True))
    marked = rows.join(F.broadcast(sized), ["report", "table"], "left")
    fixed = F.map_filter("cells", lambda key, _: key.isin([*REQUIRED_COLUMNS, first]) | ((key == second) & F.col("sized").isNull()))
    return marked.withColumn("cells", F.when(destination, fixed).otherwise(F.col("cells"))).drop("sized")


def check_destinations(rows: DataFrame) -> None:
    """Raise if the per-user destinations of shaped rows lack a required column or a size.

    A column without any value counts as missing. Without rows there is nothing to check.
    """
    cells = rows.filter(in_table(C.USER_REPORT, TOP10_DESTINATIONS)).select(F.explode("cells").alias("name", "value"))
    found = {r.name for r in cells.filter("value is not null").filter(F.col("name").isin(DESTINATION_COLUMNS)).select("name").distinct().collect()}
    missing = [name for name in REQUIRED_COLUMNS if name not in found]
    if not found.intersection(SIZE_COLUMNS):
        missing.append(" or ".join(SIZE_COLUMNS))
    if found and missing:
        raise ValueError(f"per-user destinations lack {missing}")


def shape(rows: DataFrame) -> DataFrame:
    """Output form of enriched rows: null cells gone, fixed columns of the per-user
    destinations, filter rows on the source address gone, terminal lists without repeats."""
    rows = rows.withColumn("cells", F.map_filter("cells", lambda _, value: value.isNotNull()))
    terminal = reduce(Column.__or__, [in_table(report, C.TERMINAL_TABLE) for report in TERMINAL_REPORTS])
    filters = in_table(C.CLIENT_REPUTATION, C.REPORT_FILTERS)
    rest = rows.filter(~terminal).filter(~filters | F.coalesce(cell("Filter_name") != "srcip", F.lit(False)))
    kept = ["report", "table", "place", "cells"]
    return with_one_size(rest).select(*kept).unionByName(distinct_rows(rows.filter(terminal)).select(*kept))

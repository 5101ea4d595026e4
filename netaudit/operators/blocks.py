"""Sections and setting blocks in firewall configuration lines.

Input rows are ``file, chunk, pos, line``. Only lines that can matter are kept before any
shuffle, and all state between lines comes from :func:`ordered_scan`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from netaudit.functions.net import ip_to_number, number_to_ip
from netaudit.functions.text import config_value, remove_first, trim_blanks
from netaudit.operators.dropped import counted
from netaudit.operators.matchjoin import file_join
from netaudit.operators.scan import lines_since, ordered_scan
from netaudit.session import checkpointed
from netaudit.sources.lines import place

# Words of the DHCP section.
DHCP_START = "config system dhcp server"
SET_INTERFACE = "set interface "

# Words of the lines that the parsers of this module look at.
RELEVANT = [
    DHCP_START, SET_INTERFACE, "config reserved-address", "end", "set mac ", "set action block", "set description ",
    "set start-ip ", "set end-ip ", "edit ", "next", "set subnet", "set fqdn",
]


# Addresses of a part of a range that one row lists.
RANGE_PART = 1 << 16


def last_places(lines: DataFrame) -> DataFrame:
    """Place of the last line of each file: ``file, final``."""
    of_chunks = lines.groupBy("file", "chunk").agg(F.max("pos").alias("pos"))
    return of_chunks.groupBy("file").agg(F.max(place()).alias("final"))


def relevant_lines(lines: DataFrame) -> DataFrame:
    """Lines that can matter, written out once, with a blank one at the end of each file.

    State between lines takes several passes; they then read these lines, not the files. The
    blank line keeps the place of a file's last line.
    """
    wanted = lines.filter(F.col("line").rlike("|".join(RELEVANT))).select("file", "chunk", "pos", "line")
    finals = last_places(lines).select("file", "final.chunk", "final.pos", F.lit("").alias("line"))
    return checkpointed(wanted.unionByName(finals))


def section_bounds(lines: DataFrame, start: Column, end: Column) -> DataFrame:
    """Per file the last start line before the first end line that follows any start."""
    marks = lines.filter(start | end).select("file", "chunk", "pos", F.when(start, place()).alias("at"), end.alias("ends"))
    seen = ordered_scan(marks, ["file"], ["chunk"], "pos", carry={"begin": F.col("at")})
    return (
        seen.filter(F.col("ends") & F.col("begin").isNotNull())
        .groupBy("file")
        .agg(F.min_by("begin", place()).alias("begin"), F.min(place()).alias("finish"))
    )


def section(lines: DataFrame, start: Column, end: Column, keep: Column | None = None) -> DataFrame:
    """Lines of the section found by :func:`section_bounds`; files without one give none."""
    kept = lines if keep is None else lines.filter(keep)
    return (
        file_join(kept, section_bounds(lines, start, end))
        .filter(place().between(F.col("begin"), F.col("finish")))
        .drop("begin", "finish")
    )


def _has(word: str) -> Column:
    return F.contains("line", F.lit(word))


def _setting(word: str, key: str) -> Column:
    return F.when(_has(word), config_value(F.col("line"), key))


def blocked_macs(lines: DataFrame, per_entry: bool = False) -> DataFrame:
    """Reserved-address records: ``file, macAddress, action, description, interFace``.

    A record runs from ``config reserved-address`` to the next line that holds ``end``, as
    part of a word too; the last value of each setting counts, only ``block`` actions are
    taken, and a later record of the same MAC replaces an earlier one. With ``per_entry``
    each ``edit … next`` pair is a record of its own.
    """
    opens, closes = _has("config reserved-address"), _has("end")
    if per_entry:
        opens, closes = F.col("line").rlike(r"^\s*edit "), F.trim("line") == "next"
    sets = _has("set mac ") | _has("set action block") | _has("set description ")
    dhcp = section(
        lines,
        F.col("line") == DHCP_START,
        F.col("line") == "end",
        keep=opens | closes | sets | _has(SET_INTERFACE),
    )
    settings = checkpointed(dhcp.select(
        "file", "chunk", "pos", opens.alias("opens"), closes.alias("closes"),
        _setting(SET_INTERFACE, SET_INTERFACE).alias("set_interface"),
        _setting("set mac ", "set mac ").alias("macAddress"),
        _setting("set action block", "set action ").alias("action"),
        _setting("set description ", "set description ").alias("description"),
    ))
    state = ordered_scan(
        settings, ["file"], ["chunk"], "pos",
        carry={"interFace": F.col("set_interface")},
        carry_before={"was_open": F.when(F.col("closes"), False).when(F.col("opens"), True)},
    )
    is_open = F.col("opens") | F.coalesce("was_open", F.lit(False))
    state = state.filter(is_open).withColumn("closing", F.col("closes"))
    blocks = ordered_scan(state, ["file"], ["chunk"], "pos", total_before={"block": F.col("closing").cast("int")})

    def last_of(name: str) -> Column:
        return F.max_by(name, F.when(F.col(name).isNotNull() & ~F.col("closing"), place())).alias(name)

    records = (
        blocks.groupBy("file", "block")
        .agg(
            F.max("closing").alias("closed"),
            last_of("macAddress"),
            last_of("action"),
            last_of("description"),
            F.max_by("interFace", F.when(F.col("closing"), place())).alias("interFace"),
        )
    )
    records = counted(records, "blocks without MAC", F.col("closed") & F.col("macAddress").isNull()).filter("closed and macAddress is not null")
    if per_entry:
        records = records.filter("action is not null")
    fields = F.struct("action", "description", "interFace")
    return (
        records.groupBy("file", "macAddress")
        .agg(F.max_by(fields, "block").alias("r"))
        .select("file", "macAddress", "r.action", "r.description", "r.interFace")
    )


def dhcp_ranges(lines: DataFrame, all_ranges: bool = False) -> DataFrame:
    """Address ranges per interface: ``file, interface, lo, hi``.

    A range is complete when both a start and an end address are known, in either order;
    then both are forgotten. Only the last range of an interface is kept unless ``all_ranges``.

    Lines of one kind in a row form a run, and only the first line of a run can complete a
    range: if an address of the other kind still waits. After a run of two or more lines one
    does. After a run of a single line one does unless that line completed a range itself. So
    completions alternate along the runs since the last line that continued a run.
    """
    dhcp = section(
        lines,
        _has(DHCP_START),
        F.startswith("line", F.lit("end")),
        keep=_has(SET_INTERFACE) | _has("set start-ip ") | _has("set end-ip "),
    )
    kind = F.when(_has("set start-ip "), F.lit("start")).when(_has("set end-ip "), F.lit("end"))
    address = F.coalesce(_setting("set start-ip ", "set start-ip "), _setting("set end-ip ", "set end-ip "))
    settings = checkpointed(dhcp.select(
        "file", "chunk", "pos", kind.alias("kind"), address.alias("address"),
        _setting(SET_INTERFACE, SET_INTERFACE).alias("set_interface"),
    ))
    ends = ordered_scan(
        settings, ["file"], ["chunk"], "pos",
        carry={"interface": F.col("set_interface")},
        carry_before={"previous": F.when(F.col("kind").isNotNull(), F.struct("kind", "address"))},
    ).filter("kind is not null").withColumn("continues", F.expr("previous.kind <=> kind"))
    runs = ordered_scan(
        ends, ["file"], ["chunk"], "pos",
        since={"runs": lines_since(F.col("continues"))},
        total_before={"continued": F.col("continues").cast("int")},
    )
    completes = ~F.col("continues") & ((F.col("runs") % 2 == 0) == (F.col("continued") > 0))
    one, other = ip_to_number(F.col("previous.address")), ip_to_number(F.col("address"))
    found = (
        runs.filter(completes & F.col("interface").isNotNull())
        .select(
            "file", "interface", "chunk", "pos",
            F.least(one, other).alias("lo"), F.greatest(one, other).alias("hi"),
            (one + other).isNotNull().alias("valid"),
        )
    )
    found = counted(found, "ranges without addresses", ~F.col("valid")).filter("valid")
    if all_ranges:
        return found.select("file", "interface", "lo", "hi")
    return (
        found.groupBy("file", "interface")
        .agg(F.max_by(F.struct("lo", "hi"), place()).alias("r"))
        .select("file", "interface", "r.lo", "r.hi")
    )


def deny_list(lines: DataFrame) -> DataFrame:
    """Deny-list entries: ``file, ip, hostName, macAddress`` (the MAC is always null).

    An ``edit "Black<digits>…`` line opens an entry. Its ip is the last subnet or domain set
    on the lines up to and including the next one that holds ``next``. The last line of a
    file is never read, and subnets keep their mask text unless it is that of one address.
    """
    entry = F.col("line").rlike('edit "Black[0-9]+')
    closes = _has("next")
    subnet = trim_blanks(
        F.regexp_replace(remove_first(F.col("line"), "set subnet "), r"^(.*?) 255.255.255.255", "$1")
    )
    value = F.when(_has("set fqdn"), config_value(F.col("line"), "set fqdn ")).when(_has("set subnet"), subnet)

    marked = lines.filter(entry | closes | _has("set subnet") | _has("set fqdn"))
    kept = file_join(marked, last_places(lines))
    spans = ordered_scan(
        kept, ["file"], ["chunk"], "pos",
        total={"spans_through": closes.cast("int")}, total_before={"spans_before": closes.cast("int")},
    )
    read = F.when(place() < F.col("final"), value)
    settings = (
        spans.withColumnRenamed("spans_before", "span")
        .groupBy("file", "span")
        .agg(
            F.max_by(read, F.when(read.isNotNull(), place())).alias("ip"),
            F.max(F.when(read.isNotNull(), place())).alias("set_at"),
        )
        .filter("set_at is not null")
    )
    entries = spans.filter(entry).select(
        "file",
        F.col("spans_through").alias("span"),
        place().alias("edited_at"),
        F.translate(F.regexp_substr("line", F.lit('".*"')), '"', "").alias("hostName"),
    )
    return entries.join(settings, ["file", "span"], "left").select(
        "file",
        F.when(F.col("set_at") > F.col("edited_at"), F.col("ip")).alias("ip"),
        "hostName",
        F.lit(None).cast("string").alias("macAddress"),
    )


def deny_networks(denied: DataFrame) -> DataFrame:
    """Deny-list subnets as address ranges ``hostName, lo, hi`` instead of mask texts."""
    address, mask = F.split_part("ip", F.lit(" "), F.lit(1)), F.split_part("ip", F.lit(" "), F.lit(2))
    low = ip_to_number(address)
    size = F.when(mask == "", F.lit(1)).otherwise(F.lit(4294967296) - ip_to_number(mask))
    return denied.select("hostName", low.alias("lo"), (low + size - 1).alias("hi")).filter("lo is not null and hi is not null")


def range_addresses(ranges: DataFrame) -> DataFrame:
    """Every address of every range, for export; lookups use the bounds instead.

    A range is cut into parts of bounded size, which are dealt out before they are listed.
    """
    step = F.lit(RANGE_PART).cast("bigint")
    bounds = ranges.select("interface", F.least("lo", "hi").alias("lo"), F.greatest("lo", "hi").alias("hi"))
    parts = bounds.select("interface", "hi", F.explode(F.sequence("lo", "hi", step)).alias("first")).repartition("interface", "first")
    spread = parts.select("interface", F.explode(F.sequence("first", F.least("hi", F.col("first") + step - 1))).alias("n"))
    return spread.select("interface", number_to_ip(F.col("n")).alias("ip"))

"""The jobs a user runs, from input folders to output folders."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from netaudit.constants import BANDWIDTH_REPORT, XML_SINCE
from netaudit.functions.dates import previous_period, shift_period, trend_periods
from netaudit.functions.net import mac_search_key
from netaudit.functions.text import trim_blanks
from netaudit.operators.blocks import DHCP_START, blocked_macs, deny_list, dhcp_ranges, relevant_lines
from netaudit.operators.dropped import counted, counting
from netaudit.operators.matchjoin import mac_search
from netaudit.plans.devices import device_register
from netaudit.plans.identity import identity_relation, report_keys
from netaudit.plans.reports import check_destinations, enrich, shape
from netaudit.plans.review import (
    missing_periods,
    not_yet_converted,
    of_fiscal_year,
    produced_names,
    produced_periods,
    read_calendar,
    review_records,
)
from netaudit.plans.trend import chart_series, trend_of_csv, trend_of_xml, with_ranks
from netaudit.plans.vpn import marked_lines, vpn_local_ips, vpn_sessions
from netaudit.session import checkpointed, job_tables
from netaudit.sinks.namedfiles import write_documents
from netaudit.sinks.tables import (
    write_mac_matches,
    write_register,
    write_reports,
    write_review_records,
    write_trend,
)
from netaudit.sinks.versions import notes_of, publish, registers_of, versions, write_registers
from netaudit.sources.lines import base_name, decoded_name, read_lines, read_vpn_lines
from netaudit.sources.registers import (
    ALLOW_SCHEMA,
    ASSET_SCHEMA,
    DENY_SCHEMA,
    RANGE_SCHEMA,
    STATIC_SCHEMA,
    VPN_LOCAL_SCHEMA,
    VPN_SCHEMA,
    WHOIS_SCHEMA,
    allowed_domains,
    assets_in_use,
    network_register,
    read_leases,
    read_parameters,
    read_register,
    static_devices,
    valid_on,
)
from netaudit.sources.xmlreports import check_complete, dated_export, list_reports, read_reports, read_tables


def _folder(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def owns_tables(job):
    """Remove the intermediate tables of a job whose first argument is the session, once its output is written."""
    @wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        with job_tables(spark):
            return job(spark, *args, **kwargs)

    return run


def config_registers(lines: DataFrame, out: str) -> None:
    """Deny list, its export form, blocked MACs and DHCP ranges of a configuration, published together.

    A configuration without DHCP section is an error; the snapshots then stay as they are.
    Blocked MACs are exported only if there are any. ``config_dropped`` counts what had no result.
    """
    spark = lines.sparkSession
    with job_tables(spark), counting() as dropped:
        if lines.filter(F.contains("line", F.lit(DHCP_START))).isEmpty():
            raise ValueError(f"the configuration has no section '{DHCP_START}'")
        lines = relevant_lines(lines)
        denied = deny_list(lines).drop("file")
        registers = {"deny_list": denied, "deny_list_export": denied_export(denied), "dhcp_ranges": dhcp_ranges(lines).drop("file")}
        blocked = checkpointed(blocked_macs(lines).drop("file"))
        if not blocked.isEmpty():
            registers["blocked_macs"] = blocked
        write_registers(spark, out, registers, then=lambda: {"config_dropped": dropped.table(spark)})


def denied_export(denied: DataFrame) -> DataFrame:
    return denied.select(F.col("ip").alias("IP"), F.col("hostName").alias("Description"))


@owns_tables
def vpn_registers(spark: SparkSession, logs: str, yyyymm: str | None, out: str, today: date | None = None) -> None:
    """VPN sessions and VPN-local addresses of a month, the last one unless given; its neighbours' files are read too."""
    yyyymm = yyyymm or previous_period(today or date.today())
    periods = [yyyymm, shift_period(yyyymm, -1), shift_period(yyyymm, 1)]
    lines = marked_lines(read_vpn_lines(spark, logs, periods))
    month = int(yyyymm[4:])
    write_registers(spark, out, {"vpn": vpn_sessions(lines, month), "vpn_local": vpn_local_ips(lines, month)})


def refresh_registers(registers: dict[str, DataFrame], users: str, today: date, out: str) -> int:
    """Write all registers and publish them as one version, whose number is given; of the user register only the rows still valid."""
    spark = registers[users].sparkSession
    return write_registers(spark, out, {n: valid_on(r, today) if n == users else r for n, r in registers.items()})


def audit_reports(
    rows: DataFrame, devices: DataFrame, ranges: DataFrame, networks: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Identity relation and the enriched, shaped report rows of a month.

    The relation is read by several joins, so it is written out once.
    """
    identities = checkpointed(identity_relation(report_keys(rows), devices, ranges, networks))
    return identities, shape(enrich(rows, identities))


@owns_tables
def monthly_audit(
    spark: SparkSession, reports: str, ext: str, yyyymm: str | None, own_label: str, out: str,
    version: int | None = None, today: date | None = None,
) -> None:
    """Annotate the reports of a folder and write them under ``out``, as those of the last month unless one is given.

    Files that are none of the seven reports are left out. Destinations that lack a required
    column or a size are an error.

    ``ext`` holds the snapshots of :func:`config_registers`, :func:`vpn_registers` and
    :func:`refresh_registers`, all of the one last version or of ``version``, the lease files
    (``dhcp``) and the parameter register (``parameters``).
    """
    yyyymm = yyyymm or previous_period(today or date.today())
    if version is None:
        version = next(reversed(versions(spark, ext)), None)

    def register(name: str, schema: str) -> DataFrame:
        return read_register(spark, _folder(ext, name), schema, version=version)

    check_complete(list_reports(spark, reports))
    devices = device_register(
        static_devices(register("static", STATIC_SCHEMA)),
        read_leases(spark, _folder(ext, "dhcp")),
        register("deny_list", DENY_SCHEMA),
        allowed_domains(register("allow_list", ALLOW_SCHEMA)),
        assets_in_use(register("assets", ASSET_SCHEMA)),
        register("vpn", VPN_SCHEMA).drop("seq"),
        register("vpn_local", VPN_LOCAL_SCHEMA).drop("seq"),
    )
    networks = network_register(
        register("whois", WHOIS_SCHEMA), read_parameters(spark, _folder(ext, "parameters"), version), own_label
    )
    ranges = register("dhcp_ranges", RANGE_SCHEMA).drop("seq")
    rows = read_reports(spark, reports).select("report", "table", "place", "cells")
    rows = checkpointed(rows, by=["report", "table"])
    with counting() as dropped:
        _, shaped = audit_reports(rows, devices, ranges, networks)
        check_destinations(shaped)
        write_reports(shaped, yyyymm, _folder(out, "reports"))
        write_register(dropped.table(spark), _folder(out, f"dropped-{yyyymm}"))


# Fixed value: folder of a month's reports below the common root.
MONTH_FOLDER = "UTM Logs {}/input"


TREND_SCHEMA = "application string, size string, bandwidth double, yyyymm string, month string"


def _month(file: str = "file") -> Column:
    return F.regexp_extract(file, MONTH_FOLDER.format("([0-9]{6})"), 1)


def month_fingerprints(spark: SparkSession, root: str, periods: list[str], xml_since: str) -> dict[str, str]:
    """By month what its report files are, from names, sizes and times of change, and which reader takes them. No file is opened."""
    folders = [_folder(root, MONTH_FOLDER.format(p)) for p in periods]
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"{BANDWIDTH_REPORT}-*").load(folders)
    file = decoded_name(F.col("path"))
    listed = files.filter(file.rlike(dated_export(BANDWIDTH_REPORT))).select(file.alias("file"), "length", F.unix_micros("modificationTime").alias("changed"))
    each = F.array_sort(F.collect_list(F.concat_ws("|", base_name(F.col("file")), "length", "changed")))  # a month's files are few
    found = listed.groupBy(_month().alias("yyyymm")).agg(F.sha2(F.concat_ws("/", each), 256).alias("files"))
    prints = {r.yyyymm: r.files for r in found.collect()}
    return {p: f"{prints.get(p)} {'csv' if p < xml_since else 'xml'}" for p in periods}


def trend_rows(spark: SparkSession, root: str, periods: list[str], xml_since: str) -> DataFrame:
    """Trend rows of the bandwidth reports of some months, each by the reader it takes."""
    glob = f"{BANDWIDTH_REPORT}-*"
    parts = []
    for reader, months in (
        ("csv", [p for p in periods if p < xml_since]),
        ("xml", [p for p in periods if p >= xml_since]),
    ):
        folders = [_folder(root, MONTH_FOLDER.format(p)) for p in months]
        if folders and reader == "csv":
            parts.append(trend_of_csv(read_lines(spark, folders, glob, dated_export(BANDWIDTH_REPORT)), _month()))
        elif folders:
            rows = read_tables(spark, folders, glob=glob)
            rows = rows.filter(F.col("file").rlike(dated_export(BANDWIDTH_REPORT)))
            parts.append(trend_of_xml(rows.withColumn("yyyymm", _month())))
    return reduce(DataFrame.unionByName, parts)


def update_months(spark: SparkSession, root: str, periods: list[str], state: str, xml_since: str) -> list[str]:
    """Read the months whose files are not those that the state was made from, publish their rows together, and name them."""
    prints, known = month_fingerprints(spark, root, periods, xml_since), notes_of(spark, state)
    changed = [p for p in periods if known.get(p) != prints[p]]
    if changed:
        folder = f"v-{uuid.uuid4().hex}"
        rows = trend_rows(spark, root, changed, xml_since).withColumn("month", F.col("yyyymm"))
        rows.write.partitionBy("month").parquet(_folder(state, folder))
        publish(spark, state, dict.fromkeys(changed, folder), {p: prints[p] for p in changed})
    return changed


def stored_months(spark: SparkSession, state: str, periods: list[str]) -> DataFrame:
    """Trend rows of the months of the state; a month's rows are in the version that read it last."""
    folders = registers_of(spark, state)
    parts = []
    for folder in sorted({folders[p] for p in periods}):
        own = [p for p in periods if folders[p] == folder]
        rows = spark.read.schema(TREND_SCHEMA).parquet(_folder(state, folder))
        parts.append(rows.filter(F.col("month").isin(own)).drop("month"))
    return reduce(DataFrame.unionByName, parts)


@owns_tables
def bandwidth_report(
    spark: SparkSession, root: str, yyyymm: str | None, out: str, xml_since: str = XML_SINCE, today: date | None = None
) -> list[str]:
    """Write the thirteen-month trend of the bandwidth reports and its chart series, up to the last month unless one is given.

    The rows of each month are kept below ``out``; only months that are new or whose files have
    changed are read, and named in the result. Counts and series are made from the kept rows.
    """
    yyyymm = yyyymm or previous_period(today or date.today())
    periods, state = trend_periods(yyyymm), _folder(out, "months")
    changed = update_months(spark, root, periods, state, xml_since)
    stored = stored_months(spark, state, periods)
    with counting() as dropped:
        trend = checkpointed(counted(stored, "sizes in other units", F.col("size").isNotNull() & F.col("bandwidth").isNull()))
        write_trend(with_ranks(trend), chart_series(trend), yyyymm, out)
        write_register(dropped.table(spark), _folder(out, f"dropped-{yyyymm}"))
    return changed


@owns_tables
def missing_reviews(
    spark: SparkSession, calendar: str, records: str, header: str, today: date,
    creator: str, approver: str, participants: str, out: str,
) -> None:
    """Write a review record for every period of the fiscal year that has none."""
    due = of_fiscal_year(read_calendar(spark, calendar), today)
    missing = missing_periods(due, produced_periods(spark, records, header))
    write_review_records(review_records(missing, creator, approver, participants), header, out)


@owns_tables
def convert_records(spark: SparkSession, sources: str, out: str, extension: str, convert: Callable[[Column], Column]) -> int:
    """Convert the documents of a folder that have no output yet, by a function of their text; how many there were.

    An output has the name of its document with another extension.
    """
    named = F.regexp_replace("name", r"\.[^.]*$", "")
    waiting = not_yet_converted(
        produced_names(spark, sources).select("name", named.alias("stem")),
        produced_names(spark, out).filter(F.endswith("name", F.lit(extension))).select(named.alias("stem")), "stem",
    )
    texts = spark.read.text(sources, wholetext=True).select(base_name(decoded_name(F.col("_metadata.file_path"))).alias("name"), "value")
    made = checkpointed(texts.join(waiting, "name").select(F.concat("stem", F.lit(extension)).alias("name"), convert(F.col("value")).alias("text")))
    write_documents(made, out)
    return made.count()


@owns_tables
def write_mac_search(spark: SparkSession, mac_list: str, tables: str, out: str) -> None:
    """Write the lines of the switch tables that hold a listed MAC, with an index of the MACs."""
    # Ranges are sampled from the matches before they are written; the join runs once.
    write_mac_matches(checkpointed(mac_matches(spark, mac_list, tables)), out)


def mac_matches(spark: SparkSession, mac_list: str, tables: str) -> DataFrame:
    """Lines of the switch tables that hold a listed MAC: ``mac, file, line``."""
    macs = spark.read.text(mac_list).select(mac_search_key(trim_blanks(F.col("value"))).alias("mac"))
    found = mac_search(read_lines(spark, tables, glob="*.txt"), macs)
    return found.withColumn("file", base_name(F.col("file")))

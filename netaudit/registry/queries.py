"""Registered queries: each runs one operator or job over inputs derived from the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from netaudit import constants as C
from netaudit.functions import dates, net, text as tx
from netaudit.operators import blocks, matchjoin, shaping
from netaudit.plans import devices, identity, jobs, reports, review, trend, vpn
from netaudit.registry import inputs
from netaudit.registry.inputs import ip10, mac_of, table
from netaudit.sources import lines, registers, xmlreports

# Fixed values of the registered runs.
TODAY = date(1998, 6, 15)
TREND_PERIOD = "199907"
XML_SINCE = "199901"
APPROVER, CREATOR, PARTICIPANTS = "Yamada Taro", "Suzuki", "Sato、Tanaka"

IDENTITY = registers.DEVICE_COLUMNS


def long_cells(rows: DataFrame, *by: str) -> DataFrame:
    return rows.select(*by, F.explode("cells").alias("column_name", "value"))


def extract_ips(spark, sf):
    found = table(spark, sf, "documents").select(
        "doc_id",
        net.extract_ip(F.col("text"), anywhere=True).alias("ip"),
        net.extract_ip(F.col("text")).alias("ip_at_end"),
    )
    return found.filter("ip is not null or ip_at_end is not null")


def extract_domains(spark, sf):
    domains = table(spark, sf, "pages").select(net.extract_domain(F.col("url")).alias("domain"))
    return domains.groupBy("domain").agg(F.count("*").alias("pages"))


def report_keys(spark, sf):
    return identity.report_keys(inputs.report_rows(spark, sf))


def report_keys_anywhere(spark, sf):
    return identity.report_keys(inputs.report_rows(spark, sf), anywhere=True)


def ip_number_roundtrip(spark, sf):
    ip = ip10(F.col("c_custkey") * 16)
    rows = table(spark, sf, "customer").select("c_custkey", ip.alias("ip"))
    number = net.ip_to_number(F.col("ip"))
    return rows.select(
        "c_custkey", "ip", number.alias("number"), net.number_to_ip(number).alias("back"),
        net.first_octet(F.col("ip")).alias("octet"),
    )


def network_bounds(spark, sf):
    cidr = F.col("cidr")
    return inputs.network_entries(spark, sf).select(
        "User", "cidr", net.network_low(cidr).alias("lo"), net.network_high(cidr).alias("hi")
    )


def malformed_networks(spark, sf):
    return matchjoin.invalid_networks(inputs.network_entries(spark, sf)).select("User", "cidr")


def range_expand(spark, sf):
    return blocks.range_addresses(inputs.lan_ranges(spark, sf))


def range_lookup(spark, sf):
    ips = table(spark, sf, "customer").select(ip10(F.col("c_custkey")).alias("ip")).distinct()
    return matchjoin.range_hits(ips, inputs.lan_ranges(spark, sf), ["interface"])


def cidr_first_match(spark, sf):
    ips = table(spark, sf, "documents").select(net.extract_ip(F.col("text"), anywhere=True).alias("ip")).distinct()
    found = matchjoin.first_network_match(ips, inputs.network_entries(spark, sf), "seq", "User")
    return found.withColumnRenamed("User", "hostName")


def lease_identities(spark, sf) -> DataFrame:
    """One identity per lease; every fifth has neither host nor MAC, user only where even."""
    leases = inputs.leases(spark, sf)
    number = net.ip_to_number(F.col("ip"))
    known = number % 5 != 0
    return leases.select(
        "ip",
        F.when(known, F.col("hostName")).alias("hostName"),
        F.when(known & (number % 2 == 0), F.concat(F.lit("u-"), F.col("ip"))).alias("user"),
        F.lit(None).cast("string").alias("description"),
        F.when(known, F.col("macAddress")).alias("macAddress"),
    )


def dhcp_released(spark, sf):
    released = identity.with_released(lease_identities(spark, sf), inputs.lan_ranges(spark, sf))
    return identity.with_unregistered(released).select(*IDENTITY)


def network_override(spark, sf):
    known = lease_identities(spark, sf)
    found = identity.nameless_networks(known, inputs.network_entries(spark, sf))
    return identity.with_network_hosts(known, found)


def suffix_match(spark, sf, literal: bool):
    domains = table(spark, sf, "pages").select(inputs.page_domain().alias("ip")).distinct()
    allowed = registers.allowed_domains(inputs.allow_register(spark, sf))
    register = devices.first_per_ip(devices.with_device_columns(allowed, "seq"))
    return identity.domain_identities(domains, register, literal).select("ip", "hostName")


def domain_suffix_first_match(spark, sf):
    return suffix_match(spark, sf, literal=False)


def domain_suffix_literal(spark, sf):
    return suffix_match(spark, sf, literal=True)


def prefix_match(spark, sf, literal: bool):
    hosts = inputs.leases(spark, sf).select(F.lower("hostName").alias("host"))
    assets = registers.assets_in_use(inputs.assets_register(spark, sf))
    found = matchjoin.first_prefix_match(hosts, "host", assets, "key", "seq", ["user", "description"], literal)
    return found.select("host", "match.user", "match.description")


def host_prefix_first_match(spark, sf):
    return prefix_match(spark, sf, literal=False)


def host_prefix_literal(spark, sf):
    return prefix_match(spark, sf, literal=True)


def domain_pattern_first_match(spark, sf):
    register = inputs.domain_patterns(spark, sf)
    return matchjoin.first_suffix_match(inputs.pattern_domains(spark, sf), "domain", register, "pattern", "seq", ["owner"]).select("domain", "match.owner")


def host_pattern_first_match(spark, sf):
    assets = inputs.pattern_assets(spark, sf)
    return matchjoin.first_prefix_match(inputs.host_patterns(spark, sf), "host", assets, "key", "seq", ["user"]).select("host", "match.user")


def invalid_patterns(spark, sf):
    keys = inputs.domain_patterns(spark, sf).select("pattern").unionByName(inputs.host_patterns(spark, sf).select(F.col("host").alias("pattern")))
    return matchjoin.invalid_patterns(keys, "pattern")


def host_owner(spark, sf):
    leases = devices.with_device_columns(inputs.leases(spark, sf))
    return devices.with_owners(leases, registers.assets_in_use(inputs.assets_register(spark, sf)))


def all_registers(spark, sf) -> DataFrame:
    return devices.union_registers(
        registers.static_devices(inputs.static_register(spark, sf)),
        inputs.leases(spark, sf),
        inputs.denied_register(spark, sf),
        registers.allowed_domains(inputs.allow_register(spark, sf)),
    )


def device_priority_dedupe(spark, sf):
    return devices.first_per_ip(all_registers(spark, sf))


def device_register(spark, sf):
    return devices.device_register(
        registers.static_devices(inputs.static_register(spark, sf)),
        inputs.leases(spark, sf),
        inputs.denied_register(spark, sf),
        registers.allowed_domains(inputs.allow_register(spark, sf)),
        registers.assets_in_use(inputs.assets_register(spark, sf)),
        inputs.vpn_pairs(spark, sf),
        inputs.vpn_local(spark, sf),
    )


def identity_relation(spark, sf):
    return identity.identity_relation(
        identity.report_keys(inputs.report_rows(spark, sf)),
        device_register(spark, sf),
        inputs.lan_ranges(spark, sf),
        inputs.network_entries(spark, sf),
    )


def config_deny_list(spark, sf):
    return blocks.deny_list(blocks.relevant_lines(inputs.config_lines(spark, sf)))


def config_blocked_macs(spark, sf):
    return blocks.blocked_macs(blocks.relevant_lines(inputs.config_lines(spark, sf)))


def config_dhcp_ranges(spark, sf):
    return blocks.dhcp_ranges(blocks.relevant_lines(inputs.config_lines(spark, sf)))


def config_blocked_macs_per_entry(spark, sf):
    return blocks.blocked_macs(blocks.relevant_lines(inputs.config_lines(spark, sf)), per_entry=True)


def config_dhcp_all_ranges(spark, sf):
    return blocks.dhcp_ranges(blocks.relevant_lines(inputs.config_lines(spark, sf)), all_ranges=True)


def deny_networks(spark, sf):
    return blocks.deny_networks(config_deny_list(spark, sf))


def network_span(spark, sf):
    """Addresses all over the space in networks shorter than /8, taken whole."""
    ips = table(spark, sf, "customer").select(net.number_to_ip(F.pmod(F.col("c_custkey") * 104729 * 40503, F.lit(2**32))).alias("ip"))
    return matchjoin.first_network_match(ips.distinct(), inputs.short_networks(spark, sf), "seq", "User", span=True)


def plain_device_enrichment(spark, sf):
    """The device table and the tables of risen scores and of destinations, read by their own columns."""
    rows = inputs.device_rows(spark, sf)
    # Every second address has an identity.
    identities = table(spark, sf, "customer").select(
        ip10(F.col("c_custkey") * 2).alias("ip"), F.col("c_name").alias("hostName"), *[F.lit(None).cast("string").alias(c) for c in ("user", "description", "macAddress")]
    )
    found = reports.enrich(rows, identities)
    return long_cells(found.withColumnRenamed("table", "table_name"), "report", "table_name", "place")


def lease_layout(spark, sf):
    return registers.leases_of_cells(inputs.lease_cells(spark, sf)).drop("seq")


def vpn_sessions(spark, sf):
    return vpn.vpn_sessions(inputs.vpn_lines(spark, sf), 1)


def vpn_sessions_chronological(spark, sf):
    return vpn.vpn_sessions(inputs.vpn_lines(spark, sf), 1, chronological=True)


def vpn_local_ips(spark, sf):
    return vpn.vpn_local_ips(inputs.vpn_lines(spark, sf), 1)


def xml_tables(spark, sf):
    schema = xmlreports.table_schema({"Dev": True, "IP": False, "Note": False}, own=["Total", "Unit"])
    rows = xmlreports.rows_of_xml_column(inputs.xml_tables(spark, sf), "xml", schema, "at")
    return long_cells(rows.select("table", F.col("place.at").alias("c_custkey"), F.col("place.row").alias("row"), "cells"),
                      "table", "c_custkey", "row").withColumnRenamed("table", "table_name")


def xml_user_sections(spark, sf):
    schema = xmlreports.section_schema(xmlreports.table_schema({"Destination": False, "Hits": False}, own=["Total"]))
    rows = xmlreports.rows_of_xml_column(inputs.xml_sections(spark, sf), "xml", schema, "at", C.USER_SECTION)
    rows = rows.select(F.col("table").alias("table_name"), F.col("place.at.at").alias("page_id"), F.col("place.row").alias("row"), "cells")
    return long_cells(rows, "table_name", "page_id", "row")


def enriched(spark, sf) -> DataFrame:
    return reports.enrich(inputs.report_rows(spark, sf), jobs.checkpointed(identity_relation(spark, sf)))


def report_enrichment(spark, sf):
    rows = reports.shape(enriched(spark, sf))
    return long_cells(rows.withColumnRenamed("table", "table_name"), "report", "table_name", "place")


def distinct_terminals(spark, sf):
    rows = inputs.report_rows(spark, sf)
    terminals = rows.filter(F.col("report").isin(reports.TERMINAL_REPORTS))
    distinct = reports.distinct_rows(terminals)
    return distinct.select("report", "place", reports.cell("User_or_IP_").alias("ip"))


def drop_null_columns(spark, sf):
    orders = table(spark, sf, "orders")
    return shaping.drop_null_columns(orders.select(
        "o_orderkey",
        F.lit(None).cast("string").alias("never"),
        F.when(F.col("o_orderkey") % 97 == 0, F.col("o_orderstatus")).alias("sometimes"),
        F.when(F.col("o_orderkey") < 0, 1).alias("impossible"),
    ))


def section_keys(spark, sf):
    section = reports.cell("rank")
    visits = inputs.report_rows(spark, sf).filter(reports.in_table(C.USER_REPORT, xmlreports.TOP10_DESTINATIONS))
    return visits.select(
        "place",
        net.extract_ip(section, anywhere=True).alias("ip"),
        reports.section_usage(section).alias("usage"),
        reports.section_rank(section).alias("rank"),
    )


def csv_section(spark, sf):
    report = inputs.csv_report_lines(inputs.monthly_applications(spark, sf))
    return lines.csv_section(
        report, f"###{C.TOP_APPLICATIONS}###", 30, ["position", "application", "size", "sessions"]
    )


def size_to_mb(spark, sf):
    monthly = inputs.monthly_applications(spark, sf).select("yyyymm", "application", F.translate("size", ",", "").alias("size"))
    other = F.when(F.col("application") == "SSH", F.translate("size", "MGT", "KKK")).otherwise(F.col("size"))
    return monthly.select("yyyymm", "application", other.alias("size"), tx.size_to_mb(other).alias("mb"))


def trend_rows(spark, sf, wanted: Column) -> DataFrame:
    """Trend rows of the wanted months, by the reader each month takes."""
    monthly = jobs.checkpointed(inputs.monthly_applications(spark, sf).filter(wanted))
    old = monthly.filter(trend.reader_of(F.col("yyyymm"), XML_SINCE) == "csv")
    new = monthly.filter(trend.reader_of(F.col("yyyymm"), XML_SINCE) == "xml")
    schema = xmlreports.table_schema({n: False for n in ["Summary", "Statistics", "Application", "Bytes", "Sessions"]})
    xml = xmlreports.rows_of_xml_column(inputs.xml_report_column(new), "xml", schema, "at")
    rows = trend.trend_of_csv(inputs.csv_report_lines(old), F.col("file")).unionByName(trend.trend_of_xml(xml))
    return jobs.checkpointed(rows)


def bandwidth_trend(spark, sf):
    return trend.with_ranks(trend_rows(spark, sf, trend.in_window(F.col("yyyymm"), TREND_PERIOD)))


def bandwidth_trend_all(spark, sf):
    return trend.with_ranks(trend_rows(spark, sf, F.lit(True)))


def chart_series(spark, sf):
    series = trend.chart_series(trend_rows(spark, sf, F.lit(True)))
    return series.withColumn("bandwidth", F.round("bandwidth", 6))


def fiscal_year(spark, sf):
    period = F.concat(F.year("o_orderdate").cast("string"), F.lit("年"), F.month("o_orderdate").cast("string"), F.lit("月"))
    years = table(spark, sf, "orders").select(dates.fiscal_year(period).alias("fiscal_year"))
    return years.groupBy("fiscal_year").agg(F.count("*").alias("orders"))


def review_calendar_of_year(spark, sf):
    return review.of_fiscal_year(inputs.calendar(spark, sf), TODAY)


def missing_periods(spark, sf):
    return review.missing_periods(inputs.calendar(spark, sf), inputs.produced(spark, sf))


def review_text(spark, sf):
    return review.review_records(missing_periods(spark, sf), CREATOR, APPROVER, PARTICIPANTS)


def month_arithmetic(spark, sf):
    yyyymm = inputs.month_of_order()
    months = table(spark, sf, "orders").select(yyyymm.alias("yyyymm")).groupBy("yyyymm").agg(F.count("*").alias("orders"))
    month = F.col("yyyymm")
    return months.select(
        "yyyymm", "orders",
        dates.shift_period_column(month, -1).alias("previous"),
        dates.shift_period_column(month, 1).alias("next"),
        trend.in_window(month, TREND_PERIOD).alias("in_window"),
    )


def weekdays(spark, sf):
    """Weekdays of the order dates, of every second one a day later by number, which some months do not have."""
    day = F.col("o_orderdate")
    number = F.dayofmonth(day) + F.col("o_orderkey") % 2
    name = dates.japanese_weekday(F.year(day).cast("string"), F.month(day).cast("string"), number.cast("string"))
    return table(spark, sf, "orders").select(name.alias("weekday")).groupBy("weekday").agg(F.count("*").alias("orders"))


def month_numbers(spark, sf):
    month = dates.month_number(F.date_format("o_orderdate", "MMM"))
    return table(spark, sf, "orders").select(month.alias("month")).groupBy("month").agg(F.count("*").alias("orders"))


def valid_registrations(spark, sf):
    return registers.valid_on(inputs.user_register(spark, sf), TODAY).select("o_orderkey", "o_custkey")


def mac_search(spark, sf):
    macs = table(spark, sf, "customer").select(net.mac_search_key(mac_of(F.col("c_custkey"))).alias("mac"))
    return matchjoin.mac_search(inputs.switch_lines(spark, sf), macs)


def deny_export(spark, sf):
    return jobs.denied_export(inputs.denied_register(spark, sf))


QUERIES = {
    f.__name__: f
    for f in [
        extract_ips, extract_domains, report_keys, report_keys_anywhere, ip_number_roundtrip, network_bounds,
        malformed_networks, range_expand, range_lookup, cidr_first_match, dhcp_released, network_override,
        domain_suffix_first_match, domain_suffix_literal, host_prefix_first_match, host_prefix_literal, host_owner,
        domain_pattern_first_match, host_pattern_first_match, invalid_patterns,
        device_priority_dedupe, device_register, config_deny_list, config_blocked_macs, config_dhcp_ranges,
        config_blocked_macs_per_entry, config_dhcp_all_ranges, deny_networks, network_span, plain_device_enrichment,
        lease_layout, vpn_sessions, vpn_sessions_chronological, vpn_local_ips, xml_tables, xml_user_sections,
        report_enrichment, distinct_terminals, drop_null_columns, section_keys, csv_section, size_to_mb,
        bandwidth_trend, bandwidth_trend_all, chart_series, fiscal_year, review_calendar_of_year, missing_periods,
        review_text, month_arithmetic, weekdays, month_numbers, valid_registrations, mac_search, deny_export,
    ]
} | {"identity": identity_relation}

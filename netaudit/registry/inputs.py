"""Inputs of the audit jobs, derived by Spark from the given tables.

Each function takes the session and the folder of the tables. The shapes are those of
``FIXTURES.md``; all of them grow with the tables they come from.
"""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from netaudit import constants as C
from netaudit.functions.net import extract_domain, extract_ip, number_to_ip
from netaudit.operators.matchjoin import ADDRESS_BITS
from netaudit.plans import reports
from netaudit.sources.lines import lines_of_table
from netaudit.sources.registers import sequence
from netaudit.sources.xmlreports import TOP10_DESTINATIONS

TEN = 10 << (ADDRESS_BITS - 8)


_tables: WeakKeyDictionary[SparkSession, dict[str, DataFrame]] = WeakKeyDictionary()


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table; its files are listed once per session."""
    path = f"{sf}/{name}.parquet"
    known = _tables.setdefault(spark, {})
    if path not in known:
        known[path] = spark.read.parquet(path)
    return known[path]


def ip10(number: Column) -> Column:
    """Address of a key inside 10.0.0.0/8."""
    return number_to_ip(F.lit(TEN).cast("bigint") + F.pmod(number.cast("bigint"), F.lit(1 << 24)))


def mac_of(key: Column) -> Column:
    digits = F.lpad(key.cast("string"), 12, "0")
    return F.concat_ws(":", *[F.substring(digits, i, 2) for i in range(1, 13, 2)])


def text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def host_of(key: Column) -> Column:
    return (
        F.when(key % 7 == 0, "")
        .when(key % 3 == 1, None)
        .when(key % 13 == 0, text("pc.", key % 50))
        .otherwise(text("pc-", key))
    )


def at(pos: Column, file: str = "") -> Column:
    return sequence(0, F.lit(file), F.lit(0), pos).alias("seq")


def leases(spark, sf) -> DataFrame:
    key = F.col("c_custkey")
    host = F.when(host_of(key) == "", C.BLANK_HOST).otherwise(host_of(key))
    return table(spark, sf, "customer").select(
        ip10(key).alias("ip"), mac_of(key).alias("macAddress"), host.alias("hostName"), at(key)
    )


def lease_cells(spark, sf) -> DataFrame:
    """Cells of lease files, one file per nation; a third of the files each have layout one, two or none."""
    key, layout = F.col("c_custkey"), F.col("c_nationkey") % 3
    ip = F.when(key % 17 == 0, "reserved").otherwise(text(" ", ip10(key), " "))
    host = F.coalesce(host_of(key), F.lit(""))
    cells = (
        F.when(layout == 0, F.array(ip, F.lit("-"), mac_of(key), host))
        .when(layout == 1, F.array(ip, mac_of(key), text(host, " lease ", key)))
        .otherwise(F.array(ip, F.lit("x"), F.lit("y")))
    )
    return table(spark, sf, "customer").select(
        text("dhcp-", F.col("c_nationkey")).alias("file"),
        F.floor(key / 1000).alias("chunk"), key.alias("pos"), cells.alias("cells"),
    )


def assets_register(spark, sf) -> DataFrame:
    key = F.col("s_suppkey")
    number = F.when(key % 4 == 3, key - 1).otherwise(key)
    name = text("PC-", number, F.when(number % 2 == 1, "-NB").otherwise(""))
    return table(spark, sf, "supplier").select(
        F.when(key % 17 != 5, F.col("s_name")).alias("使用者名"),
        F.when(key % 3 != 1, name).alias("コンピュータ名"),
        text("NATION_", F.col("s_nationkey")).alias("部署名"),
        F.when(key % 10 == 0, "2020-01-01").alias("廃棄日"),
        at(key),
    )


def static_register(spark, sf) -> DataFrame:
    key = F.col("s_suppkey")
    host = F.when(key % 9 == 0, C.DHCP_MARKERS[0]).when(key % 10 != 1, text("srv-", key))
    return table(spark, sf, "supplier").select(
        ip10(key * 3).alias("IPアドレス"),
        host.alias("ホスト名"),
        text("NATION_", F.col("s_nationkey")).alias("設置場所"),
        F.when(key % 2 == 0, F.col("s_name")).alias("管理者"),
        F.when(key % 3 == 0, text("purpose-", key % 5)).alias("用途"),
        at(key),
    )


def denied_register(spark, sf) -> DataFrame:
    key = F.col("s_suppkey")
    ip = F.when(key % 2 == 0, ip10(key * 5 + 1)).when(key % 8 != 7, text("bad", key, ".example.net"))
    return table(spark, sf, "supplier").select(ip.alias("ip"), text("Black", key).alias("hostName"), at(key))


def page_domain() -> Column:
    return extract_domain(F.col("url"))


def allow_register(spark, sf) -> DataFrame:
    """Two domains per page: one that ends it, dashes as dots, and one that starts inside a label."""
    domain = page_domain()
    parent = F.translate(F.regexp_replace(domain, "^[a-z]+[.]", ""), "-", ".")
    entries = F.posexplode(F.array(parent, domain.substr(F.lit(4), F.length(domain)))).alias("which", "domain")
    return table(spark, sf, "pages").select("page_id", entries).select(
        "domain",
        text("allow-", F.col("page_id")).alias("Description1"),
        at(F.col("page_id") * 2 + F.col("which")),
    )


def network_entries(spark, sf) -> DataFrame:
    """Networks in search order: /24 of suppliers, some malformed, then /9 and /8 of nations."""
    key = F.col("s_suppkey")
    last = F.when(key % 6 == 5, ".1/24").otherwise(".0/24")
    sites = table(spark, sf, "supplier").select(
        text("site-", key).alias("User"), text("10.0.", key % 256, last).alias("cidr"), at(key, "a")
    )
    octets = table(spark, sf, "nation").select("n_name", F.explode(F.sequence(F.lit(1), F.lit(255))).alias("octet"), "n_nationkey")
    octets = octets.filter(F.col("octet") % 25 == F.col("n_nationkey"))
    halves = octets.select("n_name", "octet", F.explode(F.array(F.lit(9), F.lit(8))).alias("bits"))
    nations = halves.filter((F.col("bits") == 8) | (F.col("octet") % 2 == 0)).select(
        text(F.col("n_name"), "/", F.col("bits")).alias("User"),
        text(F.col("octet"), ".0.0.0/", F.col("bits")).alias("cidr"),
        at(F.col("octet") * 2 + F.col("bits") - 9, "b"),
    )
    return sites.unionByName(nations)


def short_networks(spark, sf) -> DataFrame:
    """Networks of four and six bits; the first of two that overlap is the longer one in every second pair."""
    key = F.col("n_nationkey")
    bits = F.when(key % 2 == 0, 4).otherwise(6)
    return table(spark, sf, "nation").select(
        text("wide-", key).alias("User"), text(F.pmod(F.floor(key / 2), F.lit(13)) * 16, ".0.0.0/", bits).alias("cidr"), at(F.pmod(key * 7, F.lit(25)))
    )


def device_rows(spark, sf) -> DataFrame:
    """Rows of the device table with its plain column, of risen scores and of destinations."""
    key = F.col("c_custkey")
    names = [reports.DEVICE.table, " 直近2期間にスコアが増加した上位ユーザー", "Top 30 Destination by Bandwidth and Sessions"]
    cell_names = ["Device", "User__or_IP_", "Hostname_or_IP_"]
    report = F.when(key % 3 == 2, C.BANDWIDTH_REPORT).otherwise(C.CLIENT_REPUTATION)
    return table(spark, sf, "customer").select(
        report.alias("report"), by_rest(key, names).alias("table"), key.alias("place"), F.create_map(by_rest(key, cell_names), ip10(key)).alias("cells")
    )


def lan_ranges(spark, sf) -> DataFrame:
    """Two overlapping address ranges per supplier."""
    key = F.col("s_suppkey")
    spans = F.array(
        F.struct(text("lan", key).alias("interface"), (TEN + key * 20).alias("lo"), (TEN + key * 20 + 14).alias("hi")),
        F.struct(text("wifi", key).alias("interface"), (TEN + key * 20 + 10).alias("lo"), (TEN + key * 20 + 18).alias("hi")),
    )
    return table(spark, sf, "supplier").select(F.inline(spans))


def vpn_pairs(spark, sf) -> DataFrame:
    user = F.col("user_id")
    clicks = table(spark, sf, "events").filter("event_type = 'click'")
    return clicks.select(ip10(user * 11).alias("ip"), text("u", user).alias("user")).distinct()


def vpn_local(spark, sf) -> DataFrame:
    signups = table(spark, sf, "events").filter("event_type = 'signup'")
    return signups.select(ip10(F.col("user_id") + 500000).alias("ip")).distinct()


def vpn_lines(spark, sf) -> DataFrame:
    """VPN log lines of the events, four files."""
    user, ts, kind = F.col("user_id"), F.col("ts"), F.col("event_type")
    head = F.concat(F.date_format(ts, "MMM d HH:mm:ss"), F.lit(" gw vpn[1]: "))
    named = F.when(user % 5 == 0, text(" u", user)).otherwise("")
    body = (
        F.when(kind == "click", text("peer connected from ", ip10(user), named))
        .when(kind == "view", text("Call detected from user u", user))
        .when(kind == "signup", text("PPP/IPCP up (local addr = ", ip10(user + 1000), ")"))
        .otherwise(text("keepalive ", kind))
    )
    events = table(spark, sf, "events").select("event_id", "user_id", F.concat(head, body).alias("body"))
    return lines_of_table(events, text("vpn-", user % 4), F.col("event_id"), F.col("body"), chunk_lines=1000)


SECTION_END = 1_000_000_000_000


def config_lines(spark, sf) -> DataFrame:
    """Firewall configurations, one file per nation: an interface, an address range and a
    reserved-address block per customer, then the deny-list entries."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    start, end = ip10(key * 16), ip10(key * 16 + 9)
    first = F.when(key % 14 == 13, end).otherwise(start)
    second = F.when(key % 14 == 13, start).otherwise(end)
    as_start, as_end = text("        set start-ip ", first), text("        set end-ip ", second)
    backwards = key % 6 == 5
    dhcp = [
        text("    edit ", key),
        F.when(key % 4 != 1, text('        set interface "port', F.floor(key / 10), '"')),
        F.when(key % 9 == 0, text("        set start-ip ", ip10(key * 16 + 3))),
        F.when(backwards & (key % 9 != 0), as_end).otherwise(as_start),
        F.when(backwards & (key % 9 != 0), as_start).otherwise(as_end),
        F.lit("        config reserved-address"),
        F.lit("            edit 1"),
        text("                set mac ", mac_of(F.floor(key / 2))),
        F.when(key % 3 == 0, "                set action block").otherwise("                set action assign"),
        text('                set description "', F.when(key % 5 == 0, "vendor ").otherwise("guest "), key, '"'),
        F.lit("            next"),
        F.lit("        end"),
        F.lit("    next"),
    ]
    address = text("198.51.", F.pmod(F.floor(key / 256), F.lit(256)), ".", key % 256)
    deny = [
        text(F.when(key % 3 != 2, '    edit "Black').otherwise('    edit "White'), key, ' host"'),
        F.when(key % 4 == 0, text("        set subnet ", address, " 255.255.255.255"))
        .when(key % 4 == 1, text("        set subnet ", address, " 255.255.255.0"))
        .when(key % 4 == 2, text('        set fqdn "bad', key, '.example.com"')),
        F.when(key % 10 != 9, "    next"),
    ]
    customers = table(spark, sf, "customer")
    parts = [
        customers.select(nation, (base + key * 20).alias("base"), F.posexplode(F.array(*lines)).alias("i", "line"))
        for base, lines in [(F.lit(0), dhcp), (F.lit(SECTION_END), deny)]
    ]
    body = parts[0].unionByName(parts[1]).filter(F.col("line").isNotNull())
    body = body.select("c_nationkey", (F.col("base") + F.col("i")).alias("p"), "line")
    frame = F.array(
        F.struct(F.lit(-1).cast("bigint").alias("p"), F.lit("config system dhcp server").alias("line")),
        F.struct(F.lit(SECTION_END - 2).alias("p"), F.lit("end").alias("line")),
        F.struct(F.lit(SECTION_END - 1).alias("p"), F.lit("config firewall address").alias("line")),
    )
    frames = customers.select("c_nationkey").distinct().select("c_nationkey", F.inline(frame))
    return lines_of_table(
        body.unionByName(frames), text("FW-", nation), F.col("p"), F.col("line"), chunk_lines=5000
    )


TABLE_OF_REST = [
    (C.ADMIN_EVENTS, "Login Summary"),
    (C.ADMIN_EVENTS, "List of Failed Logins"),
    (C.BANDWIDTH_REPORT, "Top 30 Users by Bandwidth and Sessions"),
    (C.CLIENT_REPUTATION, "レピュテーションスコアの上位ユーザー"),
    (C.CLIENT_REPUTATION, "レピュテーションスコアの大きい上位デバイス"),
    (C.TERMINALS_DATACENTER, C.TERMINAL_TABLE),
    (C.TERMINALS_VPN, C.TERMINAL_TABLE),
    (C.CLIENT_REPUTATION, C.REPORT_FILTERS),
]


def by_rest(key: Column, values: list) -> Column:
    choice = None
    for rest, value in enumerate(values):
        value = F.lit(value) if isinstance(value, str) else value
        test = key % len(values) == rest
        choice = F.when(test, value) if choice is None else choice.when(test, value)
    return choice


def report_rows(spark, sf) -> DataFrame:
    """Rows of report tables: customers' addresses, addresses in documents, domains of pages."""
    def row(df, report, table_name, place, **cells):
        pairs = [p for name, value in cells.items() for p in (F.lit(name), value)]
        present = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
        return df.select(report.alias("report"), table_name.alias("table"), place.alias("place"), present.alias("cells"))

    key = F.col("c_custkey")
    ip = ip10(key)

    def only(rest: int, value: Column) -> Column:
        return F.when(key % 8 == rest, value)

    people = row(
        table(spark, sf, "customer"),
        by_rest(key, [r for r, _ in TABLE_OF_REST]), by_rest(key, [t for _, t in TABLE_OF_REST]), key,
        Login_Interface=only(0, text("ssh(", ip, ")")),
        Login_Source=only(1, text("from ", ip)),
        User_or_IP_=F.coalesce(only(2, ip), only(5, ip10(key - key % 16)), only(6, ip)),
        User__or_IP_=only(3, ip),
        Device1=only(4, F.col("c_name")),
        Device2=only(4, ip),
        Filter_name=only(7, F.when(key % 24 == 7, "srcip").when(key % 24 == 15, "dstip")),
    )
    hosts = row(
        table(spark, sf, "documents"),
        F.lit(C.BANDWIDTH_REPORT), F.lit("Top 30 Destination by Bandwidth and Sessions"), F.col("doc_id"),
        Hostname_or_IP_=extract_ip(F.col("text"), anywhere=True),
        Lang=F.col("lang"),
    )
    page = F.col("page_id")
    visits = row(
        table(spark, sf, "pages"),
        F.lit(C.USER_REPORT), F.lit(TOP10_DESTINATIONS), page,
        Destination=page_domain(),
        Source=ip10(page * 7),
        rank=text(page % 5 + 1, ": ", ip10(page * 7), " user Usage: ", page % 900, " MB"),
        Bandwidth=text(page % 900, " MB"),
        Bytes=F.when(page % 3 == 0, text(page, " KB")),
        Application=F.lit("HTTPS"),
    )
    return people.unionByName(hosts).unionByName(visits)


def xml_tables(spark, sf) -> DataFrame:
    """One ``table`` element per customer; a tag repeats in some rows only."""
    key = F.col("c_custkey")
    users = text(
        '<table name="Users ', F.col("c_nationkey"), '"><id><Dev>a-', key, "</Dev>",
        F.when(key % 2 == 0, text("<Dev>b &amp; ", key, "</Dev>")).otherwise(""),
        "<IP>", ip10(key), "</IP><Note/></id><id><Dev>c-", key, "</Dev></id></table>",
    )
    total = text('<table name="Traffic Summary"><Total>', key, "</Total><Unit>MB</Unit></table>")
    return table(spark, sf, "customer").select(key.alias("at"), F.when(key % 10 == 0, total).otherwise(users).alias("xml"))


def xml_sections(spark, sf) -> DataFrame:
    """One per-user section per page."""
    page = F.col("page_id")
    section = text(
        '<Top_5_Users_by_Bandwidth name="', page % 5 + 1, ": ", ip10(page), " u Usage: ", page % 90, ' MB">',
        '<table name="Traffic Summary"><Total>', page, "</Total></table>",
        '<table name="Top 10 Destinations"><id><Destination>', page_domain(), "</Destination></id>",
        "<id><Destination>", ip10(page * 3), "</Destination><Hits>", page % 7, "</Hits></id></table>",
        '<table name="Other"><id><Destination>x</Destination></id></table>',
        "</Top_5_Users_by_Bandwidth>",
    )
    return table(spark, sf, "pages").select(page.alias("at"), section.alias("xml"))


def size_text(mb: Column) -> Column:
    """Size in one of three units; thousands carry commas."""
    in_gb = text(F.format_number(F.floor(mb / 1024), 0), " GB")
    part = F.lpad(F.pmod(F.floor(mb * 10000 / 1048576), F.lit(10000)).cast("string"), 4, "0")
    in_tb = text(F.floor(mb / 1048576), ".", part, " TB")
    return F.when(mb % 3 == 0, text(F.format_number(mb, 0), " MB")).when(mb % 3 == 1, in_gb).otherwise(in_tb)


def month_of_order() -> Column:
    return F.date_format("o_orderdate", "yyyyMM")


def monthly_applications(spark, sf) -> DataFrame:
    """Top thirty applications of each month by size, and the month's total as rank 0."""
    rest = F.col("o_custkey") % 40
    names = F.array(*map(F.lit, C.CHART_APPLICATIONS))
    application = F.when(rest < 8, F.element_at(names, (F.pmod(rest, F.lit(8)) + 1).cast("int"))).otherwise(text("tcp/", rest))
    price = F.col("o_totalprice").cast("decimal(18,2)")
    sizes = (
        table(spark, sf, "orders")
        .groupBy(month_of_order().alias("yyyymm"), application.alias("application"))
        .agg(F.sum(price).alias("price"), F.count("*").alias("sessions"))
    )
    ordered = Window.partitionBy("yyyymm").orderBy(F.desc("price"), "application")
    tops = sizes.withColumn("rank", F.row_number().over(ordered)).filter("rank <= 30")
    totals = sizes.groupBy("yyyymm").agg(F.sum("price").alias("price"), F.sum("sessions").alias("sessions"))
    both = tops.unionByName(totals.select("yyyymm", F.lit(C.TOTAL_TITLE).alias("application"), "price", "sessions", F.lit(0).alias("rank")))
    return both.select("yyyymm", "application", "rank", "sessions", size_text(F.floor((F.col("price") * 100).cast("bigint") / 5000)).alias("size"))


def csv_report_lines(monthly: DataFrame) -> DataFrame:
    """Sectioned CSV reports, one file per month, from :func:`monthly_applications`."""
    def quoted(value: Column) -> Column:
        return text('"', value, '"')

    sessions = F.format_number("sessions", 0)
    total = F.col("rank") == 0
    statistics = [
        F.lit("###Traffic Statistics###"), F.lit("#,Summary,Statistics"),
        *[text(f"{i},", F.lit(f'"Item {i}"'), ",", quoted(sessions)) for i in range(1, 8)],
        text("8,", quoted(F.col("application")), ",", quoted(F.col("size"))),
        F.lit(""), F.lit(f"###{C.TOP_APPLICATIONS}###"), F.lit("#,Application,Bandwidth,Sessions"),
    ]
    first = len(statistics)
    blocks = F.when(total, F.array(*statistics)).otherwise(F.array(F.concat_ws(
        ",", F.col("rank").cast("string"), quoted(F.col("application")), quoted(F.col("size")), quoted(sessions)
    )))
    base = F.when(total, F.lit(0)).otherwise(F.col("rank") + first - 1)
    lines = monthly.select("yyyymm", base.alias("base"), F.posexplode(blocks).alias("i", "line"))
    return lines_of_table(lines, F.col("yyyymm"), F.col("base") + F.col("i"), F.col("line"), chunk_lines=16)


def xml_report_column(monthly: DataFrame) -> DataFrame:
    """The same reports as ``table`` elements, one per row of the month; every tenth has no application."""
    named = F.when(F.col("rank") % 10 != 9, text("<Application>", F.col("application"), "</Application>")).otherwise("")
    total = text(
        f'<table name="{C.TRAFFIC_STATISTICS}"><id><Summary>', F.col("application"), "</Summary><Statistics>",
        F.col("size"), "</Statistics></id></table>",
    )
    top = text(
        f'<table name="{C.TOP_APPLICATIONS}"><id>', named, "<Bytes>",
        F.col("size"), "</Bytes><Sessions>", F.col("sessions"), "</Sessions></id></table>",
    )
    return monthly.select("yyyymm", F.col("rank").alias("at"), F.when(F.col("rank") == 0, total).otherwise(top).alias("xml"))


def calendar(spark, sf) -> DataFrame:
    """Review calendar over the months of the orders."""
    months = table(spark, sf, "orders").select(month_of_order().alias("yyyymm")).distinct()
    year, month = F.substring("yyyymm", 1, 4), F.substring("yyyymm", 5, 2).cast("int")
    return months.select(
        text(year, "年", month, "月").alias("targetYm"),
        text("reviewer ", month).alias("name"),
        # The last months of a year have days that are none: 2/30, 13/1 and a word.
        F.when(month == 12, F.when(year.cast("int") % 3 == 0, "2/30").when(year.cast("int") % 3 == 1, "13/1").otherwise("2/x"))
        .when(month % 5 != 0, text(F.pmod(month, F.lit(12)) + 1, "/", month + 7)).alias("eventDate"),
    )


def produced(spark, sf) -> DataFrame:
    months = table(spark, sf, "orders").select(month_of_order().alias("yyyymm")).distinct()
    return months.filter(F.substring("yyyymm", 5, 2).cast("int") % 3 != 0)


def switch_lines(spark, sf) -> DataFrame:
    """Switch table lines that print the MACs of event users; errors print them without dash."""
    digits = F.lpad(F.col("user_id").cast("string"), 12, "0")
    dash = F.when(F.col("event_type") == "error", "").otherwise("-")
    line = text("vlan-", F.col("event_id") % 9, " ", F.substring(digits, 1, 6), dash, F.substring(digits, 7, 6), "-000001 up")
    events = table(spark, sf, "events").select("event_id", "event_type", line.alias("printed"))
    return lines_of_table(events, text("switch-", F.col("event_type")), F.col("event_id"), F.col("printed"))


def user_register(spark, sf) -> DataFrame:
    deleted = F.when(F.col("o_orderstatus") != "O", F.to_date("o_orderdate"))
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", deleted.alias("削除日"))


def pattern_domains(spark, sf) -> DataFrame:
    """A domain per customer: its key, its nation and one of three ends."""
    key = F.col("c_custkey")
    end = F.element_at(F.array(F.lit("com"), F.lit("net"), F.lit("org")), (key % 3 + 1).cast("int"))
    return table(spark, sf, "customer").select(text("c", key, ".n", F.col("c_nationkey"), ".example.", end).alias("domain"))


def domain_patterns(spark, sf) -> DataFrame:
    """A pattern per supplier, in eight ways to write one; every eighth is none, as its bracket stays open."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    ways = [
        text("^c[0-9]*", key % 10, "\\.n", nation, "\\.example\\.(com|net)"),
        text("(n", nation, "|n", key % 25, ")\\.example\\.com"),
        text("c", key, "[0-9]?\\.n[0-9]+\\.example\\.org"),
        text("^c(?:", key, "|", key + 1, "){1,2}\\..*"),
        text("\\bc", key, "\\.n", nation, "|c", key + 2, "\\.n.*net"),
        text("c", key, "+\\.n\\d+\\.example\\.com"),
        text("c", key, "(.n"),
        text("c", key, ".n", nation, ".example.org"),
    ]
    return table(spark, sf, "supplier").select(
        F.element_at(F.array(*ways), (key % 8 + 1).cast("int")).alias("pattern"), F.col("s_name").alias("owner"), at(key)
    )


def pattern_assets(spark, sf) -> DataFrame:
    """An asset name per customer."""
    key = F.col("c_custkey")
    name = text("pc-", key, "-n", F.col("c_nationkey"), F.when(key % 2 == 1, "-nb").otherwise(""))
    return table(spark, sf, "customer").select(name.alias("key"), F.col("c_name").alias("user"), at(key))


def host_patterns(spark, sf) -> DataFrame:
    """A host name per supplier that is a pattern, in eight ways to write one; one of them is none."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    ways = [
        text("pc-[0-9]+-n", nation, "-nb"),
        text("pc-(", key, "|", key * 2, ")-"),
        text("pc-", key, "?[0-9]-"),
        text(".*", key % 10, "-n", nation, "$"),
        text("pc-", key + 3, "-|pc-", key, "-n"),
        text("(?i)PC-", key, "\\d{1,2}-"),
        text("pc-", key, "[-"),
        text("pc.", key, "-"),
    ]
    return table(spark, sf, "supplier").select(F.element_at(F.array(*ways), (key % 8 + 1).cast("int")).alias("host"))

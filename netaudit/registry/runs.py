"""Queries that run whole jobs: inputs as files and registers, the job, and what it wrote read back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from netaudit import constants as C
from netaudit.operators import matchjoin
from netaudit.operators.dropped import counting
from netaudit.operators.positions import with_positions
from netaudit.plans import devices, jobs, trend, vpn
from netaudit.registry import inputs
from netaudit.registry.files import _lines, month_reports, new_folder, write_files
from netaudit.registry.inputs import table, text
from netaudit.registry.queries import bandwidth_trend, device_register
from netaudit.sinks import namedfiles, tables, versions
from netaudit.sources import lines, registers, xmlreports

# Fixed values of the registered runs.
FIRST_DAY, SECOND_DAY = date(1995, 1, 1), date(1998, 6, 15)
LEASE_FILES = {"named": "dhcp-a.txt", "nameless": "dhcp-b.txt"}
ROOM_COLUMNS = ["時刻", "氏名", ""]


def in_order(register: DataFrame) -> DataFrame:
    """A register whose files hold its rows in their order."""
    return register.orderBy("seq").drop("seq")


def register_rows(spark, root: str, name: str, schema: str, version: int | None = None) -> DataFrame:
    """``register, row`` with the cells of each row as one text."""
    rows = registers.read_register(spark, f"{root}/{name}", schema, version=version).drop("seq")
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("-")) for c in rows.columns]
    return rows.select(F.lit(name).alias("register"), F.concat_ws("|", *cells).alias("row"))


def refreshed_registers(spark, sf):
    """Registers refreshed on two days, read as of each version."""
    root = new_folder(spark)
    users, assets = inputs.user_register(spark, sf), in_order(inputs.assets_register(spark, sf))
    for day in (FIRST_DAY, SECOND_DAY):
        jobs.refresh_registers({"users": users, "assets": assets}, "users", day, root)
        assets = assets.limit(0)
    found = []
    for version in versions.versions(spark, root):
        for name, schema in (("users", "o_orderkey long, o_custkey long"), ("assets", "`コンピュータ名` string, `部署名` string")):
            found.append(register_rows(spark, root, name, schema, version).withColumn("version", F.lit(version)))
    whole = found[0]
    for rows in found[1:]:
        whole = whole.unionByName(rows)
    return whole


def config_job(spark, sf):
    """C1-C3 as a job: the registers of the configurations' lines, published together."""
    root = new_folder(spark)
    jobs.config_registers(inputs.config_lines(spark, sf), root)
    schemas = {
        "deny_list": "ip string, hostName string, macAddress string", "deny_list_export": "IP string, Description string",
        "dhcp_ranges": "interface string, lo long, hi long", "blocked_macs": "macAddress string, action string, description string, interFace string",
    }
    whole = [register_rows(spark, root, name, schema) for name, schema in schemas.items()]
    return whole[0].unionByName(whole[1]).unionByName(whole[2]).unionByName(whole[3])


def vpn_job(spark, sf):
    """S15, C4, C5 as a job: logs of three months by their names, the registers of one."""
    folder = new_folder(spark)
    events = inputs.vpn_lines(spark, sf).withColumn("file", F.replace("file", F.lit("vpn-"), F.lit("vpn199901-")))
    old = _lines(table(spark, sf, "events"), F.lit("vpn199803.log"), F.col("event_id"), F.lit("Jan 1 00:00:00 gw vpn[1]: peer connected from 10.0.0.1 none"))
    write_files(events.select("file", "chunk", "pos", "line").unionByName(old), f"{folder}/logs")
    # The month before the day of the run.
    jobs.vpn_registers(spark, f"{folder}/logs", None, f"{folder}/ext", today=date(1999, 2, 10))
    vpn = register_rows(spark, f"{folder}/ext", "vpn", "ip string, user string")
    return vpn.unionByName(register_rows(spark, f"{folder}/ext", "vpn_local", "ip string"))


def room_log(spark, sf):
    """Room-entry files in CP932, one per kind of event, with another order of columns in every second."""
    events = table(spark, sf, "events")
    user = F.col("user_id")
    names = F.element_at(F.array(*[F.lit(n) for n in ("山田 太郎", "ソ能表", "髙﨑①", "\"Ito, Ken\"", "")]), (user % 5 + 1).cast("int"))
    swapped = F.col("event_type").isin("click", "signup")
    stamp = F.date_format("ts", "yyyy/MM/dd")
    line = F.when(swapped, F.concat_ws(",", names, stamp, F.lit("x"))).otherwise(F.concat_ws(",", stamp, names))
    body = _lines(events, text("room-", F.col("event_type"), ".csv"), F.col("event_id"), line)
    files = events.select("event_type").distinct()
    head = F.when(swapped, "氏名,時刻,").otherwise("時刻,氏名")
    top = [_lines(files, text("room-", F.col("event_type"), ".csv"), F.lit(i - 5), F.lit("入退室ログ") if i < 3 else head) for i in range(4)]
    folder = new_folder(spark)
    with lines.java_charsets(spark):
        # The text writer puts the bytes of a string down as they are.
        written = body.unionByName(top[0]).unionByName(top[1]).unionByName(top[2]).unionByName(top[3]).withColumn("line", F.encode("line", "windows-31j").cast("string"))
    write_files(written, folder)
    rows = lines.read_room_log(spark, folder)
    cells = rows.select(lines.base_name(F.col("file")).alias("file"), F.explode("cells").alias("column_name", "value"))
    return cells.groupBy("file", "column_name", "value").agg(F.count("*").alias("rows"))


def provider_networks(spark, sf):
    """Networks in search order: the register, then the lists of the providers with their labels."""
    key = F.col("s_suppkey")
    whois = table(spark, sf, "supplier").select(
        F.col("s_name").alias("User"), text("192.", key % 256, ".", F.floor(key / 256), ".0/24").alias("ip"), inputs.at(key)
    )
    customer = F.col("c_custkey")
    lists = F.element_at(F.array(*[F.lit(f"{n}_ip_list") for n in (*registers.PROVIDER_LISTS, "other")]), (customer % 4 + 1).cast("int"))
    items = table(spark, sf, "customer").select(lists.alias("ID"), text(" 10.", customer % 256, ".", F.floor(customer / 256), ".0/24 ").alias("Item"), inputs.at(customer))
    labels = table(spark, sf, "nation").filter("n_nationkey < 2").select(
        F.element_at(F.array(F.lit("sinet_item_name"), F.lit("hgc_item_name")), (F.col("n_nationkey") + 1).cast("int")).alias("ID"),
        text(F.col("n_name"), " ").alias("Item"), inputs.at(F.col("n_nationkey")),
    )
    found = registers.network_register(whois, items.unionByName(labels), "own")
    return found.select("User", "cidr", F.col("seq.rank").alias("rank"))


def _xml(name: str, value: Column) -> Column:
    escaped = F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return F.when(value.isNotNull(), text(f"<{name}>", escaped, f"</{name}>")).otherwise("")


def report_files(spark, sf) -> DataFrame:
    """The rows of the reports as seven XML files of one table element each row: ``file, chunk, pos, line``."""
    rows = inputs.report_rows(spark, sf)
    names = [
        "Login_Interface", "Login_Source", "User_or_IP_", "User__or_IP_", "Filter_name", "Hostname_or_IP_", "Lang",
        "Destination", "Source", "Bandwidth", "Bytes", "Application",
    ]

    def cell(name: str) -> Column:
        return F.try_element_at("cells", F.lit(name))

    # A repeated tag is numbered by the reader.
    devices = text(_xml("Device", cell("Device1")), _xml("Device", cell("Device2")))
    row = F.concat(F.lit("<id>"), *[_xml(n, cell(n)) for n in names], devices, F.lit("</id>"))
    of_users = F.col("report") == C.USER_REPORT
    tables = text('<table name="', F.when(of_users, C.TOP_DESTINATIONS).otherwise(F.col("table")), '">', row, "</table>")
    sections = text(f'<{C.USER_SECTION} name="', cell("rank"), '">', tables, f"</{C.USER_SECTION}>")
    file = text(F.col("report"), "-1999-08-01_1234.xml")
    body = _lines(rows, file, F.col("place"), F.when(of_users, sections).otherwise(tables))
    reports = spark.createDataFrame([(n,) for n in C.REPORT_NAMES], "report string")
    for pos, line in ((-1, "<r>"), (1 << 40, "</r>")):
        body = body.unionByName(_lines(reports, file, F.lit(pos), F.lit(line)))
    return body


def audit_inputs(spark, sf, ext: str) -> None:
    """Registers, lease files and parameters of a month below ``ext``."""
    versions.write_registers(spark, ext, {
        "static": in_order(inputs.static_register(spark, sf)), "assets": in_order(inputs.assets_register(spark, sf)),
        "allow_list": in_order(inputs.allow_register(spark, sf)), "deny_list": in_order(inputs.denied_register(spark, sf)),
        "vpn": inputs.vpn_pairs(spark, sf), "vpn_local": inputs.vpn_local(spark, sf), "dhcp_ranges": inputs.lan_ranges(spark, sf),
        "whois": in_order(inputs.network_entries(spark, sf).select("User", F.col("cidr").alias("ip"), "seq")),
    })
    key = F.col("c_custkey")
    leases = inputs.leases(spark, sf).select("ip", "macAddress", "hostName", F.col("seq.pos").alias("pos"))
    host = F.when(F.col("hostName") == C.BLANK_HOST, "").otherwise(F.col("hostName"))
    named = F.col("hostName").isNotNull()
    written = leases.select(
        F.when(named, LEASE_FILES["named"]).otherwise(LEASE_FILES["nameless"]).alias("file"), F.lit(0).cast("long").alias("chunk"), "pos",
        F.when(named, F.concat_ws("\t", "ip", F.lit("-"), "macAddress", host)).otherwise(F.concat_ws("\t", "ip", "macAddress", F.lit(""))).alias("line"),
    )
    write_files(written, f"{ext}/dhcp")
    parameters = spark.createDataFrame([(0, "ID,Item"), (1, "sinet_item_name,SINET"), (2, "sinet_ip_list,203.0.113.0/24")], "pos long, line string")
    write_files(_lines(parameters, F.lit("parameters.csv"), F.col("pos"), F.col("line")), f"{ext}/parameters")


def monthly_audit(spark, sf):
    """The audit of a month from report files and registers to the written reports, read back and counted."""
    folder = new_folder(spark)
    write_files(report_files(spark, sf), f"{folder}/input")
    audit_inputs(spark, sf, f"{folder}/ext")
    jobs.monthly_audit(spark, f"{folder}/input", f"{folder}/ext", "199907", "own", f"{folder}/out")
    rows = spark.read.parquet(f"{folder}/out/reports").select("report", F.col("table").alias("table_name"), F.explode("cells").alias("column_name", "value"))
    return rows.groupBy("report", "table_name", "column_name", "value").agg(F.count("*").alias("rows"))


def trend_again(spark, sf):
    """A trend whose last month is exported once more; the second run reads that month alone. Its series too."""
    folder, period = new_folder(spark), "199907"
    reports = jobs.checkpointed(month_reports(spark, sf))
    last = F.contains("file", F.lit(period))
    # The first export of the last month lacks the applications from the eleventh on.
    write_files(reports.filter(~last | (F.col("pos") <= 10) | (F.col("pos") == 1 << 40)), folder)
    first = jobs.bandwidth_report(spark, folder, period, f"{folder}/out", xml_since="199901")
    write_files(reports.filter(last).withColumn("file", F.replace("file", F.lit("-01-1234"), F.lit("-02-1234"))), f"{folder}/new")
    moved = versions._Files(spark, folder)
    place = jobs.MONTH_FOLDER.format(period)
    for name in moved.names(place):
        moved.system.delete(moved.path(folder, place, name), False)
    for name in moved.names(f"new/{place}"):
        moved.system.rename(moved.path(folder, "new", place, name), moved.path(folder, place, name))
    second = jobs.bandwidth_report(spark, folder, period, f"{folder}/out", xml_since="199901")
    series = spark.read.parquet(f"{folder}/out/{period}/series").select("application", "yyyymm", F.round("bandwidth", 6).alias("bandwidth"))
    return series.withColumns({"first_read": F.lit(len(first)), "then_read": F.lit(",".join(second))})


def sorted_devices(spark, sf):
    """O1: place of each device in the text order of the addresses."""
    return devices.sorted_by_ip(device_register(spark, sf)).select("ip", "hostName", "position")


def sorted_trend(spark, sf):
    """The trend table as it is written, with the place of each row."""
    folder, period = new_folder(spark), "199907"
    rows = jobs.checkpointed(bandwidth_trend(spark, sf))
    tables.write_trend(rows, trend.chart_series(rows), period, folder)
    return spark.read.parquet(f"{folder}/{period}/trend").select("application", "yyyymm", "size", "position")


def sorted_sessions(spark, sf):
    """O3: place of each marked log line in the order that decides a session's user: day as text, then file and line."""
    lines_ = vpn.month_lines(inputs.vpn_lines(spark, sf), vpn.SESSION_MARKS, 1)
    found = lines_.select(vpn.x(2).alias("day"), "file", "chunk", "pos", F.array_join("words", " ").alias("line"))
    return with_positions(found, [F.col(c) for c in ("day", "file", "chunk", "pos")]).select("line", "position")


def large_table(spark, sf):
    """One table of one report file with a row per order, read by many tasks."""
    orders = table(spark, sf, "orders")
    name = F.lit(f"{C.TERMINALS_VPN}-1999-08-01_1234.xml")
    row = text("<id><Key>", F.col("o_orderkey"), "</Key><Who>c &amp; ", F.col("o_custkey"), "</Who><Who>", F.col("o_orderstatus"), "</Who></id>")
    frame = spark.createDataFrame([(-1, f'<r><table name="{C.TERMINAL_TABLE}">'), (1 << 40, "</table></r>")], "pos long, line string")
    folder = write_files(_lines(orders, name, F.col("o_orderkey"), row).unionByName(_lines(frame, name, F.col("pos"), F.col("line"))), new_folder(spark))
    rows = xmlreports.read_reports(spark, folder)
    return rows.select(F.col("table").alias("table_name"), *[F.try_element_at("cells", F.lit(c)).alias(c.lower()) for c in ("Key", "Who1", "Who2")])


def dropped_counts(spark, sf):
    """What jobs leave out: blocks whose MAC line is missing, networks that are none, sizes in other units."""
    root = new_folder(spark)
    no_mac = F.contains("line", F.lit("set mac ")) & F.endswith("line", F.lit("0"))
    jobs.config_registers(inputs.config_lines(spark, sf).filter(~no_mac), f"{root}/ext")
    reports = month_reports(spark, sf).withColumn("line", F.replace("line", F.lit("7 MB"), F.lit("7 KB")))
    write_files(reports, root)
    jobs.bandwidth_report(spark, root, "199907", f"{root}/out", xml_since="199901")
    with counting() as dropped:
        ips = table(spark, sf, "customer").select(inputs.ip10(F.col("c_custkey")).alias("ip"))
        jobs.checkpointed(matchjoin.first_network_match(ips, inputs.network_entries(spark, sf), "seq", "User"))
        networks = dropped.table(spark)
    kept = [registers.read_register(spark, f"{root}/{name}", "what string, rows long").drop("seq") for name in ("ext/config_dropped", "out/dropped-199907")]
    return networks.unionByName(kept[0]).unionByName(kept[1])


def converted_records(spark, sf):
    """Documents of the months converted in three runs; the second finds one put by hand, the third nothing."""
    folder = new_folder(spark)
    months = inputs.calendar(spark, sf).select(F.col("targetYm").alias("month"), F.col("name").alias("who"))
    documents = months.select(text("record ", F.col("month"), ".md").alias("name"), text("# ", F.col("month"), "\n", F.col("who")).alias("text"))
    last = F.col("name") == documents.agg(F.max("name")).first()[0]
    done = []
    for wanted in (~last, last, F.lit(False)):
        namedfiles.write_documents(documents.filter(wanted), f"{folder}/records")
        done.append(jobs.convert_records(spark, f"{folder}/records", f"{folder}/out", ".txt", lambda t: F.regexp_replace(t, "^# ", "")))
    made = spark.read.text(f"{folder}/out", wholetext=True).select(lines.base_name(lines.decoded_name(F.col("_metadata.file_path"))).alias("name"), F.col("value").alias("text"))
    return made.withColumn("runs", F.lit(",".join(str(n) for n in done[1:])))


def scalar_registers(spark, sf):
    """Registers that are one array of texts per file."""
    names = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.to_json(F.sort_array(F.collect_list("s_name"))).alias("items"))
    folder = write_files(_lines(names, text("list-", F.col("s_nationkey"), ".json"), F.lit(0), F.col("items")), f"{new_folder(spark)}/scalars")
    return registers.read_scalars(spark, folder, "name")


RUN_QUERIES = {f.__name__: f for f in [converted_records, scalar_registers, dropped_counts, sorted_devices, sorted_trend, sorted_sessions, large_table, refreshed_registers, config_job, vpn_job, room_log, provider_networks, monthly_audit, trend_again]}

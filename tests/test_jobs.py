"""Trend, review, VPN and column functions, sinks and whole jobs."""

import datetime
import os
import random
import time

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from netaudit import constants as C
from netaudit.functions import dates, net, text
from netaudit.plans import jobs, review, trend, vpn
from netaudit.session import checkpointed, job_tables
from netaudit.sinks import namedfiles, tables
from netaudit.sources import registers
from netaudit.sources.lines import lines_of_table


def column(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", make(F.col("v")).alias("o")).orderBy("i").collect()]


def test_sizes(spark):
    values = ["1.5 GB", "2MB", "0.5 TB", "7 KB", "12", None, "x MB", "1e2 MB"]
    assert column(spark, values, text.size_to_mb) == [1536.0, 2.0, 524288.0, None, None, None, None, 100.0]


def test_csv_cleaning(spark):
    assert column(spark, ['1,"2,345","6,789 MB"', '"a","b"', "1,2,3"], text.clean_csv_line) == ["1,2345,6789 MB", "a,b", "123"]


def test_addresses(spark):
    assert column(spark, ["10.0.0.1", "1.2.3", "a.b.c.d", None], net.ip_to_number) == [167772161, None, None, None]
    numbers = [0, 1, 167772161, 2**32 - 1]
    assert column(spark, numbers, lambda c: net.ip_to_number(net.number_to_ip(c)), "bigint") == numbers
    assert column(spark, ["a)b)", "x", ")"], net.strip_closing_paren) == ["ab)", "x", ""]
    assert column(spark, ["00:11:22:33:44:55", "00-11-22-33-44-55", "0011.2233.4455", "00:11:22"], net.has_mac) == [True, True, True, False]
    assert column(spark, ["aa:bb:cc:dd:ee:ff"], net.mac_search_key) == ["aabbcc-ddeeff"]
    assert column(spark, ["1234.1.1.1", "1.1.1.1x", "x"], net.extract_ip) == ["234.1.1.1", None, None]


def test_periods(spark):
    assert dates.previous_period(datetime.date(2025, 1, 31)) == "202412"
    assert dates.trend_periods("202502")[0] == "202402" and len(dates.trend_periods("202502")) == 13
    assert column(spark, ["2025年3月", "2025年4月", "2025年12月"], dates.fiscal_year) == [2024, 2025, 2025]
    assert column(spark, ["2025年3月", "2025年12月"], dates.calendar_yyyymm) == ["202503", "202512"]
    assert column(spark, ["Jan", "Dec", "jan", None], dates.month_number) == [1, 12, None, None]


TITLE = C.TOTAL_TITLE


def csv_report(file, total, apps):
    lines = ["###Traffic Statistics###", "h"] + [f"{i},S{i},1" for i in range(1, 8)]
    lines += [f'8,{TITLE},"{total}"' if total else "8,S8,1", "", f"###{C.TOP_APPLICATIONS}###", "h"]
    lines += [f'{i},{a},"{s}",1' for i, (a, s) in enumerate(apps, 1)]
    return [(file, i, l) for i, l in enumerate(lines)]


def test_trend(spark):
    rows = csv_report("202409", "1,024 GB", [("IKE", "2 GB"), ("x", "1,024 MB"), ("y", "5 KB")]) + csv_report("202410", None, [("IKE", "1 GB")])
    df = spark.createDataFrame(rows, "f string, i long, l string")
    old = trend.trend_of_csv(lines_of_table(df, F.col("f"), F.col("i"), F.col("l"), chunk_lines=4), F.col("file"))
    cells = [("202411", C.TRAFFIC_STATISTICS, 0, {"Summary": TITLE, "Statistics": "3 TB"}),
             ("202411", C.TOP_APPLICATIONS, 1, {"Application": "IKE", "Bytes": "1,024 MB"}),
             ("202412", C.TOP_APPLICATIONS, 1, {"Application": "x", "Bandwidth": "1 GB", "Bytes": "9 GB"}),
             ("202412", C.TOP_APPLICATIONS, 2, {"Application": "z", "Bytes": "9 GB"}),
             ("202412", "Other", 2, {"Application": "x", "Bandwidth": "1 GB"})]
    new = trend.trend_of_xml(spark.createDataFrame(cells, "yyyymm string, table string, place int, cells map<string,string>"))
    ranked = trend.with_ranks(old.unionByName(new))
    got = {(r.yyyymm, r.application): (r["size"], r.bandwidth, r.applicationsRank) for r in ranked.collect()}
    assert got == {
        ("202409", TITLE): ("1024 GB", 1048576.0, 99), ("202409", "IKE"): ("2 GB", 2048.0, 3),
        ("202409", "x"): ("1024 MB", 1024.0, 2), ("202409", "y"): ("5 KB", None, 1),
        ("202410", TITLE): (None, None, 99), ("202410", "IKE"): ("1 GB", 1024.0, 3),
        ("202411", TITLE): ("3 TB", 3145728.0, 99), ("202411", "IKE"): ("1024 MB", 1024.0, 3),
        ("202412", "x"): ("1 GB", 1024.0, 2),
        ("202412", "z"): (None, None, 1),  # the table has the preferred size column, this row not
    }
    first = trend.sorted_trend(ranked).filter("position = 0").first()
    assert (first.application, first.yyyymm) == (TITLE, "202409")
    series = {(r.yyyymm, r.application): r.bandwidth for r in trend.chart_series(ranked).collect()}
    assert series[("202409", "others")] is None and series[("202412", "others")] is None
    assert series[("202411", "IKE")] == 1.0 and ("202411", "others") not in series


def vpn_loop(rows, month):
    words = [(f, l.split()) for f, _, l in rows if "connected from" in l or "Call detected from user" in l]
    kept = [w for _, w in words if w[0] == month]
    kept.sort(key=lambda w: w[1])  # stable
    users = [w[9] if len(w) > 9 else None for w in kept]
    for i in range(len(kept) - 1):
        if users[i] is None and users[i + 1] is not None:
            users[i] = users[i + 1]
    return {(w[8], u) for w, u in zip(kept, users) if w[6] == "connected"}


@pytest.mark.parametrize("count", [0, 1, 2, 400])
def test_vpn_sessions(spark, count):
    rng, rows = random.Random(count), []
    for f in "ab":
        for i in range(count):
            head = f"{rng.choice(['Jan', 'Jan', 'Feb'])} {rng.choice([1, 2, 10, 11])} 00:00:0{rng.randrange(9)} gw t:"
            body = rng.choice([f"peer connected from 10.0.0.{i}", f"peer connected from 10.0.0.{i} u{i}", f"Call detected from user w{i}", "noise", f"PPP/IPCP up (local addr = 10.1.0.{i % 9})"])
            rows.append((f, i, f"{head} {body}"))
    df = spark.createDataFrame(rows, "f string, i long, l string").repartition(4)
    lines = lines_of_table(df, F.col("f"), F.col("i"), F.col("l"), chunk_lines=7)
    assert {tuple(r) for r in vpn.vpn_sessions(lines, 1).collect()} == vpn_loop(rows, "Jan")
    expected = {l.split()[10][:-1] for _, _, l in rows if "PPP/IPCP" in l and l.startswith("Feb")}
    assert {r.ip for r in vpn.vpn_local_ips(lines, 2).collect()} == expected


def calendar_file(tmp_path):
    rows = ["x,,", "y", "z", "2025年4月,,,,,,,,,,kim,,4/8", "2025年5月,,,,,,,,,,lee,,", "2024年5月,,,,,,,,,,old,,5/1"]
    (tmp_path / "calendar.csv").write_text("\n".join(rows) + "\n")
    return str(tmp_path / "calendar.csv")


def test_review_records(spark, tmp_path):
    calendar = review.of_fiscal_year(review.read_calendar(spark, calendar_file(tmp_path)), datetime.date(2026, 3, 1))
    assert sorted(r.targetYm for r in calendar.collect()) == ["2025年4月", "2025年5月"]
    done = tmp_path / "done"
    done.mkdir()
    for name in ["記録 202505.md", "記録 20250.md", "other 202504.md"]:
        (done / name).write_text("x")
    produced = review.produced_periods(spark, str(done), "記録")
    assert [r.yyyymm for r in produced.collect()] == ["202505"]
    records = review.review_records(review.missing_periods(calendar, produced), "Sato", "山田　太郎", "Ito")
    out = str(tmp_path / "out")
    tables.write_review_records(records, "記録", out)
    assert [p.name for p in Path(out).iterdir()] == ["記録 202504.md"]
    lines = Path(out, "記録 202504.md").read_text().split("\n")
    assert lines[6] == "2025年4月8日（火）13:30〜14:00" and lines[2] == "承認:山田<br>" and lines[8] == "山田　太郎、Ito"
    assert lines[10] == "2025年04月" and lines[18] == "2025年4月8日　山田"
    blank = review.review_records(review.with_event(calendar).filter("yyyymm = '202505'"), "Sato", "山田 太郎", "Ito").first().text
    assert "2025年 月 日（）13:30" in blank


def test_skip_existing(spark):
    names = spark.createDataFrame([("a",), ("b",)], "name string")
    assert [r.name for r in review.not_yet_converted(names, names.filter("name = 'a'")).collect()] == ["b"]


def test_register_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1.1.1.1", None), ("x", "h")], "ip string, hostName string")
    path = str(tmp_path / "r")
    tables.write_register(df, path)
    tables.write_register(df, path)
    read = lambda: sorted((r.ip, r.hostName) for r in registers.read_register(spark, path, "ip string, hostName string").collect())
    assert read() == [("1.1.1.1", None), ("x", "h")]
    assert tables.export_unless_empty(df.limit(0), path) is False and len(read()) == 2
    assert tables.export_unless_empty(df.limit(1), path) is True and len(read()) == 1


def test_report_sink_keeps_other_periods(spark, tmp_path):
    df = spark.createDataFrame([("R", "T 1", 0, {"a": "x"}), ("R", "T/2", 1, {"b": "y"})], "report string, table string, place int, cells map<string,string>")
    path = str(tmp_path / "out")
    tables.write_reports(df, "202501", path)
    tables.write_reports(df.limit(1), "202502", path)
    tables.write_reports(df, "202501", path)
    got = spark.read.parquet(path)
    assert got.count() == 3 and {r.table for r in got.collect()} == {"T 1", "T/2"}


def test_trend_and_mac_sinks(spark, tmp_path):
    ranked = spark.createDataFrame([("a", "1 MB", 1.0, "202501", 1), (TITLE, "9 MB", 9.0, "202501", 99)],
                                   "application string, size string, bandwidth double, yyyymm string, applicationsRank int")
    tables.write_trend(ranked, trend.chart_series(ranked), "202501", str(tmp_path))
    table = spark.read.parquet(str(tmp_path / "202501" / "trend"))
    assert "applicationsRank" not in table.columns and table.count() == 2
    assert {r.application for r in spark.read.parquet(str(tmp_path / "202501" / "series")).collect()} == {TITLE, "others"}

    (tmp_path / "macs.txt").write_text("aa:bb:cc:dd:ee:ff\n00:11:22:33:44:55\n")
    switches = tmp_path / "switches"
    switches.mkdir()
    (switches / "s1.txt").write_text("1 aabbcc-ddeeff up\n2 none\n")
    found = jobs.mac_matches(spark, str(tmp_path / "macs.txt"), str(switches))
    tables.write_mac_matches(found, str(tmp_path / "found"))
    assert list(map(tuple, namedfiles.read_keyed_lines(spark, str(tmp_path / "found")).collect())) == [("aabbcc-ddeeff", "s1.txt:1 aabbcc-ddeeff up")]


CONFIG = """config system dhcp server
    edit 1
        set interface "lan"
        set start-ip 10.0.0.2
        set end-ip 10.0.0.9
        config reserved-address
            edit 1
                set mac 00:00:00:00:00:01
                set action block
                set description "guest"
            next
        end
    next
end
config firewall address
    edit "Black1 bad"
        set subnet 1.2.3.4 255.255.255.255
    next
end
"""


def test_config_and_vpn_jobs(spark, tmp_path):
    from netaudit.sources.lines import read_config

    ext = tmp_path / "ext"
    ext.mkdir()
    (ext / "FIREWL01_2025.conf").write_text(CONFIG)
    out = str(tmp_path / "registers")
    jobs.config_registers(read_config(spark, str(ext)), out)
    read = lambda name, schema: [tuple(r) for r in registers.read_register(spark, f"{out}/{name}", schema).drop("seq").collect()]
    assert read("deny_list", "ip string, hostName string") == [("1.2.3.4", "Black1 bad")]
    assert read("deny_list_export", "IP string, Description string") == [("1.2.3.4", "Black1 bad")]
    assert read("blocked_macs", "macAddress string, action string, interFace string") == [("00:00:00:00:00:01", "block", "lan")]
    assert read("dhcp_ranges", "interface string, lo long, hi long") == [("lan", 167772162, 167772169)]
    logs = tmp_path / "vpn"
    logs.mkdir()
    (logs / "vpn202501.log").write_text("Jan 2 0:0:1 gw t: peer connected from 10.0.0.7\nJan 2 0:0:2 gw t: Call detected from user kim\n")
    jobs.vpn_registers(spark, str(logs), "202501", out)
    assert read("vpn", "ip string, user string") == [("10.0.0.7", "kim")]
    assert read("vpn_local", "ip string") == []


def test_refresh(spark, tmp_path):
    users = spark.createDataFrame([("a", datetime.date(2020, 1, 1)), ("b", None)], "name string, `削除日` date")
    jobs.refresh_registers({"users": users, "other": users}, "users", datetime.date(2025, 1, 1), str(tmp_path))
    count = lambda name: registers.read_register(spark, str(tmp_path / name), "name string").count()
    assert count("users") == 1 and count("other") == 2


def put(folder, name, content, encoding="utf-8"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(content, encoding=encoding)


def xml_table(name, *rows):
    ids = "".join("<id>" + "".join(f"<{k}>{v}</{k}>" for k, v in row) + "</id>" for row in rows)
    return f'<table name="{name}">{ids}</table>'


def test_monthly_audit(spark, tmp_path):
    reports, ext, out = tmp_path / "input", tmp_path / "ext", str(tmp_path / "out")
    body = {name: xml_table(C.TERMINAL_TABLE, [("User_or_IP_", "10.0.0.1")], [("User_or_IP_", "10.0.0.1")]) for name in C.REPORT_NAMES}
    body[C.ADMIN_EVENTS] = xml_table("Login Summary", [("Login_Interface", "ssh(10.0.0.2)"), ("Seen", "10.0.0.2")])
    body[C.USER_REPORT] = (
        f'<{C.USER_SECTION} name="1: 10.0.0.1 u Usage: 2 GB">'
        + xml_table(C.TOP_DESTINATIONS, [("Destination", "www.example.com"), ("Bandwidth", "1 GB"), ("Application", "HTTPS")]) + f"</{C.USER_SECTION}>"
    )
    for name, content in body.items():
        put(reports, f"{name}-2025-01-02_1234.xml", f"<r>{content}</r>")
    # A file that is no report is not read.
    put(reports, "Other Thing-2025-01-02_1234.xml", f"<r>{xml_table('T', [('A', '10.9.9.9')])}</r>")
    put(ext / "static", "a.json", "")
    put(ext / "dhcp", "dhcp.txt", "10.0.0.1\t-\t00:11:22:33:44:55\tpc-1\n")
    put(ext / "deny_list", "a.json", '{"ip":"9.9.9.9","hostName":"Black1"}')
    put(ext / "allow_list", "a.json", '{"domain":"example.com","Description1":"site"}')
    put(ext / "assets", "a.json", '{"使用者名":"ann","コンピュータ名":"PC-1-NB","部署名":"A"}')
    put(ext / "vpn", "a.json", "")
    put(ext / "vpn_local", "a.json", "")
    put(ext / "whois", "a.json", "")
    put(ext / "parameters", "p.csv", "ID,Item\nnmc_ip_list,10.0.0.0/24\n")
    put(ext / "dhcp_ranges", "a.json", '{"interface":"lan","lo":1,"hi":2}')
    jobs.monthly_audit(spark, str(reports), str(ext), "202501", "own", out)
    got = {(r.report, r.table): [] for r in spark.read.parquet(f"{out}/reports").collect()}
    assert {report for report, _ in got} == set(C.REPORT_NAMES)
    for r in spark.read.parquet(f"{out}/reports").collect():
        got[(r.report, r.table)].append(r.cells)
    pc = {"hostName": "pc-1", "user": "ann", "description": "A", "macAddress": "00:11:22:33:44:55"}
    assert got[(C.TERMINALS_VPN, C.TERMINAL_TABLE)] == [{"User_or_IP_": "10.0.0.1", **pc}]
    assert got[(C.ADMIN_EVENTS, "Login Summary")] == [
        {"Login_Interface": "ssh(10.0.0.2)", "Seen": "10.0.0.2", "ip": "10.0.0.2", "hostName": "own"}
    ]
    assert got[(C.USER_REPORT, "top10Destinations")] == [{
        "Destination": "www.example.com", "Bandwidth": "1 GB", "Application": "HTTPS", "destinationHost": "site", "ip": "10.0.0.1", "rank": "1", "usage": "2 GB", **pc,
    }]
    users = reports / f"{C.USER_REPORT}-2025-01-02_1234.xml"
    users.write_text(users.read_text().replace("Application", "App"))
    with pytest.raises(ValueError, match="Application"):
        jobs.monthly_audit(spark, str(reports), str(ext), "202501", "own", out)
    (reports / f"{C.TERMINALS_VPN}-2025-01-02_1234.xml").unlink()
    with pytest.raises(ValueError, match="vpn"):
        jobs.monthly_audit(spark, str(reports), str(ext), "202501", "own", out)


def test_bandwidth_report(spark, tmp_path):
    for p in dates.trend_periods("202503"):
        folder = tmp_path / f"UTM Logs {p}" / "input"
        if p < C.XML_SINCE:
            lines = [l for _, _, l in csv_report(p, "1,024 GB", [("IKE", "2 GB")])]
            put(folder, f"{C.BANDWIDTH_REPORT}-{p[:4]}-{p[4:]}-01-1234.csv", "\n".join(lines))
        else:
            tables_ = xml_table(C.TRAFFIC_STATISTICS, [("Summary", TITLE), ("Statistics", "1 TB")])
            tables_ += xml_table(C.TOP_APPLICATIONS, [("Application", "other"), ("Bytes", "1,024 MB"), ("Sessions", "1")])
            put(folder, f"{C.BANDWIDTH_REPORT}-{p[:4]}-{p[4:]}-01-1234_9.xml", f"<r>{tables_}</r>")
        put(folder, "Other-2025-01-01_1234.xml", "<r/>")
    assert jobs.bandwidth_report(spark, str(tmp_path), "202503", str(tmp_path / "out")) == dates.trend_periods("202503")
    rows = spark.read.parquet(str(tmp_path / "out" / "202503" / "trend")).collect()
    assert sorted((r.yyyymm, r.application, r.bandwidth) for r in rows) == sorted(
        [(p, TITLE, 1048576.0) for p in dates.trend_periods("202503")]
        + [(p, "IKE", 2048.0) if p < C.XML_SINCE else (p, "other", 1024.0) for p in dates.trend_periods("202503")]
    )
    series = spark.read.parquet(str(tmp_path / "out" / "202503" / "series"))
    assert series.filter("application = 'others'").count() == 5


def test_only_changed_months_are_read(spark, tmp_path):
    """The second run reads the new month and one that was exported again; the others could not be read any more."""
    periods = dates.trend_periods("202503")

    def export(p, size):
        folder = tmp_path / f"UTM Logs {p}" / "input"
        lines = [l for _, _, l in csv_report(p, "1,024 GB", [("IKE", f"{size} GB"), (f"a{p}", "1 GB")])]
        put(folder, f"{C.BANDWIDTH_REPORT}-{p[:4]}-{p[4:]}-01-1234.csv", "\n".join(lines))

    for p in periods[:-1]:
        export(p, 1)
    out = str(tmp_path / "out")
    export("202402", 1)
    assert jobs.bandwidth_report(spark, str(tmp_path), "202502", out, "999999") == dates.trend_periods("202502")
    export("202406", 7)
    export("202503", 9)
    for p in periods[:-1]:
        if p != "202406":
            # Same names, sizes and times, other content.
            for file in (tmp_path / f"UTM Logs {p}" / "input").iterdir():
                times = file.stat()
                file.write_bytes(b"x" * times.st_size)
                os.utime(file, ns=(times.st_atime_ns, times.st_mtime_ns))
    assert jobs.bandwidth_report(spark, str(tmp_path), "202503", out, "999999") == ["202406", "202503"]
    rows = spark.read.parquet(f"{out}/202503/trend").filter("application = 'IKE'").collect()
    assert sorted((r.yyyymm, r["size"]) for r in rows) == [(p, {"202406": "7 GB", "202503": "9 GB"}.get(p, "1 GB")) for p in periods]
    assert jobs.bandwidth_report(spark, str(tmp_path), "202503", out, "999999") == []
    assert spark.read.parquet(f"{out}/202503/trend").count() == 3 * 13


def test_missing_reviews(spark, tmp_path):
    put(tmp_path / "done", "記録 202505.md", "x")
    jobs.missing_reviews(spark, calendar_file(tmp_path), str(tmp_path / "done"), "記録", datetime.date(2025, 6, 1), "Sato", "山田 太郎", "Ito", str(tmp_path / "out"))
    assert [p.name for p in (tmp_path / "out").iterdir() if p.is_file()] == ["記録 202504.md"]


def test_reviews_end(spark, tmp_path):
    """The first run finds no folder, the second its own records and has nothing to write."""
    out = str(tmp_path / "records")
    run = (spark, calendar_file(tmp_path), out, "記録", datetime.date(2025, 6, 1), "Sato", "山田 太郎", "Ito", out)
    jobs.missing_reviews(*run)
    first = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "records").iterdir() if p.is_file()}
    assert set(first) == {"記録 202504.md", "記録 202505.md"}
    jobs.missing_reviews(*run)
    assert {p.name: p.stat().st_mtime_ns for p in (tmp_path / "records").iterdir() if p.is_file()} == first


def test_folders_are_listed_once_for_each_change(spark, tmp_path, monkeypatch):
    walked = []
    listing = review.list_names
    monkeypatch.setattr(review, "list_names", lambda s, p: walked.append(p) or listing(s, p))
    folder = tmp_path / "records"
    names = lambda: sorted(r.name for r in review.produced_names(spark, str(folder)).collect())
    assert names() == [] and not walked
    put(folder, "a.md", "x")

    def settled():
        os.utime(folder, (time.time() - 60, time.time() - 60))

    assert names() == ["a.md"] == names() and len(walked) == 2  # the change is too young
    settled()
    assert names() == ["a.md"] == names() == names() and len(walked) == 3
    namedfiles.write_documents(spark.createDataFrame([("b.md", "x"), ("c.md", "x")], "name string, text string"), str(folder))
    (folder / "a.md").unlink()
    settled()
    assert names() == ["b.md", "c.md"] == names() and len(walked) == 4
    for file in folder.glob("*.md"):
        file.unlink()
    settled()
    assert names() == [] == names() and len(walked) == 5


def test_mac_search_writes_its_files(spark, tmp_path):
    put(tmp_path / "switch", "a.txt", "vlan 001122-334455 up\nvlan 001122-334466 up\n")
    put(tmp_path, "macs", "00:11:22:33:44:55\n")
    jobs.write_mac_search(spark, str(tmp_path / "macs"), str(tmp_path / "switch"), str(tmp_path / "found"))
    assert list(map(tuple, namedfiles.read_keyed_lines(spark, str(tmp_path / "found")).collect())) == [("001122-334455", "a.txt:vlan 001122-334455 up")]


def test_mac_search_joins_once(spark, tmp_path, monkeypatch):
    """What is written is read twice, to place the ranges and to write them; it is a table, not the join."""
    put(tmp_path / "switch", "a.txt", "vlan 001122-334455 up\n")
    put(tmp_path, "macs", "00:11:22:33:44:55\n")
    plans, write = [], jobs.write_mac_matches
    monkeypatch.setattr(jobs, "write_mac_matches", lambda found, out: (plans.append(found._jdf.queryExecution().executedPlan().toString()), write(found, out)))
    jobs.write_mac_search(spark, str(tmp_path / "macs"), str(tmp_path / "switch"), str(tmp_path / "found"))
    [plan] = plans
    assert "Join" not in plan and "parquet" in plan
    assert namedfiles.read_keyed_lines(spark, str(tmp_path / "found")).count() == 1


def test_jobs_remove_their_tables(spark, tmp_path):
    df = spark.range(3)
    with job_tables(spark):
        kept = checkpointed(df)
        path = kept.inputFiles()[0]
        assert kept.count() == 3
    assert not Path(path.removeprefix("file://")).exists()
    assert checkpointed(df).count() == 3


def test_configuration_without_dhcp_section(spark, tmp_path):
    lines = spark.createDataFrame([("f", 0, 0, "config system global"), ("f", 0, 1, "end")], "file string, chunk long, pos long, line string")
    with pytest.raises(ValueError, match="dhcp"):
        jobs.config_registers(lines, str(tmp_path))
    assert not list(tmp_path.iterdir())


def test_stored_parts_keep_their_names(spark):
    names = [" 直近2期間にスコアが増加した上位ユーザー", "Report Filters(Logic: All)", "a/b=c", "0123", "x "]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "table string, i int")
    got = checkpointed(df, by=["table"])
    assert {(r.table, r.i) for r in got.collect()} == {(n, i) for i, n in enumerate(names)}
    assert [r.i for r in got.filter(F.col("table") == names[0]).collect()] == [0]

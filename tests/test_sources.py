"""Readers over small files in each input shape."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from netaudit import constants as C
from netaudit.sources import lines, registers, xmlreports


def write(folder, name, text, encoding="utf-8"):
    (folder / name).write_bytes(text.encode(encoding))
    return str(folder)


def test_line_order_over_many_splits(spark, tmp_path):
    rng = random.Random(2)
    text = [f"{i} " + "x" * rng.randrange(40) for i in range(20000)]
    write(tmp_path, "a+b c.txt", "\n".join(text) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = lines.read_lines(spark, str(tmp_path))
        rows = df.orderBy("chunk", "pos").collect()
        assert [r.line for r in rows] == text
        assert len({r.chunk for r in rows}) > 3
        assert {r.file.split("/")[-1] for r in rows} == {"a+b c.txt"}
        numbered = lines.number_lines(df)
        assert numbered.filter("line_no <> cast(split(line, ' ')[0] as int) + 1").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_config_folder_must_hold_one_file(spark, tmp_path):
    write(tmp_path, "notes.conf", "x")
    with pytest.raises(ValueError, match="missing"):
        lines.read_config(spark, str(tmp_path))
    write(tmp_path, "FIREWL01_2025-01_02.conf", "config\nend")
    assert [r.line for r in lines.read_config(spark, str(tmp_path)).orderBy("pos").collect()] == ["config", "end"]
    write(tmp_path, "FIREWL02_2025-01_02.conf", "config")
    with pytest.raises(ValueError, match="only one"):
        lines.read_config(spark, str(tmp_path))


def test_vpn_files_of_three_months(spark, tmp_path):
    for name in ["vpn202501.log", "vpn202503.log", "vpn202502.log", "access.log", "access.log.1"]:
        write(tmp_path, name, name)
    got = {r.line for r in lines.read_vpn_lines(spark, str(tmp_path), ["202502", "202501"]).collect()}
    assert got == {"vpn202501.log", "vpn202502.log", "access.log"}


def test_room_log_in_cp932(spark, tmp_path):
    write(tmp_path, "a.csv", 'x\ny\nz\n日付,氏名\n1/2,"山田, 太郎"\n1/3,鈴木\n', "cp932")
    write(tmp_path, "b.csv", "x\ny\nz\n日付,扉\n2/2,東\n", "cp932")
    rows = lines.read_room_log(spark, str(tmp_path)).select(F.element_at("cells", "日付").alias("d"), "cells").orderBy("d").collect()
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"
    assert [r.cells for r in rows] == [{"日付": "1/2", "氏名": "山田, 太郎"}, {"日付": "1/3", "氏名": "鈴木"}, {"日付": "2/2", "扉": "東"}]


def test_room_log_has_as_many_cells_as_its_lines(spark, tmp_path):
    names = [f"n{i}" for i in range(100)]
    write(tmp_path, "a.csv", "x\ny\nz\n" + ",".join(names) + "\n" + ",".join(f'"v ""{i}"", x"' for i in range(100)) + "\nonly\n", "cp932")
    rows = [r.cells for r in lines.read_room_log(spark, str(tmp_path)).orderBy("line_no").collect()]
    assert rows == [{n: f'v "{i}", x' for i, n in enumerate(names)}, {n: "only" if n == "n0" else None for n in names}]


CSV_REPORT = ["Report", "###Traffic Statistics###", "h"] + [f'{i},S{i},"{i},000"' for i in range(1, 9)] + ["", "###Top###", "h", '1,a,"1,234 MB"', "2,b,2 GB", "tail,x"]


def test_csv_sections(spark):
    df = spark.createDataFrame([("f", i // 4, i, l) for i, l in enumerate(CSV_REPORT)], "file string, chunk long, pos long, line string")
    got = [tuple(r) for r in lines.csv_section(df, "###Traffic Statistics###", 8, ["id", "s", "v"]).orderBy("row_no").collect()]
    assert got == [("f", i, str(i), f"S{i}", f"{i}000") for i in range(1, 9)]
    got = [tuple(r) for r in lines.csv_section(df, "###Top###", 2, ["id", "app", "size", "none"]).orderBy("row_no").collect()]
    assert got == [("f", 1, "1", "a", "1234 MB", None), ("f", 2, "2", "b", "2 GB", None)]
    assert lines.csv_section(df, "###Other###", 2, ["id"]).count() == 0


LAYOUT_ONE = "IP\tx\ty\tz\n 10.0.0.1 \t-\t00:11:22:33:44:55\tpc-1\n10.0.0.2\t-\t00-11-22-33-44-66\t\nno address\t-\t0011.2233.4455\tq\n"
LAYOUT_TWO = "10.0.1.1\t0011.2233.4455\tpc 一号 lease\textra\n10.0.1.2\t0011.2233.4466\t\n"


def leases(df):
    return sorted(((r.ip, r.macAddress, r.hostName) for r in df.collect()))


def test_leases(spark, tmp_path):
    write(tmp_path, "one.txt", LAYOUT_ONE)
    write(tmp_path, "two.txt", LAYOUT_TWO)
    write(tmp_path, "none.txt", "10.0.2.1\tx\ty\n")
    assert leases(registers.read_leases(spark, str(tmp_path))) == [
        ("10.0.0.1", "00:11:22:33:44:55", "pc-1"),
        ("10.0.0.2", "00-11-22-33-44-66", C.BLANK_HOST),
        ("10.0.1.1", "0011.2233.4455", "pc"),
        ("10.0.1.2", "0011.2233.4466", None),
    ]


def test_leases_in_utf16(spark, tmp_path):
    write(tmp_path, "one.txt", LAYOUT_ONE, "utf-16")
    write(tmp_path, "two b.txt", LAYOUT_TWO.replace("pc 一号", "《端末》 一号"), "utf-16")
    write(tmp_path, "three.txt", LAYOUT_TWO.replace("10.0.1", "10.0.3"))
    assert leases(registers.read_leases(spark, str(tmp_path))) == [
        ("10.0.0.1", "00:11:22:33:44:55", "pc-1"),
        ("10.0.0.2", "00-11-22-33-44-66", C.BLANK_HOST),
        ("10.0.1.1", "0011.2233.4455", "《端末》"),
        ("10.0.1.2", "0011.2233.4466", None),
        ("10.0.3.1", "0011.2233.4455", "pc"),
        ("10.0.3.2", "0011.2233.4466", None),
    ]


@pytest.mark.parametrize("encoding", ["utf-8", "utf-16"])
def test_lease_layout_does_not_depend_on_cells_or_encoding(spark, tmp_path, encoding):
    write(tmp_path, "wide.txt", "10.0.0.1\t00:11:22:33:44:55\tpc" + "\tx" * 40 + "\n", encoding)
    assert leases(registers.read_leases(spark, str(tmp_path))) == [("10.0.0.1", "00:11:22:33:44:55", "pc")]


@pytest.mark.parametrize("split", ["16", "100", "128m"])
def test_marked_lines_over_many_splits(spark, tmp_path, split):
    """Bytes 0A that are halves of characters, marks inside the text, empty lines, no last line end."""
    rng = random.Random(8)
    characters = ["a", "\t", "\u0a05", "\u4e0a", "\u0a0a", "\u4e00", "\u000b", "\ufeff", "\u00e9", "\U0001f642", "\n", "\n", "\r\n", "\u0a00", "\uff0a", "\u0aff"]
    want = {}
    for i in range(12):
        body = "".join(rng.choice(characters) for _ in range(rng.choice([0, 1, 5, 60, 400]))) + rng.choice(["", "\n"])
        encoding = ["utf-8", "utf-16-le", "utf-16-be"][i % 3]
        (tmp_path / f"f{i}.txt").write_bytes(("" if i % 3 == 0 else "\ufeff").encode(encoding) + body.encode(encoding))
        want[f"f{i}.txt"] = body.split("\n")
    (tmp_path / "odd.txt").write_bytes(b"\xff\xfea\x00\n\x00b\x00c")
    want["odd.txt"] = ["a", "b"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = lines.read_marked_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for name, expected in want.items():
        got = [r.line for r in sorted(rows, key=lambda r: (r.chunk, r.pos)) if r.file.endswith(f"/{name}")]
        # Nothing behind the last line end is no line.
        assert got == (expected[:-1] if expected[-1] == "" else expected) or got == expected, name


def test_no_leases_is_an_error(spark, tmp_path):
    write(tmp_path, "none.txt", "10.0.2.1\tx\ty\n")
    with pytest.raises(ValueError, match="no leases"):
        registers.read_leases(spark, str(tmp_path))


def test_leading_rows_of_each_file(spark, tmp_path):
    write(tmp_path, "a.csv", "about,x\nmore,y\nu1,1\nu2,2\n")
    write(tmp_path, "b.csv", "about,x\nmore,y\nu3,3\n")
    register = registers.read_register(spark, str(tmp_path), "user string, n string", fmt="csv")
    assert sorted(r.user for r in registers.without_leading_rows(register).collect()) == ["u1", "u2", "u3"]


def test_registers(spark, tmp_path):
    path = write(tmp_path, "static.json", '[{"IPアドレス":"10.0.0.1","ホスト名":"a","管理者":"m","用途":"p","設置場所":"x"},'
                 '{"IPアドレス":"10.0.0.2","ホスト名":"DHCP Start"},{"IPアドレス":"10.0.0.3"},{"IPアドレス":"10.0.0.4","ホスト名":"b","用途":"p"}]')
    static = registers.static_devices(registers.read_register(spark, path, registers.STATIC_SCHEMA, multiLine=True))
    assert [tuple(r)[:4] for r in static.orderBy("seq").collect()] == [("10.0.0.1", "a", "m", "x"), ("10.0.0.4", "b", "p", None)]


def test_scalar_register(spark, tmp_path):
    path = write(tmp_path, "local.json", '["10.0.0.1", null, "10.0.0.2"]')
    assert sorted(r.ip for r in registers.read_scalars(spark, path).collect()) == ["10.0.0.1", "10.0.0.2"]


def test_networks_in_search_order(spark, tmp_path):
    path = write(tmp_path, "parameters.csv", "ID,Item\nsinet_ip_list,10.1.0.0/16\nsinet_ip_list, 10.2.0.0/16 \nsinet_item_name,SINET\n"
                 "hgc_ip_list,10.3.0.0/16\nhgc_item_name,HGC\nnmc_ip_list,10.4.0.0/16\nother,x\n")
    parameters = registers.read_parameters(spark, path)
    folder = tmp_path / "whois"
    folder.mkdir()
    whois = registers.read_register(spark, write(folder, "w.json", '{"User":"w","ip":"10.0.0.0/16"}\n'), registers.WHOIS_SCHEMA)
    networks = registers.network_register(whois, parameters, "own")
    assert [(r.User, r.cidr) for r in networks.orderBy("seq").collect()] == [
        ("w", "10.0.0.0/16"), ("SINET", "10.1.0.0/16"), ("SINET", "10.2.0.0/16"), ("HGC", "10.3.0.0/16"), ("own", "10.4.0.0/16"),
    ]


def test_validity(spark):
    df = spark.createDataFrame([(1, None), (2, datetime.date(2025, 1, 1)), (3, datetime.date(2024, 12, 31))], "id int, `削除日` date")
    assert sorted(r.id for r in registers.valid_on(df, datetime.date(2025, 1, 1)).collect()) == [1, 2]


def test_parameter_file(spark, tmp_path):
    path = write(tmp_path, "param.csv", "kA,1\nkB,山田　太郎\n")
    assert sorted(tuple(r) for r in registers.read_settings(spark, path).collect()) == [("kA", "1"), ("kB", "山田　太郎")]


REPORT = """<r><g><table name="T1"><id><Dev>a</Dev><Dev>b &amp; c</Dev><IP>1.2.3.4 </IP></id><id><Dev>z</Dev><E/></id></table>
<table name="Traffic Summary"><A>1</A><B>2</B></table><table name="T2"><rows><id><K x="1">v</K></id></rows></table></g></r>"""
USERS = """<r><Top_5_Users_by_Bandwidth name="1: 10.0.0.5 u Usage: 1.2 GB"><table name="Traffic Summary"><A>1</A></table>
<table name="Top 10 Destinations"><id><Destination>x.example.com</Destination></id><id><Destination>y</Destination></id></table></Top_5_Users_by_Bandwidth>
<Top_5_Users_by_Bandwidth name="2: 10.0.0.6"><table name="Top 10 Destinations"><id><Destination>x</Destination></id></table></Top_5_Users_by_Bandwidth></r>"""


def test_xml_reports(spark, tmp_path):
    write(tmp_path, f"{C.CLIENT_REPUTATION}-2025-01-01+0900_12.xml", REPORT)
    write(tmp_path, f"{C.USER_REPORT}-2025-01-01_1234.xml", USERS)
    rows = xmlreports.read_reports(spark, str(tmp_path))
    got = [(r.report, r.table, r.cells) for r in rows.orderBy("report", "place").collect()]
    assert got == [
        (C.CLIENT_REPUTATION, "T1", {"Dev1": "a", "Dev2": "b & c", "IP": "1.2.3.4 "}),
        (C.CLIENT_REPUTATION, "T1", {"Dev": "z", "E": ""}),
        (C.CLIENT_REPUTATION, "Traffic Summary", {"A": "1", "B": "2"}),
        (C.CLIENT_REPUTATION, "T2", {"K": "v"}),
        (C.USER_REPORT, "trafficSummary", {"A": "1"}),
        (C.USER_REPORT, "top10Destinations", {"Destination": "x.example.com", "rank": "1: 10.0.0.5 u Usage: 1.2 GB"}),
        (C.USER_REPORT, "top10Destinations", {"Destination": "y", "rank": "1: 10.0.0.5 u Usage: 1.2 GB"}),
        (C.USER_REPORT, "top10Destinations", {"Destination": "x", "rank": "2: 10.0.0.6"}),
    ]
    view = xmlreports.table_view(rows, C.CLIENT_REPUTATION, "T1")
    assert view.columns == ["place", "Dev", "Dev1", "Dev2", "E", "IP"]


def test_report_files(spark, tmp_path):
    assert C.REPORT_NAMES == sorted(C.REPORT_NAMES)
    for i, name in enumerate(C.REPORT_NAMES):
        write(tmp_path, f"{name}-2025-01-0{i + 1}" + ("_1234.xml" if i % 2 else "+0900_1234.xml"), "<r/>")
    write(tmp_path, "Other report-2025-01-01_1234.xml", "<r/>")
    write(tmp_path, "notes.txt", "x")
    files = xmlreports.list_reports(spark, str(tmp_path))
    known = {r.report: r.known for r in files.collect()}
    assert known == {name: True for name in C.REPORT_NAMES} | {"Other report": False}
    xmlreports.check_complete(files)
    with pytest.raises(ValueError, match=C.USER_REPORT):
        xmlreports.check_complete(files.filter(F.col("report") != C.USER_REPORT))
    with pytest.raises(ValueError, match=C.USER_REPORT):
        xmlreports.check_complete(files.unionByName(files.filter(F.col("report") == C.USER_REPORT)))
    found = files.filter(F.col("file").rlike(xmlreports.dated_export(C.BANDWIDTH_REPORT))).count()
    assert found == 0
    write(tmp_path, f"{C.BANDWIDTH_REPORT}-2024-01-05-1234_5.xml", "<r/>")
    files = xmlreports.list_reports(spark, str(tmp_path))
    assert files.filter(F.col("file").rlike(xmlreports.dated_export(C.BANDWIDTH_REPORT))).count() == 1

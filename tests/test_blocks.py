"""Configuration jobs against plain loops over randomly made, also malformed, files."""

import random
import re

import pytest
from pyspark.sql import functions as F

from netaudit.operators import blocks
from netaudit.sources.lines import lines_of_table

WORDS = [
    "config system dhcp server", "    set interface \"lan{n}\"", "    config reserved-address", "        end", "end",
    "            set mac 00:00:00:00:00:0{n}", "            set action block", "            set action assign",
    "            set description \"guest {n}\"", "            set description \"vendor {n}\"",
    "    set start-ip 10.0.{n}.1", "    set end-ip 10.0.{n}.9", "    edit \"Black{n} host\"", "    set subnet 1.2.3.{n} 255.255.255.255",
    "    set subnet 1.2.{n}.0 255.255.255.0", "    set fqdn \"bad{n}.example.com\"", "    next", "    edit \"White{n}\"",
]


def made_files(seed, count, length):
    rng = random.Random(seed)
    files = {}
    for i in range(count):
        lines = [rng.choice(WORDS).replace("{n}", str(rng.randrange(5))) for _ in range(rng.randrange(1, length))]
        lines = [l for l in lines if l not in ("end", WORDS[0]) or rng.random() < 0.1]
        if rng.random() < 0.9:
            lines.insert(0, WORDS[0])
        if rng.random() < 0.9:
            lines.append("end")
        files[f"f{i}"] = lines
    return files


@pytest.fixture(scope="module")
def files():
    return made_files(11, 150, 60)


@pytest.fixture(scope="module")
def lines(spark, files):
    rows = [(f, i, l) for f, ls in files.items() for i, l in enumerate(ls)]
    df = spark.createDataFrame(rows, "f string, i long, l string").repartition(7)
    return lines_of_table(df, F.col("f"), F.col("i"), F.col("l"), chunk_lines=5)


def value(line, key):
    return line.replace(key, "", 1).replace('"', "").strip()


def loop_section(lines, is_start, is_end):
    start = None
    for i, line in enumerate(lines):
        if is_start(line):
            start = i
        if start is not None and is_end(line):
            return lines[start : i + 1]
    return []


def test_blocked_macs(files, lines):
    expected = set()
    for f, ls in files.items():
        found, record, inside, iface = {}, {}, False, None
        for line in loop_section(ls, lambda x: x == "config system dhcp server", lambda x: x == "end"):
            if "set interface " in line:
                iface = value(line, "set interface ")
            if "config reserved-address" in line:
                inside = True
            if not inside:
                continue
            if "end" in line:
                inside = False
                if "mac" in record:
                    found[record["mac"]] = (record.get("action"), record.get("description"), iface)
                record = {}
            else:
                if "set mac " in line:
                    record["mac"] = value(line, "set mac ")
                if "set action block" in line:
                    record["action"] = "block"
                if "set description " in line:
                    record["description"] = value(line, "set description ")
        expected |= {(f, m, *r) for m, r in found.items()}
    got = [tuple(r) for r in blocks.blocked_macs(lines).collect()]
    assert len(got) == len(set(got)) and set(got) == expected and len(expected) > 10


def loop_ranges(ls):
    out, start, end, iface = [], None, None, None
    for line in loop_section(ls, lambda x: "config system dhcp server" in x, lambda x: x.startswith("end")):
        if "set interface " in line:
            iface = value(line, "set interface ")
        if "set start-ip " in line:
            start = value(line, "set start-ip ")
        if "set end-ip " in line:
            end = value(line, "set end-ip ")
        if start and end:
            if iface is not None:
                out.append((iface, start, end))
            start = end = None
    return out


def number(ip):
    a, b, c, d = map(int, ip.split("."))
    return ((a * 256 + b) * 256 + c) * 256 + d


@pytest.mark.parametrize("all_ranges", [False, True])
def test_dhcp_ranges(files, lines, all_ranges):
    expected = []
    for f, ls in files.items():
        found = loop_ranges(ls)
        if not all_ranges:
            found = list({iface: (iface, s, e) for iface, s, e in found}.values())
        expected += [(f, i, min(number(s), number(e)), max(number(s), number(e))) for i, s, e in found]
    got = [tuple(r) for r in blocks.dhcp_ranges(lines, all_ranges).collect()]
    assert sorted(got) == sorted(expected) and len(expected) > 20


def test_deny_list(files, lines):
    expected = []
    for f, ls in files.items():
        for i, line in enumerate(ls):
            if not re.search('edit "Black[0-9]+', line):
                continue
            ip = None
            for later in ls[i + 1 : len(ls) - 1]:
                if "set subnet" in later:
                    ip = later.replace("set subnet ", "", 1).replace(" 255.255.255.255", "", 1).strip()
                if "set fqdn" in later:
                    ip = value(later, "set fqdn ")
                if "next" in later:
                    break
            expected.append((f, ip, re.search('".*"', line).group().replace('"', "")))
    got = [(r.file, r.ip, r.hostName) for r in blocks.deny_list(lines).collect()]
    key = lambda r: tuple(x or "" for x in r)
    assert sorted(got, key=key) == sorted(expected, key=key) and len(expected) > 50


def test_per_entry_records(spark):
    text = """config system dhcp server
    set interface "lan"
    config reserved-address
        edit 1
            set mac 00:00:00:00:00:01
            set action block
            set description "friend"
        next
        edit 2
            set mac 00:00:00:00:00:02
            set action block
        next
    end
end""".split("\n")
    df = spark.createDataFrame([("f", i, l) for i, l in enumerate(text)], "f string, i long, l string")
    lines = lines_of_table(df, F.col("f"), F.col("i"), F.col("l"), chunk_lines=4)
    got = {tuple(r) for r in blocks.blocked_macs(lines, per_entry=True).collect()}
    assert got == {("f", "00:00:00:00:00:01", "block", "friend", "lan"), ("f", "00:00:00:00:00:02", "block", None, "lan")}
    # "friend" ends the block in the default reading, before the second entry
    assert {r.macAddress for r in blocks.blocked_macs(lines).collect()} == {"00:00:00:00:00:01"}


def test_deny_networks(spark):
    df = spark.createDataFrame([("10.0.1.0 255.255.255.0", "n"), ("1.2.3.4", "h"), ("x.example.com", "d")], "ip string, hostName string")
    got = {tuple(r) for r in blocks.deny_networks(df).collect()}
    assert got == {("n", number("10.0.1.0"), number("10.0.1.255")), ("h", number("1.2.3.4"), number("1.2.3.4"))}

"""Reports read by their ``id`` elements against a parser of whole documents, with splits anywhere."""

import random
from collections import Counter
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pytest
from pyspark.sql import functions as F

from netaudit import constants as C
from netaudit.sources import xmlreports

NAMES = ["Dev", "IP", "Note", "A.b", "x-y"]


def value(rng):
    text = escape("".join(rng.choice(["a", "é", "日本", "<", "&", " ", "\n", '"', "'", ">", "]]", "1.2.3.4"]) for _ in range(rng.randrange(6))))
    return text.replace("é", rng.choice(["é", "&#233;", "&#xE9;"])).replace("日本", rng.choice(["日本", "&#x65E5;本"]))


def child(rng, depth=0):
    name = rng.choice(NAMES) + ("" if depth == 0 else "in")
    kind = rng.randrange(8)
    if kind == 0:
        return f"<{name}/>"
    if kind == 1:
        return f'<{name} at="a&lt;/{name}b" c=\'2\'>{value(rng)}</{name}>'
    if kind == 2 and depth == 0:
        return f"<{name}>{value(rng)}{child(rng, 1)}{value(rng)}</{name}>"
    return f"<{name}>{value(rng)}</{name}>"


def ident(rng):
    if rng.random() < 0.05:
        return rng.choice(["<id/>", "<id></id>", '<id a="1" />'])
    return rng.choice(["<id>", '<id n="x">', "\n <id>"]) + "\n".join(child(rng) for _ in range(rng.randrange(5))) + "</id>"


def table(rng, n):
    if rng.random() < 0.2:
        return f'<table name="{C.TRAFFIC_SUMMARY}">' + "".join(child(rng) for _ in range(rng.randrange(4))) + "</table>"
    name = rng.choice(["T1", "T & 2", "表 3", C.TOP_DESTINATIONS])
    if rng.random() < 0.1:
        return f"<table name={quoteattr(name)}/>"
    rows = [ident(rng) for _ in range(rng.randrange(n))]
    if rng.random() < 0.3:
        rows = ["<rows>", *rows, "</rows><!-- <table name='no'> <id>no -->"]
    return f"<table kind='k' name={quoteattr(name)}>" + "".join(rows) + "</table >"


def report(rng, tables, n):
    loose = ["<id><Dev>outside</Dev></id>"] * rng.randrange(2)
    return "<?xml version='1.0'?>\n<r>" + "".join([*loose, *(table(rng, n) for _ in range(tables)), *loose]) + "</r>\n"


def users(rng, sections, n):
    out = []
    for i in range(sections):
        name = quoteattr(f"{i}: 10.0.0.{i} a&b Usage: {i} GB")
        out.append(f"<{C.USER_SECTION} name={name}>" + "".join(table(rng, n) for _ in range(rng.randrange(4))) + f"</{C.USER_SECTION}>")
        out += [table(rng, 3)] * (rng.random() < 0.3)
    return "<r>" + "".join(out) + "</r>"


def cells(element):
    names = [c.tag for c in element]
    out = {}
    for i, c in enumerate(element):
        key = c.tag if names.count(c.tag) == 1 else f"{c.tag}{names[: i + 1].count(c.tag)}"
        out.setdefault(key, "".join(c.itertext()))
    return out


def tables_of(root):
    for t in root.iter("table"):
        if t.get("name") == C.TRAFFIC_SUMMARY:
            yield t.get("name"), cells(t)
        else:
            for row in t.iter("id"):
                yield t.get("name"), cells(row)


def by_hand(files):
    for name, body in files.items():
        root = ElementTree.fromstring(body)
        if name != C.USER_REPORT:
            yield from ((name, t, tuple(sorted(c.items()))) for t, c in tables_of(root))
            continue
        for section in root.iter(C.USER_SECTION):
            for t, c in tables_of(section):
                if t == C.TRAFFIC_SUMMARY:
                    yield name, "trafficSummary", tuple(sorted(c.items()))
                elif t == C.TOP_DESTINATIONS:
                    yield name, "top10Destinations", tuple(sorted((c | {"rank": section.get("name")}).items()))


@pytest.mark.parametrize("split", ["64", "1000", "128m"])
def test_rows_equal_those_of_a_parser(spark, tmp_path, split):
    rng = random.Random(3)
    files = {name: report(rng, 12, 9) for name in C.REPORT_NAMES if name != C.USER_REPORT} | {C.USER_REPORT: users(rng, 12, 6)}
    files["Other Thing"] = report(rng, 2, 3)
    for name, body in files.items():
        (tmp_path / f"{name}-2025-01-02_1234.xml").write_text(body)
    del files["Other Thing"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = xmlreports.read_reports(spark, str(tmp_path)).select("report", "table", "cells", "place").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = list(by_hand(files))
    assert Counter((r.report, r.table, tuple(sorted(r.cells.items()))) for r in rows) == Counter(want) and len(want) > 150
    for name in C.REPORT_NAMES:
        ordered = [(r.report, r.table, tuple(sorted(r.cells.items()))) for r in sorted(rows, key=lambda r: r.place) if r.report == name]
        assert ordered == [w for w in want if w[0] == name]


def test_one_table_of_many_rows_is_read_by_many_tasks(spark, tmp_path):
    with open(tmp_path / f"{C.TERMINALS_VPN}-2025-01-02_1234.xml", "w") as out:
        out.write(f'<r><table name="{C.TERMINAL_TABLE}">')
        out.writelines(f"<id><N>{i}</N><M>text {i % 7} &amp; more</M></id>" for i in range(1_000_000))
        out.write("</table></r>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        rows = xmlreports.read_reports(spark, str(tmp_path))
        assert xmlreports.read_id_rows(spark, str(tmp_path)).select("place.n").distinct().count() > 8
        found = rows.select("table", F.col("cells")["N"].cast("long").alias("n"), F.length(F.col("cells")["M"]).alias("m"))
        assert tuple(found.agg(F.count("*"), F.sum("n"), F.sum("m"), F.countDistinct("table"), F.countDistinct("n")).first()) == (10**6, 10**6 * (10**6 - 1) // 2, 13 * 10**6, 1, 10**6)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_windows_run_inside_blocks_of_a_split(spark, tmp_path, monkeypatch):
    """The table's name is carried over blocks; no window holds a whole split."""
    monkeypatch.setattr(xmlreports, "BLOCK_BITS", 4)
    held = []
    scan = xmlreports.ordered_scan
    monkeypatch.setattr(xmlreports, "ordered_scan", lambda df, within, levels, *a, **k: held.append(df.groupBy(*within, *levels).count().agg({"count": "max"}).first()[0]) or scan(df, within, levels, *a, **k))
    rows = "".join(f"<id><Key>{i}</Key></id>" for i in range(500))
    (tmp_path / f"{C.TERMINALS_VPN}-1999-08-01_1234.xml").write_text(f'<r><table name="T1">{rows}</table><table name="T2">{rows}</table></r>')
    found = xmlreports.read_reports(spark, str(tmp_path)).select("table", F.col("cells")["Key"].cast("int").alias("key")).collect()
    assert sorted(map(tuple, found)) == sorted((t, i) for t in ("T1", "T2") for i in range(500))
    assert held and held[0] <= 16


def test_rows_of_reports_are_read_in_one_pass(spark, tmp_path):
    """Reports of users and the others in one reading of the parsed rows, next to that of the chunks' summaries."""
    rng = random.Random(4)
    for name in C.REPORT_NAMES:
        (tmp_path / f"{name}-2025-01-02_1234.xml").write_text(users(rng, 3, 2) if name == C.USER_REPORT else report(rng, 3, 2))
    plan = xmlreports.read_reports(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    # Levels of summaries read the states of the rows, not the rows.
    assert sum("Relation [" in line and "rows#" in line for line in plan.split("\n")) <= 3
    assert "Union" not in plan


def test_cells_of_an_element_are_cut_once(spark):
    """No search for children stands in a function that is run for each of them."""
    plan = spark.createDataFrame([("<a>1</a><b>x &amp; y</b><a>2</a>",)], "x string").select(xmlreports.child_cells(F.col("x")).alias("cells"))
    assert plan.first().cells == {"a1": "1", "b": "x & y", "a2": "2"}
    text = plan._jdf.queryExecution().analyzed().toString()
    assert text.count("regexp_extract_all(") <= 2 + 1

"""Device register, identity relation and enriched reports on small hand-made inputs."""

import pytest
from pyspark.sql import functions as F

from netaudit import constants as C
from netaudit.operators import shaping
from netaudit.plans import devices, identity, reports
from netaudit.sources.registers import DEVICE_COLUMNS, sequence

DEVICE = "ip string, hostName string, user string, description string, macAddress string"
MAC = "00:11:22:33:44:55"


def rows(df):
    return sorted((tuple(r) for r in df.select(*DEVICE_COLUMNS).collect()), key=str)


def expect(*items):
    return sorted(items, key=str)


def with_seq(df):
    return df.withColumn("seq", sequence(0, F.lit("f"), F.lit(0), F.monotonically_increasing_id()))


def assets(spark, *items):
    df = spark.createDataFrame([(u, d, k, i) for i, (u, d, k) in enumerate(items)], "user string, description string, key string, i int")
    return df.withColumn("seq", sequence(0, F.lit("f"), F.lit(0), F.col("i"))).drop("i")


def test_first_register_wins_and_null_ips_are_one_group(spark):
    static = with_seq(spark.createDataFrame([("1.1.1.1", "s", "u", "d")], "ip string, hostName string, user string, description string"))
    lease = with_seq(spark.createDataFrame([("1.1.1.1", "l", MAC), ("2.2.2.2", "l", MAC)], "ip string, hostName string, macAddress string"))
    deny = with_seq(spark.createDataFrame([("2.2.2.2", "b"), (None, "n1"), (None, "n2")], "ip string, hostName string").coalesce(1))
    allow = with_seq(spark.createDataFrame([("x.example.com", "w"), ("127.0.0.1", "first")], "ip string, hostName string"))
    got = rows(devices.first_per_ip(devices.union_registers(static, lease, deny, allow)))
    assert got == expect(
        ("1.1.1.1", "s", "u", "d", None), ("2.2.2.2", "l", None, None, MAC), (None, "n1", None, None, None),
        ("x.example.com", "w", None, None, None), ("127.0.0.1", "first", None, None, None),
    )


def test_owners(spark):
    register = assets(
        spark, ("ann", "A", "pc-1"), ("bob", "B", "pc-2-nb"), ("eve", "E", "pc-2-xx"), (None, "N", "pc-3"), ("kim", "K", "pc-3-b"),
        ("dup", "D", "pc-1"), ("nul", "L", None),
    )
    found = spark.createDataFrame(
        [("1", "PC-1", "x", "x", MAC), ("2", "pc-2", None, None, MAC), ("3", "Pc-3", None, None, MAC), ("4", "pc.2", None, None, MAC),
         ("5", None, None, None, MAC), ("6", C.BLANK_HOST, None, None, MAC), ("7", "srv", "keep", "k", None), ("8", None, "gone", "k", None),
         ("9", "pc-9", None, None, MAC)], DEVICE,
    )
    got = rows(devices.with_owners(found, register))
    assert got == expect(
        ("1", "PC-1", "ann", "A", MAC), ("1", "PC-1", "dup", "D", MAC),
        ("2", "pc-2", "bob", "B", MAC),
        ("3", "Pc-3", None, "N", MAC),  # the first asset that begins with it has no user either
        ("4", "pc.2", "bob", "B", MAC),  # the dot matches the dash
        ("5", None, None, None, MAC),  # a nameless host has no owner
        ("6", C.BLANK_HOST, C.BLANK_HOST, None, MAC),
        ("7", "srv", "keep", "k", None), ("8", None, None, "k", None),
        ("9", "pc-9", None, None, MAC),
    )
    literal = {r.ip: r.user for r in devices.with_owners(found, register, literal=True).collect()}
    assert literal["4"] is None
    paired = {(r.ip, r.user, r.description) for r in devices.with_owners(found, register, pair_nameless=True).collect()}
    # Nameless hosts then meet nameless assets, but lose the user.
    assert ("5", None, "L") in paired and ("5", None, None) not in paired
    alone = {(r.ip, r.user, r.description) for r in devices.with_owners(found, assets(spark, ("ann", "A", "pc-1")), pair_nameless=True).collect()}
    assert ("5", None, None) in alone


@pytest.fixture(scope="module")
def audit(spark):
    register = spark.createDataFrame(
        [("10.0.0.1", "a", "u", "d", None), ("10.0.0.2", "b", None, None, MAC), ("10.0.0.3", None, None, None, MAC),
         ("10.0.0.3", C.VPN_HOST, "v", None, None), ("10.0.0.4", C.VPN_HOST, "v1", None, None), ("10.0.0.4", C.VPN_HOST, "v2", None, None),
         ("20.0.0.1", None, "w", "k", None), ("20.0.0.1", C.VPN_HOST, "v", None, None), ("example.com", "site", None, "t", None),
         ("le.com", "later", None, None, None), ("cdn.example.com", "cdn", None, None, MAC), (None, "n", None, None, None)], DEVICE,
    )
    keys = spark.createDataFrame([(k,) for k in [
        "10.0.0.1", "10.0.0.2", "10.0.0.3", "10.0.0.4", "10.0.0.5", "20.0.0.1", "20.0.0.2", "30.0.0.1", "999.1.1.1",
        "www.example.com", "notexample.com", "examplexcom", "cdn.example.com", "other.org"]], "ip string")
    ten = 10 << 24
    ranges = spark.createDataFrame([("lan", ten + 2, ten + 5), ("wifi", ten + 3, ten + 3)], "interface string, lo long, hi long")
    networks = with_seq(spark.createDataFrame([("half", "20.0.0.0/9"), ("all", "20.0.0.0/8"), ("ten", "10.0.0.0/8")], "User string, cidr string").coalesce(1))
    return keys, register, ranges, networks


EXPECTED = [
    ("10.0.0.1", "a", "u", "d", None),
    ("10.0.0.2", "b", C.UNREGISTERED, None, MAC),
    # nameless in two ranges: once per range, and the other row of the address is dropped
    ("10.0.0.3", C.BLANK_HOST, C.BLANK_HOST, None, MAC), ("10.0.0.3", C.BLANK_HOST, C.BLANK_HOST, None, MAC),
    ("10.0.0.4", C.VPN_HOST, "v1", None, None), ("10.0.0.4", C.VPN_HOST, "v2", None, None),
    ("10.0.0.5", C.RELEASED, C.RELEASED, None, None),
    # the network's name replaces the host of all rows of a nameless address
    ("20.0.0.1", "half", "w", "k", None), ("20.0.0.1", "half", "v", None, None),
    ("20.0.0.2", "half", None, None, None),
    ("30.0.0.1", None, None, None, None), ("999.1.1.1", None, None, None, None),
    ("www.example.com", "site", None, "t", None), ("notexample.com", "site", None, "t", None),
    ("examplexcom", "site", None, "t", None), ("cdn.example.com", "cdn", C.UNREGISTERED, None, MAC),
    ("other.org", None, None, None, None),
]


def test_identity_relation(audit):
    assert rows(identity.identity_relation(*audit)) == expect(*EXPECTED)


def test_one_pass_equals_the_steps(audit):
    keys, register, ranges, networks = audit
    joined = identity.address_identities(keys, register).unionByName(
        identity.domain_identities(keys, register).select(*DEVICE_COLUMNS)
    )
    labelled = identity.with_unregistered(identity.with_released(joined, ranges))
    steps = identity.with_network_hosts(labelled, identity.nameless_networks(labelled, networks))
    assert rows(steps) == expect(*EXPECTED)


def test_no_key_is_lost(audit):
    keys = audit[0]
    assert {r.ip for r in identity.identity_relation(*audit).collect()} == {r.ip for r in keys.collect()}


def test_keys_of_cells(spark):
    cells = [{"a": "1234.1.1.1", "b": "x 10.0.0.1 y"}, {"a": "see WWW.example.com and b.org", "b": None}, {"a": "10.0.0.2"}]
    df = spark.createDataFrame([(c,) for c in cells], "cells map<string,string>")
    assert {r.ip for r in identity.report_keys(df).collect()} == {"234.1.1.1", "10.0.0.2", ".example.com"}
    assert "10.0.0.1" in {r.ip for r in identity.report_keys(df, anywhere=True).collect()}


LONG = "report string, table string, place long, cells map<string,string>"
DEVICE_TABLE = reports.DEVICE.table


def enriched(spark, identities, *items):
    df = spark.createDataFrame([(r, t, i, c) for i, (r, t, c) in enumerate(items)], LONG)
    shaped = reports.shape(reports.enrich(df, identities))
    return sorted(((r.place, r.cells) for r in shaped.collect()), key=str)


@pytest.fixture(scope="module")
def identities(spark):
    return spark.createDataFrame(EXPECTED, DEVICE)


def test_enrichment(spark, identities):
    got = enriched(
        spark, identities,
        (C.ADMIN_EVENTS, "Login Summary", {"Login_Interface": "ssh(10.0.0.1)", "n": "1"}),
        (C.BANDWIDTH_REPORT, "Top 30 Users by Bandwidth and Sessions", {"User_or_IP_": "10.0.0.4"}),
        (C.BANDWIDTH_REPORT, "Traffic Statistics", {"Summary": "x"}),
        (C.USER_REPORT, "top10Destinations", {"rank": "1: 10.0.0.2 u Usage: 1.2 GB", "Destination": "www.example.com", "Bytes": "5", "drop": "x"}),
        (C.USER_REPORT, "top10Destinations", {"rank": "2: nobody", "Destination": "30.0.0.1"}),
    )
    assert got == [
        (0, {"Login_Interface": "ssh(10.0.0.1)", "n": "1", "ip": "10.0.0.1", "hostName": "a", "user": "u", "description": "d"}),
        (1, {"User_or_IP_": "10.0.0.4", "hostName": C.VPN_HOST, "user": "v1"}),
        (1, {"User_or_IP_": "10.0.0.4", "hostName": C.VPN_HOST, "user": "v2"}),
        (2, {"Summary": "x"}),
        (3, {"Destination": "www.example.com", "Bytes": "5", "destinationHost": "site", "ip": "10.0.0.2", "usage": "1.2 GB", "rank": "1",
             "hostName": "b", "user": C.UNREGISTERED, "macAddress": MAC}),
        (4, {"Destination": "30.0.0.1", "rank": "2"}),
    ]


def test_destinations_have_one_size_and_all_columns(spark, identities):
    whole = {"rank": "1: 10.0.0.2 u Usage: 1.2 GB", "Destination": "www.example.com", "Application": "HTTPS"}
    got = enriched(
        spark, identities, (C.USER_REPORT, "top10Destinations", {**whole, "Bandwidth": "5 MB", "Bytes": "5"}),
        (C.USER_REPORT, "top10Destinations", {**whole, "Bytes": "6"}),
    )
    assert [(c.get("Bandwidth"), c.get("Bytes")) for _, c in got] == [("5 MB", None), (None, None)]
    shaped = spark.createDataFrame(
        [(C.USER_REPORT, "top10Destinations", i, {**dict.fromkeys(reports.REQUIRED_COLUMNS, "x"), "Bytes": "5"}) for i in range(3)],
        "report string, table string, place int, cells map<string,string>",
    )
    reports.check_destinations(shaped)
    reports.check_destinations(shaped.limit(0))
    for lost in ("macAddress", "Bytes"):
        with pytest.raises(ValueError, match=lost):
            reports.check_destinations(shaped.withColumn("cells", F.map_filter("cells", lambda k, _: k != lost)))


def test_device_table_is_read_by_its_plain_column_if_it_has_one(spark, identities):
    second = (C.CLIENT_REPUTATION, DEVICE_TABLE, {"Device1": "x", "Device2": "10.0.0.1"})
    plain = (C.CLIENT_REPUTATION, DEVICE_TABLE, {"Device": "10.0.0.2"})
    assert [c.get("hostName") for _, c in enriched(spark, identities, second)] == ["a"]
    assert [c.get("hostName") for _, c in enriched(spark, identities, second, plain)] == [None, "b"]


def test_shape_drops_filter_rows_and_repeats(spark, identities):
    got = enriched(
        spark, identities,
        (C.CLIENT_REPUTATION, C.REPORT_FILTERS, {"Filter_name": "srcip"}),
        (C.CLIENT_REPUTATION, C.REPORT_FILTERS, {"Filter_name": "dstip"}),
        (C.CLIENT_REPUTATION, C.REPORT_FILTERS, {"other": "x"}),
        (C.TERMINALS_VPN, C.TERMINAL_TABLE, {"User_or_IP_": "10.0.0.1"}),
        (C.TERMINALS_VPN, C.TERMINAL_TABLE, {"User_or_IP_": "10.0.0.1"}),
        (C.TERMINALS_VPN, C.TERMINAL_TABLE, {"User_or_IP_": "10.0.0.3"}),
    )
    assert [(p, c.get("Filter_name"), c.get("User_or_IP_")) for p, c in got] == [(1, "dstip", None), (3, None, "10.0.0.1"), (5, None, "10.0.0.3")]


def test_column_choice(spark):
    df = spark.createDataFrame([(None, 1, "x")], "a string, b int, Bytes string")
    assert shaping.drop_null_columns(df).columns == ["b", "Bytes"]
    assert shaping.drop_null_columns(df.limit(0)).columns == []
    assert shaping.with_bandwidth(df).columns == ["a", "b", "Bandwidth"]
    assert shaping.size_column(df.withColumn("Bandwidth", F.lit("y"))) == "Bandwidth"
    with pytest.raises(ValueError):
        shaping.size_column(df.drop("Bytes"))


def broadcast_joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    return [line for line in plan if "BroadcastHashJoin" in line and "LeftSemi" not in line]


def test_what_grows_with_the_data_is_not_broadcast(spark, audit):
    """Small as these tables are, addresses, their register rows and identities are merged; lengths of keys and sizes of blocks are broadcast."""
    keys, register, ranges, networks = audit
    found = identity.identity_relation(keys, register, ranges, networks)
    assert [line for line in broadcast_joins(found) if "bits" in line or "[ip#" in line.split("BroadcastHashJoin")[1][:8]] == []
    report_rows = spark.createDataFrame([("r", 1, {"a": "10.0.0.1"})], "report string, place long, cells map<string,string>")
    assert broadcast_joins(reports.left_join_identity(report_rows, F.col("cells")["a"], found, ["hostName"]).select("_hostName")) == broadcast_joins(found)
    owned = devices.with_owners(register, assets(spark, ("ann", "A", "pc-1")))
    assert not any("hostName" in line for line in broadcast_joins(owned))


def test_domains_of_the_register_are_read_apart(spark, audit, monkeypatch):
    """The suffix match reads its register several times; it is given the domains alone, written out."""
    given = []
    match = identity.first_suffix_match
    monkeypatch.setattr(identity, "first_suffix_match", lambda probes, probe, register, *rest: given.append(register) or match(probes, probe, register, *rest))
    identity.identity_relation(*audit)
    [entries] = given
    assert entries.count() == 3 and len(entries.inputFiles()) > 0
    [read] = [spark.read.parquet(*entries.inputFiles())]
    assert read.filter("ip like '10.%'").isEmpty()

"""First-match joins against loops over all pairs."""

import ipaddress
import random
import re

import pytest
from pyspark.sql import functions as F

from netaudit.operators import matchjoin


def word(rng, letters, low, high):
    return "".join(rng.choice(letters) for _ in range(rng.randrange(low, high)))


@pytest.fixture(scope="module")
def words(spark):
    rng = random.Random(7)
    patterns = sorted({word(rng, "ab.-", 1, 6) for _ in range(120)})
    texts = [(word(rng, "abc.-", 0, 9), i, f"u{i}") for i in range(300)] + [(None, 900, "none")]
    p = spark.createDataFrame([(x,) for x in patterns], "p string").unionByName(spark.createDataFrame([(None,)], "p string"))
    return patterns, texts, p, spark.createDataFrame(texts, "t string, seq int, u string")


def as_pattern(text, literal):
    return re.escape(text) if literal else text.replace("-", r"\-")


@pytest.mark.parametrize("literal", [False, True])
def test_first_prefix(words, literal):
    patterns, texts, p, t = words
    expected = {}
    for x in patterns:
        for text, _, user in texts:
            if text is not None and re.match(as_pattern(x, literal), text):
                expected[x] = user
                break
    got = {r.p: r.match.u for r in matchjoin.first_prefix_match(p, "p", t, "t", "seq", ["u"], literal).collect()}
    assert got == expected and len(expected) > 20


@pytest.mark.parametrize("literal", [False, True])
def test_first_suffix(words, literal):
    patterns, texts, p, t = words
    expected = {}
    for text in {x for x, _, _ in texts if x is not None}:
        for x in patterns:
            if re.search(as_pattern(x, literal) + "$", text):
                expected[text] = x
                break
    register = p.withColumn("order", F.col("p")).withColumn("name", F.col("p"))
    got = {r.t: r.match.name for r in matchjoin.first_suffix_match(t, "t", register, "p", "order", ["name"], literal).collect()}
    assert got == expected and len(expected) > 50


def test_empty_suffix_pattern_matches_all(spark):
    register = spark.createDataFrame([("", "any"), ("b", "b")], "p string, name string")
    t = spark.createDataFrame([("a",), ("ab",)], "t string")
    got = {r.t: r.match.name for r in matchjoin.first_suffix_match(t, "t", register, "p", "p", ["name"]).collect()}
    assert got == {"a": "any", "ab": "any"}


def test_other_pattern_characters_are_read_unless_literal(spark):
    register = spark.createDataFrame([("pc(1)-nb", 1, "x"), ("pc1-nb", 2, "y")], "t string, seq int, u string")
    hosts = spark.createDataFrame([("pc(1)",)], "h string")
    for literal, user in ((False, "y"), (True, "x")):
        got = [r.match.u for r in matchjoin.first_prefix_match(hosts, "h", register, "t", "seq", ["u"], literal).collect()]
        assert got == [user]


@pytest.fixture(scope="module")
def addresses(spark):
    texts = [str(ipaddress.ip_address(x)) for x in [*range(0, 4000, 3), 2**32 - 1, 10 << 24, (10 << 24) + 77, 3 << 30]]
    odd = ["01.2.3.4", "256.1.1.1", "x.example.com", "1.2.3", ""]
    return texts, spark.createDataFrame([(x,) for x in texts + odd], "ip string")


def number(ip):
    return int(ipaddress.ip_address(ip))


def test_range_hits(spark, addresses):
    texts, ips = addresses
    rng = random.Random(3)
    ranges = [(i, a, a + rng.choice([0, 1, 5, 100, 700])) for i, a in enumerate(rng.randrange(0, 3000) for _ in range(60))]
    ranges += [(99, 0, 2**32 - 1), (98, 5, 4)]
    df = spark.createDataFrame(ranges, "id int, lo long, hi long")
    got = sorted((r.ip, r.id) for r in matchjoin.range_hits(ips, df, ["id"]).collect())
    assert got == sorted((ip, i) for ip in texts for i, lo, hi in ranges if lo <= number(ip) <= hi)


def test_range_cover_is_exact_and_small(spark):
    rng = random.Random(9)
    ranges = [(lo, lo + rng.randrange(0, 1 << rng.randrange(1, 33)) % (2**32 - lo)) for lo in (rng.randrange(0, 2**32) for _ in range(200))]
    rows = spark.createDataFrame(ranges, "lo long, hi long").withColumn(
        "blocks", matchjoin.range_blocks(F.col("lo"), F.col("hi"))
    ).collect()
    for row in rows:
        spans = sorted((b.block << b.bits, ((b.block + 1) << b.bits) - 1) for b in row.blocks)
        assert spans[0][0] == row.lo and spans[-1][1] == row.hi
        assert all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))
        assert sum(b.bits < matchjoin.LARGEST_BLOCK for b in row.blocks) <= 2 * matchjoin.LARGEST_BLOCK


NETWORKS = [
    "10.0.0.0/8", "10.0.0.64/26", "0.0.0.0/0", "0.0.0.0/22", "0.0.8.0/24", "192.0.0.0/2", "0.0.1.1/24", "nonsense", "1.2.3.4",
    "0.0.2.0/23", "300.0.0.0/8", "0.0.0.0/33",
]


@pytest.mark.parametrize("span", [False, True])
def test_first_network(spark, addresses, span):
    texts, ips = addresses
    rng = random.Random(1)
    listed = [(f"n{i}", c, i) for i, c in enumerate(rng.sample(NETWORKS, len(NETWORKS)))]
    df = spark.createDataFrame(listed, "name string, cidr string, seq int")
    expected = {}
    for ip in texts:
        for name, cidr, _ in listed:
            try:
                network = ipaddress.ip_network(cidr) if "/" in cidr else None
            except ValueError:
                continue
            if network is None or not span and ip.split(".")[0] != cidr.split(".")[0]:
                continue
            if ipaddress.ip_address(ip) in network:
                expected[ip] = name
                break
    got = {r.ip: r.name for r in matchjoin.first_network_match(ips, df, "seq", "name", span=span).collect()}
    assert got == expected
    dropped = {r.cidr for r in matchjoin.invalid_networks(df).collect()}
    assert dropped == {"0.0.1.1/24", "nonsense", "1.2.3.4", "300.0.0.0/8", "0.0.0.0/33"}


def test_mac_search(spark):
    lines = ["aabbcc-ddeeff up", "xaabbcc-ddeeff-001122 x", "aabbcc-ddeef", "AABBCC-DDEEFF", "aabbcc-ddeeff aabbcc-ddeeff", "none"]
    macs = ["aabbcc-ddeeff", "ddeeff-001122", "001122-334455", "aabbcc-ddeeff"]
    df = spark.createDataFrame([("f", i, l) for i, l in enumerate(lines)], "file string, pos int, line string")
    m = spark.createDataFrame([(x,) for x in macs], "mac string")
    got = sorted((r.mac, r.line) for r in matchjoin.mac_search(df, m).collect())
    assert got == sorted((mac, line) for mac in set(macs) for line in lines if mac in line)


def test_mac_tokens_of_any_line(spark):
    rng = random.Random(9)
    lines = ["".join(rng.choice(["a", "B", "7", "-", "-", " ", "ä", "𝒳", "abcdef", "012345"]) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    df = spark.createDataFrame([(x,) for x in [*lines, None]], "line string").coalesce(2)
    places = {line: [line[i : i + 13] for i in range(len(line)) if re.match("[0-9A-Za-z]{6}-[0-9A-Za-z]{6}", line[i:])] for line in lines}
    got = {r.line: r.tokens for r in df.select("line", matchjoin.mac_tokens(F.col("line")).alias("tokens")).collect()}
    assert got == {line: list(dict.fromkeys(found)) if "-" in line else None for line, found in places.items()} | {None: None}
    assert sum(map(len, places.values())) > 100


def test_macs_are_not_repeated_more_on_more_partitions(spark):
    """Partitions grow with the data as the MACs do; the repeats would grow with the square."""
    lines = spark.range(10).select(F.lit("f").alias("file"), F.col("id").alias("pos"), F.lit("aabbcc-000001").alias("line"))
    macs = spark.createDataFrame([("aabbcc-000001",)], "mac string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    repeats = []
    for partitions in ("4", "800"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            repeats += re.findall(r"sequence\(0, (\d+)", matchjoin.mac_search(lines, macs)._jdf.queryExecution().analyzed().toString())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert repeats == ["15", "15"]


def test_repeated_lookups_are_not_broadcast(spark):
    """Rows that a lookup is repeated to are not seen by Spark's size check, so it must not decide."""
    lines = spark.range(10).select(F.lit("f").alias("file"), F.col("id").alias("pos"), F.lit("aabbcc-000001").alias("line"))
    macs = spark.range(10).select(F.concat(F.lit("aabbcc-"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("mac"))
    found = matchjoin.mac_search(lines, macs)
    assert len(found.collect()) == 10
    assert "BroadcastExchange" not in found._jdf.queryExecution().executedPlan().toString()

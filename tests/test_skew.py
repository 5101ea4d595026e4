"""A third of the rows on one key: the work of the joins still spreads over tasks."""

import pytest
from pyspark.sql import functions as F

from netaudit import constants as C
from netaudit.operators import blocks, matchjoin
from netaudit.plans import devices, reports, vpn
from netaudit.registry.inputs import at, ip10, mac_of
from netaudit.sources import registers

ROWS = 300_000
SETTINGS = {
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    # Sizes of a cluster, scaled down with the rows.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(scope="module")
def cluster_like(spark):
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def largest_share(df) -> float:
    # The hash keeps all columns in the shuffled rows.
    whole = F.max(F.xxhash64(*[F.to_json(c) if t.startswith("map") else F.col(c) for c, t in df.dtypes]))
    counts = [r.n for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), whole).collect()]
    assert sum(counts) >= ROWS
    return max(counts) / sum(counts)


def key():
    return F.col("id")


def test_one_address_in_a_third_of_the_report_rows(cluster_like):
    hot = F.when(key() % 3 == 0, 7).otherwise(key())
    rows = cluster_like.range(ROWS).select(
        F.lit(C.TERMINALS_VPN).alias("report"), F.lit(C.TERMINAL_TABLE).alias("table"), key().alias("place"),
        F.create_map(F.lit("User_or_IP_"), ip10(hot), F.lit("note"), F.sha2(key().cast("string"), 256)).alias("cells"),
    )
    identities = cluster_like.range(ROWS).select(
        ip10(key()).alias("ip"), F.lit("h").alias("hostName"), F.lit("u").alias("user"), F.lit("d").alias("description"), mac_of(key()).alias("macAddress")
    )
    assert largest_share(reports.enrich(rows, identities).select("cells")) < 0.2


def test_rows_without_address_do_not_meet(cluster_like):
    rows = cluster_like.range(ROWS).select(
        F.lit(C.TERMINALS_VPN).alias("report"), F.lit(C.TERMINAL_TABLE).alias("table"), key().alias("place"),
        F.create_map(F.lit("note"), F.sha2(key().cast("string"), 256)).alias("cells"),
    )
    identities = cluster_like.createDataFrame([("10.0.0.1", "h", "u", "d", "m")], "ip string, hostName string, user string, description string, macAddress string")
    assert largest_share(reports.enrich(rows, identities).select("cells")) < 0.2


def test_one_host_name_in_a_third_of_the_leases(cluster_like):
    leases = cluster_like.range(ROWS).select(
        ip10(key()).alias("ip"), F.when(key() % 3 == 0, "pc-7").otherwise(F.concat(F.lit("pc-"), key())).alias("hostName"),
        F.lit(None).cast("string").alias("user"), F.lit(None).cast("string").alias("description"), F.sha2(key().cast("string"), 256).alias("macAddress"),
    )
    assets = cluster_like.range(1000).select(F.lit("u").alias("user"), F.lit("d").alias("description"), F.concat(F.lit("pc-"), key()).alias("key"), at(key()))
    assert largest_share(devices.with_owners(leases, assets).select("ip", "macAddress")) < 0.2


def test_one_network_holds_all_addresses(cluster_like):
    ips = cluster_like.range(ROWS).select(ip10(key() * 50).alias("ip"))
    ranges = cluster_like.createDataFrame([(10 << 24, (11 << 24) - 1)], "lo long, hi long")
    assert largest_share(matchjoin.range_hits(ips, ranges, [])) < 0.3


def test_one_mac_in_a_third_of_the_lines(cluster_like):
    digits = F.when(key() % 3 == 0, "000001").otherwise(F.lpad((key() % 3000).cast("string"), 6, "0"))
    lines = cluster_like.range(ROWS).select(F.lit("f").alias("file"), key().alias("pos"), F.concat(F.lit("aabbcc-"), digits).alias("line"))
    macs = cluster_like.range(3000).select(F.concat(F.lit("aabbcc-"), F.lpad(key().cast("string"), 6, "0")).alias("mac"))
    assert largest_share(matchjoin.mac_search(lines, macs)) < 0.2


def test_one_domain_ends_all_others(cluster_like):
    domains = cluster_like.range(ROWS).select(F.concat(F.lit("h"), key(), F.lit(".example.com")).alias("ip"))
    entries = cluster_like.createDataFrame([("com",), ("example.org",)], "p string").withColumn("key", F.reverse("p"))
    texts = domains.withColumn("reversed", F.reverse("ip"))
    reached = matchjoin.prefix_keys(texts, "reversed", entries, "key", False)
    assert largest_share(matchjoin.salted_join(reached, entries, "key", ["ip"])) < 0.2


def test_one_lease_file(cluster_like):
    cells = cluster_like.range(ROWS).select(
        F.lit("one").alias("file"), F.floor(key() / 1000).alias("chunk"), key().alias("pos"), F.array(ip10(key()), F.lit("-"), mac_of(key()), F.lit("h")).alias("cells")
    )
    assert largest_share(registers.leases_of_cells(cells).select("ip", "macAddress")) < 0.2


def test_one_range_of_many_addresses(cluster_like):
    ranges = cluster_like.range(1).select(F.lit("lan").alias("interface"), F.lit(10 << 24).cast("long").alias("lo"), ((F.lit(10 << 24) + 2**22 - 1).cast("long")).alias("hi"))
    counts = [r.n for r in blocks.range_addresses(ranges).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(counts) == 2**22 and max(counts) < 2**22 / 4


def test_one_minute_of_all_logs(cluster_like):
    lines = cluster_like.range(ROWS).select(
        F.lit("a").alias("file"), F.floor(key() / 5000).alias("chunk"), key().alias("pos"),
        F.concat(F.lit("Jan 2 00:00:01 gw t: peer connected from "), ip10(key()), F.lit(" u")).alias("line"),
    )
    assert largest_share(vpn.vpn_sessions(lines, 1, chronological=True)) < 0.2

"""Device register: one row per address from all registers, with the owner of each host."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from netaudit.constants import BLANK_HOST, VPN_HOST, VPN_LOCAL_HOST
from netaudit.operators.matchjoin import SALTS, first_prefix_match
from netaudit.operators.positions import with_positions
from netaudit.session import checkpointed
from netaudit.sources.registers import DEVICE_COLUMNS, sequence

LOCALHOST_RANK = 4


def with_device_columns(df: DataFrame, *extra: str) -> DataFrame:
    missing = {name: F.lit(None).cast("string") for name in DEVICE_COLUMNS if name not in df.columns}
    return df.withColumns(missing).select(*DEVICE_COLUMNS, *extra)


def ranked(df: DataFrame, rank: int) -> DataFrame:
    return df.withColumn("seq", F.col("seq").withField("rank", F.lit(rank)))


def union_registers(static: DataFrame, leases: DataFrame, denied: DataFrame, allowed: DataFrame) -> DataFrame:
    """All registers and the localhost row, ordered by ``seq`` in this order of registers."""
    none = F.lit(0)
    localhost = static.sparkSession.range(1).select(
        F.lit("127.0.0.1").alias("ip"),
        F.lit("localhost").alias("hostName"),
        sequence(LOCALHOST_RANK, F.lit(""), none, none).alias("seq"),
    )
    parts = [ranked(df, rank) for rank, df in enumerate([static, leases, denied, allowed])] + [localhost]
    return reduce(DataFrame.unionByName, [with_device_columns(df, "seq") for df in parts])


def first_per_ip(devices: DataFrame) -> DataFrame:
    """The first row of each ip; rows without ip form one group."""
    rest = [name for name in devices.columns if name not in ("ip", "seq")]
    first = devices.groupBy("ip").agg(F.min_by(F.struct(*rest), "seq").alias("row"))
    return first.select("ip", "row.*").select(*[name for name in devices.columns if name != "seq"])


def host_owners(hosts: DataFrame, assets: DataFrame, literal: bool = False) -> DataFrame:
    """Owners of each distinct host name that is not null: ``hostName, user, description``.

    A host takes every asset of its lower-case name. Hosts still without user take the first
    asset whose name begins with the host's. The names are read once per kind of pattern, so they
    are written out first.
    """
    keys = checkpointed(hosts.filter(F.col("hostName").isNotNull()).select("hostName").distinct().withColumn("key", F.lower("hostName")))
    named = assets.filter(F.col("key").isNotNull()).select(F.col("key").alias("asset_key"), "user", "description")
    exact = keys.join(named, F.col("key") == F.col("asset_key"), "left").drop("asset_key")
    prefixed = first_prefix_match(
        keys, "key", assets.withColumnRenamed("key", "text"), "text", "seq", ["user", "description"], literal
    )
    both = exact.join(prefixed.hint("merge"), "key", "left")
    take = F.col("user").isNull() & F.col("match").isNotNull()
    return both.select(
        "hostName",
        F.when(take, F.col("match.user")).otherwise(F.col("user")).alias("user"),
        F.when(take, F.col("match.description")).otherwise(F.col("description")).alias("description"),
    )


def nameless_pairs(nameless: DataFrame, assets: DataFrame) -> DataFrame:
    """Every device without host name with every asset without name: rows grow with the product of both.

    Without such an asset a device keeps one row. Both sides are spread over salts.
    """
    owners = assets.filter(F.col("key").isNull()).select("description", F.pmod(F.xxhash64("seq"), F.lit(SALTS)).cast("int").alias("salt"))
    salted = nameless.drop("user", "description").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    some = owners.limit(1).select(F.lit(True).alias("some"))
    alone = nameless.join(F.broadcast(some), F.lit(True), "left_anti")
    return salted.join(owners, "salt").withColumn("user", F.lit(None).cast("string")).select(*DEVICE_COLUMNS).unionByName(alone.select(*DEVICE_COLUMNS))


def blank_host_user(host: Column, user: Column) -> Column:
    """The blank-host message as user; a missing host name also removes the user."""
    return F.when(host == BLANK_HOST, F.lit(BLANK_HOST)).when(host.isNotNull(), user)


def with_owners(devices: DataFrame, assets: DataFrame, literal: bool = False, pair_nameless: bool = False) -> DataFrame:
    """Devices with a MAC take their host's owners; the others keep user and description.

    A popular host name is one row on the owner side, so AQE can split its devices. A device
    without host name has no owner and keeps one row. With ``pair_nameless`` it meets every
    asset without name instead, which multiplies the two and serves only small registers.
    """
    private = devices.filter(F.col("macAddress").isNotNull()).select("ip", "hostName", "macAddress")
    owned = private.join(host_owners(private, assets, literal).hint("merge"), "hostName").select(*DEVICE_COLUMNS)
    nameless = with_device_columns(private.filter(F.col("hostName").isNull()))
    public = devices.filter(F.col("macAddress").isNull())
    both = owned.unionByName(nameless_pairs(nameless, assets) if pair_nameless else nameless).unionByName(public.select(*DEVICE_COLUMNS))
    return both.withColumn("user", blank_host_user(F.col("hostName"), F.col("user")))


def device_register(
    static: DataFrame,
    leases: DataFrame,
    denied: DataFrame,
    allowed: DataFrame,
    assets: DataFrame,
    vpn: DataFrame | None = None,
    vpn_local: DataFrame | None = None,
    literal: bool = False,
) -> DataFrame:
    """The whole register. VPN users and VPN-local addresses are added to it, not deduplicated.

    Hosts are looked up by distinct name and joined back, so the deduplicated rows are written
    out first.
    """
    firsts = checkpointed(first_per_ip(union_registers(static, leases, denied, allowed)))
    register = with_owners(firsts, assets, literal)
    if vpn is not None:
        register = register.unionByName(with_device_columns(vpn.withColumn("hostName", F.lit(VPN_HOST))))
    if vpn_local is not None:
        register = register.unionByName(with_device_columns(vpn_local.withColumn("hostName", F.lit(VPN_LOCAL_HOST))))
    return register


def sorted_by_ip(register: DataFrame) -> DataFrame:
    """The register with each row's ``position`` in the text order of the addresses, for export. Joins do not need it."""
    return with_positions(register, [F.col("ip")])

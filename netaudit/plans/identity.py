"""Identity relation: who or what every address and domain in the reports is.

Columns ``ip, hostName, user, description, macAddress``; at least one row per distinct key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from netaudit.constants import BLANK_HOST, RELEASED, UNREGISTERED
from netaudit.functions.net import extract_domain, extract_ip, is_ip
from netaudit.operators.matchjoin import first_network_match, first_suffix_match, range_and_network, range_hits
from netaudit.session import checkpointed
from netaudit.sources.registers import DEVICE_COLUMNS

REST = [name for name in DEVICE_COLUMNS if name != "ip"]


def report_keys(rows: DataFrame, anywhere: bool = False) -> DataFrame:
    """Distinct addresses and domains (column ``ip``) over all cells of all report tables.

    Per cell the first address, by default only one that ends the cell, and the first domain.
    """
    cells = rows.select(F.explode(F.map_values("cells")).alias("cell"))
    return keys_of_text(cells.select("cell"), "cell", anywhere)


def keys_of_text(texts: DataFrame, text: str, anywhere: bool = False) -> DataFrame:
    found = F.array(extract_ip(F.col(text), anywhere), extract_domain(F.col(text)))
    return texts.select(F.explode(found).alias("ip")).filter(F.col("ip").isNotNull()).distinct()


def domain_identities(keys: DataFrame, register: DataFrame, literal: bool = False) -> DataFrame:
    """Each domain key with the first register domain, by text order, that ends it."""
    domains = keys.filter(~is_ip(F.col("ip"))).select("ip")
    entries = register.filter(~is_ip(F.col("ip"))).withColumnRenamed("ip", "pattern")
    matched = first_suffix_match(domains, "ip", entries, "pattern", "pattern", REST, literal)
    return domains.join(matched, "ip", "left").select("ip", "match.*")


def address_identities(keys: DataFrame, register: DataFrame) -> DataFrame:
    """Each address key with its register rows."""
    entries = register.filter(is_ip(F.col("ip"))).select(*DEVICE_COLUMNS)
    return keys.filter(is_ip(F.col("ip"))).select("ip").join(entries, "ip", "left").select(*DEVICE_COLUMNS)


def released_label(mac: Column) -> Column:
    return F.when(mac.isNull(), RELEASED).otherwise(BLANK_HOST)


def with_released(identities: DataFrame, ranges: DataFrame) -> DataFrame:
    """Nameless addresses inside DHCP ranges get a label as host and user, once per range.

    All other rows of such an address are dropped.
    """
    nameless = identities.filter(F.col("hostName").isNull())
    hits = range_hits(nameless.select("ip").distinct(), ranges, [])
    released = nameless.join(hits, "ip").withColumn("hostName", released_label(F.col("macAddress")))
    released = released.withColumn("user", F.col("hostName"))
    others = identities.join(hits.select("ip").distinct(), "ip", "left_anti")
    return others.unionByName(released.select(*others.columns))


def unregistered_user(host: Column, mac: Column, user: Column) -> Column:
    """A label for the user of a named device with MAC that nobody registered."""
    return F.when(host.isNotNull() & mac.isNotNull() & user.isNull(), UNREGISTERED).otherwise(user)


def with_unregistered(identities: DataFrame) -> DataFrame:
    return identities.withColumn(
        "user", unregistered_user(F.col("hostName"), F.col("macAddress"), F.col("user"))
    )


def nameless_networks(identities: DataFrame, networks: DataFrame, span: bool = False) -> DataFrame:
    """``(ip, hostName)`` of nameless addresses found in a network; the network's user is the host."""
    nameless = identities.filter(F.col("hostName").isNull() & is_ip(F.col("ip")))
    return first_network_match(nameless, networks, "seq", "User", span=span).withColumnRenamed("User", "hostName")


def with_network_hosts(identities: DataFrame, found: DataFrame) -> DataFrame:
    """All rows of the found addresses take the network's name as host."""
    overriding = identities.drop("hostName").join(found, "ip").select(*DEVICE_COLUMNS)
    return identities.select(*DEVICE_COLUMNS).join(found, "ip", "left_anti").unionByName(overriding)


def identity_relation(
    keys: DataFrame,
    register: DataFrame,
    ranges: DataFrame,
    networks: DataFrame,
    literal: bool = False,
    span: bool = False,
) -> DataFrame:
    """The steps above as one pass.

    Whether an address is released or takes a network's name depends on the address alone:
    on whether it has a nameless row, on the ranges that hold it and on the networks. So
    these are joined per key, and no step reads the result of an earlier one twice. Keys and
    register are read several times; they are written out first, so that the reports and
    the sources of the register are read once. So are the register's domains, which the
    suffix match reads once per kind of pattern. Joins with the register are merged: it is as
    large as the data, which the size of a compressed table hides.
    """
    keys, register = checkpointed(keys), checkpointed(register)
    domains = checkpointed(register.filter(~is_ip(F.col("ip"))))
    addresses = keys.filter(is_ip(F.col("ip"))).select("ip")
    entries = register.filter(is_ip(F.col("ip"))).select(*DEVICE_COLUMNS)
    named = entries.groupBy("ip").agg(F.bool_or(F.col("hostName").isNull()).alias("nameless_entry"))
    found = range_and_network(addresses, ranges, networks, "seq", "User", span=span).withColumnRenamed("User", "network")
    facts = (
        addresses.join(named.hint("merge"), "ip", "left")
        .withColumn("nameless", F.coalesce("nameless_entry", F.lit(True)))
        .join(found.hint("merge"), "ip", "left")
    )
    rows = facts.join(entries.hint("merge"), "ip", "left")
    released = F.col("nameless") & (F.coalesce("ranges", F.lit(0)) > 0)
    kept = rows.withColumn("released", released).filter(~F.col("released") | F.col("hostName").isNull())
    label = released_label(F.col("macAddress"))
    host = F.when(F.col("released"), label).otherwise(F.col("hostName"))
    user = F.when(F.col("released"), label).otherwise(
        unregistered_user(F.col("hostName"), F.col("macAddress"), F.col("user"))
    )
    network = F.when(~F.col("released") & F.col("nameless"), F.col("network"))
    copies = F.when(F.col("released"), F.sequence(F.lit(1).cast("bigint"), F.col("ranges"))).otherwise(
        F.array(F.lit(1).cast("bigint"))
    )
    by_address = kept.select(
        "ip",
        F.coalesce(network, host).alias("hostName"),
        user.alias("user"),
        "description",
        "macAddress",
        F.explode(copies).alias("copy"),
    ).drop("copy")
    by_domain = with_unregistered(domain_identities(keys, domains, literal))
    return by_address.unionByName(by_domain.select(*DEVICE_COLUMNS))

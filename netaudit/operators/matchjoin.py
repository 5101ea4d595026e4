"""First-match joins: text prefixes and suffixes, networks and address ranges.

Each is an equi-join. Patterns, networks and ranges are turned into keys, the searched side
is exploded into the few keys it could meet, and the first match is a ``min_by`` that starts
before the shuffle. No step compares all pairs, and no step depends on a side being small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from netaudit.functions.net import ipv4_number, network_bits, network_low
from netaudit.operators.dropped import counted
from netaudit.operators.patternjoin import pattern_pairs, split_keys

ADDRESS_BITS = 32
# Blocks of addresses are at most this large, so that one block holds a bounded number of them.
LARGEST_BLOCK = 20


# Least number of parts that the rows of one key are spread over.
SALTS = 16


def salts_of(df: DataFrame) -> int:
    """Parts for the rows of one key: an eighth of the shuffle partitions, so that they grow with the cluster."""
    return max(SALTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)


def salted_join(rows: DataFrame, lookup: DataFrame, key: str, spread_by: list[str], salts: int | None = None) -> DataFrame:
    """Inner join with a lookup of few rows per key, where a key may be in a large share of the rows.

    The rows of a key are spread over salts by a hash of ``spread_by``; the lookup, small
    beside the rows, is repeated for each salt. Spark's size check does not see the repeats,
    so the hint keeps them from being broadcast through the driver. A lookup that grows as the
    rows do needs a fixed number of ``salts``.
    """
    salts = salts or salts_of(rows)
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    return rows.withColumn("_salt", salt).join(repeated, [key, "_salt"]).drop("_salt")


def file_join(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """Inner join with a lookup of one row per file. The driver lists the files, so that many rows are broadcast."""
    return rows.join(F.broadcast(lookup), "file")


def with_prefixes(texts: DataFrame, text: str, keys: DataFrame, key: str, name: str) -> DataFrame:
    """One row per text and prefix of a length that some key has, the prefix in column ``name``.

    The lengths are at most as many as the longest key has characters, so they are broadcast.
    """
    lengths = keys.select(F.length(key).alias("_length")).distinct()
    all_lengths = F.sequence(F.lit(0), F.length(text))
    spread = texts.filter(F.col(text).isNotNull()).withColumn("_length", F.explode(all_lengths))
    kept = spread.join(F.broadcast(lengths), "_length", "left_semi")
    return kept.withColumn(name, F.substring(F.col(text), F.lit(1), F.col("_length"))).drop("_length")


def dot_places(pattern: Column) -> Column:
    """One-based places of the dots, which match any character."""
    places = F.sequence(F.lit(1), F.greatest(F.length(pattern), F.lit(1)))
    return F.filter(places, lambda i: F.substring(pattern, i, 1) == ".")


def with_dots(text: Column, length: Column, dots: Column) -> Column:
    """First ``length`` characters of the text with dots written over the given places."""
    places = F.sequence(F.lit(1), length)
    return F.concat_ws("", F.transform(
        places, lambda i: F.when(F.array_contains(dots, i), ".").otherwise(F.substring(text, i, 1))
    ))


def prefix_keys(texts: DataFrame, text: str, patterns: DataFrame, pattern: str, literal: bool) -> DataFrame:
    """Texts with one row per pattern text (column ``key``) that begins them.

    A dot in a pattern matches any character unless ``literal``. Patterns without dots meet
    the plain prefixes of a text. Patterns with dots are first reduced to their shapes (text
    before the first dot, length, dot places); a text takes the shapes whose leading text
    begins it, and writing the dots into it gives the key to compare whole.
    """
    if literal:
        return with_prefixes(texts, text, patterns, pattern, "key")
    has_dot = F.contains(pattern, F.lit("."))
    shapes = patterns.filter(has_dot).select(
        F.split_part(pattern, F.lit("."), F.lit(1)).alias("head"),
        F.length(pattern).alias("shape_length"),
        dot_places(F.col(pattern)).alias("shape_dots"),
    ).distinct()
    shaped = (
        salted_join(with_prefixes(texts, text, shapes, "head", "head"), shapes, "head", [text])
        .filter(F.length(text) >= F.col("shape_length"))
        .withColumn("key", with_dots(F.col(text), F.col("shape_length"), F.col("shape_dots")))
        .drop("head", "shape_length", "shape_dots")
    )
    plain = with_prefixes(texts, text, patterns.filter(~has_dot), pattern, "key")
    # A plain prefix that itself holds a dot is found through the shapes.
    return plain.filter(~F.contains("key", F.lit("."))).unionByName(shaped)


# Keys with one of these are read as patterns; a dot alone is met by shapes.
SPECIAL = r"[\\\[\](){}*+?^$|]"


def key_kinds(keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Keys with no pattern character but the dot, keys that are patterns, and others, which are plain text."""
    special = F.col(key).rlike(SPECIAL)
    patterns, broken = split_keys(keys.filter(special), key)
    return keys.filter(~special), patterns, broken


def invalid_patterns(keys: DataFrame, key: str) -> DataFrame:
    """Keys with pattern characters that are no patterns; they match as plain text."""
    return key_kinds(keys, key)[2]


def first_prefix_match(
    probes: DataFrame, probe: str, register: DataFrame, text: str, order: str, payload: list[str], literal: bool = False
) -> DataFrame:
    """For each distinct probe, the payload of the first register row whose text it begins, as a pattern unless ``literal``.

    Gives ``(probe, match)`` with ``match`` a struct of the payload; probes without a match
    are left out, and null or empty texts match nothing.
    """
    keys = probes.select(F.col(probe).alias("key")).filter(F.length("key") > 0).distinct()
    searched = register.select(text, F.col(order).alias("order"), F.struct(*payload).alias("match"))
    if literal:
        reached = prefix_keys(searched, text, keys, "key", literal=True).select("key", "order", "match")
    else:
        plain, patterns, broken = key_kinds(keys, "key")
        anchored = patterns.select(F.concat(F.lit("^(?:"), F.col("key"), F.lit(")")).alias("key"))
        pairs = pattern_pairs(searched, text, anchored, "key", salted_join)
        found = searched.join(pairs.hint("merge"), text).withColumn("key", F.expr("substring(pattern, 5, length(pattern) - 5)"))
        reached = prefix_keys(searched, text, plain, "key", literal=False).select("key", "order", "match").unionByName(
            prefix_keys(searched, text, broken, "key", literal=True).select("key", "order", "match")
        ).unionByName(found.select("key", "order", "match"))
    firsts = reached.groupBy("key").agg(F.min_by("match", F.struct("order", "match")).alias("match"))
    return keys.join(firsts, "key").select(F.col("key").alias(probe), "match")


def first_suffix_match(
    probes: DataFrame, probe: str, register: DataFrame, pattern: str, order: str, payload: list[str], literal: bool = False
) -> DataFrame:
    """For each distinct probe, the payload of the first register row whose pattern, with an end behind it, is in it.

    Same result columns as :func:`first_prefix_match`. Of alternatives at the top of a pattern
    only the last one has the end behind it. Plain texts work on reversed texts.
    """
    entries = (
        register.filter(F.col(pattern).isNotNull())
        .groupBy(F.col(pattern).alias("entry"))
        .agg(F.min_by(F.struct(*payload), F.struct(order, *payload)).alias("match"), F.min(order).alias("order"))
    )
    texts = probes.filter(F.col(probe).isNotNull()).select(probe).distinct()
    reversed_texts = texts.withColumn("reversed", F.reverse(probe))

    def ends(of: DataFrame, plain: bool) -> DataFrame:
        keyed = of.withColumn("key", F.reverse("entry")).drop("entry")
        reached = prefix_keys(reversed_texts, "reversed", keyed, "key", plain)
        return salted_join(reached, keyed, "key", [probe]).select(probe, "order", "match")

    if literal:
        reached = ends(entries, plain=True)
    else:
        plain, patterns, broken = key_kinds(entries, "entry")
        ended = patterns.withColumn("pattern", F.concat("entry", F.lit("$")))
        pairs = pattern_pairs(texts, probe, ended, "pattern", salted_join)
        found = salted_join(pairs, ended, "pattern", [probe]).select(probe, "order", "match")
        reached = ends(plain, plain=False).unionByName(ends(broken, plain=True)).unionByName(found)
    return reached.groupBy(probe).agg(F.min_by("match", F.struct("order", "match")).alias("match"))


def with_blocks(ips: DataFrame, ip: str, blocks: DataFrame) -> DataFrame:
    """Each address with the aligned power-of-two blocks that hold it, as ``bits, block``.

    Only block sizes that occur in ``blocks`` are made; there are at most 21, so they are
    broadcast. Only well-formed addresses give any. ``ips`` must be distinct: then no block
    gathers more than 1,048,576 of them, however popular its network is. Spark's size check
    does not see how many rows an address becomes, so joins with them are merged.
    """
    sizes = blocks.select("bits").distinct()
    numbered = ips.select(ip, ipv4_number(F.col(ip)).alias("number")).filter(F.col("number").isNotNull())
    spread = numbered.withColumn("bits", F.explode(F.sequence(F.lit(0), F.lit(LARGEST_BLOCK))))
    kept = spread.join(F.broadcast(sizes), "bits", "left_semi")
    return kept.select(ip, "bits", F.call_function("shiftright", "number", "bits").alias("block"))


def range_blocks(low: Column, high: Column) -> Column:
    """Aligned blocks that cover ``low..high`` exactly: two per size at most, but any number of the largest.

    At each size the range is cut to whole blocks; an odd first block and an odd end cannot
    be part of a larger block of the cover, so they are taken at this size.
    """
    def whole(bits: Column) -> tuple[Column, Column]:
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits)
        return F.call_function("shiftright", low + size - 1, bits), F.call_function("shiftright", high + 1, bits)

    def placed(bits: Column, blocks: Column) -> Column:
        return F.transform(blocks, lambda block: F.struct(bits.alias("bits"), block.alias("block")))

    def edges(bits: Column) -> Column:
        first, end = whole(bits)
        left = F.when((first < end) & (first % 2 == 1), first)
        right = F.when((first < end) & (end % 2 == 1), end - 1)
        return placed(bits, F.array_compact(F.array(left, right)))

    largest = F.lit(LARGEST_BLOCK)
    first, end = whole(largest)
    rest = F.when(first < end, F.sequence(first, end - 1)).otherwise(F.array().cast("array<bigint>"))
    smaller = F.flatten(F.transform(F.sequence(F.lit(0), largest - 1), edges))
    return F.concat(smaller, placed(largest, rest))


def blocks_of_ranges(ranges: DataFrame, payload: list[str]) -> DataFrame:
    """``(lo, hi)`` ranges as blocks: ``bits, block, *payload``."""
    blocks = ranges.select(*payload, F.explode(range_blocks(F.col("lo"), F.col("hi"))).alias("at"))
    return blocks.select("at.bits", "at.block", *payload)


def blocks_of_networks(networks: DataFrame, order: str, name: str, span: bool) -> DataFrame:
    """Networks with a ``cidr`` text as blocks: ``bits, block, order, name``, the first of each block.

    Malformed networks and those with host bits set are left out. A network shorter than /8
    counts for its first octet only unless ``span``.
    """
    cidr = F.col("cidr")
    networks = counted(networks, "malformed networks", network_low(cidr).isNull())
    size = F.lit(ADDRESS_BITS) - (network_bits(cidr) if span else F.greatest(network_bits(cidr), F.lit(8)))
    bounded = networks.select(
        F.col(name).alias("_name"), F.col(order).alias("_order"), network_low(cidr).alias("lo"), size.alias("size")
    ).filter("lo is not null")
    high = F.col("lo") + F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("size")) - 1
    found = bounded.withColumn("hi", high).select(
        "_name", "_order", F.explode(range_blocks(F.col("lo"), F.col("hi"))).alias("at")
    )
    return (
        found.groupBy("at.bits", "at.block")
        .agg(F.min_by("_name", "_order").alias(name), F.min("_order").alias("order"))
    )


def range_hits(ips: DataFrame, ranges: DataFrame, payload: list[str], ip: str = "ip") -> DataFrame:
    """All pairs of a distinct address and a ``(lo, hi)`` range that holds it: ``(ip, *payload)``."""
    blocks = blocks_of_ranges(ranges, payload)
    return with_blocks(ips, ip, blocks).join(blocks.hint("merge"), ["bits", "block"]).select(ip, *payload)


def first_network_match(
    ips: DataFrame, networks: DataFrame, order: str, name: str, ip: str = "ip", span: bool = False
) -> DataFrame:
    """First network in ``order`` that holds each distinct address: ``(ip, name)``.

    For which networks count see :func:`blocks_of_networks`.
    """
    blocks = blocks_of_networks(networks, order, name, span)
    matches = with_blocks(ips.select(ip).distinct(), ip, blocks).join(blocks.hint("merge"), ["bits", "block"])
    return matches.groupBy(ip).agg(F.min_by(name, "order").alias(name))


def range_and_network(
    ips: DataFrame, ranges: DataFrame, networks: DataFrame, order: str, name: str, ip: str = "ip", span: bool = False
) -> DataFrame:
    """Both lookups in one: ``(ip, ranges, name)`` of the distinct addresses found in any.

    ``ranges`` is the number of ranges that hold the address, zero if none.
    """
    in_ranges = blocks_of_ranges(ranges, []).groupBy("bits", "block").agg(F.count("*").alias("ranges"))
    in_networks = blocks_of_networks(networks, order, name, span)
    blocks = in_ranges.unionByName(in_networks, allowMissingColumns=True)
    return (
        with_blocks(ips, ip, blocks)
        .join(blocks.hint("merge"), ["bits", "block"])
        .groupBy(ip)
        .agg(F.coalesce(F.sum("ranges"), F.lit(0)).alias("ranges"), F.min_by(name, "order").alias(name))
    )


def invalid_networks(networks: DataFrame) -> DataFrame:
    """Networks that :func:`first_network_match` leaves out."""
    return networks.filter(network_low(F.col("cidr")).isNull())


def mac_tokens(line: Column) -> Column:
    """Every ``six-six`` text around a dash, overlapping ones too; null without a dash."""
    # Looking ahead takes no characters, so the next search begins one further.
    found = F.regexp_extract_all(line, F.lit("(?=([0-9A-Za-z]{6}-[0-9A-Za-z]{6}))"), F.lit(1))
    return F.when(F.contains(line, F.lit("-")), F.array_distinct(found))


def mac_search(lines: DataFrame, macs: DataFrame, key: str = "mac") -> DataFrame:
    """All lines holding a listed search key: ``(mac, file, line)``, one row per line and key."""
    tokens = lines.withColumn(key, F.explode(mac_tokens(F.col("line"))))
    # MACs grow with the lines, so their repeats must not grow with the partitions too. A key that is too large for these salts is split by AQE.
    return salted_join(tokens, macs.select(key).distinct(), key, ["file", "pos"], SALTS).select(key, "file", "line")

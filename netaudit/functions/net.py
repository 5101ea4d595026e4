"""Columns for addresses, networks, domains and hardware addresses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The patterns decide which texts count as an address, domain or MAC.
IP_ANYWHERE = r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"
IP_AT_END = IP_ANYWHERE + "$"
DOMAIN = r"[a-z0-9.-]+\.[a-z]{2,}"
MAC = r"([0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}|([0-9A-Fa-f]{4}\.){2}[0-9A-Fa-f]{4}"

_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
CANONICAL_IPV4 = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}\z"


def extract_ip(text: Column, anywhere: bool = False) -> Column:
    """First address in the text (by default only one that ends it), else null."""
    return F.regexp_substr(text, F.lit(IP_ANYWHERE if anywhere else IP_AT_END))


def extract_domain(text: Column) -> Column:
    """First lower-case domain in the text, else null."""
    return F.regexp_substr(text, F.lit(DOMAIN))


def is_ip(text: Column) -> Column:
    """Whether the text ends with an address; octets are not range checked."""
    return text.rlike(IP_AT_END)


def has_mac(text: Column) -> Column:
    return text.rlike(MAC)


def ip_to_number(ip: Column) -> Column:
    """Base-256 value of the first four dot-separated parts; null unless all are numbers."""
    def part(i: int) -> Column:
        return F.split_part(ip, F.lit("."), F.lit(i)).try_cast("bigint")

    return part(1) * 16777216 + part(2) * 65536 + part(3) * 256 + part(4)


def ipv4_number(ip: Column) -> Column:
    """Like :func:`ip_to_number`, but null unless the text is a well-formed IPv4 address."""
    return F.when(ip.rlike(CANONICAL_IPV4), ip_to_number(ip))


def number_to_ip(number: Column) -> Column:
    def octet(shift: int) -> Column:
        return F.shiftright(number, shift).bitwiseAND(255)

    dotted = F.concat_ws(".", F.shiftright(number, 24), octet(16), octet(8), octet(0))
    return F.when(number.isNotNull(), dotted)


def first_octet(ip: Column) -> Column:
    return F.split_part(ip, F.lit("."), F.lit(1))


def network_bits(cidr: Column) -> Column:
    """Prefix length after the slash, null if it is missing or out of range."""
    bits = F.split_part(cidr, F.lit("/"), F.lit(2))
    return F.when(bits.rlike(r"^([0-9]|[12][0-9]|3[0-2])\z"), bits.cast("int"))


def network_low(cidr: Column) -> Column:
    """First address of a network; null for malformed networks or ones with host bits set."""
    low = ipv4_number(F.split_part(cidr, F.lit("/"), F.lit(1)))
    size = _power_of_two(32 - network_bits(cidr))
    return F.when(F.pmod(low, size) == 0, low)


def network_high(cidr: Column) -> Column:
    """Last address of a network; null where :func:`network_low` is."""
    return network_low(cidr) + _power_of_two(32 - network_bits(cidr)) - 1


def _power_of_two(exponent: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), exponent.cast("int"))


def mac_search_key(mac: Column) -> Column:
    """``aa:bb:cc:dd:ee:ff`` as switch tables print it: ``aabbcc-ddeeff``."""
    digits = F.translate(mac, ":", "")
    return F.concat(F.substring(digits, 1, 6), F.lit("-"), F.substring(digits, 7, 12))


def strip_closing_paren(text: Column) -> Column:
    """Remove the first closing parenthesis."""
    return F.regexp_replace(text, r"^([^)]*)\)", "$1")

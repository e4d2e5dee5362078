"""IPv4 addresses: validation, canonical form, type, default subnet, reverse pointer.

An address is judged by its first bad octet.  Each reason is one pattern over
the whole text that skips the good octets in front, so a row needs no array
and the whole chain stays inside generated code.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netgroom.functions.stages import Stages, add_fields
from netgroom.functions.text import count_char, stripped_plain_digits

_OCTET = r"[+]?0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_GOOD_OCTETS = rf"\A(?:{_OCTET}[.]){{0,3}}"
_VALID = rf"\A{_OCTET}(?:[.]{_OCTET}){{3}}\z"
_EMPTY = rf"{_GOOD_OCTETS}(?:[.]|\z)"
_NON_NUMERIC = rf"{_GOOD_OCTETS}(?![+]*[0-9²]+(?:[.]|\z))"
_NON_DECIMAL = rf"{_GOOD_OCTETS}(?:[+]{{2}}|[+]?[0-9]*²)"
_LEADING = r"(\A|[.])[+]?0*(?=[0-9])"

_STRICT_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
STRICT_IPV4 = rf"{_STRICT_OCTET}(?:[.]{_STRICT_OCTET}){{3}}"


@cache
def ipv4_stages(source: str = "ip", out: str = "ip") -> Stages:
    s, valid = F.col(f"_{out}_text"), F.col(f"{out}_valid")
    to_shorten = s.startswith("0") | s.contains(".0") | s.contains("+")
    canonical = F.when(to_shorten, F.regexp_replace(s, _LEADING, "$1")).otherwise(s)
    return [
        {f"_{out}_text": stripped_plain_digits(source)},
        {f"{out}_valid": F.coalesce(s.rlike(_VALID), F.lit(False))},
        {
            f"{out}_clean": F.when(valid, canonical),
            f"{out}_reason": F.when(valid, "ok")
            .when(s.isNull(), "missing")
            .when(s.contains(":"), "ipv6_or_non_ipv4")
            .when(count_char(s, ".") != 3, "wrong_octet_count")
            .when(s.rlike(_EMPTY), "empty_octet")
            .when(s.rlike(_NON_NUMERIC), "non_numeric_or_negative")
            .when(s.rlike(_NON_DECIMAL), "non_decimal_format")
            .otherwise("octet_out_of_range"),
        },
    ]


def clean_ipv4(df: DataFrame, source: str = "ip", out: str = "ip") -> DataFrame:
    """Add ``{out}_clean``, ``{out}_valid`` and ``{out}_reason`` for the text column ``source``."""
    return add_fields(df, ipv4_stages(source, out))


def ipv4_type(ip: Column) -> Column:
    """Class of a canonical address; NULL is ``invalid``, other text ``invalid_format``."""
    return (
        F.when(ip.isNull(), "invalid")
        .when(~ip.rlike(rf"\A{STRICT_IPV4}\z"), "invalid_format")
        .otherwise(canonical_ipv4_type(ip))
    )


def canonical_ipv4_type(ip: Column) -> Column:
    """:func:`ipv4_type` for a column already known to hold canonical addresses or NULL."""
    private_172 = ip.startswith("172.") & F.substring_index(ip, ".", 2).rlike(r"[.](?:1[6-9]|2[0-9]|3[01])\z")
    return (
        F.when(ip.isNull(), "invalid")
        .when(ip.startswith("10.") | ip.startswith("192.168.") | private_172, "private_rfc1918")
        .when(ip.startswith("169.254."), "link_local_apipa")
        .when(ip.startswith("127."), "loopback")
        .otherwise("public_or_other")
    )


def _class_c(ip: Column) -> Column:
    return F.concat(F.substring_index(ip, ".", 3), F.lit(".0/24"))


def default_subnet(ip: Column, ip_type: Column | None = None) -> Column:
    """Usual network of a canonical address, ``""`` where there is none."""
    ip_type = ipv4_type(ip) if ip_type is None else ip_type
    return (
        F.when(
            ip_type == "private_rfc1918",
            F.when(ip.startswith("10."), "10.0.0.0/8")
            .when(ip.startswith("172."), F.concat(F.substring_index(ip, ".", 2), F.lit(".0.0/16")))
            .otherwise(_class_c(ip)),
        )
        .when(ip_type == "link_local_apipa", "169.254.0.0/16")
        .when(ip_type == "loopback", "127.0.0.0/8")
        .when(ip_type == "public_or_other", _class_c(ip))
        .otherwise("")
    )


def private_subnet_24(ip: Column) -> Column:
    """Starter rule: every private address gets its /24, anything else ``""``."""
    return F.when(canonical_ipv4_type(ip) == "private_rfc1918", _class_c(ip)).otherwise("")


def reverse_ptr4(ip: Column) -> Column:
    """``in-addr.arpa`` name of a canonical address; NULL stays NULL."""
    octet = lambda i: F.substring_index(F.substring_index(ip, ".", i), ".", -1)
    return F.when(
        ip.isNotNull(), F.concat_ws(".", octet(4), octet(3), octet(2), octet(1), F.lit("in-addr.arpa"))
    )

"""IPv6 addresses with native string columns: expansion, version, reverse pointer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netgroom.functions.ipv4 import STRICT_IPV4, reverse_ptr4
from netgroom.functions.text import count_char, strip

_GROUPS = r"[0-9a-f]{1,4}(?::[0-9a-f]{1,4})*"
_SHAPE = rf"\A(?:{_GROUPS}|(?:{_GROUPS})?::(?:{_GROUPS})?)\z"
_LONGEST = 39
_SCOPE = r"%[^%/]+\z"


def _octets_as_hex(quad: Column, first: int, second: int) -> Column:
    parts = F.split(quad, r"\.")
    octet = lambda i: F.lpad(F.lower(F.hex(F.get(parts, i).cast("int"))), 2, "0")
    return F.concat(octet(first), octet(second))


def _padded(groups: Column) -> Column:
    """Colon-separated groups as hex digits, four for each group."""
    longer = F.regexp_replace(groups, r"(\A|:)(?=[0-9a-f])", "$1000")
    return F.replace(F.regexp_replace(longer, r"0*([0-9a-f]{4})(?=:|\z)", "$1"), F.lit(":"), F.lit(""))


def expand_ipv6(df: DataFrame, source: str, out: str = "ipv6") -> DataFrame:
    """Add ``{out}_hex``: the 32 hex digits of the address, NULL when it is not a valid one.

    A scope (``%eth0``) is accepted and not part of the digits; ``{out}_scoped`` tells.
    """
    text, tail, body = f"_{out}_text", f"_{out}_tail", f"_{out}_body"
    left, right, gap = f"_{out}_left", f"_{out}_right", f"_{out}_gap"
    whole = strip(F.col(source))
    s, quad, b = F.col(text), F.col(tail), F.col(body)
    n_groups = lambda c: F.when(c == "", 0).otherwise(count_char(c, ":") + 1)
    compressed = b.contains("::")
    return (
        df.withColumn(f"{out}_scoped", F.coalesce(whole.rlike(_SCOPE), F.lit(False)))
        .withColumn(text, F.when(whole.contains(":"), F.lower(F.regexp_replace(whole, _SCOPE, ""))))
        .withColumn(tail, F.substring_index(s, ":", -1))
        .withColumn(
            body,
            F.when(
                quad.rlike(rf"\A{STRICT_IPV4}\z"),
                F.concat(
                    F.substring(s, F.lit(1), F.length(s) - F.length(quad)),
                    _octets_as_hex(quad, 0, 1),
                    F.lit(":"),
                    _octets_as_hex(quad, 2, 3),
                ),
            ).otherwise(s),
        )
        .withColumn(body, F.when((F.length(b) <= _LONGEST) & b.rlike(_SHAPE), b))
        .withColumns(
            {
                left: F.split_part(b, F.lit("::"), F.lit(1)),
                right: F.when(compressed, F.split_part(b, F.lit("::"), F.lit(2))).otherwise(""),
            }
        )
        .withColumn(gap, F.lit(8) - n_groups(F.col(left)) - n_groups(F.col(right)))
        .withColumn(
            f"{out}_hex",
            F.when(
                (compressed & (F.col(gap) >= 1)) | (~compressed & (F.col(gap) == 0)),
                F.concat(
                    _padded(F.col(left)),
                    F.expr(f"repeat('0000', {gap})"),
                    _padded(F.col(right)),
                ),
            ),
        )
        .drop(text, tail, body, left, right, gap)
    )


def reverse_ptr(df: DataFrame, source: str, out: str = "reverse_ptr") -> DataFrame:
    """Add the reverse pointer name of an IPv4 or IPv6 literal; NULL for anything else.

    A scoped IPv6 literal has no pointer name and gives NULL.
    """
    hex_, scoped = "_ptr_hex", "_ptr_scoped"
    s = strip(F.col(source))
    nibbles = F.regexp_replace(F.reverse(F.col(hex_)), r"(.)(?=.)", "$1.")
    return (
        expand_ipv6(df, source, "_ptr")
        .withColumn(
            out,
            F.when(s.rlike(rf"\A{STRICT_IPV4}\z"), reverse_ptr4(s)).when(
                F.col(hex_).isNotNull() & ~F.col(scoped), F.concat(nibbles, F.lit(".ip6.arpa"))
            ),
        )
        .drop(hex_, scoped)
    )


def ip_version(df: DataFrame, source: str, out: str = "ip_version") -> DataFrame:
    """Add ``6``, ``4`` or ``invalid`` (two colons or more mean IPv6, exactly three dots IPv4)."""
    s = strip(F.col(source))
    return (
        expand_ipv6(df, source, "_ver")
        .withColumn(
            out,
            F.when(
                count_char(s, ":") >= 2, F.when(F.col("_ver_hex").isNotNull(), "6").otherwise("invalid")
            )
            .when(s.rlike(rf"\A{STRICT_IPV4}\z"), "4")
            .otherwise("invalid"),
        )
        .drop("_ver_hex", "_ver_scoped")
    )

"""Host names (RFC 1123) and fully qualified names (RFC 1035)."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netgroom.functions.stages import Stages, add_fields
from netgroom.functions.text import count_char, strip_column

# The patterns of labels. In Python "$" also matches before a final line feed, and so it does here with (?d).
HOST_LABEL = r"(?d)^[a-zA-Z0-9]([a-zA-Z0-9-]*[a-zA-Z0-9])?$"
DOMAIN_CHARS = r"(?d)^[a-zA-Z0-9-]+$"

_AT_MOST_63 = r"(?=[^.]{1,63}(?:[.]|\z))"
_FIRST = rf"{_AT_MOST_63}[a-zA-Z0-9](?:[a-zA-Z0-9-]*[a-zA-Z0-9])?\n?"
_OTHER = rf"{_AT_MOST_63}(?!-)[a-zA-Z0-9-]+(?:(?<!-)|\n)"
_VALID_FQDN = rf"\A{_FIRST}(?:[.]{_OTHER})+\z"
_GOOD_LABELS = rf"\A(?:{_FIRST}[.](?:{_OTHER}[.])*+)?"


@cache
def hostname_stages(source: str = "hostname", out: str = "hostname") -> Stages:
    s, ok = F.col(f"_{out}_text"), F.col(f"{out}_reason") == "ok"
    return [
        {f"_{out}_text": strip_column(source)},
        {
            f"{out}_reason": F.when(s.isNull(), "missing")
            .when(s == "", "empty_string")
            .when(F.length(s) > 63, "too_long")
            .when(s.contains("."), "contains_periods")
            .when(~s.rlike(HOST_LABEL), "invalid_characters")
            .otherwise("ok"),
        },
        {
            f"{out}_valid": ok,
            f"{out}_clean": F.when(ok, F.lower(s)).when(s != "", s),
        },
    ]


def clean_hostname(df: DataFrame, source: str = "hostname", out: str = "hostname") -> DataFrame:
    """Add ``{out}_clean``, ``{out}_valid`` and ``{out}_reason``; bad names keep their stripped text."""
    return add_fields(df, hostname_stages(source, out))


@cache
def fqdn_stages(
    source: str = "fqdn", out: str = "fqdn", hostname: str | None = None, site: str | None = None
) -> Stages:
    s, b, state, good = (F.col(f"_{out}_{x}") for x in ("text", "body", "state", "good"))
    valid = state == "valid"
    at = count_char(good, ".")
    label = F.substring_index(F.substring(b, F.length(good) + 1, F.length(b)), ".", 1)
    bad_label = (
        F.when(F.length(label) > 63, F.concat(F.lit("label_"), at, F.lit("_too_long")))
        .when(label == "", "empty_label")
        .when(good == "", "invalid_hostname_label")
        .when(~label.rlike(DOMAIN_CHARS), F.concat(F.lit("invalid_domain_label"), at))
        .otherwise(F.concat(F.lit("label_"), at, F.lit("_hyphen_edge")))
    )
    if hostname is None or site is None:
        compared = F.lit("unknown")
    else:
        expected = F.lower(F.concat(F.col(hostname), F.lit("."), F.col(site)))
        compared = (
            F.when(expected.isNull(), "unknown")
            .when(F.lower(b) == expected, "consistent")
            .otherwise("inconsistent")
        )
    return [
        {f"_{out}_text": strip_column(source)},
        {f"_{out}_body": F.when(s.endswith("."), F.left(s, F.length(s) - 1)).otherwise(s)},
        {
            f"_{out}_state": F.when(s.isNull(), "missing")
            .when(s == "", "empty_string")
            .when(F.length(b) > 255, "too_long")
            .when(~b.contains("."), "too_few_labels")
            .when(b.rlike(_VALID_FQDN), "valid")
            .otherwise("bad_label"),
        },
        {f"_{out}_good": F.when(state == "bad_label", F.regexp_extract(b, _GOOD_LABELS, 0))},
        {
            f"{out}_valid": valid,
            f"{out}_clean": F.when(valid, F.lower(b)).when(s != "", s),
            f"{out}_reason": F.when(state == "bad_label", bad_label).otherwise(state),
            f"{out}_consistent": F.when(valid, compared).otherwise("inconsistent"),
        },
    ]


def clean_fqdn(
    df: DataFrame,
    source: str = "fqdn",
    out: str = "fqdn",
    hostname: str | None = None,
    site: str | None = None,
) -> DataFrame:
    """Add ``{out}_clean``, ``{out}_valid``, ``{out}_reason`` and ``{out}_consistent``.

    The first bad label gives the reason.  One pattern finds the good labels in
    front of it, so names with any number of labels need no array functions.
    ``hostname`` and ``site`` name the columns the valid name is compared with.
    """
    return add_fields(df, fqdn_stages(source, out, hostname, site))

"""Device types: exact names, then keywords in a fixed order."""

from __future__ import annotations

import re
from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netgroom.functions.stages import Stages, add_fields
from netgroom.functions.text import java_regex, squeeze_column, strip_column

# Names taken as they are (confidence 100).
EXACT = {
    "switch": "switch",
    "router": "router",
    "firewall": "firewall",
    "server": "server",
    "printer": "printer",
    "controller": "wireless_controller",
    "storage": "storage",
    "ups": "ups",
    "phone": "ip_phone",
    "camera": "camera",
    "unknown": "unknown",
}

# Keyword patterns, first match wins (confidence 90).
KEYWORDS = [
    (r"\bsw\b|switch", "switch"),
    (r"\brtr\b|router", "router"),
    (r"\bfw\b|firewall|asa|pa\d+", "firewall"),
    (r"\bap\b|access[_-]?point", "wireless_ap"),
    (r"wlc|controller", "wireless_controller"),
    (r"f5|ltm|lb|load[_-]?balancer", "load_balancer"),
    (r"server|vm|esxi", "server"),
    (r"printer|print", "printer"),
    (r"ups", "ups"),
    (r"voip|phone", "ip_phone"),
    (r"camera|cam", "camera"),
    (r"nas|san|storage", "storage"),
]


def _has_keyword(s: Column, pattern: str) -> Column:
    """``pattern`` occurs in ``s``; plain words need no regular expression, others only after a first look."""
    tests = []
    for word in pattern.split("|"):
        start = re.sub(r"^\\b", "", word)
        literal = re.match("[a-z0-9]+", start).group()
        found = s.contains(literal)
        tests.append(found if literal == word else found & s.rlike(java_regex(word)))
    return reduce(Column.__or__, tests)


@cache
def device_type_stages(source: str = "device_type", out: str = "device_type") -> Stages:
    s, exact, fuzzy = F.col(f"_{out}_text"), F.col(f"_{out}_exact"), F.col(f"_{out}_fuzzy")
    names = reduce(lambda case, kv: case.when(s == kv[0], kv[1]), EXACT.items(), F)
    words = reduce(lambda case, kv: case.when(_has_keyword(s, kv[0]), kv[1]), KEYWORDS, F)
    return [
        {f"_{out}_lower": F.lower(strip_column(source))},
        {f"_{out}_text": squeeze_column(f"_{out}_lower", ",_;/", " ")},
        {f"_{out}_exact": names},
        {f"_{out}_fuzzy": F.when(exact.isNull(), words)},
        {
            f"{out}_clean": F.coalesce(exact, fuzzy, F.lit("unknown")),
            f"{out}_confidence": F.when(exact.isNotNull(), 100)
            .when(fuzzy.isNotNull(), 90)
            .otherwise(0)
            .cast("long"),
            f"{out}_reason": F.when(exact.isNotNull(), "exact_match")
            .when(fuzzy.isNotNull(), "fuzzy_match")
            .when(s.isNull(), "missing")
            .when(s == "", "empty_string")
            .otherwise("no_match"),
        },
    ]


def clean_device_type(df: DataFrame, source: str = "device_type", out: str = "device_type") -> DataFrame:
    """Add ``{out}_clean``, ``{out}_confidence`` and ``{out}_reason``.

    ``_`` is a separator like white space, so ``access_point`` is matched by
    nothing and ``wireless_ap`` only by its keyword ``ap``.
    """
    return add_fields(df, device_type_stages(source, out))

"""MAC addresses as lower-case colon pairs."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netgroom.functions.stages import Stages, add_fields
from netgroom.functions.text import strip_column

# The two accepted spellings (pairs with : or -, or three dotted groups).
MAC_PAIRS = r"\A([0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}\z"
MAC_DOTTED = r"\A([0-9A-Fa-f]{4}\.){2}[0-9A-Fa-f]{4}\z"


@cache
def mac_stages(source: str = "mac", out: str = "mac") -> Stages:
    s, clean = F.col(f"_{out}_text"), F.col(f"{out}_clean")
    pairs = F.translate(s, "-ABCDEF", ":abcdef")
    hex_digits = F.translate(s, "ABCDEF.", "abcdef")
    regrouped = F.concat_ws(":", *[F.substring(hex_digits, i, 2) for i in range(1, 12, 2)])
    return [
        {f"_{out}_text": strip_column(source)},
        {f"{out}_clean": F.when(s.rlike(MAC_PAIRS), pairs).when(s.rlike(MAC_DOTTED), regrouped)},
        {
            f"{out}_valid": clean.isNotNull(),
            f"{out}_reason": F.when(clean.isNotNull(), "valid")
            .when(s.isNull(), "missing")
            .when(s == "", "empty_string")
            .otherwise("invalid_format"),
        },
    ]


def clean_mac(df: DataFrame, source: str = "mac", out: str = "mac") -> DataFrame:
    """Add ``{out}_clean``, ``{out}_valid`` and ``{out}_reason``."""
    return add_fields(df, mac_stages(source, out))

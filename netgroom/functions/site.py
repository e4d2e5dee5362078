"""Site names in one spelling."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netgroom.functions.stages import Stages, add_fields
from netgroom.functions.text import squeeze_column, strip_column

# Names that mean "no site".
NO_SITE = ["n/a", "na", "none", "null", "unknown"]


@cache
def site_stages(source: str = "site", out: str = "site") -> Stages:
    s, name, reason = F.col(f"_{out}_text"), F.col(f"_{out}_name"), F.col(f"{out}_reason")
    hyphens = squeeze_column(f"_{out}_text", ",_-", "-")
    return [
        {f"_{out}_text": F.lower(strip_column(source))},
        {f"_{out}_name": F.btrim(F.replace(hyphens, F.lit("building"), F.lit("bldg")), F.lit("-"))},
        {
            f"{out}_reason": F.when(s == "", "empty_string")
            .when(s.isNull() | name.isin(NO_SITE), "missing")
            .otherwise("normalized_site"),
        },
        {f"{out}_clean": F.when(reason == "normalized_site", name).otherwise("unknown")},
    ]


def clean_site(df: DataFrame, source: str = "site", out: str = "site") -> DataFrame:
    """Add ``{out}_clean`` and ``{out}_reason``.  A name of hyphens only becomes ``""``."""
    return add_fields(df, site_stages(source, out))

"""Reports over the clean table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netgroom.operators.clean import LOGGED_FIELDS, clean_fields

PREVIEW_ROWS = 20


def row_count(clean: DataFrame) -> DataFrame:
    return clean.agg(F.count(F.lit(1)).alias("rows"))


def preview(clean: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows by id, each with its JSON form in which missing values are null."""
    first = clean.orderBy("source_row_id").limit(n)
    as_json = F.to_json(F.struct(*clean.columns), {"ignoreNullFields": "false"})
    return first.select("source_row_id", as_json.alias("row_json"))


def quality_report(raw: DataFrame) -> DataFrame:
    """How often each field ended with each reason.

    Rows with the same seven reasons are counted together first, so the
    unpivot and the shuffle see a few combinations and not every row.
    """
    reasons = [f"{f}_reason" for f in LOGGED_FIELDS]
    combined = clean_fields(raw).groupBy(*reasons).agg(F.count(F.lit(1)).alias("n"))
    pairs = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col(f"{f}_reason").alias("reason")) for f in LOGGED_FIELDS]
    )
    return (
        combined.select("n", F.inline(pairs))
        .groupBy("field", "reason")
        .agg(F.sum("n").alias("rows"))
    )


def subnet_rollup(clean: DataFrame) -> DataFrame:
    """Devices and different MAC addresses of each subnet."""
    return clean.groupBy("subnet_cidr", "ip_type").agg(
        F.count(F.lit(1)).alias("devices"), F.countDistinct("mac").alias("distinct_macs")
    )


def site_device_matrix(clean: DataFrame) -> DataFrame:
    """Devices by site and type with totals; ``level`` tells totals from values.

    The totals are made from the counts of the pairs and not from the rows.
    """
    pairs = clean.groupBy("site_normalized", "device_type").agg(F.count(F.lit(1)).alias("n"))
    return pairs.cube("site_normalized", "device_type").agg(
        F.grouping_id().alias("level"), F.sum("n").alias("devices")
    )

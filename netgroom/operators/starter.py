"""The starter variant: only addresses are cleaned, all other raw columns pass through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netgroom.functions import clean_ipv4, private_subnet_24
from netgroom.functions.text import strip

ACTION = "Correct IP or mark record for review"


def _checked(raw: DataFrame) -> DataFrame:
    renamed = F.col("checked_reason")
    return clean_ipv4(raw, "ip", "checked").withColumn(
        "checked_reason", F.when(renamed == "wrong_octet_count", "wrong_part_count").otherwise(renamed)
    )


def starter_clean(raw: DataFrame) -> DataFrame:
    """Six checked columns, then the rest of the raw columns in their order.

    An invalid address stays as it was, without surrounding white space.
    """
    valid = F.col("checked_valid")
    steps = F.when(valid, F.array(F.lit("ip_trim"), F.lit("ip_parse"), F.lit("ip_normalize"))).otherwise(
        F.array(F.lit("ip_trim"), F.concat(F.lit("ip_invalid_"), F.col("checked_reason")))
    )
    rest = [c for c in raw.columns if c not in ("ip", "source_row_id")]
    return _checked(raw).select(
        F.when(valid, F.col("checked_clean")).otherwise(strip(F.col("ip"))).alias("ip"),
        F.when(valid, "true").otherwise("false").alias("ip_valid"),
        F.when(valid, "4").otherwise("").alias("ip_version"),
        private_subnet_24(F.col("checked_clean")).alias("subnet_cidr"),
        F.array_join(steps, "|").alias("normalization_steps"),
        "source_row_id",
        *rest,
    )


def starter_anomalies(raw: DataFrame) -> DataFrame:
    """One record for each invalid address."""
    issue = F.struct(
        F.lit("ip").alias("field"), F.col("checked_reason").alias("type"), F.col("ip").alias("value")
    )
    record = F.struct(
        F.array(issue).alias("issues"), F.array(F.lit(ACTION)).alias("recommended_actions")
    )
    found = F.when(~F.col("checked_valid"), F.array(record))
    return _checked(raw).select("source_row_id", F.inline(found))

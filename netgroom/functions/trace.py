"""Trace records: which field was changed, from what, to what, and why."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trace(field: str, raw: Column, clean: Column, reason: Column) -> Column:
    return F.struct(
        F.lit(field).alias("field"),
        raw.alias("from"),
        clean.alias("to"),
        reason.alias("reason"),
    )

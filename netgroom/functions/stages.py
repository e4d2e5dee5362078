"""Building columns in stages.

A field function is a list of stages; each stage maps new column names to
expressions over the columns of earlier stages, so that a shared value is
computed once.  Running several fields together merges their stages, which
keeps the plan at a handful of projections for any number of fields.  Stages
hold no data and are the same for every table, so they are built once.
"""

from __future__ import annotations

from itertools import zip_longest

from pyspark.sql import Column, DataFrame

Stages = list[dict[str, Column]]


def add_fields(df: DataFrame, *fields: Stages) -> DataFrame:
    """Add the columns of all fields; working columns (leading underscore) are dropped."""
    added: list[str] = []
    for level in zip_longest(*fields, fillvalue={}):
        columns = {name: column for stage in level for name, column in stage.items()}
        df = df.withColumns(columns)
        added += columns
    return df.drop(*[name for name in added if name.startswith("_")])

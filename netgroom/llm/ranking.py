"""Numbers of rows in order, without a task that sees a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netgroom.llm.common import stored

#: Rows of one partition are numbered in the lower bits of ``monotonically_increasing_id``.
_BITS = 33


def numbered(rows: DataFrame, group: list[str], order: list[Column | str]) -> DataFrame:
    """``rows`` with ``idx``, their number from 0 within ``group`` by ``order``, and ``group_rows``, the rows of the group.

    Rows are dealt by ranges of (group, order), so a group of any size lies in neighbouring
    partitions; only one row for each partition that a group touches is added up.  Rows that
    are equal in ``order`` are numbered in any order.  Nulls in ``group`` are a group and sort
    first; an empty table stays empty.  ``rows`` is read twice (once to find the ranges).
    """
    keys = [F.col(c).asc_nulls_first() for c in group] + list(order)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()
    dealt = stored(dealt.withColumn("_place", place))
    dealt = dealt.withColumn("_part", F.shiftright("_place", _BITS)).withColumn("_place", F.col("_place").bitwiseAND((1 << _BITS) - 1))
    own = [f"_group{k}" for k in range(len(group))]
    named = [F.col(c).alias(o) for c, o in zip(group, own)]
    runs = dealt.groupBy(F.col("_part").alias("_run"), *named).agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    span = Window.partitionBy(*own)
    before = F.sum("_n").over(span.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumns({"_skip": F.coalesce(before, F.lit(0)), "group_rows": F.sum("_n").over(span)})
    same = [F.col("_part") == F.col("_run"), *(F.col(c).eqNullSafe(F.col(o)) for c, o in zip(group, own))]
    idx = F.col("_place") - F.col("_first") + F.col("_skip")
    return dealt.join(runs, same).select(*rows.columns, idx.alias("idx"), "group_rows")

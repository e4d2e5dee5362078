"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it has more than this part of all counted rows.  So there are at most as many
#: hot keys, whatever the size of the table, and their list may be broadcast.
HOT_PART = 1000


def salted_lookup(rows: DataFrame, table: DataFrame, key: str, n: str = "n") -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row for each key and its frequency ``n`` in ``rows``.

    Rows of a hot key are dealt over salts in number to its share, so no task meets more than about a
    thousandth of the counted rows for one key; the answers of hot keys, at most a thousand, are
    repeated for each salt.  ``rows`` is read once, and the counts behind ``table`` need one reading more.
    """
    answers = [c for c in table.columns if c != key]
    spark = rows.sparkSession
    salts = f"int(ceil({n} * {HOT_PART} / (SELECT sum({n}) FROM {{counted}})))"
    counted = spark.sql(f"SELECT *, {salts} AS _salts FROM {{counted}}", counted=table)
    hot = counted.where("_salts > 1").select(key, F.col("_salts").alias("_hot"))
    dealt = rows.join(F.broadcast(hot), key, "left")
    salt = F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64(*rows.columns), F.col("_hot"))).otherwise(F.lit(0)).cast("int")
    copies = counted.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(F.col("_salts"), F.lit(1)) - 1)))
    return dealt.withColumn("_salt", salt).join(copies, [key, "_salt"]).select(*rows.columns, *answers)


def salted_left_lookup(rows: DataFrame, table: DataFrame, key: str, n: str = "n") -> DataFrame:
    """:func:`salted_lookup` that keeps the rows without a key, with no answer.

    ``table`` has every key of ``rows``.  Rows without a key get a place of their own, dealt over many
    tasks, so ``rows`` is read once.
    """
    answers = [c for c in table.columns if c != key]
    spark = rows.sparkSession
    salts = f"int(ceil({n} * {HOT_PART} / (SELECT sum({n}) FROM {{counted}})))"
    counted = spark.sql(f"SELECT *, {salts} AS _salts FROM {{counted}}", counted=table.where(F.col(key).isNotNull()))
    hot = counted.where("_salts > 1").select(key, F.col("_salts").alias("_hot"))
    dealt = rows.join(F.broadcast(hot), key, "left")
    place = F.pmod(F.xxhash64(*rows.columns), F.coalesce("_hot", F.lit(HOT_PART).cast("long")))
    salt = F.when(F.col("_hot").isNotNull(), place).when(F.col(key).isNull(), -1 - place).otherwise(F.lit(0)).cast("int")
    copies = counted.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(F.col("_salts"), F.lit(1)) - 1)))
    return dealt.withColumn("_salt", salt).join(copies, [key, "_salt"], "left").select(*rows.columns, *answers)


def left_lookup(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join of ``rows`` with ``table``, which has one row for each key.

    Rows without a key have no answer; they are dealt over many tasks and not sent to one.
    """
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*rows.columns), F.lit(HOT_PART)) + 1).otherwise(F.lit(0))
    answers = [c for c in table.columns if c != key]
    side = table.where(F.col(key).isNotNull()).withColumns({"_key": F.col(key), "_spread": F.lit(0).cast("long")}).drop(key)
    dealt = rows.withColumn("_spread", spread.cast("long"))
    on = (dealt[key] == side["_key"]) & (dealt["_spread"] == side["_spread"])
    return dealt.join(side, on, "left").select(*(dealt[c] for c in rows.columns), *(side[c] for c in answers))

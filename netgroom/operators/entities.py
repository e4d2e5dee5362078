"""One device on many rows: classes of rows that share an address or a name, directly or over others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netgroom.operators.skew import salted_lookup
from netgroom.session import stored

#: Fields that tell a device, and when they do: not addresses that every device has.
IDENTITIES = {
    "mac": "mac IS NOT NULL",
    "ip": "ip_valid AND ip_type IN ('private_rfc1918', 'public_or_other')",
    "fqdn": "fqdn LIKE '%.%'",
}


def identity_values(clean: DataFrame, key: str = "source_row_id", identities: dict[str, str] | None = None) -> DataFrame:
    """(key, value) of every row and every field that tells its device; rows without a key are left out."""
    tests = IDENTITIES if identities is None else identities
    values = [F.when(F.expr(test), F.concat(F.lit(f"{field}:"), F.col(field))) for field, test in tests.items()]
    return clean.where(F.col(key).isNotNull()).select(F.col(key).alias("row"), F.explode(F.array_compact(F.array(*values))).alias("value"))


def device_classes(clean: DataFrame, key: str = "source_row_id", identities: dict[str, str] | None = None) -> DataFrame:
    """(key, class_id, class_rows) of every row: ``class_id`` is the least key reachable over shared values.

    Rows and values are the two sides of a graph, so a value on many rows makes as many edges and no
    pairs.  In each round every value takes the least label of its rows and every label the least of
    its values; labels that point to each other are followed to the end, and the graph is
    contracted to the labels left.  Labels and values may be shared by any part of the rows: they
    are counted before each join.  Rows that repeat a key are one node; a row that shares nothing is a class
    of its own; rows without a key have none and are left out.
    """
    rows = clean.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("row")).agg(F.count(F.lit(1)).alias("_rows"))
    assigned = stored(rows.withColumn("label", F.col("row")), "classes")
    pairs = _connecting(identity_values(clean, key, identities).select(F.col("row").alias("label"), "value").distinct())
    while not pairs.isEmpty():
        low = pairs.groupBy("value").agg(F.min("label").alias("low"), F.count(F.lit(1)).alias("n"))
        hooks = salted_lookup(pairs, low, "value").groupBy("label").agg(F.min("low").alias("to"))
        hooks = _followed(stored(hooks, "classes"))
        assigned = stored(_renamed(assigned, hooks), "classes")
        pairs = _connecting(_renamed(pairs, hooks).distinct())
    sizes = assigned.groupBy("label").agg(F.sum("_rows").alias("class_rows"), F.count(F.lit(1)).alias("n"))
    found = salted_lookup(assigned, sizes, "label")
    return found.select(F.col("row").alias(key), F.col("label").alias("class_id"), "class_rows")


def _connecting(pairs: DataFrame) -> DataFrame:
    """The pairs (label, value) whose value joins several labels; the others are settled."""
    pairs = stored(pairs, "classes")
    several = pairs.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return stored(salted_lookup(pairs, several, "value").select("label", "value"), "classes")


def _followed(hooks: DataFrame) -> DataFrame:
    """(label, to) with each label led to the end of its chain; the length of a chain is halved in each round."""
    while True:
        counted = hooks.groupBy("to").agg(F.count(F.lit(1)).alias("n"))
        ahead = counted.join(hooks.select(F.col("label").alias("to"), F.col("to").alias("ahead")), "to", "left")
        found = salted_lookup(hooks, ahead.withColumn("ahead", F.coalesce("ahead", "to")), "to")
        if found.where("ahead <> to").isEmpty():
            return hooks
        hooks = stored(found.select("label", F.col("ahead").alias("to")), "classes")


def _renamed(rows: DataFrame, hooks: DataFrame) -> DataFrame:
    """``rows`` with the new label of each; labels without a hook stay."""
    counted = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).join(hooks, "label", "left")
    found = salted_lookup(rows, counted, "label")
    renamed: Column = F.coalesce("to", "label")
    return found.withColumn("label", renamed).select(*rows.columns)

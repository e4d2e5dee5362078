"""Misspelt names: the nearest name of a list by at most two edits, found by equal deletions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netgroom.functions.device import EXACT
from netgroom.operators.skew import salted_left_lookup
from netgroom.session import stored

#: Edits that are followed, and the least length of a text for each number of them.
EDITS, LEAST = 2, {1: 4, 2: 6}
#: Confidence of a name without edits, and what each edit takes from it.
FULL, LOSS = 100, 20


def deletions(text: Column, edits: int = EDITS) -> Column:
    """All texts left after up to ``edits`` characters are taken out."""
    found = F.array(text)
    for _ in range(edits):
        cut = lambda t: F.transform(
            F.sequence(F.lit(0), F.greatest(F.length(t) - 1, F.lit(0))),
            lambda k: F.concat(F.substring(t, F.lit(1), k), F.substring(t, k + 2, F.length(t))),
        )
        found = F.array_distinct(F.concat(found, F.flatten(F.transform(found, cut))))
    return found


def nearest_names(texts: DataFrame, names: Sequence[str], text: str = "text", edits: int = EDITS) -> DataFrame:
    """(text, name, distance): the nearest of ``names`` for each text within ``edits``; texts without one are left out.

    Two texts within n edits share a text that is left after taking up to n characters out of
    each, so candidates meet by equality and are then measured.  A text more than ``edits`` longer or
    shorter than all names can have none.  Of names equally near the first of the list counts.  A text must be long
    enough for its edits (``LEAST``).
    """
    spark = texts.sparkSession
    listed = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "place int, name string")
    longest, shortest = max(map(len, names), default=0), min(map(len, names), default=0)
    known = listed.select("place", "name", F.explode(deletions(F.col("name"), edits)).alias("part"))
    asked = texts.select(F.col(text).alias("text")).where(F.length("text").between(shortest - edits, longest + edits)).distinct()
    tried = asked.select("text", F.explode(deletions(F.col("text"), edits)).alias("part"))
    met = tried.join(F.broadcast(known), "part").select("text", "place", "name").distinct()
    measured = met.withColumn("distance", F.levenshtein("text", "name"))
    long_enough = F.lit(False)
    for n in range(edits + 1):
        long_enough |= (F.col("distance") == n) & (F.length("text") >= LEAST.get(n, 0))
    best = measured.where(long_enough).groupBy("text").agg(F.min(F.struct("distance", "place", "name")).alias("b"))
    return best.select(F.col("text").alias(text), "b.name", "b.distance")


def guess_device_type(fields: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """``fields`` (rows of ``clean_fields``) with the type of misspelt names, its confidence and reason.

    Only rows that matched nothing are looked at, by their text in lower case without
    blanks around it; each text is looked up once.  The reason is ``misspelt_1`` or ``misspelt_2``; a text that
    is near to nothing stays as it is.
    """
    names = EXACT if names is None else names
    text = F.lower(F.trim("device_type"))
    rows = fields.withColumn("_text", F.when(F.col("device_type_reason") == "no_match", text))
    # stored before it is filtered: a filter would go below the cleaning with all of its patterns
    counted = stored(rows.groupBy("_text").agg(F.count(F.lit(1)).alias("n")), "texts").where("_text IS NOT NULL")
    best = nearest_names(counted, list(names), "_text")
    kind = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    found = stored(counted.join(best, "_text", "left").withColumn("_type", kind[F.col("name")]), "texts")
    told = salted_left_lookup(rows, found, "_text")
    guessed = F.col("_type").isNotNull()
    return told.withColumns(
        {
            "device_type_clean": F.when(guessed, F.col("_type")).otherwise(F.col("device_type_clean")),
            "device_type_confidence": F.when(guessed, F.lit(FULL) - LOSS * F.col("distance")).otherwise(F.col("device_type_confidence")).cast("long"),
            "device_type_reason": F.when(guessed, F.concat(F.lit("misspelt_"), F.col("distance").cast("string"))).otherwise(F.col("device_type_reason")),
        }
    ).select(*fields.columns)

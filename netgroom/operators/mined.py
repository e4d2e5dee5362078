"""Rules that the table itself shows: fields that nearly always follow from another one."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netgroom.operators.skew import salted_lookup
from netgroom.sources.schema import ANOMALY

#: A value speaks for a rule from this number of rows on, and if this part of them agrees.
SUPPORT, AGREE = 5, 0.9

#: Expressions of a clean table that may follow from each other.
HOST_PREFIX = "regexp_extract(hostname, '^[a-z]+', 0)"


@dataclass(frozen=True)
class Dependency:
    """``then`` follows from ``given``; both are SQL expressions of a row, ``field`` is the one to look at."""

    given: str
    then: str
    field: str

    @property
    def name(self) -> str:
        return f"{self.given} -> {self.then}"


DEPENDENCIES = [
    Dependency("site_normalized", "subnet_cidr", "subnet_cidr"),
    Dependency("subnet_cidr", "site_normalized", "site_normalized"),
    Dependency(HOST_PREFIX, "device_type", "device_type"),
]


def _sides(clean: DataFrame, dependencies: Sequence[Dependency], key: str) -> DataFrame:
    """(key, rule, given, then) of every row and dependency; rows without one of the two say nothing."""
    def text(e: str):
        return F.nullif(F.expr(e).cast("string"), F.lit(""))

    each = [F.struct(F.lit(d.name).alias("rule"), text(d.given).alias("given"), text(d.then).alias("then")) for d in dependencies]
    sides = clean.select(F.col(key), F.explode(F.array(*each)).alias("s")).select(key, "s.*")
    return sides.where("given IS NOT NULL AND then IS NOT NULL AND given <> 'unknown' AND then <> 'unknown'")


def _majorities(sides: DataFrame) -> DataFrame:
    """(rule, given, usual, agree, n): the most frequent value behind each one, ties to the smaller."""
    counted = sides.groupBy("rule", "given", "then").agg(F.count(F.lit(1)).alias("c"))
    best = F.min(F.struct((-F.col("c")).alias("c"), "then")).alias("b")
    return counted.groupBy("rule", "given").agg(best, F.sum("c").alias("n")).select("rule", "given", F.col("b.then").alias("usual"), (-F.col("b.c")).alias("agree"), "n")


def mine_dependencies(
    clean: DataFrame, dependencies: Sequence[Dependency] = tuple(DEPENDENCIES), key: str = "source_row_id", support: int = SUPPORT
) -> DataFrame:
    """(rule, values, rows, kept, violations, confidence): how far each dependency holds.

    Only values with ``support`` rows or more count.  ``kept`` rows have the usual value, the others are
    ``violations``; ``confidence`` is the kept part in percent, rounded down.  A dependency
    without such values is left out.
    """
    usual = _majorities(_sides(clean, dependencies, key)).where(F.col("n") >= support)
    total = usual.groupBy("rule").agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows"), F.sum("agree").alias("kept"))
    return total.withColumns({"violations": F.col("rows") - F.col("kept"), "confidence": F.expr("kept * 100 div rows")})


def dependency_violations(
    clean: DataFrame,
    dependencies: Sequence[Dependency] = tuple(DEPENDENCIES),
    key: str = "source_row_id",
    support: int = SUPPORT,
    agree: float = AGREE,
) -> DataFrame:
    """Rows that break what ``agree`` or more of the rows with the same value show, as anomaly records.

    The confidence is that part in percent, rounded down.  Counting comes before the join, which is
    salted by the counts: a value may stand on any part of the rows.  Rows without one of the
    two values, or with ``unknown``, break nothing; a row that breaks several dependencies has a
    record for each.
    """
    sides = _sides(clean, dependencies, key).withColumn("side", F.struct("rule", "given"))
    usual = _majorities(sides).where((F.col("n") >= support) & (F.col("agree") >= agree * F.col("n")))
    answers = usual.select(F.struct("rule", "given").alias("side"), "usual", "agree", "n")
    broken = salted_lookup(sides, answers, "side").where("then <> usual")
    field = F.create_map(*[F.lit(x) for d in dependencies for x in (d.name, d.field)])[F.col("rule")]
    issue = F.concat(field, F.lit(" is "), F.col("then"), F.lit(" where "), F.col("agree"), F.lit(" of "), F.col("n"), F.lit(" rows with "), F.col("given"), F.lit(" have "), F.col("usual"))
    return broken.select(
        F.col(key).alias("source_row_id"),
        F.array(field).alias("affected_fields"),
        issue.alias("issue_type"),
        F.lit("modify").alias("recommended_action"),
        F.expr("agree * 100 div n").alias("anomaly_confidence"),
    ).select(*ANOMALY.names)

"""Team proposals learned from the rows whose team is known.

Each field that may tell a team is evidence: how much more often its value stands beside a
team than that team stands anywhere, as a smoothed log ratio.  The evidence of a row's values
adds up to a score for each team.  A part of the known rows is not learned from; there the margin
between the best two teams is compared with how often the best was right, and that gives
the confidence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netgroom.operators.skew import salted_lookup
from netgroom.session import stored

#: Fields that may tell a team, as SQL expressions of a clean row.
EVIDENCE = ["site_normalized", "device_type", "subnet_cidr", "regexp_extract(hostname, '^[a-z]+', 0)"]
#: Weight of the team's own share in each ratio, the part of the known rows kept for calibration, and its steps of margin.
WEIGHT, HELD_OUT, STEPS = 2.0, 5, 10


def _values(rows: DataFrame, key: str, evidence: Sequence[str]) -> DataFrame:
    """(key, value) of every row and field; empty and unknown values tell nothing."""
    def value(e: str) -> Column:
        text = F.expr(e).cast("string")
        return F.when((text != "") & (text != "unknown"), F.concat(F.lit(f"{e}="), text))

    return rows.select(key, F.explode(F.array_compact(F.array(*map(value, evidence)))).alias("value"))


def team_evidence(known: DataFrame, key: str, team: str, evidence: Sequence[str] = tuple(EVIDENCE)) -> tuple[DataFrame, DataFrame]:
    """(team, prior) of every team and (value, team, weight) of every value beside a team, from rows whose team is known.

    ``prior`` is the log of the team's share; ``weight`` is the log of (n + WEIGHT * share) / (WEIGHT * share)
    with n rows of the value and the team, which is what the ratio exceeds that of a team never seen
    with the value.
    """
    teams = known.groupBy(F.col(team).alias("team")).agg(F.count(F.lit(1)).alias("c"))
    total = teams.agg(F.sum("c").alias("total"))
    spark = known.sparkSession
    teams = spark.sql("SELECT team, c / (SELECT total FROM {total}) AS share FROM {teams}", teams=teams, total=total)
    teams = stored(teams.withColumn("prior", F.log("share")), "teams")
    pairs = _values(known.select("*", F.col(team).alias("_team")), "_team", evidence).groupBy("value", F.col("_team").alias("team")).agg(F.count(F.lit(1)).alias("c"))
    ratio = (F.col("c") + WEIGHT * F.col("share")) / (WEIGHT * F.col("share"))
    weights = pairs.join(teams, "team").select("value", "team", F.log(ratio).alias("weight"))
    return teams.select("team", "prior"), weights


def best_teams(rows: DataFrame, learned: tuple[DataFrame, DataFrame], key: str, evidence: Sequence[str] = tuple(EVIDENCE)) -> DataFrame:
    """(key, team, margin): the team with the highest score of each row, and by how much it is ahead of the next.

    Rows with no value that was seen beside a team are left out.  Equal scores go to the team that
    sorts first.  The margin is rounded to 6 places; the only team has that of its score against none.
    """
    priors, weights = learned
    beside = weights.groupBy("value").agg(F.collect_list(F.struct("team", "weight")).alias("teams"))
    asked = _values(rows, key, evidence)
    counted = asked.groupBy("value").agg(F.count(F.lit(1)).alias("n")).join(beside, "value")
    told = salted_lookup(asked, counted, "value").select(key, F.inline("teams"))
    scores = told.groupBy(key, "team").agg(F.sum("weight").alias("score"))
    scores = scores.join(priors, "team").select(key, "team", F.round(F.col("score") + F.col("prior"), 6).alias("score"))
    order = Window.partitionBy(key).orderBy(F.col("score").desc(), "team")
    ranked = scores.withColumns({"k": F.row_number().over(order), "next": F.lead("score").over(order)}).where("k = 1")
    return ranked.select(key, "team", F.round(F.coalesce(F.col("score") - F.col("next"), F.lit(float(STEPS))), 6).alias("margin"))


def _step() -> Column:
    return F.least(F.floor("margin"), F.lit(STEPS - 1)).cast("long")


def calibration(held: DataFrame, key: str, team: str, found: DataFrame) -> DataFrame:
    """(step, n, right, confidence): how often the best team was right on ``held`` rows, by whole steps of the margin.

    ``confidence`` is (right + 1) / (n + 2) in percent, rounded down, so few rows tell little.
    """
    truth = held.select(key, F.col(team).alias("_truth"))
    steps = truth.join(found, key).groupBy(_step().alias("step")).agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("team") == F.col("_truth")).cast("long")).alias("right"))
    return steps.withColumn("confidence", F.expr("(right + 1) * 100 div (n + 2)"))


def learn_owner(clean: DataFrame, key: str = "source_row_id", team: str = "owner_team", evidence: Sequence[str] = tuple(EVIDENCE)) -> DataFrame:
    """Proposals (key, owner, owner_team, owner_email, confidence_percentage) for the rows whose team is missing.

    Owner and e-mail stay as they are.  One known row in ``HELD_OUT``, by its key, is not learned from but
    tells the confidence; a margin that none of them had gets 50.  Rows without a key are neither learned from nor
    answered; rows that repeat a key are taken together.
    """
    rows = clean.where(F.col(key).isNotNull())
    known = rows.where(F.col(team).isNotNull())
    out = F.pmod(F.xxhash64(F.col(key).cast("string")) if clean.schema[key].dataType.typeName() == "string" else F.col(key), F.lit(HELD_OUT)) == 0
    learned = team_evidence(known.where(~out), key, team, evidence)
    held = known.where(out)
    steps = calibration(held, key, team, best_teams(held, learned, key, evidence))
    missing = rows.where(F.col(team).isNull())
    found = best_teams(missing, learned, key, evidence).withColumn("step", _step()).join(F.broadcast(steps), "step", "left")
    answers = found.select(key, F.col("team").alias("_team"), F.coalesce("confidence", F.lit(50)).cast("double").alias("confidence_percentage"))
    own = missing.groupBy(key).agg(F.any_value("owner").alias("owner"), F.any_value("owner_email").alias("owner_email"))
    return own.join(answers, key).select(key, "owner", F.col("_team").alias("owner_team"), "owner_email", "confidence_percentage")

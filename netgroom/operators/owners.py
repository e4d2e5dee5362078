"""Correction of owners: proposals with a confidence, merged above a threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netgroom.operators.skew import left_lookup
from netgroom.sources.schema import OWNER_COLUMNS

ACCEPT_FROM = 70

# Owner texts that name a team.
TEAM_NAMES = ["facilities", "ops", "platform", "sec"]

_PROPOSED = {c: f"_proposed_{c}" for c in OWNER_COLUMNS}


def high_confidence(proposals: DataFrame, threshold: float = ACCEPT_FROM) -> DataFrame:
    """Proposals to be applied; a proposal without a confidence is not."""
    return proposals.where(F.col("confidence_percentage") >= threshold)


def _rule(df: DataFrame, teams: list[str]) -> DataFrame:
    """Add the proposed owner, team, e-mail and confidence next to the present values."""
    owner, team, email = F.col("owner"), F.col("owner_team"), F.col("owner_email")
    is_team = F.coalesce(owner.isin(teams) & team.isNull(), F.lit(False))
    from_email = owner.isNull() & email.isNotNull()
    return df.withColumns(
        {
            "_proposed_owner": F.when(is_team, None)
            .when(from_email, F.substring_index(email, "@", 1))
            .otherwise(owner),
            "_proposed_owner_team": F.when(is_team, owner).otherwise(team),
            "_proposed_owner_email": email,
            "confidence_percentage": F.when(from_email, 80).otherwise(100).cast("double"),
        }
    )


def propose_owner(clean: DataFrame, teams: list[str] | None = None) -> DataFrame:
    """Proposals by rule, one for each row.

    A team name in the owner column moves to the team; a missing owner is
    taken from the e-mail address; anything else stays.
    """
    ruled = _rule(clean, TEAM_NAMES if teams is None else teams)
    return ruled.select(
        "source_row_id", *[F.col(p).alias(c) for c, p in _PROPOSED.items()], "confidence_percentage"
    )


def correct_owner(
    clean: DataFrame, teams: list[str] | None = None, threshold: float = ACCEPT_FROM
) -> DataFrame:
    """Apply the rule of :func:`propose_owner` to its own rows; needs no join."""
    accepted = F.col("confidence_percentage") >= threshold
    ruled = _rule(clean, TEAM_NAMES if teams is None else teams)
    return ruled.withColumns(
        {c: F.when(accepted, F.col(p)).otherwise(F.col(c)) for c, p in _PROPOSED.items()}
    ).select(*clean.columns)


def _one_per_row(proposals: DataFrame, key: str) -> DataFrame:
    """Fail when two proposals name the same row; otherwise the table as it is."""
    answer = F.struct(*OWNER_COLUMNS)
    counted = proposals.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.any_value(answer).alias("_answer"))
    clash = F.concat(F.lit("more than one proposal for row "), F.col(key))
    checked = F.when(F.col("_n") > 1, F.raise_error(clash)).otherwise(F.col("_answer"))
    return counted.select(key, checked.alias("_answer"))


def merge_owner(clean: DataFrame, proposals: DataFrame, threshold: float = ACCEPT_FROM, key: str = "source_row_id") -> DataFrame:
    """Overwrite owner, e-mail and team of the rows with a confident proposal, also by NULL.

    Proposals name their rows by ``key``: the row id, or a key of every row where ids are
    repeated or missing (a proposal for a repeated key changes all its rows).  The proposals are
    checked for a second one of the same row; the table is read once and joined once.
    Proposals for unknown rows have no effect, see :func:`unknown_proposals`.
    """
    answers = _one_per_row(high_confidence(proposals, threshold).where(F.col(key).isNotNull()), key)
    merged = left_lookup(clean, answers, key)
    found = F.col("_answer").isNotNull()
    return merged.withColumns(
        {c: F.when(found, F.col(f"_answer.{c}")).otherwise(F.col(c)) for c in OWNER_COLUMNS}
    ).select(*clean.columns)


def unknown_proposals(clean: DataFrame, proposals: DataFrame, key: str = "source_row_id") -> DataFrame:
    """Proposals whose row is not in the table, and those without a row id."""
    known = clean.select(key).distinct()
    return proposals.join(known, key, "left_anti").select(*proposals.columns)

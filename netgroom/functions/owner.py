"""Owner texts split into person, e-mail address and team."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netgroom.functions.stages import Stages, add_fields
from netgroom.functions.text import WORD, strip, strip_column

# Finds what Python's [\w\.-]+@[\w\.-]+\.\w+ finds.  A match can only begin where a run of
# name characters begins or where the match before ended, which keeps long texts linear.
EMAIL = rf"(?:\G|(?<![{WORD}.-]))[{WORD}.-]++@[{WORD}.-]+\.[{WORD}]+"
_PARENS = r"\(([^\n]*?)\)"


@cache
def owner_stages(source: str = "owner", out: str = "owner") -> Stages:
    s, mail, rest, bare, name = (F.col(f"_{out}_{x}") for x in ("text", "mail", "rest", "bare", "name"))
    has_at = s.contains("@")
    return [
        {f"_{out}_text": strip_column(source)},
        {
            f"_{out}_mail": F.when(has_at, F.regexp_extract(s, EMAIL, 0)),
            f"_{out}_rest": F.when(has_at, strip(F.regexp_replace(s, EMAIL, ""))).otherwise(s),
        },
        {
            f"{out}_email": F.when(mail != "", mail),
            f"_{out}_bare": F.when(rest.contains("("), F.regexp_replace(rest, _PARENS, "")).otherwise(rest),
        },
        {
            f"_{out}_name": strip(bare),
            f"{out}_team": F.when(bare != rest, strip(F.regexp_extract(rest, _PARENS, 1))),
        },
        {
            f"{out}_clean": F.when(name != "", F.lower(name)),
            f"{out}_reason": F.when(s.isNull() | (s == ""), "missing").otherwise(
                "owner_valid_and_normalized"
            ),
        },
    ]


def parse_owner(df: DataFrame, source: str = "owner", out: str = "owner") -> DataFrame:
    """Add ``{out}_clean``, ``{out}_email``, ``{out}_team`` and ``{out}_reason``.

    The first address and the first parenthesised part count; all of them are
    taken out of the name.  An empty pair of parentheses gives the team ``""``.
    """
    return add_fields(df, owner_stages(source, out))

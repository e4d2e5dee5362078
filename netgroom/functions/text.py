"""String helpers whose results equal Python's, written as native Spark columns.

Spark and Java differ from Python in what counts as white space, a word
character or a digit.  The differences are handled here once; the field
functions only use these helpers.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# All characters that ``str.strip()`` removes, derived from Python's own rule.
PY_SPACE = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())
ASCII_SPACE = "".join(c for c in PY_SPACE if c.isascii())

# Python's \w in Java spelling, for use inside a character class.
WORD = r"\p{L}\p{N}_"

_WORD_EDGE = f"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"


def java_regex(pattern: str) -> str:
    r"""Give a simple Python pattern (``\b`` and ``\d`` outside classes) its Java form."""
    return pattern.replace(r"\b", _WORD_EDGE).replace(r"\d", r"\p{Nd}")


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def strip(c: Column) -> Column:
    """``str.strip()`` without a regular expression."""
    return F.btrim(c, F.lit(PY_SPACE))


def strip_column(name: str) -> Column:
    """:func:`strip` of a plain column, with a short list of characters for ASCII text."""
    c = F.col(name)
    return F.when(is_ascii(c), F.btrim(c, F.lit(ASCII_SPACE))).otherwise(strip(c))


def squeeze_column(name: str, chars: str, to: str) -> Column:
    """Replace each run of white space and ``chars`` in a plain column by ``to``."""
    c = F.col(name)
    runs = lambda space: F.regexp_replace(c, f"[{java_class(space + chars)}]+", to)
    return F.when(is_ascii(c), runs(ASCII_SPACE)).otherwise(runs(PY_SPACE))


def java_class(chars: str) -> str:
    """The characters as the inside of a Java character class."""
    return "".join(rf"\x{{{ord(c):x}}}" for c in chars)


def count_char(c: Column, char: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))


def _digit_table() -> tuple[str, str]:
    """Translation of every non-ASCII digit: decimal digits to 0-9, others to a superscript two.

    ``int()`` accepts decimal digits of any script; ``str.isdigit()`` also
    accepts superscripts and the like, which ``int()`` then refuses.
    """
    source, target = [], []
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        value = unicodedata.decimal(char, None)
        if value is not None:
            source.append(char)
            target.append(str(value))
        elif char.isdigit():
            source.append(char)
            target.append("²")
    return "".join(source), "".join(target)


_DIGITS_FROM, _DIGITS_TO = _digit_table()


def stripped_plain_digits(name: str) -> Column:
    """Stripped column with the digits of all scripts as 0-9 (see :func:`_digit_table`)."""
    c = F.col(name)
    wide = F.translate(strip(c), _DIGITS_FROM, _DIGITS_TO)
    return F.when(is_ascii(c), F.btrim(c, F.lit(ASCII_SPACE))).otherwise(wide)

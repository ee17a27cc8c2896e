"""Column helpers for text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode property White_Space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Python's str.strip also removes the four ASCII separators.
PYTHON_WHITE_SPACE = WHITE_SPACE + "\x1c\x1d\x1e\x1f"


def strip(col: Column, chars: str = WHITE_SPACE) -> Column:
    """Remove ``chars`` at both ends; Spark's plain ``trim`` only knows the space."""
    return F.btrim(col, F.lit(chars))


def drop_prefix(col: Column, prefix: str) -> Column:
    """Remove one ``prefix`` where the text starts with it."""
    rest = F.substring(col, F.lit(len(prefix) + 1), F.length(col))
    return F.when(col.startswith(prefix), rest).otherwise(col)


def drop_suffix(col: Column, suffix: str) -> Column:
    """Remove one ``suffix`` where the text ends with it."""
    rest = F.left(col, F.length(col) - len(suffix))
    return F.when(col.endswith(suffix), rest).otherwise(col)


def two_decimals(col: Column) -> Column:
    """Two decimals, rounding the exact binary value and exact ties to even."""
    return F.format_number(col, 2)

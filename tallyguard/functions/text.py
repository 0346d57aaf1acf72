"""Text: stripping, folding and Yes/No flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Unicode counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The words read as true and as false.
TRUE_WORDS = ("yes", "y", "true", "1")
FALSE_WORDS = ("no", "n", "false", "0")


def strip(text: Column) -> Column:
    """Remove white space at both ends, tabs, line ends and no-break spaces included."""
    return F.trim(text, F.lit(WHITESPACE))


def fold(text: Column) -> Column:
    """Strip and lower-case, for comparisons that ignore case."""
    return F.lower(strip(text))


def yes_no_flag(text: Column) -> Column:
    """1.0 for a true word, 0.0 for a false word, NULL for anything else."""
    word = fold(text.cast("string"))
    return F.when(word.isin(*TRUE_WORDS), F.lit(1.0)).when(word.isin(*FALSE_WORDS), F.lit(0.0))

"""Column expressions over texts that the native operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space that separates words, and the ASCII letters.
SPACE = " \t\n\x0b\f\r"
SPACES = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """The words of a text between runs of white space; none for null and for blank texts."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(bare) > 0, F.split(bare, SPACES)).otherwise(F.array().cast("array<string>"))


def lines(text: Column) -> Column:
    r"""The lines of a text, split at \n; one empty line for null and for the empty text."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, UPPER.lower())

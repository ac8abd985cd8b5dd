"""Text as column expressions: normalising, splitting, joining, and the values that stand for "nothing"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that mean "no value", accented letters with their plain ones, words for "true".
NULL_WORDS = ("", "NAN", "NONE", "NULL")
NAME_BLANKS = ("", "-", "NAN", "NONE")
ACCENTED = "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ"
PLAIN = "AAAAAEEEEIIIIOOOOOUUUUCN"
TRUE_WORDS = ("TRUE", "VERDADEIRO", "1", "SIM")
NO_BLOCK = ("", "N", "N/A", "NA", "SN", "S/N")

_ENDS = r"^[\s ]+|[\s ]+$"


def strip(c: Column) -> Column:
    """Without white space at both ends, non-breaking spaces too."""
    return F.regexp_replace(c, _ENDS, "")


def upper_or_null(c: Column) -> Column:
    """Stripped and upper-cased; words for "no value" become null."""
    up = F.upper(strip(c.cast("string")))
    return F.when(~up.isin(*NULL_WORDS), up)


def fold(c: Column) -> Column:
    """Upper case without accents, runs of white space as one blank; null as the empty text."""
    up = F.translate(F.upper(F.coalesce(c.cast("string"), F.lit(""))), ACCENTED, PLAIN)
    return strip(F.regexp_replace(up, r"[\s ]+", " "))


def person(c: Column) -> Column:
    """A person's name, accents kept; placeholders become the empty text."""
    up = F.upper(strip(F.coalesce(c.cast("string"), F.lit(""))))
    return F.when(up.isin(*NAME_BLANKS), F.lit("")).otherwise(up)


def safe(c: Column) -> Column:
    """Stripped text; null and words for "no value" become the empty text."""
    bare = strip(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(F.upper(bare).isin(*NULL_WORDS), F.lit("")).otherwise(bare)


def code(c: Column) -> Column:
    """A listing code: whole numbers written as decimals lose the fraction, all else is stripped."""
    bare = strip(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(bare.rlike(r"^\d+\.0+$"), F.regexp_replace(bare, r"\.0+$", "")).otherwise(bare)


def licence(c: Column) -> Column:
    """The digits of a licence number without a trailing ``.0``; null if there are none."""
    digits = F.regexp_replace(F.regexp_replace(strip(c.cast("string")), r"\.0$", ""), "[^0-9]", "")
    return F.nullif(digits, F.lit(""))


def licence_is_valid(c: Column) -> Column:
    return F.coalesce(F.length(c) >= 4, F.lit(False))


def is_true(c: Column) -> Column:
    return F.coalesce(F.upper(strip(c.cast("string"))).isin(*TRUE_WORDS), F.lit(False))


def unquoted_upper(c: Column) -> Column:
    """For booleans that an export wrote with an apostrophe."""
    return F.upper(F.replace(c, F.lit("'"), F.lit("")))


def names(c: Column, at_most: int = 3) -> Column:
    """The distinct names of a list separated by any of ``| ; , /``, in order."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), r"[|;,/]"), strip)
    return F.slice(F.array_distinct(F.filter(parts, lambda x: x != "")), 1, at_most)


def three_names(c: Column) -> list[Column]:
    """The parts between bars as exactly three columns, empty where there are fewer."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), r"\|"), strip)
    return [F.coalesce(F.get(parts, k), F.lit("")) for k in range(3)]


def joined_names(*cols: Column, default: str = "N/D") -> Column:
    """Names joined by bars, without the empty ones."""
    text = F.concat_ws(" | ", *[F.nullif(safe(c), F.lit("")) for c in cols])
    return F.when(text == "", F.lit(default)).otherwise(text)


def address(street: Column, number: Column, block: Column, extra: Column, default: str = "N/D") -> Column:
    """Street, number, block (unless it says there is none) and complement."""
    part = lambda c: F.nullif(safe(c), F.lit(""))
    named = F.when(~F.upper(safe(block)).isin(*NO_BLOCK), F.concat(F.lit("Bloco "), safe(block)))
    text = F.concat_ws(" ", part(street), part(number), named, part(extra))
    return F.when(text == "", F.lit(default)).otherwise(text)


def first_text(*cols: Column, default: str = "") -> Column:
    """The first that is not blank."""
    return F.coalesce(*[F.nullif(strip(c.cast("string")), F.lit("")) for c in cols], F.lit(default))

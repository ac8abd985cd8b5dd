"""Numbers written in either locale, and money for display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def comma_decimal(c: Column) -> Column:
    """Points are always thousands, the comma is the decimal sign; null if unreadable."""
    text = F.replace(F.replace(F.trim(c.cast("string")), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return text.try_cast("double")


def either_decimal(c: Column, keep_sign: bool = True) -> Column:
    """With both signs points are thousands; a comma alone or a point alone is the decimal sign; null if unreadable."""
    text = F.regexp_replace(c.cast("string"), r"R\$|[\s ]", "")
    text = F.regexp_replace(text, r"[^0-9.,\-]" if keep_sign else r"[^0-9.,]", "")
    both = F.contains(text, F.lit(".")) & F.contains(text, F.lit(","))
    plain = F.when(both, F.replace(text, F.lit("."), F.lit(""))).otherwise(text)
    return F.replace(plain, F.lit(","), F.lit(".")).try_cast("double")


def either_decimal_or_zero(c: Column) -> Column:
    return F.coalesce(either_decimal(c), F.lit(0.0))


def whole(c: Column) -> Column:
    """The whole part; null if unreadable."""
    return c.try_cast("double").try_cast("int")


def number_or(c: Column, default: float | None = None) -> Column:
    out = c.try_cast("double")
    return out if default is None else F.coalesce(out, F.lit(default))


def money(c: Column) -> Column:
    """Two digits, comma as the decimal sign, points between thousands."""
    return F.translate(F.format_number(c, 2), ",.", ".,")


def per_area(price: Column, area: Column) -> Column:
    return F.try_divide(price, area)


def per_area_if_missing(value: Column, price: Column, area: Column) -> Column:
    """The given value per area unless it is missing or not above zero, and can be worked out."""
    lacks = (F.coalesce(value, F.lit(0.0)) <= 0) & (price > 0) & (area > 0)
    return F.when(lacks, F.try_divide(price, area)).otherwise(value)


def rounded(c: Column | str, digits: int = 4, margin: float = 1e-7) -> Column:
    """Rounded half up, with a margin that swallows the noise of binary fractions: an exact half never falls."""
    return F.round((F.col(c) if isinstance(c, str) else c) + F.lit(margin), digits)

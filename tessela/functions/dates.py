"""Dates from texts, months, and windows of months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The formats that dates come in, the first that fits wins.
FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "dd-MM-yyyy", "yyyy/MM/dd", "dd/MM/yyyy HH:mm", "dd/MM/yyyy HH:mm:ss", "yyyy-MM-dd HH:mm:ss")


def parsed(c: Column) -> Column:
    """A timestamp by the first format that fits the whole text; null if none does."""
    text = F.trim(c.cast("string"))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in FORMATS])


def parsed_within(c: Column) -> Column:
    """As ``parsed``, of the first date found within the text."""
    return parsed(F.nullif(F.regexp_extract(c.cast("string"), r"(\d{4}[-/]\d{2}[-/]\d{2}|\d{2}[-/]\d{2}[-/]\d{4})", 1), F.lit("")))


def in_file_name(c: Column) -> Column:
    """The date that a file's name holds, year first or day first."""
    return F.to_date(parsed_within(F.replace(c, F.lit("_"), F.lit("-"))))


def shown(c: Column, default: Column | None = None) -> Column:
    """Day, month, year; ``default`` (else the empty text) for null."""
    return F.coalesce(F.date_format(c, "dd/MM/yyyy"), default if default is not None else F.lit(""))


def sheet_serial(c: Column) -> Column:
    """Days since the origin that spreadsheets count from."""
    return F.datediff(c, F.lit("1899-12-30").cast("date"))


def month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def window_start(first_of_month: Column, months: int = 3) -> Column:
    """The first day of a window of months that ends with the given one."""
    return F.add_months(F.trunc(first_of_month, "month"), 1 - months)


def in_period(c: Column, start: str | None = None, last_day: str | None = None, midnight: bool = False) -> Column:
    """Within the days from ``start`` to ``last_day``, either of which may be open; with ``midnight`` the last day counts only at its very start."""
    inside = F.lit(True)
    if start is not None:
        inside = inside & (c >= F.lit(start).cast("timestamp"))
    if last_day is not None:
        inside = inside & ((c <= F.lit(last_day).cast("timestamp")) if midnight else (c < F.date_add(F.lit(last_day).cast("date"), 1)))
    return inside

"""Text, number, date and band expressions on their edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessela.functions import dates, numbers, text
from tessela.operators import segments


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(build(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("value", "want"),
    [("R$ 1.234,56", 1234.56), ("1.234", 1.234), ("1234,5", 1234.5), ("-", None), ("", None), (None, None), ("450000.0", 450000.0), ("-3,5", -3.5)],
)
def test_either_decimal(spark, value, want):
    assert one(spark, value, numbers.either_decimal) == want


def test_other_numbers(spark):
    assert one(spark, "450000.0", numbers.comma_decimal) == 4500000.0
    assert one(spark, "x", numbers.either_decimal_or_zero) == 0.0
    assert one(spark, "12.9", numbers.whole) == 12
    assert one(spark, "a", numbers.whole) is None
    assert one(spark, 1234567.5, numbers.money, "double") == "1.234.567,50"
    assert one(spark, 1.00005, numbers.rounded, "double") == 1.0001


@pytest.mark.parametrize("value", ["2025-12-31", "31/12/2025", "31-12-2025", "2025/12/31", "31/12/2025 10:11"])
def test_dates(spark, value):
    assert one(spark, value, dates.parsed).date() == dt.date(2025, 12, 31)


def test_other_dates(spark):
    assert one(spark, "x", dates.parsed) is None
    assert one(spark, "em 31/12/2025, tarde", dates.parsed_within).date() == dt.date(2025, 12, 31)
    assert one(spark, "base_2025-03-01.csv", dates.in_file_name) == dt.date(2025, 3, 1)
    assert one(spark, dt.date(1900, 1, 1), dates.sheet_serial, "date") == 2
    assert one(spark, dt.date(2025, 3, 9), dates.window_start, "date") == dt.date(2025, 1, 1)


def test_text(spark):
    assert one(spark, " águas   claras ", text.fold) == "AGUAS CLARAS"
    assert one(spark, "NaN", text.upper_or_null) is None
    assert one(spark, "-", text.person) == ""
    assert one(spark, "123.0", text.code) == "123"
    assert one(spark, "CRECI 25.432", text.licence) == "25432"
    assert one(spark, "25432.0", text.licence) == "25432"
    assert one(spark, None, text.licence) is None
    assert one(spark, "Ana | Bia;Ana,", text.names) == ["Ana", "Bia"]
    assert one(spark, "verdadeiro", text.is_true) is True


def test_bands(spark):
    right = lambda c: segments.band_right(c, segments.AREA_APARTMENT)
    legacy = lambda c: segments.band_right(c, segments.AREA_APARTMENT, lowest=False)
    left = lambda c: segments.band_left(c, segments.AREA_LEFT)
    assert [one(spark, v, right, "double") for v in (0.0, 50.0, 75.0, 400.0, -1.0, None)] == ["<50", "<50", "50-75", ">200", None, None]
    assert one(spark, 0.0, legacy, "double") is None
    assert [one(spark, v, left, "double") for v in (0.0, 75.0, 1000.0)] == ["<75", "75-90", ">1000"]


def test_repairs(spark):
    assert one(spark, "'verdadeiro", text.unquoted_upper) == "VERDADEIRO"
    assert one(spark, "x", numbers.number_or) is None
    assert one(spark, "x", lambda c: numbers.number_or(c, 2.0)) == 2.0
    value = lambda v, p, a: spark.sql(f"select cast({v} as double) v, cast({p} as double) p, cast({a} as double) a").select(numbers.per_area_if_missing(F.col("v"), F.col("p"), F.col("a"))).first()[0]
    assert [value(0, 100, 4), value("null", 100, 4), value(7, 100, 4), value(0, 0, 4), value("null", 100, 0)] == [25.0, 25.0, 7.0, 0.0, None]


def test_periods_end_at_midnight_or_with_the_day(spark):
    def within(t, midnight):
        return one(spark, t, lambda c: dates.in_period(c.cast("timestamp"), "2025-01-01", "2025-01-31", midnight))

    assert [within(t, False) for t in ("2025-01-01 00:00:00", "2025-01-31 13:00:00", "2025-02-01 00:00:00")] == [True, True, False]
    open_ = [one(spark, "2030-01-01", lambda c, a=a: dates.in_period(c.cast("timestamp"), *a)) for a in ((None, None), ("2025-01-01", None), (None, "2025-01-31"))]
    assert open_ == [True, True, False]
    assert [within(t, True) for t in ("2025-01-31 00:00:00", "2025-01-31 13:00:00")] == [True, False]

"""Row filters, outliers and duplicates of listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessela.functions.text import upper_or_null
from tessela.operators.quantiles import quantiles
from tessela.sources.kept import kept


def in_range(df: DataFrame, **limits: tuple[float, float]) -> DataFrame:
    """Rows whose columns lie between limits, both included; null drops the row."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).between(*v) for c, v in limits.items()]))


def asked(df: DataFrame, normalise: bool = True, **values: str | None) -> Column:
    """Whether a row equals the given values; a value of None, or a column that is not there, asks for nothing."""
    tests = [upper_or_null(F.col(c)) == v.strip().upper() if normalise else F.col(c) == v for c, v in values.items() if v is not None and c in df.columns]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def wanted(df: DataFrame, normalise: bool = True, **values: str | None) -> DataFrame:
    """Rows that equal the given values; a value of None, or a column that is not there, filters nothing."""
    return df.filter(asked(df, normalise, **values))


def offered(df: DataFrame, target: str | None, others: tuple[str, ...] = ("PUBLICADO", "VENDA")) -> DataFrame:
    """Rows offered as the target or as one of the usual ways."""
    return df if target is None else df.filter(F.col("oferta").isin(target.upper(), *others))


def offered_where_found(df: DataFrame, target: str, by: str = "vaga") -> DataFrame:
    """Filters by offer only in those groups in which the wanted offer occurs at all."""
    has = kept(df.groupBy(F.col(by).alias("__by")).agg(F.max((F.col("oferta") == target).cast("int")).alias("__has")))
    joined = df.join(has, F.col(by).eqNullSafe(F.col("__by")), "left")
    return joined.filter((F.coalesce("__has", F.lit(0)) == 0) | (F.col("oferta") == target)).select(*df.columns)


def without_outliers(df: DataFrame, value: str, by: list[str] | None = None, least_rows: int = 0, guard_zero: bool = True, factor: float = 1.5, few_groups: bool = False, keep: bool = True) -> DataFrame:
    """Rows within ``factor`` interquartile ranges of the quartiles of their group.

    Groups of fewer than ``least_rows`` rows stay whole; so do, with ``guard_zero``, those whose range is zero or
    null. Groups are compared null-safe. The limits are one row per group, kept, so that they go to the rows. Quartiles are exact; those of ``few_groups``
    (and of the table as a whole) are selected in several passes, so that groups may be larger than what a task holds,
    those of many groups are worked out in one. ``keep`` as of ``quantiles``: false where ``df`` is a kept table.
    """
    by = by or []
    if few_groups or not by:
        limits = quantiles(df, by, value, (0.25, 0.75), keep=keep).select(*[F.col(c).alias(f"__{c}") for c in by], F.col("q").alias("__q"), F.col("rows").alias("__n"))
    else:
        counts = df.groupBy(*by, F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__c"))  # values that rows share go on once
        limits = counts.groupBy(*by).agg(F.percentile("__v", F.array(F.lit(0.25), F.lit(0.75)), F.col("__c")).alias("__q"), F.sum("__c").alias("__n"))
        limits = kept(limits.select(*[F.col(c).alias(f"__{c}") for c in by], "__q", "__n"))
    joined = df.join(limits, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by], F.lit(True)))
    spread = F.col("__q")[1] - F.col("__q")[0]
    inside = F.col(value).between(F.col("__q")[0] - factor * spread, F.col("__q")[1] + factor * spread)
    stays = F.col("__n") < least_rows
    if guard_zero:
        stays = stays | spread.isNull() | (spread == 0)
    return joined.filter(stays | inside).select(*df.columns)


def one_per_key(df: DataFrame, key: list[str | Column], order: list[Column]) -> DataFrame:
    """The first row of each key; null keys are one key."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def first_per_key(df: DataFrame, key: list[str], order: tuple[str, ...]) -> DataFrame:
    """As ``one_per_key`` with the columns of ``order`` ascending, by an aggregate that keeps one row per key and task before the shuffle: for keys that many rows share. Keys come first in the result."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__first")).select(*key, "__first.*")


def enough_rows(df: DataFrame, by: str, least: int) -> DataFrame:
    """Rows of the groups (files, months) that have enough of them."""
    return df.join(kept(df.groupBy(by).count().filter(F.col("count") >= least).select(by)), by, "left_semi")


def unit_corrected(df: DataFrame, value: str, by: str, thousand_below: float = 200_000, million_below: float = 1_000) -> DataFrame:
    """Prices of files that were written in thousands or millions, told by their median."""
    median = kept(df.groupBy(by).agg(F.percentile(value, 0.5).alias("__m")))
    scale = F.when(F.col("__m") < million_below, 1e6).when(F.col("__m") < thousand_below, 1e3).otherwise(1.0)
    return df.join(median, by).withColumn(value, F.col(value) * scale).drop("__m")

"""Dimensions and facts of the listing stock: keys, upserts, captures and exits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessela.functions.text import code, first_text, fold

#: Situations in which a listing is still offered, and type ids that are not homes.
AVAILABLE = ("VAGO/DISPONIVEL", "VAGO / DISPONIVEL", "VAGO", "DISPONIVEL")
NOT_HOMES = ("T7", "T8", "T9", "T10", "T11")


def lookup(df: DataFrame, dim: DataFrame, name: str, dim_name: str, dim_id: str, order: str, out: str, fallback: bool = False) -> DataFrame:
    """Adds a dimension's id by normalised name; the last of equal names wins, a miss is "" or the name itself."""
    ids = dim.groupBy(fold(F.col(dim_name)).alias("__name")).agg(F.max_by(dim_id, order).alias(out))
    joined = df.join(ids, fold(F.col(name)) == F.col("__name"), "left").drop("__name")
    return joined.withColumn(out, F.coalesce(out, F.col(name) if fallback else F.lit(""), F.lit("")))


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The target with rows of equal keys replaced by the source's; applying it twice changes nothing more."""
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source)


def of_these_days(facts: DataFrame, batch: DataFrame, day: str) -> DataFrame:
    """The facts of the days that a batch spans, as a filter on the scan: of a table kept by day only these folders are read.

    The span is one row. A batch without any day spans none, since facts without one equal nothing.
    """
    span = batch.agg(F.min(day).alias("a"), F.max(day).alias("b")).first()
    return facts.filter(F.lit(False) if span["a"] is None else F.col(day).between(F.lit(span["a"]), F.lit(span["b"])))


def appended(target: DataFrame, source: DataFrame, keys: list[str], day: str | None = None) -> DataFrame:
    """The target and those rows of the source whose keys it doesn't have. With ``day``, one of the keys, only facts of the source's days are compared."""
    known = target if day is None else of_these_days(target, source, day)
    return target.unionByName(source.join(known.select(*keys).distinct(), keys, "left_anti"))


def in_ranges(df: DataFrame, order: str, parts: int = 64) -> DataFrame:
    """Adds ``__part``: ranges of about equally many rows, in order; their ends are quantiles of ``order``, to 1 / 10,000 of the rows."""
    ends = df.agg(F.percentile_approx(order, [k / parts for k in range(1, parts)], F.lit(10_000)).alias("__ends"))
    return df.join(ends, F.lit(True)).withColumn("__part", F.size(F.filter("__ends", lambda e: e < F.col(order)))).drop("__ends")


def new_keys(names: DataFrame, name: str, order: str, dim: DataFrame, dim_name: str, dim_id: str, prefix: str = "B", parts: int = 64) -> DataFrame:
    """The dimension with unseen names, numbered on from its largest key in the order of their first row.

    Names are numbered within ranges of their first row that hold about equally many names each, however these crowd,
    and ranges are moved up by what lies before them, so no task gets all names.
    """
    known = dim.select(fold(F.col(dim_name)).alias("__name"))
    fresh = names.withColumn("__name", fold(F.col(name))).filter("__name <> ''").join(known, "__name", "left_anti")
    fresh = fresh.groupBy("__name").agg(F.min_by(name, order).alias(dim_name), F.min(order).alias("__first"))
    ranged = in_ranges(fresh, "__first", parts)
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__k"))
    before = sizes.select("__part", F.coalesce(F.sum("__k").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    rank = F.row_number().over(Window.partitionBy("__part").orderBy("__first", "__name"))
    largest = dim.agg(F.coalesce(F.max(F.regexp_extract(dim_id, r"(\d+)$", 1).try_cast("long")), F.lit(0)).alias("__largest"))
    out = ranged.withColumn("__rank", rank).join(before, "__part").join(largest, F.lit(True))
    number = F.col("__largest") + F.col("__before") + F.col("__rank")
    return dim.select(dim_id, dim_name).unionByName(out.select(F.concat(F.lit(prefix), number.cast("string")).alias(dim_id), dim_name))


def latest(facts: DataFrame, key: str, day: str, order: str, columns: list[str]) -> DataFrame:
    """The columns of each key's latest record; undated ones come first, of equal days the later row counts."""
    when = F.struct(F.coalesce(F.col(day), F.lit("0001-01-01").cast("date")).alias("d"), F.col(order).alias("o"))
    return facts.groupBy(key).agg(F.max_by(F.struct(*columns), when).alias("x")).select(key, "x.*")


def has_left(situation: Column) -> Column:
    """Whether a situation means that the listing left; none at all counts as such."""
    return ~fold(situation).isin(*AVAILABLE)


def exit_reason(*columns: Column, default: str = "NAO INFORMADO") -> Column:
    return first_text(*columns, default=default)


def exits(feed: DataFrame, facts: DataFrame, captures: DataFrame, keys: list[str], columns: list[str], distinct: bool = False, day: str | None = None) -> DataFrame:
    """Exits that the fact table doesn't have, with the latest capture's columns ("" where there is none). With ``day``, one of the keys, only facts of the feed's days are compared."""
    known = facts if day is None else of_these_days(facts, feed, day)
    fresh = feed.join(known.select(*keys).distinct(), keys, "left_anti")
    fresh = fresh.dropDuplicates(keys) if distinct else fresh
    return fresh.join(captures, keys[0], "left").na.fill("", columns)


#: The columns of the exit facts.
EXIT_FACT = ("Codigo", "Captador1", "Captador2", "Captador3", "Gerente", "Motivo", "DataSaida")


def exit_facts(feed: DataFrame, facts: DataFrame, captures: DataFrame, order: str, run_day: str, default: str = "NAO INFORMADO") -> DataFrame:
    """The rows that a feed adds to the exit facts, in their columns.

    ``feed``: Codigo and, where there are such, Situacao, Motivo and DataSaida; listings that are still offered and rows
    without code are left out. The reason is the feed's, else the situation, else the default; the day is the feed's,
    of a feed without days that of the run. ``captures``: Codigo, Captador1 to 3, Gerente and DataEntrada; the latest
    counts, by ``order`` of equal days. A batch's own repeats stay.
    """
    given = lambda c: F.col(c) if c in feed.columns else F.lit(None).cast("string")
    feed = feed.filter(has_left(given("Situacao"))).withColumn("Codigo", code(F.col("Codigo"))).filter(F.coalesce("Codigo", F.lit("")) != "")
    day = F.col("DataSaida").cast("date") if "DataSaida" in feed.columns else F.lit(run_day).cast("date")
    feed = feed.select("Codigo", exit_reason(given("Motivo"), given("Situacao"), default=default).alias("Motivo"), day.alias("DataSaida"))
    brokers = list(EXIT_FACT[1:5])
    last = latest(captures.withColumn("Codigo", code(F.col("Codigo"))).filter("Codigo <> ''"), "Codigo", "DataEntrada", order, brokers)
    return exits(feed, facts.withColumn("Codigo", code(F.col("Codigo"))), last, ["Codigo", "DataSaida"], brokers, day="DataSaida").select(*EXIT_FACT)


def is_home(type_id: Column) -> Column:
    """Unknown types count as homes."""
    return F.coalesce(~F.upper(type_id).isin(*NOT_HOMES), F.lit(True))


def focus(price: str, commission: str, home: Column, least_price: float, least_commission: float = 3.5) -> Column:
    """Whether a listing is in a focus district (flag column ``__focus`` joined before), dear and well paid enough, and a home."""
    return F.coalesce(F.col("__focus"), F.lit(False)) & (F.col(price) >= least_price) & (F.col(commission) >= least_commission) & home


def with_focus_districts(df: DataFrame, districts: DataFrame, district: str) -> DataFrame:
    flags = districts.select(fold(F.col(district)).alias("__d"), F.lit(True).alias("__focus")).distinct()
    return df.join(flags, fold(F.col(district)) == F.col("__d"), "left").drop("__d")


def in_table(codes: DataFrame, table: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The distinct codes that a table has, and those that it lacks."""
    asked, there = codes.select(key).distinct(), table.select(key).distinct()
    return asked.join(there, key, "left_semi"), asked.join(there, key, "left_anti")


def found_and_missing(codes: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """The codes with whether the table has them."""
    return codes.select(key).distinct().join(table.select(key).distinct().withColumn("__has", F.lit(True)), key, "left").select(key, F.when(F.col("__has"), "SIM").otherwise("NAO").alias("disponivel"))

"""Windows of months, changes between months, and trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessela.functions.numbers import rounded
from tessela.functions.dates import month
from tessela.operators.quantiles import quantiles
from tessela.sources.kept import kept


def targets_of(month_text: Column, months: int = 3) -> Column:
    """The months whose windows a month lies in: its own and those after it."""
    first = F.to_date(F.concat(month_text, F.lit("-01")))
    return F.array(*[month(F.add_months(first, k)) for k in range(months)])


def into_windows(df: DataFrame, pane: str = "mes_ref", months: int = 3, wanted: tuple[str, ...] | None = None) -> DataFrame:
    """Each row (of a month's state or result) once for each window that its month lies in, as ``mes_alvo``; of all windows or the wanted ones."""
    out = df.withColumn("mes_alvo", F.explode(targets_of(F.col(pane), months)))
    return out if wanted is None else out.filter(F.col("mes_alvo").isin(*wanted))


def sliding_bundle(df: DataFrame, by: list[str], pane: str = "mes_ref", months: int = 3) -> DataFrame:
    """Size, mean and median per area, mean price and mean area of each window of months, in one pass over the rows.

    Months are added up once, a row for each month and group; windows add up their months' rows. The median's rank is
    looked for in the months' counts too, so rows aren't repeated for the windows they lie in. Windows that end in a
    month without rows are left out.
    """
    rows = kept(df.select(pane, *by, "valor_m2", "preco", "area_util"))
    sums = [F.sum(F.col(c).cast("double")).alias(f"__{c}") for c in ("valor_m2", "preco", "area_util")]
    states = rows.groupBy(pane, *by).agg(F.count(F.lit(1)).alias("amostra"), *sums)
    merged = into_windows(states, pane, months).withColumn("__own", F.when(F.col(pane) == F.col("mes_alvo"), F.col("amostra")))
    merged = merged.groupBy("mes_alvo", *by).agg(*[F.sum(c).alias(c) for c in ("amostra", "__own", "__valor_m2", "__preco", "__area_util")])
    merged = merged.withColumn("__own", F.sum("__own").over(Window.partitionBy("mes_alvo"))).filter("__own > 0")
    medians = quantiles(rows, [pane, *by], "valor_m2", (0.5,), spread=(pane, lambda m: targets_of(m, months)), keep=False)
    medians = medians.select(F.col(pane).alias("__alvo"), *[F.col(c).alias(f"__by_{c}") for c in by], F.col("q")[0].alias("__m"))
    on = F.col("mes_alvo") == F.col("__alvo")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    mean = lambda c: rounded(F.col(c) / F.col("amostra"), 4)
    return merged.join(medians, on).select("mes_alvo", *by, "amostra", mean("__valor_m2").alias("m2_medio"), rounded("__m", 4).alias("m2_mediana"), mean("__preco").alias("preco_medio"), mean("__area_util").alias("area_media"))


def with_span(df: DataFrame, months: int = 3) -> DataFrame:
    """Adds the first and the last day of the window that ends with ``mes_alvo``."""
    first = F.to_date(F.concat("mes_alvo", F.lit("-01")))
    return df.withColumns({"inicio": F.add_months(first, 1 - months), "fim": F.last_day(first)})


def spans(spark: SparkSession, months: tuple[str, ...]) -> DataFrame:
    """(mes_alvo, inicio, fim) of the windows that end in the given months."""
    return with_span(spark.createDataFrame([(m,) for m in months], "mes_alvo string"))


def training_span(spans: DataFrame, months: int) -> DataFrame:
    """One row: the span of all windows, widened by some months on both sides."""
    return spans.agg(F.add_months(F.min("inicio"), -months).alias("inicio"), F.add_months(F.max("fim"), months).alias("fim"))


def change_to_previous(df: DataFrame, value: str, order: str = "mes") -> DataFrame:
    """Percent change against the row before (not the calendar month before); the table has a row per month."""
    before = F.lag(value).over(Window.orderBy(order))
    return df.withColumn("variacao_pct", rounded(F.try_divide(F.col(value) - before, before) * 100, 4))


def box_plot(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles and whiskers: the extreme values within 1.5 interquartile ranges. Months may be of any size; their limits are a row each."""
    df = kept(df.select(by, value))
    limits = quantiles(df, [by], value, (0.25, 0.5, 0.75), keep=False).select(F.col(by).alias("__by"), F.col("q").alias("__q"), F.col("rows").alias("n"))
    spread = F.col("__q")[2] - F.col("__q")[0]
    inside = F.col(value).between(F.col("__q")[0] - 1.5 * spread, F.col("__q")[2] + 1.5 * spread)
    return df.join(limits, F.col(by).eqNullSafe(F.col("__by"))).groupBy(by).agg(
        F.first("n").alias("n"),
        *[rounded(F.first("__q")[i], 4).alias(n) for i, n in enumerate(("q1", "mediana", "q3"))],
        rounded(F.min(F.when(inside, F.col(value))), 4).alias("bigode_min"),
        rounded(F.max(F.when(inside, F.col(value))), 4).alias("bigode_max"),
    )

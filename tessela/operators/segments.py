"""Bands, and statistics by segments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessela.functions.numbers import rounded
from tessela.operators.quantiles import quantiles
from tessela.sources.kept import kept

#: Lower limits and labels of the bands of the monthly study, and of the studies of apartments and houses.
AREA_LEFT = ((0, "<75"), (75, "75-90"), (90, "90-130"), (130, "130-160"), (160, "160-200"), (200, "200-400"), (400, "400-600"), (600, "600-800"), (800, "800-1000"), (1000, ">1000"))
AREA_LEFT_END = 10_000_000
AREA_APARTMENT = ((0, "<50"), (50, "50-75"), (75, "75-90"), (90, "90-130"), (130, "130-160"), (160, "160-200"), (200, ">200"))
AREA_HOUSE = ((0, "<400"), (400, "400-600"), (600, "600-800"), (800, "800-1000"), (1000, ">1000"))
ROOMS_APARTMENT = ((0, "1"), (1, "2"), (2, "3"), (3, "4"), (4, "+5"))
ROOMS_HOUSE = ((0, "Até 4"), (4, "5 ou mais"))
ROOMS_HOUSE_UPPER = ((0, "ATÉ 4"), (4, "5 OU MAIS"))

Bands = tuple[tuple[float, str], ...]


def band_left(c: Column, bands: Bands, end: float | None = None) -> Column:
    """Labels of bands that hold their lower limit, the last one up to ``end``; outside of all the empty text."""
    out = F.when(c.isNull() | (c < bands[0][0]) | (c >= end if end is not None else F.lit(False)), "")
    for low, label in reversed(bands):
        out = out.when(c >= low, label)
    return out.otherwise("")


def band_right(c: Column, bands: Bands, lowest: bool = True) -> Column:
    """Labels of bands that hold their upper limit, the first one its lower limit too if ``lowest``; the last one is open, outside null."""
    out = F.when(c.isNull() | (c < bands[0][0]), F.lit(None).cast("string"))
    for i, (low, label) in reversed(list(enumerate(bands))):
        out = out.when((c >= low) if i == 0 and lowest else (c > low), label)
    return out


def rooms_apartment(c: Column) -> Column:
    """Bands of bedrooms; none at all counts with one."""
    return band_right(c, ROOMS_APARTMENT)


def rooms_house(c: Column, upper: bool = False) -> Column:
    return band_right(c, ROOMS_HOUSE_UPPER if upper else ROOMS_HOUSE)


def luxury(c: Column, limit: float | None) -> Column:
    return F.lit("N/A") if limit is None else F.when(c >= limit, "Alto Padrão").otherwise("Padrão")


def parking(c: Column, names: tuple[str, str] = ("COM VAGA", "SEM VAGA")) -> Column:
    return F.when(F.coalesce(c, F.lit(0)) > 0, names[0]).otherwise(names[1])


def bundle() -> list[Column]:
    """Size, mean and median per area, mean price and mean area."""
    return [
        F.count(F.lit(1)).alias("amostra"),
        rounded(F.avg("valor_m2"), 4).alias("m2_medio"),
        rounded(F.percentile("valor_m2", 0.5), 4).alias("m2_mediana"),
        rounded(F.avg("preco"), 4).alias("preco_medio"),
        rounded(F.avg("area_util"), 4).alias("area_media"),
    ]


def bundled(df: DataFrame, by: list[str]) -> DataFrame:
    """``bundle`` of few groups of any size, with ``media``, ``mediana`` and ``area``, not rounded: rows are kept narrow, medians selected in passes over them."""
    rows = kept(df.select(*by, "valor_m2", "preco", "area_util"))
    sums = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("amostra"), F.avg("valor_m2").alias("media"), F.avg("preco").alias("__preco"), F.avg("area_util").alias("area"))
    medians = quantiles(rows, by, "valor_m2", (0.5,), keep=False).select(*[F.col(c).alias(f"__{c}") for c in by], F.col("q")[0].alias("mediana"))
    met = sums.join(medians, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]))
    return met.select(*by, "amostra", *[rounded(c, 4).alias(n) for c, n in (("media", "m2_medio"), ("mediana", "m2_mediana"), ("__preco", "preco_medio"), ("area", "area_media"))], "media", "mediana", "area")


def summaries(df: DataFrame, groups: Column) -> DataFrame:
    """``summary`` of few groups of any size that overlap, as ``grupo``; a row is in all groups that the array names.

    Rows are kept once, with their array; what is counted and selected is counted by array and added up by group.
    """
    columns = ("valor_m2", "preco", "area_util")
    rows = kept(df.select(groups.alias("__in"), *columns))
    totals = [F.count(F.lit(1)).alias("n"), *[f(c).alias(f"__{name}_{c}") for c in columns for name, f in (("sum", F.sum), ("n", F.count))]]
    states = rows.groupBy("__in").agg(*totals).withColumn("grupo", F.explode("__in"))
    out = states.groupBy("grupo").agg(F.sum("n").alias("n"), *[F.sum(f"__{name}_{c}").alias(f"__{name}_{c}") for c in columns for name in ("sum", "n")])
    texts = rows.withColumn("grupo", F.array_join("__in", "\x1f"))
    of = lambda t: F.split(t, "\x1f", -1)
    for c, shares in (("valor_m2", (0.5, 0.1, 0.9)), ("preco", (0.5,)), ("area_util", (0.5,))):
        q = quantiles(texts, ["grupo"], c, shares, spread=("grupo", of), keep=False).select(F.col("grupo").alias("__g"), F.col("q").alias(f"__q_{c}"))
        out = out.join(q, F.col("grupo") == F.col("__g")).drop("__g")
    mean = lambda c: rounded(F.try_divide(F.col(f"__sum_{c}"), F.col(f"__n_{c}")), 4)
    at = lambda c, i=0: rounded(F.col(f"__q_{c}")[i], 4)
    named = {"m2_medio": mean("valor_m2"), "m2_mediana": at("valor_m2"), "m2_p10": at("valor_m2", 1), "m2_p90": at("valor_m2", 2), "preco_medio": mean("preco"), "preco_mediana": at("preco"), "area_media": mean("area_util"), "area_mediana": at("area_util")}
    return out.select("grupo", "n", *[c.alias(n) for n, c in named.items()])


def summary() -> list[Column]:
    """Size, and mean, median, 10th and 90th percentile per area, with mean and median of price and area."""
    q = F.percentile("valor_m2", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    return [
        F.count(F.lit(1)).alias("n"),
        rounded(F.avg("valor_m2"), 4).alias("m2_medio"),
        rounded(q[1], 4).alias("m2_mediana"),
        rounded(q[0], 4).alias("m2_p10"),
        rounded(q[2], 4).alias("m2_p90"),
        rounded(F.avg("preco"), 4).alias("preco_medio"),
        rounded(F.percentile("preco", 0.5), 4).alias("preco_mediana"),
        rounded(F.avg("area_util"), 4).alias("area_media"),
        rounded(F.percentile("area_util", 0.5), 4).alias("area_mediana"),
    ]


#: Segments with the column that each adds to the common ones.
SEGMENTS = (("GERAL", None), ("CLUSTER", "cluster_nome"), ("QUARTOS", "quartos"), ("METRAGEM", "metragem_fx"), ("QUADRA", "quadra"))


def long_segments(df: DataFrame, common: list[str], least: int = 3) -> DataFrame:
    """All segments in one pass: grouping sets of the common columns and one more each; sentinels where a column is rolled up.

    A segment leaves out rows whose own key is blank (no tier, no bedrooms, no band, no block). The grouping id names
    the segment, so the sets are aggregated once and filtered once. Rows that share all keys and the value per area are
    added up before, so that what is repeated for the sets, and goes into medians, is a row for each value.
    """
    own = [c for _, c in SEGMENTS if c]
    fine = df.groupBy(*common, *own, "valor_m2").agg(F.count(F.lit(1)).alias("__c"), *[f(c).alias(f"__{name}_{c}") for c in ("preco", "area_util") for name, f in (("sum", F.sum), ("n", F.count))])
    known = F.when(F.col("valor_m2").isNotNull(), F.col("__c"))
    mean = lambda total, n: rounded(F.try_divide(F.sum(total), F.sum(n)), 4)
    aggs = [
        F.sum("__c").alias("amostra"),
        mean(F.col("valor_m2") * F.col("__c"), known).alias("m2_medio"),
        rounded(F.percentile("valor_m2", 0.5, F.col("__c")), 4).alias("m2_mediana"),
        mean("__sum_preco", "__n_preco").alias("preco_medio"),
        mean("__sum_area_util", "__n_area_util").alias("area_media"),
    ]
    sets = [[F.col(c) for c in common] + ([F.col(k)] if k else []) for _, k in SEGMENTS]
    keys = [F.col(c) for c in common + own]
    agg = fine.groupingSets(sets, *keys).agg(F.grouping_id(*keys).alias("__gid"), *aggs)
    name, full = F.when(F.lit(False), ""), F.when(F.lit(False), False)
    for segment, k in SEGMENTS:
        here = F.col("__gid") == sum(1 << (len(own) - 1 - j) for j, c in enumerate(own) if c != k)
        name = name.when(here, segment)
        full = full.when(here, F.lit(True) if k is None else F.col(k) > 0 if k == "quartos" else F.col(k) != "")
    out = agg.filter((F.col("amostra") >= least) & full).withColumn("segmento", name)
    return out.withColumn("quartos", F.coalesce("quartos", F.lit(-1))).na.fill("", [c for c in own if c != "quartos"]).drop("__gid")


def grouped_by_sets(df: DataFrame, sets: list[list[str]], aggs: list[Column], names: list[str]) -> DataFrame:
    """Aggregates by several sets of keys at once, with the set's name as ``segmento``; keys become text."""
    keys = list(dict.fromkeys(c for s in sets for c in s))
    if not keys:
        return df.agg(*aggs).withColumn("segmento", F.lit(names[0]))
    agg = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in keys]).agg(F.grouping_id(*keys).alias("__gid"), *aggs)
    label = F.when(F.lit(False), "")
    for name, s in zip(names, sets, strict=True):
        gid = sum(1 << (len(keys) - 1 - j) for j, c in enumerate(keys) if c not in s)
        label = label.when(F.col("__gid") == gid, name)
    return agg.withColumn("segmento", label).drop("__gid")


def with_empty(labels: list[str], name: str, groups: DataFrame, agg: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Every label in every group that occurs; where no row fell, the count is 0 and the rest null."""
    every = groups.withColumn(name, F.explode(F.array(*map(F.lit, labels))))
    return every.join(agg, [*keys, name], "left").na.fill(0, [count])

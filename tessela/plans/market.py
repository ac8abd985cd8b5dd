"""Queries of the market studies: metrics, outliers, trends, windows, bands and tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessela.functions.numbers import rounded
from tessela.functions.dates import month
from tessela.operators import monthly, quality, segments, tiers, windows
from tessela.plans.views import CLEANED, LIMITS, LISTING, TIE, cleaned, valued
from tessela.sources import sinks
from tessela.sources.kept import folder, kept

METRICS = "count(*) AS amostra, round(avg(valor_m2), 4) AS m2_medio, round(quantile_cont(valor_m2, 0.5), 4) AS m2_mediana, round(avg(preco), 4) AS preco_medio, round(avg(area_util), 4) AS area_media"
SUMMARY = "count(*) AS n, round(avg(valor_m2), 4) AS m2_medio, round(quantile_cont(valor_m2, 0.5), 4) AS m2_mediana, round(quantile_cont(valor_m2, 0.1), 4) AS m2_p10, round(quantile_cont(valor_m2, 0.9), 4) AS m2_p90, round(avg(preco), 4) AS preco_medio, round(quantile_cont(preco, 0.5), 4) AS preco_mediana, round(avg(area_util), 4) AS area_media, round(quantile_cont(area_util, 0.5), 4) AS area_mediana"
#: Fixed centres for assignment: (cluster, value per area, area) in standard units of 2,000 and 15.
CENTRES = [(i, 400.0 + 1100.0 * i, 45.0 - 5.0 * i) for i in range(9)]


def _centres(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame([(i, a, b, 2000.0, 15.0) for i, a, b in CENTRES], "cluster int, valor_m2 double, area_util double, valor_m2_scale double, area_util_scale double")
    return tiers.tier_of_centres(df, "valor_m2")


def _tiered(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    df = cleaned(spark, sf, *more).withColumn("metragem_fx", segments.band_left(F.col("area_util") * 25, segments.AREA_LEFT, segments.AREA_LEFT_END))
    return tiers.assign(df, _centres(spark), ["valor_m2", "area_util"])


def metrics_geral(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned(spark, sf).groupBy("bairro", "tipo", "mes_ref", "vaga_cat").agg(*segments.bundle()).filter("amostra >= 3")


def metrics_long(spark: SparkSession, sf: str) -> DataFrame:
    return segments.long_segments(_tiered(spark, sf), ["bairro", "mes_ref", "vaga_cat"])


def iqr_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = kept(valued(spark, sf).select("mes_ref", "valor_m2"))
    return quality.without_outliers(rows, "valor_m2", keep=False).groupBy("mes_ref").agg(F.count(F.lit(1)).alias("n"), rounded(F.max("valor_m2"), 4).alias("maior"))


def iqr_by_parking(spark: SparkSession, sf: str) -> DataFrame:
    rows = kept(valued(spark, sf).select("vaga_cat", "mes_ref", "valor_m2"))
    inside = quality.without_outliers(rows, "valor_m2", ["vaga_cat"], least_rows=20, few_groups=True, keep=False)
    return inside.groupBy("vaga_cat", "mes_ref").agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("valor_m2"), 4).alias("media"))


def iqr_no_guard(spark: SparkSession, sf: str) -> DataFrame:
    rows = kept(valued(spark, sf).select("mes_ref", "preco"))
    return quality.without_outliers(rows, "preco", ["mes_ref"], guard_zero=False, few_groups=True, keep=False).groupBy("mes_ref").agg(F.count(F.lit(1)).alias("n"), rounded(F.min("preco"), 4).alias("menor"), rounded(F.max("preco"), 4).alias("maior"))


def summary_stats(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned(spark, sf).groupBy("bairro").agg(*segments.summary())


def summary_by_rooms_parking(spark: SparkSession, sf: str) -> DataFrame:
    groups = F.array(F.lit("TODOS"), F.col("vaga_cat"), F.when(F.col("quartos") > 0, F.concat(F.lit("QUARTOS "), "quartos")))
    return segments.summaries(cleaned(spark, sf), F.array_compact(groups))


def month_trend(spark: SparkSession, sf: str) -> DataFrame:
    q = F.percentile("preco", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    return cleaned(spark, sf).groupBy(F.col("mes_ref").alias("mes")).agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("preco"), 4).alias("media"), rounded(q[1], 4).alias("mediana"), rounded(q[0], 4).alias("p10"), rounded(q[2], 4).alias("p90"), rounded(F.percentile("valor_m2", 0.5), 4).alias("m2_mediana"), rounded(F.percentile("area_util", 0.5), 4).alias("area_mediana"))


def daily_trend(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned(spark, sf).groupBy(F.col("data_coleta").alias("dia")).agg(F.count(F.lit(1)).alias("n"), rounded(F.percentile("valor_m2", 0.5), 4).alias("m2_mediana"), rounded(F.avg("valor_m2"), 4).alias("m2_medio"))


def mom_change(spark: SparkSession, sf: str) -> DataFrame:
    months = quality.enough_rows(cleaned(spark, sf), "mes_ref", 600).groupBy(F.col("mes_ref").alias("mes")).agg(F.count(F.lit(1)).alias("n"), F.percentile("preco", 0.5).alias("m"))
    return windows.change_to_previous(months, "m").select("mes", "n", rounded("m", 4).alias("mediana"), "variacao_pct")


def boxplot_stats(spark: SparkSession, sf: str) -> DataFrame:
    return windows.box_plot(cleaned(spark, sf), "valor_m2", "mes_ref")


def window_3m(spark: SparkSession, sf: str) -> DataFrame:
    """Windows that end in a month that has rows."""
    return windows.with_span(windows.sliding_bundle(cleaned(spark, sf), ["vaga_cat"]))


#: Months that the job is run for, and those that it is run for again.
MONTHS, AGAIN = ("1996-03", "1996-04", "1996-06"), ("1996-06", "1996-07")


def _monthly(spark: SparkSession, sf: str, months: tuple[str, ...], oferta: str = "VENDA", only: bool = False) -> DataFrame:
    rows = valued(spark, sf).withColumn("area_util", F.col("area_util") * 25).withColumn("valor_m2", F.col("preco") * 25 / F.col("area_util"))
    rows = rows.filter(F.col("oferta") == oferta) if only else rows
    limits = {"preco": LIMITS["preco"], "valor_m2": LIMITS["valor_m2"], "area_util": (50, 1250)}
    return monthly.window_metrics(monthly.loaded(rows, months, oferta, limits, TIE), months, "TODOS", oferta, _centres(spark))


def monthly_job(spark: SparkSession, sf: str) -> DataFrame:
    """The job of some months, all districts at once; areas times 25, so that all bands occur."""
    return _monthly(spark, sf, MONTHS)


def metrics_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The metrics table after two runs: of sales alone, and of all that is offered for some months more."""
    path = folder(spark)
    for df in (_monthly(spark, sf, MONTHS, only=True), _monthly(spark, sf, AGAIN)):
        sinks.upsert_metrics(df.withColumn("gerado_em", F.lit("1996-08-01 00:00:00")), path)
    return sinks.metrics(spark, path).drop("gerado_em")


def unit_scale(spark: SparkSession, sf: str) -> DataFrame:
    """Prices written in units, thousands or millions by month come back to units; small months drop out."""
    df = valued(spark, sf).withColumn("k", (F.substring("mes_ref", 6, 2).cast("int") % 3))
    df = df.withColumn("preco", F.col("preco") * 10 / F.when(F.col("k") == 1, 1e3).when(F.col("k") == 2, 1e6).otherwise(1.0))
    fixed = quality.unit_corrected(quality.enough_rows(df, "mes_ref", 700), "preco", "mes_ref")
    return fixed.groupBy("mes_ref").agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("preco"), 2).alias("media"), rounded(F.percentile("preco", 0.5), 2).alias("mediana"))


def fixed_centres_assign(spark: SparkSession, sf: str) -> DataFrame:
    out = segments.bundled(_tiered(spark, sf), ["cluster_nome"])
    return out.withColumn("preco_proxy", rounded(F.col("mediana") * F.col("area"), 3)).drop("media", "mediana", "area")


def cluster_pivot(spark: SparkSession, sf: str) -> DataFrame:
    out = tiers.tier_counts(_tiered(spark, sf), "mes_ref")
    return out.select("mes_ref", *[F.col(f"`{t}`").alias(n) for t, n in zip(tiers.TIERS, ("original", "semi", "reformado"), strict=True)])


def pick3(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks stand for clusters: brands within each parking group, by mean price per area."""
    means = cleaned(spark, sf).groupBy("vaga_cat", F.substring_index("quadra", "#", -1).cast("int").alias("cluster")).agg(rounded(F.sum(F.col("valor_m2") * (1 + F.col("quartos"))) / F.count(F.lit(1)), 4).alias("media"), F.count(F.lit(1)).alias("n"))
    return tiers.pick_three(means, ["vaga_cat"])


def _bands(spark: SparkSession, sf: str, c) -> DataFrame:  # noqa: ANN001
    return valued(spark, sf).select(c.alias("faixa"), "preco", "vaga_cat")


def bands_left_closed(spark: SparkSession, sf: str) -> DataFrame:
    """Areas times 25, so that all bands occur."""
    return _bands(spark, sf, segments.band_left(F.col("area_util") * 25, segments.AREA_LEFT, segments.AREA_LEFT_END)).groupBy("faixa").agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("preco"), 4).alias("media"))


def bands_right_closed(spark: SparkSession, sf: str) -> DataFrame:
    """Areas times 5 and 25 less 5 and 25, so that all bands and both ends occur."""
    area = F.col("area_util") - 1
    both = F.concat_ws("|", segments.band_right(area * 5, segments.AREA_APARTMENT, lowest=False), segments.band_right(area * 25, segments.AREA_HOUSE), segments.rooms_apartment(F.col("quartos")), segments.rooms_house(F.col("quartos")))
    return _bands(spark, sf, both).groupBy("faixa").agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("preco"), 4).alias("media"))


def bands_zero_fill(spark: SparkSession, sf: str) -> DataFrame:
    df = _bands(spark, sf, segments.band_right(F.col("area_util"), segments.AREA_APARTMENT))
    agg = df.filter("faixa is not null").groupBy("vaga_cat", "faixa").agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("preco"), 4).alias("media"))
    return segments.with_empty([label for _, label in segments.AREA_APARTMENT], "faixa", df.select("vaga_cat").distinct(), agg, ["vaga_cat"], "n")


def kmeans_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """Tiers of a fit on all listings; libraries differ in where they start, so there is no SQL for it."""
    df = cleaned(spark, sf).select("mes_ref", "valor_m2", "area_util", "preco")
    centres = tiers.fit_centres(df, ["valor_m2", "area_util"], seeds=(42, 43, 44))
    return segments.bundled(tiers.assign(df, tiers.tier_of_centres(centres, "valor_m2"), ["valor_m2", "area_util"]), ["cluster_nome"]).drop("media", "mediana", "area")


def luxury_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """Tiers of dear listings: five clusters by price and area, three to a tier; a fit, so there is no SQL for it."""
    df = cleaned(spark, sf).select("mes_ref", "valor_m2", "area_util", "preco")
    centres = tiers.fit_centres(df, ["preco", "area_util"], k=5, seeds=(42, 43))
    named = tiers.tier_of_centres(centres, "preco", tiers.TIERS_LUXURY)
    return segments.bundled(tiers.assign(df, named, ["preco", "area_util"]), ["cluster_nome"]).drop("media", "mediana", "area")


def scatter_points(spark: SparkSession, sf: str) -> DataFrame:
    """The points behind the chart: area, value per area and tier of each listing."""
    return _tiered(spark, sf, "codigo").select("codigo", "data_coleta", "area_util", rounded("valor_m2").alias("valor_m2"), "cluster_nome")


def cluster_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters with their metrics and proxy price, tiers given by the clusters' own means; places are in the order of the means."""
    rows = tiers.nearest(cleaned(spark, sf), _centres(spark).drop("cluster_nome"), ["valor_m2", "area_util"])
    means = segments.bundled(rows, ["cluster"]).withColumn("preco_proxy", rounded(F.col("mediana") * F.col("area"), 3)).withColumnRenamed("media", "valor_m2").drop("mediana", "area")
    out = tiers.tier_of_centres(means, "valor_m2")
    return out.withColumn("linha", F.row_number().over(Window.orderBy("valor_m2"))).drop("valor_m2").orderBy("linha")


def sanity_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, sum, mean and median of the price of each file."""
    return valued(spark, sf).groupBy("mes_ref").agg(F.count(F.lit(1)).alias("n"), rounded(F.sum("preco"), 2, 1e-5).alias("soma"), rounded(F.avg("preco")).alias("media"), rounded(F.percentile("preco", 0.5)).alias("mediana"))


def dedupe_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """The first row of each (price, area, bedrooms, district, type): what counts where an export has no codes."""
    rows = quality.first_per_key(valued(spark, sf), ["preco", "area_util", "quartos", "bairro", "tipo"], ("codigo", *TIE))
    return rows.groupBy("bairro", "tipo").agg(F.count(F.lit(1)).alias("n"), F.min("codigo").alias("codigo"))


def dedupe_first(spark: SparkSession, sf: str) -> DataFrame:
    """The first row of each order, before any filter."""
    df = valued(spark, sf).withColumn("codigo", F.substring_index("codigo", "-", 1))
    return quality.one_per_key(df, ["codigo"], [F.col(c) for c in TIE]).select("codigo", "preco", "area_util", "data_coleta")


def dedupe_last(spark: SparkSession, sf: str) -> DataFrame:
    df = valued(spark, sf).withColumn("codigo", F.substring_index("codigo", "-", 1))
    return quality.one_per_key(df, ["codigo", month(F.col("data_coleta"))], [F.col(c).desc() for c in TIE]).select("codigo", "preco", "area_util", "data_coleta")


def distinct_on(spark: SparkSession, sf: str) -> DataFrame:
    df = quality.in_range(valued(spark, sf), preco=(2_000, 100_000))
    return quality.one_per_key(df, ["codigo", "data_coleta"], [F.col(c) for c in TIE]).select("codigo", "data_coleta", "preco", "area_util")


def _iqr_sql(value: str, by: str, where: str) -> str:
    on = "" if by == "''" else f"PARTITION BY {by}"
    return f"q AS (SELECT *, quantile_cont({value}, 0.25) OVER ({on}) AS q1, quantile_cont({value}, 0.75) OVER ({on}) AS q3, count(*) OVER ({on}) AS g FROM valued), kept AS (SELECT * FROM q WHERE {where} {value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))"


_LEFT = "CASE WHEN {c} < 0 OR {c} >= 10000000 THEN '' WHEN {c} < 75 THEN '<75' WHEN {c} < 90 THEN '75-90' WHEN {c} < 130 THEN '90-130' WHEN {c} < 160 THEN '130-160' WHEN {c} < 200 THEN '160-200' WHEN {c} < 400 THEN '200-400' WHEN {c} < 600 THEN '400-600' WHEN {c} < 800 THEN '600-800' WHEN {c} < 1000 THEN '800-1000' ELSE '>1000' END"


_TIES = "l_partkey, l_suppkey, preco, area_util, l_tax, l_discount, data_coleta"
_TIES_DOWN = "l_partkey DESC, l_suppkey DESC, preco DESC, area_util DESC, l_tax DESC, l_discount DESC, data_coleta DESC"
_CENTRES = """centres AS (
  SELECT i AS cluster, 400.0 + 1100.0 * i AS cm, 45.0 - 5.0 * i AS ca,
         CASE i // 3 WHEN 0 THEN '01 - Original' WHEN 1 THEN '02 - Semi-Reformado' ELSE '03 - Reformado' END AS nome
  FROM range(9) t(i)
)"""
_TIERED = f""", {_CENTRES}, tiered AS (
  SELECT c.*, (SELECT arg_min(nome, pow((valor_m2 - cm) / 2000.0, 2) + pow((area_util - ca) / 15.0, 2)) FROM centres) AS cluster_nome,
         {_LEFT.format(c="(area_util * 25)")} AS metragem_fx
  FROM cleaned c
)"""


def _segment(name: str, key: str | None, cluster: str = "''", rooms: str = "-1", band: str = "''", block: str = "''", where: str = "true") -> str:
    return f"SELECT bairro, mes_ref, vaga_cat, '{name}' AS segmento, {cluster} AS cluster_nome, {rooms} AS quartos, {band} AS metragem_fx, {block} AS quadra, {METRICS} FROM tiered WHERE {where} GROUP BY bairro, mes_ref, vaga_cat{', ' + key if key else ''} HAVING count(*) >= 3"


APARTMENT_SQL = "CASE WHEN {c} < 0 THEN NULL WHEN {c} <= 50 THEN '<50' WHEN {c} <= 75 THEN '50-75' WHEN {c} <= 90 THEN '75-90' WHEN {c} <= 130 THEN '90-130' WHEN {c} <= 160 THEN '130-160' WHEN {c} <= 200 THEN '160-200' ELSE '>200' END"
HOUSE_SQL = "CASE WHEN {c} < 0 THEN NULL WHEN {c} <= 400 THEN '<400' WHEN {c} <= 600 THEN '400-600' WHEN {c} <= 800 THEN '600-800' WHEN {c} <= 1000 THEN '800-1000' ELSE '>1000' END"
ROOMS_APARTMENT_SQL = "CASE WHEN quartos < 0 THEN NULL WHEN quartos <= 1 THEN '1' WHEN quartos <= 2 THEN '2' WHEN quartos <= 3 THEN '3' WHEN quartos <= 4 THEN '4' ELSE '+5' END"
ROOMS_HOUSE_SQL = "CASE WHEN quartos < 0 THEN NULL WHEN quartos <= 4 THEN 'Até 4' ELSE '5 ou mais' END"
_RIGHT = f"concat_ws('|', CASE WHEN area_util > 1 THEN {APARTMENT_SQL.format(c='(area_util - 1) * 5')} END, {HOUSE_SQL.format(c='(area_util - 1) * 25')}, {ROOMS_APARTMENT_SQL}, {ROOMS_HOUSE_SQL})"

def _monthly_sql(name: str, months: tuple[str, ...], only: bool) -> str:
    """CTEs of which ``name`` has the job's rows."""
    offers = "('VENDA')" if only else "('VENDA', 'PUBLICADO')"
    first, last = min(months), max(months)
    parts = " UNION ALL ".join(
        f"SELECT bairro, mes_ref, '{segment}_VAGA' AS segmento, vaga_cat, {own['cluster_nome']} AS cluster_nome, {own['quartos']} AS quartos, {own['metragem_fx']} AS metragem_fx, {own['quadra']} AS quadra, {METRICS} FROM {name}_t WHERE {where} GROUP BY bairro, mes_ref, vaga_cat{', ' + key if key else ''} HAVING count(*) >= 3"
        for segment, key, where in (("GERAL", None, "true"), ("CLUSTER", "cluster_nome", "true"), ("QUARTOS", "quartos", "quartos > 0"), ("METRAGEM", "metragem_fx", "metragem_fx <> ''"), ("QUADRA", "quadra", "quadra <> ''"))
        for own in [{"cluster_nome": "''", "quartos": "-1", "metragem_fx": "''", "quadra": "''"} | ({key: key} if key else {})]
    )
    return f"""{name}_r AS (
  SELECT * REPLACE (area_util * 25 AS area_util, upper(quadra) AS quadra) FROM valued
  WHERE oferta IN {offers} AND data_coleta BETWEEN CAST('{first}-01' AS DATE) - INTERVAL 2 MONTH AND last_day(CAST('{last}-01' AS DATE))
    AND preco BETWEEN 2000 AND 100000 AND area_util BETWEEN 2 AND 50 AND valor_m2 BETWEEN 200 AND 20000
), {name}_s AS (
  SELECT * FROM {name}_r QUALIFY row_number() OVER (PARTITION BY codigo, data_coleta ORDER BY {_TIES}) = 1
), {name}_q AS (
  SELECT *, quantile_cont(valor_m2, 0.25) OVER w AS q1, quantile_cont(valor_m2, 0.75) OVER w AS q3, count(*) OVER w AS g FROM {name}_s WINDOW w AS (PARTITION BY bairro)
), {name}_t AS (
  SELECT c.* EXCLUDE (q1, q3, g), (SELECT arg_min(nome, pow((valor_m2 - cm) / 2000.0, 2) + pow((area_util - ca) / 15.0, 2)) FROM centres) AS cluster_nome, {_LEFT.format(c="area_util")} AS metragem_fx
  FROM {name}_q c WHERE g < 20 OR q3 = q1 OR valor_m2 BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
), {name}_p AS ({parts}
), {name} AS (
  SELECT p.bairro, 'TODOS' AS tipo, 'VENDA' AS oferta, mes_alvo, CAST(CAST(mes_alvo || '-01' AS DATE) - INTERVAL 2 MONTH AS DATE) AS janela_inicio, last_day(CAST(mes_alvo || '-01' AS DATE)) AS janela_fim,
         mes_ref, segmento, vaga_cat, cluster_nome, quartos, metragem_fx, quadra, amostra, m2_medio, m2_mediana, preco_medio AS preco_mediana, area_media AS area_mediana
  FROM {name}_p p JOIN (SELECT unnest({list(months)}) AS mes_alvo) ON mes_ref BETWEEN strftime(CAST(mes_alvo || '-01' AS DATE) - INTERVAL 2 MONTH, '%Y-%m') AND mes_alvo
)"""


QUERIES = {f.__name__: f for f in (metrics_geral, metrics_long, iqr_filter, iqr_by_parking, iqr_no_guard, summary_stats, summary_by_rooms_parking, month_trend, daily_trend, mom_change, boxplot_stats, window_3m, monthly_job, metrics_upsert, unit_scale, fixed_centres_assign, cluster_pivot, pick3, bands_left_closed, bands_right_closed, bands_zero_fill, kmeans_tiers, luxury_tiers, scatter_points, cluster_summary, sanity_totals, dedupe_fallback, dedupe_first, dedupe_last, distinct_on)}
_W, _L = f"WITH {CLEANED}", f"WITH {LISTING}"
ORACLE_SQL = {
    "metrics_geral": f"{_W} SELECT bairro, tipo, mes_ref, vaga_cat, {METRICS} FROM cleaned GROUP BY ALL HAVING count(*) >= 3",
    "metrics_long": f"{_W}{_TIERED} " + " UNION ALL ".join([_segment("GERAL", None), _segment("CLUSTER", "cluster_nome", cluster="cluster_nome"), _segment("QUARTOS", "quartos", rooms="quartos", where="quartos > 0"), _segment("METRAGEM", "metragem_fx", band="metragem_fx"), _segment("QUADRA", "quadra", block="quadra")]),
    "iqr_filter": f"{_L}, {_iqr_sql('valor_m2', chr(39) * 2, 'q3 = q1 OR')} SELECT mes_ref, count(*) AS n, round(max(valor_m2), 4) AS maior FROM kept GROUP BY mes_ref",
    "iqr_by_parking": f"{_L}, {_iqr_sql('valor_m2', 'vaga_cat', 'g < 20 OR q3 = q1 OR')} SELECT vaga_cat, mes_ref, count(*) AS n, round(avg(valor_m2), 4) AS media FROM kept GROUP BY ALL",
    "iqr_no_guard": f"{_L}, {_iqr_sql('preco', 'mes_ref', '')} SELECT mes_ref, count(*) AS n, round(min(preco), 4) AS menor, round(max(preco), 4) AS maior FROM kept GROUP BY mes_ref",
    "summary_stats": f"{_W} SELECT bairro, {SUMMARY} FROM cleaned GROUP BY bairro",
    "summary_by_rooms_parking": f"{_W} SELECT 'QUARTOS ' || quartos AS grupo, {SUMMARY} FROM cleaned WHERE quartos > 0 GROUP BY quartos UNION ALL SELECT vaga_cat, {SUMMARY} FROM cleaned GROUP BY vaga_cat UNION ALL SELECT 'TODOS', {SUMMARY} FROM cleaned",
    "month_trend": f"{_W} SELECT mes_ref AS mes, count(*) AS n, round(avg(preco), 4) AS media, round(quantile_cont(preco, 0.5), 4) AS mediana, round(quantile_cont(preco, 0.1), 4) AS p10, round(quantile_cont(preco, 0.9), 4) AS p90, round(quantile_cont(valor_m2, 0.5), 4) AS m2_mediana, round(quantile_cont(area_util, 0.5), 4) AS area_mediana FROM cleaned GROUP BY mes_ref",
    "daily_trend": f"{_W} SELECT data_coleta AS dia, count(*) AS n, round(quantile_cont(valor_m2, 0.5), 4) AS m2_mediana, round(avg(valor_m2), 4) AS m2_medio FROM cleaned GROUP BY data_coleta",
    "mom_change": f"{_W}, m AS (SELECT mes_ref AS mes, count(*) AS n, quantile_cont(preco, 0.5) AS m FROM cleaned GROUP BY mes_ref HAVING count(*) >= 600) SELECT mes, n, round(m, 4) AS mediana, round((m - lag(m) OVER (ORDER BY mes)) / lag(m) OVER (ORDER BY mes) * 100, 4) AS variacao_pct FROM m",
    "boxplot_stats": f"{_W}, q AS (SELECT mes_ref, valor_m2, quantile_cont(valor_m2, 0.25) OVER w AS q1, quantile_cont(valor_m2, 0.5) OVER w AS q2, quantile_cont(valor_m2, 0.75) OVER w AS q3 FROM cleaned WINDOW w AS (PARTITION BY mes_ref)) SELECT mes_ref, count(*) AS n, round(any_value(q1), 4) AS q1, round(any_value(q2), 4) AS mediana, round(any_value(q3), 4) AS q3, round(min(valor_m2) FILTER (valor_m2 BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS bigode_min, round(max(valor_m2) FILTER (valor_m2 BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS bigode_max FROM q GROUP BY mes_ref",
    "window_3m": f"{_W}, w AS (SELECT DISTINCT mes_ref AS mes_alvo, CAST(CAST(mes_ref || '-01' AS DATE) - INTERVAL 2 MONTH AS DATE) AS inicio, last_day(CAST(mes_ref || '-01' AS DATE)) AS fim FROM cleaned) SELECT mes_alvo, vaga_cat, inicio, fim, {METRICS} FROM w JOIN cleaned ON data_coleta BETWEEN inicio AND fim GROUP BY ALL",
    "monthly_job": f"{_L}, {_CENTRES}, {_monthly_sql('job', MONTHS, False)} SELECT * FROM job",
    "metrics_upsert": f"{_L}, {_CENTRES}, {_monthly_sql('one', MONTHS, True)}, {_monthly_sql('two', AGAIN, False)} SELECT * FROM two UNION ALL SELECT one.* FROM one ANTI JOIN two USING (bairro, tipo, oferta, mes_alvo, janela_inicio, janela_fim, mes_ref, segmento, vaga_cat, cluster_nome, quartos, metragem_fx, quadra)",
    "unit_scale": f"{_L}, s AS (SELECT mes_ref, preco * 10 / CASE CAST(mes_ref[6:7] AS INTEGER) % 3 WHEN 1 THEN 1e3 WHEN 2 THEN 1e6 ELSE 1.0 END AS p FROM valued), m AS (SELECT mes_ref, quantile_cont(p, 0.5) AS m FROM s GROUP BY mes_ref HAVING count(*) >= 700), f AS (SELECT mes_ref, p * CASE WHEN m < 1000 THEN 1e6 WHEN m < 200000 THEN 1e3 ELSE 1.0 END AS p FROM s JOIN m USING (mes_ref)) SELECT mes_ref, count(*) AS n, round(avg(p), 2) AS media, round(quantile_cont(p, 0.5), 2) AS mediana FROM f GROUP BY mes_ref",
    "fixed_centres_assign": f"{_W}{_TIERED} SELECT cluster_nome, {METRICS}, round(quantile_cont(valor_m2, 0.5) * avg(area_util), 3) AS preco_proxy FROM tiered GROUP BY cluster_nome",
    "cluster_pivot": f"{_W}{_TIERED} SELECT mes_ref, count_if(cluster_nome = '01 - Original') AS original, count_if(cluster_nome = '02 - Semi-Reformado') AS semi, count_if(cluster_nome = '03 - Reformado') AS reformado FROM tiered GROUP BY mes_ref",
    "pick3": f"{_W}, m AS (SELECT vaga_cat, CAST(split_part(quadra, '#', 2) AS INTEGER) AS cluster, round(sum(valor_m2 * (1 + quartos)) / count(*), 4) AS media, count(*) AS n FROM cleaned GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY vaga_cat ORDER BY media, cluster) AS r, count(*) OVER (PARTITION BY vaga_cat) AS k FROM m), c AS (SELECT *, max(CASE WHEN r = k // 2 + 1 THEN media END) OVER (PARTITION BY vaga_cat) AS mid FROM r), e AS (SELECT *, coalesce(max(CASE WHEN r < k // 2 + 1 AND media <= 0.9 * mid THEN r END) OVER (PARTITION BY vaga_cat), 1) AS lo, coalesce(min(CASE WHEN r > k // 2 + 1 AND media >= 1.1 * mid THEN r END) OVER (PARTITION BY vaga_cat), k) AS hi FROM c) SELECT vaga_cat, cluster, media, n, CASE WHEN r = hi THEN '03 - Reformado' WHEN r = k // 2 + 1 THEN '02 - Semi-Reformado' ELSE '01 - Original' END AS cluster_nome FROM e WHERE r IN (lo, hi, k // 2 + 1)",
    "bands_left_closed": f"{_L} SELECT {_LEFT.format(c='area_util * 25')} AS faixa, count(*) AS n, round(avg(preco), 4) AS media FROM valued GROUP BY 1",
    "bands_right_closed": f"{_L} SELECT {_RIGHT} AS faixa, count(*) AS n, round(avg(preco), 4) AS media FROM valued GROUP BY 1",
    "bands_zero_fill": f"{_L}, b AS (SELECT vaga_cat, preco, {APARTMENT_SQL.format(c='area_util')} AS faixa FROM valued), a AS (SELECT vaga_cat, faixa, count(*) AS n, round(avg(preco), 4) AS media FROM b GROUP BY ALL) SELECT g.vaga_cat, l.faixa, coalesce(a.n, 0) AS n, a.media FROM (SELECT DISTINCT vaga_cat FROM b) g CROSS JOIN (VALUES ('<50'), ('50-75'), ('75-90'), ('90-130'), ('130-160'), ('160-200'), ('>200')) l(faixa) LEFT JOIN a ON a.vaga_cat = g.vaga_cat AND a.faixa = l.faixa",
    "scatter_points": f"{_W}{_TIERED} SELECT codigo, data_coleta, area_util, round(valor_m2, 4) AS valor_m2, cluster_nome FROM tiered",
    "cluster_summary": f"{_W}, {_CENTRES}, n AS (SELECT c.*, (SELECT arg_min(cluster, pow((valor_m2 - cm) / 2000.0, 2) + pow((area_util - ca) / 15.0, 2)) FROM centres) AS cluster FROM cleaned c), g AS (SELECT CAST(cluster AS INTEGER) AS cluster, {METRICS}, round(quantile_cont(valor_m2, 0.5) * avg(area_util), 3) AS preco_proxy, row_number() OVER (ORDER BY avg(valor_m2)) AS linha FROM n GROUP BY cluster) SELECT *, CASE (linha - 1) // 3 WHEN 0 THEN '01 - Original' WHEN 1 THEN '02 - Semi-Reformado' ELSE '03 - Reformado' END AS cluster_nome FROM g",
    "sanity_totals": f"{_L} SELECT mes_ref, count(*) AS n, floor((sum(preco) + 1e-5) * 100 + 0.5) / 100 AS soma, round(avg(preco), 4) AS media, round(quantile_cont(preco, 0.5), 4) AS mediana FROM valued GROUP BY mes_ref",
    "dedupe_fallback": f"{_L}, o AS (SELECT bairro, tipo, min(codigo) AS codigo FROM valued GROUP BY preco, area_util, quartos, bairro, tipo) SELECT bairro, tipo, count(*) AS n, min(codigo) AS codigo FROM o GROUP BY ALL",
    "dedupe_first": f"{_L} SELECT split_part(codigo, '-', 1) AS codigo, preco, area_util, data_coleta FROM valued QUALIFY row_number() OVER (PARTITION BY split_part(codigo, '-', 1) ORDER BY {_TIES}) = 1",
    "dedupe_last": f"{_L} SELECT split_part(codigo, '-', 1) AS codigo, preco, area_util, data_coleta FROM valued QUALIFY row_number() OVER (PARTITION BY split_part(codigo, '-', 1), mes_ref ORDER BY {_TIES_DOWN}) = 1",
    "distinct_on": f"{_L} SELECT codigo, data_coleta, preco, area_util FROM valued WHERE preco BETWEEN 2000 AND 100000 QUALIFY row_number() OVER (PARTITION BY codigo, data_coleta ORDER BY {_TIES}) = 1",
}
#: As ``rounded`` does it.
ORACLE_SQL = {k: v.replace(" round(", " round(1e-7 + ") for k, v in ORACLE_SQL.items()}

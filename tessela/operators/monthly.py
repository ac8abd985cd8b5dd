"""The monthly job: metrics of all segments in each window of months, in the columns of the metrics table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessela.functions.text import strip
from tessela.operators.quality import in_range, offered, one_per_key, without_outliers
from tessela.operators.segments import AREA_LEFT, AREA_LEFT_END, SEGMENTS, band_left, long_segments
from tessela.operators.tiers import assign
from tessela.operators.windows import into_windows, spans, training_span, with_span


def loaded(df: DataFrame, months: tuple[str, ...], oferta: str, limits: dict[str, tuple[float, float]], tie: tuple[str, ...], extra_months: int = 0) -> DataFrame:
    """The rows that the windows need: within their span of days, offered as wanted, within the limits, one per code and day, without outliers of their district."""
    span = training_span(spans(df.sparkSession, months), extra_months).first()  # one row of two days, so that scans are cut by them
    df = df.filter(F.col("data_coleta").between(F.lit(span["inicio"]), F.lit(span["fim"])))
    df = one_per_key(in_range(offered(df, oferta), **limits), ["codigo", "data_coleta"], [F.col(c) for c in tie])
    return without_outliers(df, "valor_m2", ["bairro"], least_rows=20, few_groups=True)


def window_metrics(df: DataFrame, months: tuple[str, ...], tipo: str, oferta: str, centres: DataFrame | None = None, least: int = 3) -> DataFrame:
    """Each window's metrics by month, parking and one segment more, for all districts of ``df``.

    A window shows its months one by one, so each month is aggregated once and its rows are listed in every window that
    it lies in. Without ``centres`` there is no segment of tiers.
    """
    df = df.withColumns({"metragem_fx": band_left(F.col("area_util"), AREA_LEFT, AREA_LEFT_END), "quadra": F.coalesce(F.upper(strip(F.col("quadra"))), F.lit(""))})
    df = assign(df, centres, ["valor_m2", "area_util"]) if centres is not None else df.withColumn("cluster_nome", F.lit(""))
    by_month = long_segments(df, ["bairro", "mes_ref", "vaga_cat"], least)
    out = with_span(into_windows(by_month, "mes_ref", wanted=months))
    return out.select(
        "bairro",
        F.lit(tipo).alias("tipo"),
        F.lit(oferta).alias("oferta"),
        "mes_alvo",
        F.col("inicio").alias("janela_inicio"),
        F.col("fim").alias("janela_fim"),
        "mes_ref",
        F.concat("segmento", F.lit("_VAGA")).alias("segmento"),
        "vaga_cat",
        *[c for _, c in SEGMENTS if c],
        "amostra",
        "m2_medio",
        "m2_mediana",
        F.col("preco_medio").alias("preco_mediana"),
        F.col("area_media").alias("area_mediana"),
    )

"""Market studies of one area: mean values by tier, band, rooms, district and block within parking."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessela.functions.numbers import rounded
from tessela.functions.text import strip, upper_or_null
from tessela.operators.quality import asked, offered, offered_where_found, without_outliers
from tessela.operators.segments import AREA_APARTMENT, AREA_HOUSE, ROOMS_APARTMENT, ROOMS_HOUSE, band_right, grouped_by_sets, luxury, parking
from tessela.operators.tiers import best_clusters, pick_three
from tessela.sources.kept import kept
from tessela.sources.schema import column


@dataclass(frozen=True)
class Study:
    """What a study looks at. ``kind``: apt, apt-legacy, house or house-strict."""

    name: str
    kind: str
    oferta: str | None = None
    bairro: str | None = None
    cidade: str | None = None
    padrao: str | None = None

    @property
    def house(self) -> bool:
        return self.kind.startswith("house")


def _same(name: str, kind: str, oferta: str | None, padrao: str | None = None) -> Study:
    return Study(name, kind, oferta, bairro=name.upper(), padrao=padrao)


#: The studies that are made.
CATALOGUE = (
    Study("Águas Claras", "apt", "VENDA", cidade="ÁGUAS CLARAS"),
    _same("Asa Norte", "apt", "VENDA"),
    _same("Noroeste", "apt", "VENDA"),
    _same("Park Sul", "apt", "VENDA"),
    _same("Sudoeste", "apt", "VENDA"),
    Study("Guará", "apt", "PUBLICADO", cidade="GUARA"),
    Study("Asa Sul", "apt-legacy", None, bairro="ASA SUL"),
    _same("Arniqueira", "house", "VENDA"),
    Study("Guará", "house", "VENDA", cidade="GUARA"),
    _same("Jardim Botanico", "house", "VENDA"),
    Study("Vicente Pires", "house", "VENDA", cidade="VICENTE PIRES"),
    Study("Sobradinho Alto", "house", "VENDA", bairro="SOBRADINHO"),
    _same("Asa Sul", "house", "VENDA", "Luxo"),
    _same("Park Way", "house", "VENDA", "Luxo"),
    Study("Sobradinho", "house", "VENDA", cidade="SOBRADINHO", padrao="Luxo"),
    _same("Lago Norte", "house", "VENDA", "SuperLuxo"),
    _same("Lago Sul", "house", "VENDA", "SuperLuxo"),
    Study("Alto da Boa Vista", "house-strict", "PUBLICADO", bairro="ALTO DA BOA VISTA"),
)


#: How the studies name parking, and groups that have no value, by kind of study.
PARKING = ("Com Vaga", "Sem Vaga")
MISSING_HOUSE = {"faixa": "Sem Faixa", "comodos": "Sem Faixa", "distrito": "Sem Bairro", "bloco": "Sem Quadra", "municipio": "Sem Cidade", "postal": "Sem CEP"}
MISSING_APARTMENT = {"faixa": "nan", "comodos": "nan", "distrito": "<NA>", "bloco": "<NA>", "postal": "<NA>"}


#: What studies look at of a listing, beside ``padrao``.
LOOKED_AT = ("bairro", "cidade", "oferta", "quadra", "cep", "data_coleta", "area_util", "quartos", "vagas", "preco", "valor_m2")


def _of_study(df: DataFrame, study: Study) -> Column:
    """Whether a row is of the study's area (and, of the strict kind, of its offer)."""
    if study.kind == "house-strict":
        return asked(df, normalise=False, bairro=study.bairro, cidade=study.cidade, oferta=study.oferta)
    return asked(df, bairro=study.bairro, cidade=study.cidade)


def selected(df: DataFrame, study: Study, data_ref: str | None = None) -> DataFrame:
    """The study's rows with ``vaga`` and ``valor``, outliers of each parking group removed.

    The rows of its area are kept before they are looked at several times, so ``df`` is worked out once.
    """
    df = df.filter(_of_study(df, study)).withColumn("vaga", parking(F.col("vagas"), PARKING)).withColumn("valor", F.col("preco" if study.house else "valor_m2"))
    if study.kind == "house-strict":
        df = df.filter(F.col("data_coleta") == F.lit(data_ref).cast("date")) if data_ref else df
    elif study.kind == "apt":
        df = offered(df, study.oferta)
    df = kept(df)
    df = offered_where_found(df, study.oferta) if study.kind == "house" else df
    return without_outliers(df.filter("valor is not null"), "valor", ["vaga"], few_groups=True)


def groups(df: DataFrame, study: Study, data_ref: str | None = None) -> DataFrame:
    """(nome, vaga, valor, amostra, data) by band, rooms, district, block, city and postcode, all in one pass.

    Bands and rooms that no row falls in are listed with 0 rows. Rows without a value are a group of their own; the
    legacy kind leaves such groups out for district and block. Cities are listed by the strict kind, postcodes by
    apartments and the strict kind where the table has them. ``data`` is the day that the study refers to.
    """
    legacy = study.kind == "apt-legacy"
    bands, rooms = (AREA_HOUSE, ROOMS_HOUSE) if study.house else (AREA_APARTMENT, ROOMS_APARTMENT)
    keys = {
        "faixa": ("Metragem ", band_right(F.col("area_util"), bands, lowest=not legacy)),
        "comodos": ("Quartos ", band_right(F.col("quartos"), rooms, lowest=not legacy)),
        "distrito": ("Bairro ", F.col("bairro")),
        "bloco": ("Quadra ", upper_or_null(F.col("quadra")) if study.kind != "house-strict" else F.nullif(strip(F.col("quadra")), F.lit(""))),
    }
    if study.kind == "house-strict":
        keys["municipio"] = ("Cidade ", F.col("cidade"))
    if "cep" in df.columns and not legacy and study.kind != "house":
        keys["postal"] = ("CEP ", upper_or_null(F.col("cep")))
    missing = MISSING_HOUSE if study.house else MISSING_APARTMENT
    named = [F.concat(F.lit(prefix), F.coalesce(c.cast("string"), F.lit(missing[k]))).alias(k) for k, (prefix, c) in keys.items()]
    df = df.select("vaga", "valor", *named)
    agg = grouped_by_sets(df, [["vaga", k] for k in keys], [rounded(F.avg("valor")).alias("valor"), F.count(F.lit(1)).alias("amostra")], list(keys))
    out = agg.select(F.coalesce(*keys).alias("nome"), "vaga", "valor", "amostra")
    if legacy:
        out = out.filter(~F.col("nome").isin("Bairro <NA>", "Quadra <NA>"))
    labels = [f"Metragem {label}" for _, label in bands] + [f"Quartos {label}" for _, label in rooms]
    # for both parking groups; one that has no rows at all goes again
    pairs = F.array(*[F.struct(F.lit(x).alias("nome"), F.lit(v).alias("vaga")) for v in PARKING for x in labels])
    empty = df.sparkSession.range(1).select(F.explode(pairs).alias("x")).select("x.nome", "x.vaga", F.lit(None).cast("double").alias("valor"), F.lit(0).cast("long").alias("amostra"))
    out = out.unionByName(empty).groupBy("nome", "vaga").agg(F.max("valor").alias("valor"), F.sum("amostra").alias("amostra"))
    out = out.withColumn("__all", F.sum("amostra").over(Window.partitionBy("vaga"))).filter("__all > 0").drop("__all")
    return out.withColumn("data", F.lit(data_ref).cast("date"))


def tier_rows(df: DataFrame, data_ref: str | None = None, least_rows: int = 9) -> DataFrame:
    """(nome, vaga, valor, amostra, data): the three tiers of each parking group, picked of the nine best clusters of its values.

    A parking group with fewer than ``least_rows`` rows has no tiers.
    """
    picked = pick_three(best_clusters(df, "valor", ["vaga"], least_rows=least_rows), ["vaga"])
    return picked.select(F.col("cluster_nome").alias("nome"), "vaga", rounded("media").alias("valor"), "amostra", F.lit(data_ref).cast("date").alias("data"))


def results(df: DataFrame, study: Study, data_ref: str | None = None) -> DataFrame:
    """All rows of a study: its tiers and its groups, with ``padrao`` if the study has one; ``estudo`` names it."""
    rows = selected(df, study, data_ref)
    out = tier_rows(rows, data_ref).unionByName(groups(rows, study, data_ref))
    out = with_pattern(out, rows, study.padrao) if study.padrao else out.withColumn("padrao", F.lit(None).cast("string"))
    return out.withColumn("estudo", F.lit(f"{study.name} ({study.kind})"))


def all_results(df: DataFrame, studies: tuple[Study, ...] = CATALOGUE, data_ref: str | None = None) -> DataFrame:
    """The studies of a catalogue as one table; one without rows has none.

    The rows that any of them looks at are kept once, in the columns that they look at.
    """
    own = column(df, "padrao")
    some = df.filter(reduce(lambda a, b: a | b, [_of_study(df, s) for s in studies]))
    df = kept(some.select(*[c for c in df.columns if c in LOOKED_AT or c == own]))
    out = None
    for study in studies:
        part = results(df, study, data_ref)
        out = part if out is None else out.unionByName(part)
    return out


def with_pattern(results: DataFrame, df: DataFrame, default: str, limit: float | None = None) -> DataFrame:
    """Adds ``padrao``: the usual one of the table, where it has such a column, else ``default``; with ``limit`` whether a group's values reach it."""
    if limit is not None:
        kinds = df.groupBy("vaga").agg(single_or_mixed(luxury(F.col("valor"), limit)).alias("padrao"))
        return results.join(kinds, "vaga")
    own = column(df, "padrao")
    return results.withColumn("padrao", F.lit(usual(df.select(F.col(own).alias("padrao")), "padrao", default).first()[0] if own else default))


def usual(df: DataFrame, c: str, default: str) -> DataFrame:
    """One row: the most frequent text of a column (of equal ones the lowest), or a default."""
    return df.agg(F.coalesce(F.expr(f"mode(nullif(trim({c}), ''), true)"), F.lit(default)).alias(c))


def single_or_mixed(c: str | Column) -> Column:
    return F.when(F.count_distinct(c) == 1, F.max(c)).otherwise("Misto")

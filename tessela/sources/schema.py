"""Headers brought to standard names, and missing columns filled in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Standard column names with the headers that exports use for them, the best one first.
ALIASES = {
    "codigo": ("codigo", "código", "cod", "id_anuncio", "idanuncio", "id"),
    "bairro": ("bairro", "setor", "regiao", "região"),
    "cidade": ("cidade", "municipio", "município"),
    "tipo": ("tipo", "tipo_imovel", "tipologia"),
    "oferta": ("oferta", "finalidade", "negocio", "negócio"),
    "preco": ("preco", "preço", "valor", "valor_total", "valorvenda", "preco_venda"),
    "area_util": ("area_util", "area", "área", "area_privativa", "areautil", "m2"),
    "quartos": ("quartos", "dormitorios", "dormitórios", "dorms"),
    "vagas": ("vagas", "garagens", "vaga", "qtde_vagas"),
    "valor_m2": ("valor_m2", "valor_por_m2", "vlm2", "preco_m2", "preco_por_m2"),
    "quadra": ("quadra", "quad", "q"),
    "cep": ("cep",),
    "data": ("data", "data_coleta", "dt", "date"),
}
_ACCENTS = str.maketrans("áàâãäéèêëíìîïóòôõöúùûüçñ", "aaaaaeeeeiiiiooooouuuucn")


def plain(header: str) -> str:
    return "_".join(header.replace("﻿", "").strip().lower().split())


def standardised(df: DataFrame, aliases: dict[str, tuple[str, ...]] = ALIASES) -> DataFrame:
    """Headers in lower case with underscores, then the first alias present becomes the standard name."""
    df = df.toDF(*[plain(c) for c in df.columns])
    for name, others in aliases.items():
        found = next((c for c in others if c in df.columns), None)
        if found and found != name and name not in df.columns:
            df = df.withColumnRenamed(found, name)
    return df


def column(df: DataFrame, *candidates: str) -> str | None:
    """The first of the candidates that the table has, whatever the accents and case."""
    known = {plain(c).translate(_ACCENTS): c for c in reversed(df.columns)}
    return next((known[k] for c in candidates if (k := plain(c).translate(_ACCENTS)) in known), None)


def column_with(df: DataFrame, *parts: str) -> str | None:
    """The first column whose name holds one of the parts."""
    return next((c for c in df.columns if any(p in plain(c).translate(_ACCENTS) for p in parts)), None)


def filled(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Columns that are missing, with their defaults; null cells stay null."""
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def exactly(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns in this order, if the table has these and no others."""
    if set(df.columns) != set(columns):
        raise ValueError(f"expected {sorted(columns)}, found {sorted(df.columns)}")
    return df.select(*columns)


def locked(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Columns as a target has them: missing ones added, null numbers 0, null texts empty."""
    cols = []
    for c, kind in schema.items():
        value = F.col(c).try_cast(kind) if c in df.columns else F.lit(None).cast(kind)
        empty = F.lit("") if kind == "string" else F.lit(0).cast(kind) if kind in ("int", "long", "bigint", "double") else F.lit(None).cast(kind)
        cols.append(F.coalesce(value, empty).alias(c))
    return df.select(*cols)

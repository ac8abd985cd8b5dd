"""Which licences two advertiser registries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessela.functions.text import licence, licence_is_valid


def normalised(df: DataFrame) -> DataFrame:
    """(codigo, creci, anunciante) with the licence's digits."""
    return df.withColumn("creci", licence(F.col("creci")))


def by_licence(df: DataFrame, order: str = "codigo") -> DataFrame:
    """Valid licences with the first advertiser named (by ``order``) and the number of distinct listings."""
    named = F.min_by(F.col("anunciante"), F.when(F.col("anunciante").isNotNull(), F.col(order)))
    return df.filter(licence_is_valid(F.col("creci"))).groupBy("creci").agg(named.alias("anunciante"), F.countDistinct("codigo").alias("anuncios"))


def invalid(df: DataFrame) -> DataFrame:
    """Advertisers without valid licence, those without a name too: distinct listings and rows."""
    return df.filter(~licence_is_valid(F.col("creci"))).groupBy("anunciante").agg(F.countDistinct("codigo").alias("anuncios"), F.count(F.lit(1)).alias("linhas"))


def compared(a: DataFrame, b: DataFrame) -> DataFrame:
    """Full outer join of consolidated registries, with where each licence is."""
    left = a.select("creci", F.col("anunciante").alias("anunciante_a"), F.col("anuncios").alias("anuncios_a"))
    right = b.select("creci", F.col("anunciante").alias("anunciante_b"), F.col("anuncios").alias("anuncios_b"))
    where = F.when(F.col("anuncios_b").isNull(), "A").when(F.col("anuncios_a").isNull(), "B").otherwise("AMBOS")
    return left.join(right, "creci", "full_outer").withColumn("origem", where)


def totals(a: DataFrame, b: DataFrame, both: DataFrame) -> DataFrame:
    """(medida, total): rows, valid and invalid ones, and licences by where they are."""
    count = lambda df, side: df.agg(F.count(F.lit(1)).alias(f"linhas_{side}"), F.count_if(licence_is_valid(F.col("creci"))).alias(f"validas_{side}"), F.count_if(~licence_is_valid(F.col("creci"))).alias(f"invalidas_{side}"))
    where = both.agg(*[F.count_if(F.col("origem") == k).alias(f"creci_{k.lower()}") for k in ("A", "B", "AMBOS")])
    long = lambda df: df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("medida"), F.col(c).alias("total")) for c in df.columns])).alias("x")).select("x.*")
    return long(count(a, "a")).unionByName(long(count(b, "b"))).unionByName(long(where))


def shown(df: DataFrame, order: list[tuple[str, bool]], rows: int = 40) -> DataFrame:
    """The report's table: the first rows by ``order`` (column, descending?), as text with their places, and one more that tells the total if there are more."""
    keys = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in order]
    first = df.orderBy(*keys).limit(rows)
    place = F.row_number().over(Window.orderBy(*keys))
    listed = first.select(place.alias("linha"), *[F.col(c).cast("string").alias(c) for c in df.columns])
    text = F.concat(F.lit("... total de "), F.col("n").cast("string"), F.lit(f" registros. Exibindo apenas os primeiros {rows}."))
    more = df.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows)
    return listed.unionByName(more.select(F.lit(rows + 1).alias("linha"), text.alias(df.columns[0]), *[F.lit("").alias(c) for c in df.columns[1:]]))

"""The logical tables of the library's jobs as views of the given tables, in Spark and (``CTE``) in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessela.functions.numbers import per_area
from tessela.operators.quality import in_range, one_per_key, without_outliers
from tessela.operators.segments import parking
from tessela.sources.kept import kept

#: Limits that suit these tables.
LIMITS = {"preco": (2_000, 100_000), "area_util": (2, 50), "valor_m2": (200, 20_000)}
TIE = ("l_partkey", "l_suppkey", "preco", "area_util", "l_tax", "l_discount", "data_coleta")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def listing(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """One row per line item, with further columns of the tables; the engine picks how to join.

    The smallest tables are met first, so that a district's or a city's rows are told before any shuffle, and the orders
    last: rows then lie by order, and what goes by the columns of ``codigo`` needs no shuffle of its own.
    """
    t = lambda n: table(spark, sf, n)
    df = t("lineitem").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    df = df.join(t("part"), F.col("l_partkey") == F.col("p_partkey")).join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return df.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("codigo"),
        F.col("n_name").alias("bairro"),
        F.col("r_name").alias("cidade"),
        F.col("p_type").alias("tipo"),
        F.when(F.col("o_orderstatus") == "F", "VENDA").when(F.col("o_orderstatus") == "O", "PUBLICADO").otherwise("ALUGUEL").alias("oferta"),
        F.col("l_extendedprice").alias("preco"),
        F.col("l_quantity").alias("area_util"),
        (F.col("p_size") % 6).alias("quartos"),
        (F.round(F.col("l_tax") * 100).cast("int") % 3).alias("vagas"),
        F.col("p_brand").alias("quadra"),
        F.when(F.col("l_suppkey") % 11 > 0, F.lpad(F.col("l_suppkey").cast("string"), 5, "0")).alias("cep"),
        F.col("l_shipdate").cast("date").alias("data_coleta"),
        "l_partkey",
        "l_suppkey",
        "l_tax",
        "l_discount",
        *more,
    )


def valued(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """Listings with price per area, month and parking."""
    df = listing(spark, sf, *more).withColumn("valor_m2", per_area(F.col("preco"), F.col("area_util")))
    return df.withColumn("mes_ref", F.date_format("data_coleta", "yyyy-MM")).withColumn("vaga_cat", parking(F.col("vagas")))


#: What the studies look at of a listing.
STUDIED = ("bairro", "tipo", "quadra", "mes_ref", "data_coleta", "vaga_cat", "quartos", "preco", "area_util", "valor_m2")


def cleaned(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """Within the limits, one per code and day, without outliers of the district and type; the columns of ``STUDIED`` and more.

    A code is an order and a line, so rows of one lie together since they met the orders. The limits of outliers and all
    that follows read the rows that are left, which are kept narrow, so that tables are joined once.
    """
    df = in_range(valued(spark, sf, "l_orderkey", "l_linenumber"), **LIMITS)
    df = one_per_key(df, ["l_orderkey", "l_linenumber", "data_coleta"], [F.col(c) for c in TIE])
    return without_outliers(kept(df.select(*STUDIED, *more)), "valor_m2", ["bairro", "tipo"], least_rows=20)


def contract(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order: value, commission, two sellers and two capturers with payouts, and the managers."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("v1"), F.max("l_suppkey").alias("v2"), F.min(F.col("l_partkey") % 50).alias("c1"), F.max(F.col("l_partkey") % 50).alias("c2"))
    second = lambda a, b: F.when(F.col(a) != F.col(b), F.concat(F.lit("BROKER "), b))
    df = table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return df.select(
        F.col("o_orderkey").alias("contrato"),
        F.col("o_orderdate").cast("date").alias("data"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("valor"),
        (F.col("o_totalprice").cast("decimal(18,2)") * F.lit(0.06).cast("decimal(3,2)")).cast("decimal(18,4)").alias("comissao"),
        F.concat(F.lit("BROKER "), "v1").alias("venda_1"),
        second("v1", "v2").alias("venda_2"),
        F.concat(F.lit("BROKER "), "c1").alias("cap_1"),
        second("c1", "c2").alias("cap_2"),
        (F.col("v1") % 4).alias("pago_v1"),
        (F.col("v2") % 3).alias("pago_v2"),
        (F.col("c1") % 5).alias("pago_c1"),
        (F.col("c2") % 2).alias("pago_c2"),
        F.concat(F.lit("MANAGER "), F.col("v1") % 7).alias("gerente_venda"),
        F.when(F.col("c1") % 3 > 0, F.concat(F.lit("MANAGER "), F.col("c1") % 7)).otherwise("-").alias("gerente_captacao"),
    )


def managers(spark: SparkSession, sf: str) -> DataFrame:
    """(corretor, gerente): a broker's manager is the nation of the supplier."""
    return table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("BROKER "), "s_suppkey").alias("corretor"), F.col("n_name").alias("gerente"))


def registries(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customers and suppliers as advertiser registries; small keys make invalid licences, every ninth has no name.

    Supplier keys are moved up by all customers less half of the suppliers, so that some are in one registry only; the
    counts are one row beside each supplier.
    """
    customers, suppliers = table(spark, sf, "customer"), table(spark, sf, "supplier")
    shift = customers.agg(F.count(F.lit(1)).alias("c")).join(suppliers.agg(F.count(F.lit(1)).alias("s")), F.lit(True)).select((F.col("c") - F.floor(F.col("s") / 2)).alias("shift"))
    text = lambda k: F.concat(F.lit("CRECI "), F.substring(k.cast("string"), 1, 2), F.lit("."), F.substring(k.cast("string"), 3, 20))
    a = customers.select(F.col("c_custkey").alias("codigo"), text(F.col("c_custkey")).alias("creci"), F.when(F.col("c_custkey") % 9 > 0, F.col("c_name")).alias("anunciante"))
    b = suppliers.join(shift, F.lit(True))
    return a, b.select(F.col("s_suppkey").alias("codigo"), text(F.col("s_suppkey") + F.col("shift")).alias("creci"), F.col("s_name").alias("anunciante"))


def exit_feed(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("event_type") == "view", "Vago / Disponível").otherwise(F.col("event_type"))
    return table(spark, sf, "events").select("event_id", F.col("user_id").alias("codigo"), status.alias("situacao"), F.col("ts").cast("date").alias("data"), F.when(F.col("value") > 50, F.lit("  ")).otherwise(F.lit(None)).alias("motivo"))


def captures(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 150).alias("codigo"), F.col("o_orderpriority").alias("captador1"), F.when(F.col("o_orderkey") % 11 > 0, F.col("o_orderdate").cast("date")).alias("data"))


LISTING = """
listing AS (
  SELECT l_orderkey || '-' || l_linenumber AS codigo, n_name AS bairro, r_name AS cidade, p_type AS tipo,
         CASE o_orderstatus WHEN 'F' THEN 'VENDA' WHEN 'O' THEN 'PUBLICADO' ELSE 'ALUGUEL' END AS oferta,
         l_extendedprice AS preco, l_quantity AS area_util, p_size % 6 AS quartos,
         CAST(round(l_tax * 100) AS INTEGER) % 3 AS vagas, p_brand AS quadra,
         CASE WHEN l_suppkey % 11 > 0 THEN lpad(CAST(l_suppkey AS VARCHAR), 5, '0') END AS cep, CAST(l_shipdate AS DATE) AS data_coleta,
         l_partkey, l_suppkey, l_tax, l_discount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), valued AS (
  SELECT *, preco / area_util AS valor_m2, strftime(data_coleta, '%Y-%m') AS mes_ref,
         CASE WHEN vagas > 0 THEN 'COM VAGA' ELSE 'SEM VAGA' END AS vaga_cat
  FROM listing
)"""
CLEANED = (
    LISTING
    + """, ranged AS (
  SELECT * FROM valued WHERE preco BETWEEN 2000 AND 100000 AND area_util BETWEEN 2 AND 50 AND valor_m2 BETWEEN 200 AND 20000
), single AS (
  SELECT * FROM ranged QUALIFY row_number() OVER (PARTITION BY codigo, data_coleta
    ORDER BY l_partkey, l_suppkey, preco, area_util, l_tax, l_discount) = 1
), limits AS (
  SELECT bairro, tipo, quantile_cont(valor_m2, 0.25) AS q1, quantile_cont(valor_m2, 0.75) AS q3, count(*) AS n
  FROM single GROUP BY bairro, tipo
), cleaned AS (
  SELECT s.* FROM single s JOIN limits l ON s.bairro = l.bairro AND s.tipo = l.tipo
  WHERE n < 20 OR q3 = q1 OR valor_m2 BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
)"""
)
CONTRACT = """
lines AS (
  SELECT l_orderkey, min(l_suppkey) AS v1, max(l_suppkey) AS v2, min(l_partkey % 50) AS c1, max(l_partkey % 50) AS c2
  FROM lineitem GROUP BY l_orderkey
), contract AS (
  SELECT o_orderkey AS contrato, CAST(o_orderdate AS DATE) AS data, CAST(o_totalprice AS DECIMAL(18,2)) AS valor,
         CAST(o_totalprice AS DECIMAL(18,2)) * 0.06 AS comissao,
         'BROKER ' || v1 AS venda_1, CASE WHEN v1 <> v2 THEN 'BROKER ' || v2 END AS venda_2,
         'BROKER ' || c1 AS cap_1, CASE WHEN c1 <> c2 THEN 'BROKER ' || c2 END AS cap_2,
         v1 % 4 AS pago_v1, v2 % 3 AS pago_v2, c1 % 5 AS pago_c1, c2 % 2 AS pago_c2,
         'MANAGER ' || (v1 % 7) AS gerente_venda,
         CASE WHEN c1 % 3 > 0 THEN 'MANAGER ' || (c1 % 7) ELSE '-' END AS gerente_captacao
  FROM orders JOIN lines ON o_orderkey = l_orderkey
), managers AS (
  SELECT 'BROKER ' || s_suppkey AS corretor, n_name AS gerente FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""

"""Writers: delimited text, appends, and tables replaced as a whole."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessela.operators.stock import upsert
from tessela.sources.kept import kept
from tessela.sources.schema import locked

#: The key of the monthly metrics, and their table.
METRIC_KEY = ("bairro", "tipo", "oferta", "mes_alvo", "janela_inicio", "janela_fim", "mes_ref", "segmento", "vaga_cat", "cluster_nome", "quartos", "metragem_fx", "quadra")
METRIC_SCHEMA = "bairro string, tipo string, oferta string, mes_alvo string, janela_inicio date, janela_fim date, mes_ref string, segmento string, vaga_cat string, cluster_nome string, quartos int, metragem_fx string, quadra string, amostra long, m2_medio double, m2_mediana double, preco_mediana double, area_mediana double, gerado_em timestamp"


def to_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def append_limited(df: DataFrame, path: str, order: str, limit: int = 50_000) -> None:
    """Appends the first rows, at most ``limit``. Each file has the header, which readers take off file by file."""
    df.orderBy(order).limit(limit).write.mode("append").option("header", True).csv(path)


def append_results(df: DataFrame, path: str, schema: dict[str, str]) -> None:
    """Appends a study's rows in a target's columns; null texts are empty, null numbers 0."""
    locked(df, schema).write.mode("append").parquet(path)


def flags(df: DataFrame, path: str) -> None:
    """Codes with SIM or NAO, and both lists."""
    to_csv(df, f"{path}/todos", ";")
    for flag, name in (("SIM", "disponiveis"), ("NAO", "indisponiveis")):
        to_csv(df.filter(df["disponivel"] == flag).select("codigo"), f"{path}/{name}", ";")


def current(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of versions: what the newest one holds, or nothing."""
    versions = f"{path}/_versions"
    try:
        last = spark.read.schema("seq long, folder string").json(versions).orderBy("seq", "folder", ascending=False).first()
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        last = None
    return spark.read.schema(schema).parquet(f"{path}/{last['folder']}") if last else spark.createDataFrame([], schema)


def replace(df: DataFrame, path: str) -> None:
    """Writes a new version beside the old one and then names it, so that a reader or a failed run never meets half a table."""
    folder = uuid.uuid4().hex
    df.write.parquet(f"{path}/{folder}")
    spark = df.sparkSession
    try:
        seq = 1 + (spark.read.schema("seq long, folder string").json(f"{path}/_versions").agg({"seq": "max"}).first()[0] or 0)
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        seq = 0
    spark.createDataFrame([(seq, folder)], "seq long, folder string").coalesce(1).write.mode("append").json(f"{path}/_versions")


def ensure_table(spark: SparkSession, name: str, schema: str, path: str, by: str | None = None) -> None:
    """Creates a table over a folder, and its database, if they aren't there yet."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet" + (f" PARTITIONED BY ({by})" if by else "") + f" LOCATION '{path}'")


def metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metrics table; nothing if it isn't there yet."""
    try:
        return spark.read.schema(METRIC_SCHEMA).parquet(path)
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], METRIC_SCHEMA)


def upsert_metrics(df: DataFrame, path: str) -> None:
    """Replaces metrics of equal keys and adds the others; rows without ``gerado_em`` are stamped now.

    The table is a folder for each month of windows. Only the months that ``df`` has are read and rewritten; they are
    put in place when all tasks are done, so a failed one leaves the table as it was. Of rows of ``df`` with equal keys
    all stay: the job makes each key once.
    """
    stamp = F.col("gerado_em") if "gerado_em" in df.columns else F.current_timestamp()
    new = kept(df.withColumn("gerado_em", stamp.cast("timestamp")).select(*[F.col(c).cast(kind).alias(c) for c, kind in (x.split() for x in METRIC_SCHEMA.split(", "))]))
    months = [r["mes_alvo"] for r in new.select("mes_alvo").distinct().collect()]  # those of one run
    old = metrics(df.sparkSession, path).filter(F.col("mes_alvo").isin(*months))
    merged = upsert(old, new, list(METRIC_KEY)).select(*new.columns)
    merged.hint("rebalance", "mes_alvo").write.partitionBy("mes_alvo").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)

"""Tables kept between the steps of a job, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``. Where none is set, a run on this machine alone (tests) gets a
    temporary one; a cluster has to name a folder that its executors share.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: cuts the lineage, outlives executors."""
    path = shared_dir(df.sparkSession)
    out = df.write
    if partition_by:
        out = out.partitionBy(partition_by)
    out.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sampled(df: DataFrame, key: str, rows: int, *also: str) -> DataFrame:
    """Of the rows (for each value of ``also``) all, if there are at most ``rows``, else at most ``rows`` with the least hashes of ``key``.

    Groups are counted, then cut at the hash below which about as many lie; what is left is small and cut exactly.
    """
    h = F.shiftrightunsigned(F.xxhash64(key), 11) / F.lit(float(1 << 53))
    counts = df.groupBy(*also).agg(F.count(F.lit(1)).alias("__n")).collect()
    share = [(r[:-1], 1.0 if r["__n"] <= rows else (rows + 4 * rows**0.5) / r["__n"]) for r in counts]
    below = F.lit(False)
    for values, part in share:
        here = F.lit(True)
        for c, v in zip(also, values, strict=True):
            here = here & F.col(c).eqNullSafe(F.lit(v))
        below = below | (here & (h < part))
    place = F.row_number().over(Window.partitionBy(*also).orderBy(h, key))
    return df.filter(below).withColumn("__place", place).filter(F.col("__place") <= rows).drop("__place")

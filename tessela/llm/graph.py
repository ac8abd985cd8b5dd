"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessela.llm.shared import written

ROUNDS = 60


def _least(edges: DataFrame) -> DataFrame:
    """For each ``u`` the least ``v``; hot ones are summed up before the shuffle."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(u, v) to (node, component): the least node that can be reached. Nodes alone are not listed.

    Large and small stars in turn: first each node hands its larger neighbours to its least one, then its smaller
    ones; until all that is left are stars around the least nodes. Each round is two joins on a node, whose hot keys the
    engine splits, and is written out.
    """
    flip = lambda e: e.select(F.col("v").alias("u"), F.col("u").alias("v"))
    edges = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(ROUNDS):
        both = edges.unionByName(flip(edges))
        least = _least(both).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("c")).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        large = written(large)
        least = _least(large).withColumnRenamed("u", "c")
        small = large.join(least, F.col("u") == F.col("c"))
        small = small.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct()
        edges = written(small)
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("top")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("below"), F.lit(1).alias("top")))
        ends = ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("top").alias("top"))
        if not ends.agg(F.max(((F.col("below") > 1) | (F.col("below") + F.col("top") > 1)).cast("int"))).first()[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    raise RuntimeError(f"no fixed point in {ROUNDS} rounds")

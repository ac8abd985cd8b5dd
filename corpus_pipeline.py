"""A corpus from raw documents to a training mix: each stage filters or rewrites what the one before has kept.

Rows that share a doc_id, or have none, stay or go together where a stage decides by doc_id; ids that are texts and no
whole numbers go by their 64-bit hash; null and empty texts pass all stages, the last one takes them with their block, without words; of equal
documents the one with the least doc_id stays; texts of any length are worked on whole; other columns pass through, but for those whose
names the operators give to what they add; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tessela.llm import decontam, line_dedup, mixing, near_dup, toxicity
from tessela.llm.shared import written

#: The learned toxicity model and the hashed permutations have no SQL; the stages are tested one by one.
ORACLE_SQL = None


def _key(docs: DataFrame) -> Column:
    """A row's id as a whole number: a text that is none has a hash of it."""
    own = docs["doc_id"]
    if not isinstance(docs.schema["doc_id"].dataType, StringType):
        return own.try_cast("long")
    return F.coalesce(own.try_cast("long"), F.when(own.isNotNull(), F.xxhash64(own)))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("doc_id", _key(docs))


def _same(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    ids = ids.select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(ids, _key(docs).eqNullSafe(ids["__id"]), how)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scores(docs, model).filter(F.col("__toxicity") < toxicity.THRESHOLD).select(*docs.columns)


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many repeat; ``n_chars`` follows the text."""
    own = docs if docs.schema["doc_id"].dataType != StringType() else _keyed(docs.withColumn("__own_id", F.col("doc_id")))
    out = line_dedup.dedup_lines(own)
    out = (out.withColumn("doc_id", F.col("__own_id")) if own is not docs else out).select(*docs.columns)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return _same(docs, near_dup.near_duplicates(_keyed(docs)).filter("kept"), "left_semi")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark."""
    return _same(docs, decontam.leaks(_keyed(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "left_anti")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each draw, with its shard and its place there; columns of such names give way.

    ``taken`` is the words of the draw; ``size`` is the document's, given with its first draw and null with others, so
    that sums count a document once.
    """
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken", "shard", "place", *mixing.ADDED)]
    size = F.when(F.col("__nth") == 0, F.col("__size")).alias("size")
    known = F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), F.col("__size").alias("taken")
    return mixing.placed(docs.select(*own)).select(*own, size, *known, F.col("__shard").alias("shard"), F.col("__place").alias("place"))


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_common_lines),
    ("near_dup", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs

r"""Removes lines that many documents repeat, by levelled sorted runs of line hashes.

Documents come in batches of about equal size, those with the largest ids first. Each batch is reduced to a run: one
row per line key with the number of documents that hold it and, if no earlier run knows the key (a merge anti-join
with the runs), the document that keeps it. Runs are sorted by key; when a level has ``FANOUT`` runs they are merged
into one of the next level. A key's line stays in its keeper, the largest doc_id holding it, and goes elsewhere once
``min_docs`` documents hold it.

The common keys are written out before they meet the documents' keys, so that the engine can split a hot key; each
document's keys to drop are a set when its lines are gone through, so a long text takes time in proportion to it.

Defined results: a null or empty text is one empty line and stays as it is; texts may be of any length; a line shorter
than ``min_chars`` code points (white space at its ends not counted) always stays; several lines of one key in the
keeper all stay; each row is a document, so rows with equal doc_id count one by one and share their decisions; a null
doc_id, and one that is no whole number, sorts before all others; other columns pass through untouched, whatever
their names; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessela.llm.columns import SPACE, UPPER, lines, lower_ascii
from tessela.llm.shared import written

FANOUT = 3
BATCHES = 4
MIN_CHARS = 40
MIN_DOCS = 5

_LOWER = str.maketrans(UPPER, UPPER.lower())


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE))


def _key(line: Column) -> Column:
    """128 bits of a line's key, as text: arrays of text are de-duplicated by hashing."""
    return F.md5(lower_ascii(_bare(line)))


class LineRuns:
    """Runs of (key, n_docs, keeper), by level."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.levels = spark, {}

    def table(self) -> DataFrame | None:
        """All runs as they lie; a key has one row in each run that saw it."""
        runs = [run for level in self.levels.values() for run in level]
        out = None
        for run in runs:
            out = run if out is None else out.unionByName(run)
        return out

    def merged(self) -> DataFrame:
        """One row per key."""
        return self._merge(self.table())

    def add(self, keys: DataFrame) -> None:
        """Takes a batch's (doc_id, key), each key once per document."""
        run = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last"))
        known = self.table()
        if known is None:
            run = run.select("key", "n_docs", F.col("last").alias("keeper"))
        else:
            fresh = run.join(known.select("key"), "key", "left_anti").select("key", "n_docs", F.col("last").alias("keeper"))
            again = run.join(known.select("key"), "key", "left_semi").select("key", "n_docs", F.lit(None).cast("long").alias("keeper"))
            run = fresh.unionByName(again)
        self._put(run, 0)

    def _put(self, run: DataFrame, level: int) -> None:
        here = self.levels.setdefault(level, [])
        here.append(written(run.sortWithinPartitions("key")))
        if len(here) == FANOUT:
            together = here[0]
            for other in here[1:]:
                together = together.unionByName(other)
            self.levels[level] = []
            self._put(self._merge(together), level + 1)

    @staticmethod
    def _merge(runs: DataFrame) -> DataFrame:
        return runs.groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))


def _id() -> Column:
    return F.col("doc_id").try_cast("long")


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, key) for each document and each of its long lines' keys, once."""
    long_lines = F.filter(lines(F.col("text").cast("string")), lambda x: F.length(_bare(x)) >= min_chars)
    each = docs.select(_id().alias("doc_id"), F.explode(F.array_distinct(F.transform(long_lines, _key))).alias("key"))
    return each.select("doc_id", F.unhex("key").alias("key"))


def _without(batches: Iterator[pa.RecordBatch], at: int, min_chars: int) -> Iterator[pa.RecordBatch]:
    """Rows (..., drops) with the text, the ``at``-th column, cut down, and the lines before and dropped in place of drops."""
    for batch in batches:
        n_lines, n_dropped, texts = [], [], []
        for text, drops in zip(batch.column(at), batch.column(batch.num_columns - 1), strict=True):
            every = kept = (text.as_py() or "").split("\n")
            if drops.is_valid:
                gone = set(drops.as_py())
                kept = [x for x in every if len(bare := x.strip(SPACE)) < min_chars or hashlib.md5(bare.translate(_LOWER).encode(), usedforsecurity=False).digest() not in gone]
            n_lines.append(len(every))
            n_dropped.append(len(every) - len(kept))
            texts.append("\n".join(kept) if len(kept) < len(every) else text.as_py())
        columns = batch.columns[:-1]
        columns[at] = pa.array(texts, type=pa.string())
        yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, type=pa.int64()), pa.array(n_dropped, type=pa.int64())], names=[*batch.schema.names[:-1], "n_lines", "n_dropped"])


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """``docs`` with ``text`` cut down to the lines that stay; ``__n_lines`` (before) and ``__n_dropped`` are added, columns of such names give way."""
    docs = docs.drop("__n_lines", "__n_dropped").withColumn("text", F.col("text").cast("string"))
    keys = line_keys(docs, min_chars)
    ends = docs.agg(F.percentile_approx(_id(), [k / batches for k in range(1, batches)])).first()[0] or []
    batch = sum((F.coalesce(_id() <= F.lit(end), F.lit(True)).cast("int") for end in ends), F.lit(0))
    keys = written(keys.withColumn("batch", batch), partition_by="batch")
    runs = LineRuns(docs.sparkSession)
    for k in range(len(ends) + 1):
        runs.add(keys.filter(F.col("batch") == k).select("doc_id", "key"))
    common = written(runs.merged().filter(F.col("n_docs") >= min_docs).select("key", "keeper"))
    goes = F.col("keeper").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") < F.col("keeper")))
    drops = keys.join(common, "key").filter(goes).groupBy("doc_id").agg(F.collect_set("key").alias("drops"))
    # columns go by place, so their names can't clash with what is added
    own = [f"c{i}" for i in range(len(docs.columns))]
    out = docs.select("*", _id().alias("__id")).toDF(*own, "id").join(drops.withColumnRenamed("doc_id", "of"), F.col("id").eqNullSafe(F.col("of")), "left").select(*own, "drops")
    at = docs.columns.index("text")
    schema = StructType([*(StructField(c, f.dataType) for c, f in zip(own, docs.schema.fields, strict=True)), StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    return out.mapInArrow(lambda rows: _without(rows, at, min_chars), schema).toDF(*docs.columns, "__n_lines", "__n_dropped")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each document's lines."""
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    sha = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), sha.alias("kept_sha256"))


OP6_SQL = r"""
WITH l AS (
  SELECT rowid AS r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)
), k AS (
  SELECT *, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM l
), h AS (
  SELECT *, translate(bare, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM k
), c AS (
  SELECT key, max(doc_id) AS keeper FROM (SELECT DISTINCT r, doc_id, key FROM h WHERE length(key) >= 40)
  GROUP BY key HAVING count(*) >= 5
), f AS (
  SELECT h.*, c.key IS NOT NULL AND h.doc_id < c.keeper AS gone FROM h LEFT JOIN c ON h.key = c.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count_if(gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM f GROUP BY r
"""

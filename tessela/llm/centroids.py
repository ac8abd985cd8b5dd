r"""K-means on whole numbers, with a LAESA table of distances to fixed pivots.

``PIVOTS`` fixed pivots are chosen among ``CANDIDATES`` vectors, each as far as possible from those before. Each
vector's distances to them are worked out once and stored beside it. In every round the pivots'
distances to the centroids are known too, and by the triangle inequality a vector is at least |d(vector, pivot) -
d(centroid, pivot)| away from a centroid, for every pivot. The centroid of the least bound is measured first; of the
others only those whose bound doesn't exceed the least distance found so far are measured, exactly, in whole numbers.
Bounds are floating-point numbers, so they are lowered by more than their rounding before they rule anything out.

Tasks add up the vectors of each cluster before the shuffle, so a round sends a row for each task and cluster, and the
driver gets a row for each cluster. Vectors are written out once with their distances; a round reads them again.

Defined results: a vector that is null, has another number of components, or one that is null, NaN or infinite, is
left out; components become floor(``SCALE`` * x); rows that share a vec_id are clustered one by one; starting centroids
are those of the least hash of vec_id (of equal ones, the least components), of fewer rows all; a null vec_id starts no
centroid; equal distances go to the centroid of the smaller number; equal centroids are one cluster then, the other one
is empty and stays as it is; with no vec_id at all nothing is clustered and the result is empty, as for an empty table;
components beyond 2**27 (after scaling) raise an error, since squares of their differences would not be exact;
other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessela.llm.shared import written

DIMENSIONS = 64
CENTROIDS = 8
ROUNDS = 10
SCALE = 1024
SALT = "3:"
PIVOTS = 8
#: Vectors (of the least hashes) that the pivots are chosen among.
CANDIDATES = 256
LIMIT = 1 << 27


def whole(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, v): the vectors of ``embedding`` that are complete, as whole numbers."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    good = (F.size("embedding") == dimensions) & F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    floored = F.transform(x, lambda c: F.floor(c * SCALE))
    fits = F.forall(x, lambda c: F.abs(c * SCALE) < LIMIT)
    v = F.when(fits, F.transform(floored, lambda c: c.cast("int"))).otherwise(F.raise_error(F.lit(f"a component is beyond {LIMIT} after scaling")).cast("array<int>"))
    return vectors.filter(F.coalesce(good, F.lit(False))).select(F.col("vec_id").try_cast("long").alias("vec_id"), v.alias("v"))


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def _table(batches: Iterator[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _matrix(batch.column(1), np.int64)
        d = np.sqrt(np.stack([_squares(x, p) for p in pivots], axis=1).astype(np.float64))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(pivots)), pa.array(d.ravel()))
        yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["vec_id", "v", "d"])


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, v, d): the vectors with their distances to the pivots."""
    return vectors.mapInArrow(lambda b: _table(b, pivots), "vec_id long, v array<int>, d array<double>")


def nearest(x: np.ndarray, d: np.ndarray, centroids: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each vector its centroid and squared distance, and how many exact distances were needed."""
    bound = np.abs(d[:, None, :] - to_pivots[None, :, :]).max(axis=2)
    bound = np.maximum(bound * (1 - 1e-9) - 1e-6, 0) ** 2 * (1 - 1e-9)
    first = bound.argmin(axis=1)
    best, least, measured = first.copy(), _squares(x, centroids[first]), len(x)
    for k in range(len(centroids)):
        rows = np.flatnonzero((first != k) & (bound[:, k] <= least))
        if len(rows):
            square = _squares(x[rows], centroids[k])
            better = (square < least[rows]) | ((square == least[rows]) & (k < best[rows]))
            best[rows[better]], least[rows[better]] = k, square[better]
            measured += len(rows)
    return best, least, measured


def _sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, to_pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    n, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
    for batch in batches:
        x, d = _matrix(batch.column(0), np.int64), _matrix(batch.column(1), np.float64)
        best, _, _ = nearest(x, d, centroids, to_pivots)
        n += np.bincount(best, minlength=len(centroids))
        for k in np.unique(best):
            total[k] += x[best == k].sum(axis=0)
    has = np.flatnonzero(n)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(has) + 1, dtype=np.int32) * centroids.shape[1]), pa.array(total[has].ravel()))
    yield pa.RecordBatch.from_arrays([pa.array(has.astype(np.int32)), pa.array(n[has]), lists], names=["cluster", "n", "sums"])


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, to_pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        best, least, _ = nearest(_matrix(batch.column(1), np.int64), _matrix(batch.column(2), np.float64), centroids, to_pivots)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best.astype(np.int32)), pa.array(least)], names=["vec_id", "cluster", "distance"])


def chosen_pivots(candidates: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Of the candidates the first, and then each time the one farthest from all chosen."""
    chosen = [0]
    away = _squares(candidates, candidates[0])
    while len(chosen) < min(n, len(candidates)):
        chosen.append(int(away.argmax()))
        away = np.minimum(away, _squares(candidates, candidates[chosen[-1]]))
    return candidates[chosen]


def _to_pivots(centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([_squares(centroids, p) for p in pivots], axis=1).astype(np.float64))


def clusters(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of each vector, squared, and the final centroids. ``vectors`` has (vec_id, v)."""
    vectors = written(vectors)
    spark = vectors.sparkSession
    by_hash = F.sha2(F.concat(F.lit(SALT), F.col("vec_id").cast("string")), 256)
    start = vectors.filter("vec_id is not null").withColumn("h", by_hash).orderBy("h", "v").limit(max(k, CANDIDATES)).select("v").collect()
    if not start:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, 0), np.int64)
    least = np.array([r["v"] for r in start], dtype=np.int64)
    pivots, centroids = chosen_pivots(least), least[:k]
    table = written(pivot_table(vectors, pivots))
    for _ in range(rounds):
        c, p = centroids, _to_pivots(centroids, pivots)
        parts = table.select("v", "d").mapInArrow(lambda b, c=c, p=p: _sums(b, c, p), "cluster int, n long, sums array<long>")
        added = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[j].cast("decimal(38,0)")).alias(f"s{j}") for j in range(c.shape[1])])
        centroids = c.copy()
        for r in added.collect():  # a row for each cluster
            centroids[r["cluster"]] = [int(r[f"s{j}"]) // r["n"] for j in range(c.shape[1])]
        if (centroids == c).all():  # further rounds would change nothing
            break
    c, p = centroids, _to_pivots(centroids, pivots)
    return written(table.mapInArrow(lambda b: _assigned(b, c, p), "vec_id long, cluster int, distance long")), centroids


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector's cluster and distance, with the sums of distances and the cluster's centroid."""
    out, centroids = clusters(whole(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")))
    inertia = {r["cluster"]: r["s"] for r in out.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of = lambda values, kind: F.get(F.array(*[F.lit(v).cast(kind) for v in values]).cast(f"array<{kind}>"), F.col("cluster"))
    return out.select("vec_id", "cluster", "distance", of([inertia.get(k, 0) for k in range(len(shas))], "long").alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("long").alias("inertia"), of(shas, "string").alias("centroid_sha256"))


def _oracle(rounds: int = ROUNDS, k: int = CENTROIDS) -> str:
    """The contract, round by round; a centroid is a row for each component."""
    sql = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}
), x AS MATERIALIZED (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM kept
), c0 AS MATERIALIZED (
  SELECT k, unnest(v) AS c, generate_subscripts(v, 1) AS j
  FROM (SELECT v, row_number() OVER (ORDER BY sha256('{SALT}' || vec_id), v) - 1 AS k FROM kept WHERE vec_id IS NOT NULL) WHERE k < {k}
)"""
    for i in range(rounds + 1):
        sql += f"""
, d{i} AS (SELECT r, k, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d FROM x JOIN c{i} USING (j) GROUP BY r, k
), a{i} AS MATERIALIZED (SELECT r, k, d FROM d{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)"""
        if i < rounds:
            sql += f"""
, s{i} AS (SELECT k, j, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM a{i} JOIN x USING (r) GROUP BY k, j
), c{i + 1} AS MATERIALIZED (SELECT k, j, CAST(CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS c FROM c{i} LEFT JOIN s{i} USING (k, j))"""
    last = rounds
    return (
        sql
        + f"""
, h AS (SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY j)) AS sha FROM c{last} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha AS centroid_sha256
FROM a{last} JOIN kept USING (r) JOIN h USING (k)
"""
    )


OP12_SQL = _oracle()

"""Price tiers by k-means: fitting, fixed centres, and the choice of three tiers of nine clusters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessela.sources.kept import kept

#: The tiers in rising order, of the studies, of the summaries, and of dear houses.
TIERS = ("01 - Original", "02 - Semi-Reformado", "03 - Reformado")
TIERS_SUMMARY = ("01 - Original", "02 - Semi", "03 - Reformado")
TIERS_LUXURY = ("Luxo", "Alto Luxo")


#: Rows (of the least hashes) that starting centres are drawn from, and rounds at most.
STARTS = 10_000
ROUNDS = 100


def _drawn(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Starting centres: each next one with a chance in proportion to its squared distance from those before; fewer if there are fewer points."""
    rng = np.random.default_rng(seed)
    chosen = [points[rng.integers(len(points))]]
    away = ((points - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < k and away.any():
        chosen.append(points[rng.choice(len(points), p=away / away.sum())])
        away = np.minimum(away, ((points - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def _added(batches: Iterator[pa.RecordBatch], mean: np.ndarray, std: np.ndarray, runs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(run, cluster, n, cost, sums): a task's points, with the rows that lie there as the last column, added up by their nearest centre, for all runs at once."""
    n, cost, sums = ([np.zeros((len(c), *shape)) for c in runs] for shape in ((), (), (len(mean),)))
    for batch in batches:
        *columns, w = (c.to_numpy() for c in batch.columns)
        x = (np.stack(columns, axis=1) - mean) / std
        for j, c in enumerate(runs):
            d = sum((x[:, i, None] - c[None, :, i]) ** 2 for i in range(len(mean)))
            near = d.argmin(axis=1)
            n[j] += np.bincount(near, weights=w, minlength=len(c))
            cost[j] += np.bincount(near, weights=d[np.arange(len(x)), near] * w, minlength=len(c))
            for i in range(len(mean)):
                sums[j][:, i] += np.bincount(near, weights=x[:, i] * w, minlength=len(c))
    run = np.concatenate([np.full(len(c), j) for j, c in enumerate(runs)])
    cluster = np.concatenate([np.arange(len(c)) for c in runs])
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(run) + 1, dtype=np.int32) * len(mean)), pa.array(np.concatenate(sums).ravel()))
    yield pa.RecordBatch.from_arrays([pa.array(run.astype(np.int32)), pa.array(cluster.astype(np.int32)), pa.array(np.concatenate(n)), pa.array(np.concatenate(cost)), lists], names=["run", "cluster", "n", "cost", "sums"])


def fit_centres(df: DataFrame, columns: list[str], k: int = 9, seeds: tuple[int, ...] = tuple(range(42, 52)), least_rows: int = 20, tolerance: float = 1e-4) -> DataFrame | None:
    """(cluster, centre columns, scale columns) of the best of several fits on standardised columns; None for too few rows.

    Rows that lie at one point are counted once, and the point has their weight. All fits go on together: a round is one
    pass over the points, which adds them up in their tasks for every fit, and the driver gets a row for each fit and centre. A fit whose centres move no more than by ``tolerance`` (squares of standard units, all added) is left out of further rounds.
    Centres come back in the columns' own units, with the deviations (1 for a constant column) that distances are measured in.
    """
    rows = kept(df.select(*[F.col(c).cast("double") for c in columns]).dropna().groupBy(*columns).agg(F.count(F.lit(1)).alias("__n")))
    total = F.sum("__n")
    count, *known = rows.agg(total, *[x for c in columns for x in (F.sum(F.col(c) * F.col("__n")) / total, F.min(c) == F.max(c))]).first()
    if (count or 0) < max(least_rows, 1):
        return None
    away = rows.agg(*[F.sum(F.pow(F.col(c) - m, 2) * F.col("__n")) for c, m in zip(columns, known[::2], strict=True)]).first()
    mean, std = np.array(known[::2], float), np.array([1.0 if same else float(np.sqrt(q / (count - 1))) or 1.0 for q, same in zip(away, known[1::2], strict=True)], float)
    start = rows.orderBy(F.xxhash64(*columns), *columns).limit(STARTS).collect()
    ends = np.minimum(np.cumsum([min(r["__n"], STARTS) for r in start]), STARTS)  # the first rows, as many as lie at each point
    points = (np.repeat(np.array([tuple(r)[:-1] for r in start], float), np.diff(ends, prepend=0), axis=0) - mean) / std
    runs = [_drawn(points, k, s) for s in seeds]
    costs, moving = [float("inf")] * len(runs), list(range(len(runs)))
    for _ in range(ROUNDS):
        if not moving:
            break
        now = [runs[j] for j in moving]
        parts = rows.mapInArrow(lambda b, now=now: _added(b, mean, std, now), "run int, cluster int, n double, cost double, sums array<double>")
        found = parts.groupBy("run", "cluster").agg(F.sum("n"), F.sum("cost"), *[F.sum(F.col("sums")[i]) for i in range(len(columns))]).collect()
        new = [c.copy() for c in now]
        for j in moving:
            costs[j] = 0.0
        for run, cluster, n, cost, *sums in found:
            costs[moving[run]] += cost
            if n:
                new[run][cluster] = np.array(sums) / n
        still = [((a - b) ** 2).sum() > tolerance for a, b in zip(new, now, strict=True)]
        for j, c in zip(moving, new, strict=True):
            runs[j] = c
        moving = [j for j, m in zip(moving, still, strict=True) if m]
    best = runs[int(np.argmin(costs))]
    out = [(i, *map(float, c * std + mean), *map(float, std)) for i, c in enumerate(best)]
    return df.sparkSession.createDataFrame(out, ", ".join(["cluster int", *(f"{c} double" for c in columns), *(f"{c}_scale double" for c in columns)]))


def _optimum(values: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """Where the clusters of the least sum of squares begin, of sorted distinct values with weights; at most ``k``, all values in order.

    Row by row of the dynamic program over the number of clusters. Where the best last cluster of a value begins only
    moves up with the value, so rows are filled by halves: the values in the middle of what is known bound the others.
    """
    n = len(values)
    k = min(k, n)
    mean = np.average(values, weights=weights)
    x = values - mean
    w, s, q = (np.r_[0.0, np.cumsum(weights * y)] for y in (np.ones(n), x, x * x))
    cost = lambda i, j: np.maximum(q[j] - q[i] - (s[j] - s[i]) ** 2 / np.maximum(w[j] - w[i], 1e-300), 0.0)  # of values i to j - 1
    best = cost(np.zeros(n + 1, np.int64), np.arange(n + 1))
    begins = np.zeros((k, n + 1), dtype=np.int64)
    for m in range(1, k):
        row, at = np.full(n + 1, np.inf), begins[m]
        lo, hi, first, last = (np.array([v]) for v in (m + 1, n, m, n - 1))  # values lo to hi begin their last cluster at first to last
        while len(lo):
            mid = (lo + hi) // 2
            ends = np.minimum(last, mid - 1)
            size = ends - first + 1
            start = np.r_[0, np.cumsum(size)[:-1]]
            i = np.arange(size.sum()) - np.repeat(start, size) + np.repeat(first, size)
            c = best[i] + cost(i, np.repeat(mid, size))
            row[mid] = np.minimum.reduceat(c, start)
            hit = np.flatnonzero(c == np.repeat(row[mid], size))
            at[mid] = i[hit[np.searchsorted(hit, start)]]
            left, right = lo < mid, mid < hi
            lo, hi, first, last = np.r_[lo[left], mid[right] + 1], np.r_[mid[left] - 1, hi[right]], np.r_[first[left], at[mid][right]], np.r_[at[mid][left], last[right]]
        best = row
    out, j = [], n
    for m in range(k - 1, -1, -1):
        j = int(begins[m][j]) if m else 0
        out.append(j)
    return np.array(out[::-1])


def best_clusters(df: DataFrame, value: str, by: list[str], k: int = 9, least_rows: int = 9) -> DataFrame:
    """(group columns, cluster, media, amostra, menor, maior): the k clusters of a column's values with the least sum of squares, numbered in rising order.

    Exact: of values on a line clusters are ranges, and the best ranges come from the counts of the distinct values. These
    are counted before they meet, so a task gets a row for each distinct value of a group, however many rows have it.
    Groups of fewer than ``least_rows`` values have no clusters, those of fewer than k distinct ones a cluster for each.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    schema = ", ".join([*(f"{c} {df.schema[c].dataType.simpleString()}" for c in by), "cluster int, media double, amostra long, menor double, maior double"])

    def clustered(key: tuple, table: pa.Table) -> pa.Table:
        v, n = (table.column(c).to_numpy() for c in ("__v", "__n"))
        order = np.argsort(v)
        v, n = v[order], n[order]
        at = _optimum(v, n, k) if n.sum() >= least_rows else np.zeros(0, np.int64)
        total = lambda x: np.add.reduceat(x, at) if len(at) else x[:0]
        ends = np.r_[at[1:], len(v)] - 1 if len(at) else at
        own = {c: pa.repeat(x, len(at)) for c, x in zip(by, key, strict=True)}
        return pa.table(own | {"cluster": pa.array(np.arange(len(at)), pa.int32()), "media": pa.array(total(v * n) / total(n)), "amostra": pa.array(total(n)), "menor": pa.array(v[at]), "maior": pa.array(v[ends])})

    return counts.groupBy(*by).applyInArrow(clustered, schema)


def tier_of_centres(centres: DataFrame, by: str, tiers: tuple[str, ...] = TIERS) -> DataFrame:
    """Adds the tier: centres (the means of their clusters) in order of ``by``, three to a tier, all further ones in the last."""
    rank = F.row_number().over(Window.orderBy(by, "cluster")) - 1
    return centres.withColumn("cluster_nome", F.get(F.array(*map(F.lit, tiers)), F.least(F.floor(rank / 3), F.lit(len(tiers) - 1)).cast("int")))


def nearest(df: DataFrame, centres: DataFrame, columns: list[str]) -> DataFrame:
    """Adds each row's nearest centre as ``cluster``, with its tier if the centres have one. There are at most some dozen centres, so they go along as one literal array."""
    rows = centres.collect()
    tier = "cluster_nome" in centres.columns
    points = F.array(*[F.struct(F.lit(r["cluster"]).alias("cluster"), F.lit(r["cluster_nome"] if tier else None).cast("string").alias("nome"), *[F.lit(r[c]).alias(c) for c in columns], *[F.lit(r[f"{c}_scale"]).alias(f"{c}_scale") for c in columns]) for r in rows])
    square = lambda p, c: F.pow((F.col(c) - p[c]) / p[f"{c}_scale"], 2)
    near = F.array_min(F.transform(points, lambda p: F.struct(sum((square(p, c) for c in columns[1:]), square(p, columns[0])).alias("d"), p["cluster"].alias("cluster"), p["nome"].alias("nome"))))
    out = df.withColumn("cluster", near["cluster"])
    return out.withColumn("cluster_nome", near["nome"]) if tier else out


def assign(df: DataFrame, centres: DataFrame, columns: list[str]) -> DataFrame:
    """The tier of each row's nearest centre."""
    return nearest(df, centres, columns).drop("cluster")


def pick_three(clusters: DataFrame, by: list[str], mean: str = "media") -> DataFrame:
    """Three tiers of a group's clusters: the middle one by mean; below it the last with at most 90 % of its mean (else the lowest), above it the first with at least 110 % (else the highest). Of one cluster chosen twice the later tier counts."""
    w = Window.partitionBy(*by).orderBy(mean, "cluster")
    every = Window.partitionBy(*by)
    ranked = clusters.withColumn("__r", F.row_number().over(w)).withColumn("__n", F.count(F.lit(1)).over(every))
    middle = F.max(F.when(F.col("__r") == F.floor(F.col("__n") / 2) + 1, F.col(mean))).over(every)
    ranked = ranked.withColumn("__m", middle).withColumn("__mid", F.floor(F.col("__n") / 2) + 1)
    low = F.coalesce(F.max(F.when((F.col("__r") < F.col("__mid")) & (F.col(mean) <= 0.9 * F.col("__m")), F.col("__r"))).over(every), F.lit(1))
    high = F.coalesce(F.min(F.when((F.col("__r") > F.col("__mid")) & (F.col(mean) >= 1.1 * F.col("__m")), F.col("__r"))).over(every), F.col("__n"))
    ranked = ranked.withColumn("__lo", low).withColumn("__hi", high)
    tier = F.when(F.col("__r") == F.col("__hi"), TIERS[2]).when(F.col("__r") == F.col("__mid"), TIERS[1]).when(F.col("__r") == F.col("__lo"), TIERS[0])
    return ranked.withColumn("cluster_nome", tier).filter("cluster_nome is not null").drop("__r", "__n", "__m", "__mid", "__lo", "__hi")


def tier_counts(df: DataFrame, by: str, labels: tuple[str, ...] = TIERS) -> DataFrame:
    """Rows per month and tier, as columns; 0 where there is none."""
    return df.groupBy(by).pivot("cluster_nome", list(labels)).count().na.fill(0)

"""K-means against a plain Lloyd run, and the tables that come of it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessela.operators import studies, tiers
from tessela.plans import catalogue
from tessela.plans.views import cleaned, valued

SF = "/root/testdata/sf0.001"


def _lloyd(x: np.ndarray, k: int, seed: int) -> float:
    """The cost of a k-means run on standardised columns."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(60):
        near = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        c = np.array([x[near == i].mean(axis=0) if (near == i).any() else c[i] for i in range(k)])
    return ((x[:, None] - c[None]) ** 2).sum(axis=2).min(axis=1).sum()


@pytest.mark.parametrize(("columns", "k"), [(["valor_m2", "area_util"], 9), (["preco", "area_util"], 5), (["valor_m2"], 9)])
def test_a_fit_is_as_good_as_lloyd(spark, columns, k):
    rows = cleaned(spark, SF).select(*columns).toPandas().to_numpy(dtype=float)
    x = (rows - rows.mean(axis=0)) / rows.std(axis=0, ddof=1)
    centres = tiers.fit_centres(cleaned(spark, SF), columns, k=k, seeds=(42, 43, 44)).toPandas()
    assert len(centres) == k
    c = (centres[columns].to_numpy() - rows.mean(axis=0)) / rows.std(axis=0, ddof=1)
    cost = ((x[:, None] - c[None]) ** 2).sum(axis=2).min(axis=1).sum()
    assert cost <= 1.1 * min(_lloyd(x, k, s) for s in range(8))


def test_fits_go_on_as_alone(spark):
    """The best of several fits that share their passes is that of plain rounds from the same starts."""
    rng = np.random.default_rng(5)
    x = np.r_[rng.normal(0, 1, (80, 2)), rng.normal(6, 1, (60, 2)), rng.normal((0, 9), 2, (70, 2))]
    found = tiers.fit_centres(spark.createDataFrame(x.tolist(), "a double, b double").repartition(4), ["a", "b"], k=4, seeds=(1, 2, 3), tolerance=0).toPandas()
    mean, std = x.mean(axis=0), x.std(axis=0, ddof=1)
    z = (x - mean) / std
    best = None
    for seed in (1, 2, 3):
        order = spark.createDataFrame(x.tolist(), "a double, b double").orderBy(F.xxhash64("a", "b")).toPandas().to_numpy()
        c = tiers._drawn((order - mean) / std, 4, seed)
        for _ in range(200):
            near = ((z[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
            c = np.array([z[near == i].mean(axis=0) if (near == i).any() else c[i] for i in range(4)])
        cost = ((z[:, None] - c[None]) ** 2).sum(axis=2).min(axis=1).sum()
        best = min(best, (cost, c.tolist())) if best else (cost, c.tolist())
    assert found[["a", "b"]].to_numpy() == pytest.approx(np.array(best[1]) * std + mean)
    assert found[["a_scale", "b_scale"]].to_numpy()[0] == pytest.approx(std)
    one = tiers.fit_centres(spark.createDataFrame([(1.0, 2.0)] * 30, "a double, b double"), ["a", "b"], k=4).collect()
    assert [tuple(r) for r in one] == [(0, 1.0, 2.0, 1.0, 1.0)]


def test_tiers_rise_and_hold_all_rows(spark):
    rows = {r["cluster_nome"]: r for r in catalogue.QUERIES["kmeans_tiers"](spark, SF).collect()}
    assert sorted(rows) == list(tiers.TIERS)
    means = [rows[t]["m2_medio"] for t in tiers.TIERS]
    assert means == sorted(means)
    assert sum(r["amostra"] for r in rows.values()) == cleaned(spark, SF).count()
    dear = {r["cluster_nome"]: r for r in catalogue.QUERIES["luxury_tiers"](spark, SF).collect()}
    assert set(dear) == {"Luxo", "Alto Luxo"}
    assert dear["Luxo"]["preco_medio"] < dear["Alto Luxo"]["preco_medio"]


def _least_cost(values, k):
    """By trying all ways to cut sorted values, one cluster after another."""
    v = sorted(values)
    cost = lambda i, j: sum((x - sum(v[i:j]) / (j - i)) ** 2 for x in v[i:j])
    best = [0.0] + [float("inf")] * len(v)
    for _ in range(k):
        best = [0.0] + [min(best[i] + cost(i, j) for i in range(j)) for j in range(1, len(v) + 1)]
    return best[-1]


def test_best_clusters_have_the_least_cost(spark):
    rng = np.random.default_rng(3)
    groups = {"a": rng.lognormal(9, 1, 60), "b": rng.integers(0, 25, 70) * 1e5, "c": np.r_[rng.normal(0, 1, 30), rng.normal(1e6, 1, 30)], "few": np.array([1.0, 5.0] * 6), "same": np.full(12, 3.0), "short": np.arange(8.0)}
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [("a", None)]
    out = tiers.best_clusters(spark.createDataFrame(rows, "g string, x double").repartition(3), "x", ["g"], k=5).collect()
    for g, v in groups.items():
        mine = sorted((r for r in out if r["g"] == g), key=lambda r: r["cluster"])
        if g == "short":
            assert mine == []
            continue
        assert [r["cluster"] for r in mine] == list(range(min(5, len(set(v)))))
        assert sum(r["amostra"] for r in mine) == len(v)
        cost = 0.0
        for r in mine:
            own = v[(v >= r["menor"]) & (v <= r["maior"])]
            assert len(own) == r["amostra"]
            assert r["media"] == pytest.approx(own.mean())
            cost += ((own - own.mean()) ** 2).sum()
        assert cost == pytest.approx(_least_cost(v, 5), rel=1e-9, abs=1e-6)


def test_study_tiers_are_means_of_their_rows(spark):
    study = studies.Study("America", "apt", "VENDA", cidade="AMERICA")
    df = studies.selected(valued(spark, SF), study)
    found = studies.tier_rows(df, "1997-05-20").collect()
    for vaga in studies.PARKING:
        mine = {r["nome"]: r["valor"] for r in found if r["vaga"] == vaga}
        assert len(mine) == 3
        assert [mine[t] for t in tiers.TIERS] == sorted(mine.values())
    assert studies.tier_rows(df.limit(8)).count() == 0
    assert studies.tier_rows(df.filter("vaga = 'x'")).count() == 0

"""Quantiles by selection against numpy, where groups are refined over several passes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessela.operators.quantiles import quantiles

SHARES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)


def test_groups_of_all_kinds(spark):
    rng = np.random.default_rng(7)
    groups = {
        "close": rng.normal(5_000, 1, 3_000),
        "wide": rng.lognormal(0, 12, 2_000) * rng.choice([-1, 1], 2_000),
        "ties": rng.integers(0, 3, 2_500).astype(float),
        "ends": np.r_[rng.normal(0, 1e-9, 500), -1.5e308, 1.5e308],
        "equal": np.full(900, 7.25),
        "pair": np.array([1.0, 2.0]),
        "one": np.array([3.5]),
        None: np.arange(400.0),
    }
    rows = [(k, float(x)) for k, v in groups.items() for x in v] + [("none", None), ("one", None), (None, None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    for gather in (50, 100_000):
        found = {r["k"]: r for r in quantiles(df, ["k"], "x", SHARES, gather).collect()}
        assert set(found) == {*groups, "none"}
        for k, v in groups.items():
            assert found[k]["q"] == pytest.approx(np.quantile(v, SHARES).tolist(), rel=1e-12), k
            assert found[k]["n"] == len(v)
        assert found["none"]["q"] is None
        assert (found["one"]["n"], found["one"]["rows"], found[None]["rows"]) == (1, 2, 401)


def test_as_the_builtin_percentile(spark):
    df = spark.range(20_000).selectExpr("id % 3 k", "pow(id % 977, 2.5) / 7 x")
    want = {r["k"]: r["p"] for r in df.groupBy("k").agg(F.percentile("x", F.array(*map(F.lit, SHARES))).alias("p")).collect()}
    got = {r["k"]: r["q"] for r in quantiles(df, ["k"], "x", SHARES, 500).collect()}
    assert got == want


def test_whole_and_empty_tables(spark):
    df = spark.range(1001).selectExpr("cast(id as double) x", "1 y")
    assert [tuple(r) for r in quantiles(df, [], "x", (0.25, 0.5), 10).collect()] == [([250.0, 500.0], 1001, 1001)]
    assert [tuple(r) for r in quantiles(df.filter("x < 0"), [], "x", (0.5,)).collect()] == [(None, 0, 0)]
    assert quantiles(df.filter("x < 0"), ["y"], "x", (0.5,)).collect() == []
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (1.0,), (2.0,)], "x double")
    q = quantiles(odd, [], "x", (0.0, 0.25, 0.5, 0.75, 1.0), 1).first()["q"]
    assert q[:4] == [float("-inf"), 1.0, 2.0, float("inf")]
    assert np.isnan(q[4])

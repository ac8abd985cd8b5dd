"""What many steps need is worked out once: joins of the tables, rows that are alike, rows of a study."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tessela.operators import awards, quality, segments, studies, tiers
from tessela.plans import catalogue
from tessela.sources import files

SF = "/root/testdata/sf0.001"
ROWS = "(1, 'a', 10.0, 100.0, 5.0), (1, 'a', 10.0, 100.0, 5.0), (2, 'a', 30.0, null, 7.0), (null, 'b', 20.0, 300.0, null), (0, 'b', null, 500.0, 9.0)"


def _rows(spark):
    return spark.sql(f"SELECT * FROM VALUES {ROWS} t(quartos, vaga_cat, valor_m2, preco, area_util)")


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize("name", ["summary_by_rooms_parking", "iqr_by_parking", "metrics_long", "fixed_centres_assign", "cluster_summary", "kmeans_tiers", "luxury_tiers", "study_house", "study_tiers", "studies_all"])
def test_tables_are_not_joined_again(spark, name):
    assert not [f for f in catalogue.QUERIES[name](spark, SF).inputFiles() if SF in f]


def test_groups_that_overlap(spark):
    groups = F.array_compact(F.array(F.lit("TODOS"), "vaga_cat", F.when(F.col("quartos") > 0, F.concat(F.lit("QUARTOS "), "quartos"))))
    found = {r["grupo"]: r for r in segments.summaries(_rows(spark), groups).collect()}
    own = {"TODOS": "true", "a": "vaga_cat = 'a'", "b": "vaga_cat = 'b'", "QUARTOS 1": "quartos = 1", "QUARTOS 2": "quartos = 2"}
    assert set(found) == set(own)
    for g, where in own.items():
        want = _rows(spark).filter(where).agg(*segments.summary()).first()
        assert {c: found[g][c] for c in want.asDict()} == want.asDict(), g


def test_few_groups_without_a_task_for_each(spark):
    out = segments.bundled(_rows(spark), ["vaga_cat"])
    want = {r["vaga_cat"]: r for r in _rows(spark).groupBy("vaga_cat").agg(*segments.bundle()).collect()}
    assert {r["vaga_cat"]: tuple(r)[1:6] for r in out.collect()} == {g: tuple(r)[1:] for g, r in want.items()}


def test_segments_of_rows_that_are_alike(spark):
    df = _rows(spark).selectExpr("vaga_cat", "coalesce(quartos, 0) quartos", "'x' cluster_nome", "'' metragem_fx", "'q' quadra", "valor_m2", "preco", "area_util").withColumn("k", F.explode(F.array(*map(F.lit, range(50)))))
    out = segments.long_segments(df, ["vaga_cat"])
    want = {r["vaga_cat"]: r for r in df.groupBy("vaga_cat").agg(*segments.bundle()).collect()}
    rows = out.filter("segmento = 'GERAL'").collect()
    assert {r["vaga_cat"]: [r[c] for c in ("amostra", "m2_medio", "m2_mediana", "preco_medio", "area_media")] for r in rows} == {g: list(r)[1:] for g, r in want.items()}
    assert "__c" in out._jdf.queryExecution().analyzed().toString()


def test_fits_count_points_that_rows_share_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(tiers, "kept", lambda df: (seen.append(df.count()), df)[1])
    df = spark.range(3_000).selectExpr("double(id % 30) v", "0.1D w")
    found = [tuple(r) for r in tiers.fit_centres(df, ["v", "w"], k=3, seeds=(1, 2)).orderBy("v").collect()]
    assert seen == [30]
    assert [round(r[1], 6) for r in found] == sorted(round(r[1], 6) for r in found)
    assert {r[2] for r in found} == {0.1}
    assert {r[4] for r in found} == {1.0}  # a constant column
    assert found[0][3] == pytest.approx(df.agg(F.stddev_samp("v")).first()[0])


def test_a_catalogue_reads_its_listings_once(spark, tmp_path):
    path = str(tmp_path / "t")
    _rows(spark).selectExpr("*", "'VENDA' oferta", "concat('B', quartos) bairro", "'c' cidade", "'q' quadra", "1 vagas").write.parquet(path)
    out = studies.all_results(spark.read.parquet(path), (studies.Study("B1", "apt", "VENDA", bairro="B1"), studies.Study("B0", "house", "VENDA", bairro="B0")), "2025-01-01")
    assert not [f for f in out.inputFiles() if path in f]
    assert {r["estudo"] for r in out.filter("amostra > 0").collect()} == {"B1 (apt)", "B0 (house)"}


def _managed(spark):
    """One broker has all contracts; one of them on both sides, one contract without a key."""
    df = spark.range(200).selectExpr("nullif(id, 7) c", "cast(100 + id as decimal(18,2)) v", "cast(id as decimal(18,4)) k", "'A' s1", "if(id % 2 = 0, 'A', concat('B', id % 3)) s2", "1 p")
    return awards.managed(df, "c", "v", "k", [("VEND", "s1", "p"), ("CAP", "s2", "p")], spark.createDataFrame([("A", "M"), ("B0", "M"), ("B1", "N"), ("B2", None)], "corretor string, gerente string"))


def test_brokers_with_very_many_contracts_stay_apart(spark):
    rows = _managed(spark)
    for out in (awards.manager_detail(rows), awards.manager_commission(rows)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(corretor" not in plan
        assert plan.count("hashpartitioning(contrato") <= 3  # none of them where contracts lie together already
    listed = rows.select("contrato", "vgv", "lado", "gerente", "corretor").unionByName(rows.select("contrato", "vgv", F.lit("GERAL").alias("lado"), "gerente", "corretor").distinct())
    each = listed.join(listed.groupBy("contrato", "lado", "gerente").agg(F.count(F.lit(1)).alias("k")), ["contrato", "lado", "gerente"])
    want = each.groupBy(F.col("lado").alias("lista"), "gerente", "corretor").agg(F.sum(F.col("vgv").cast("double") / F.col("k")).alias("valor"))
    shown = lambda df: sorted((r["lista"], r["gerente"], r["corretor"], round(r["valor"], 6)) for r in df.collect())
    assert shown(awards.manager_detail(rows)) == shown(want)


def test_places_in_a_file_without_a_task_for_it(spark):
    rows = spark.range(1000).selectExpr("if(id < 700, 'a', 'b') arquivo", "id posicao").filter("posicao % 10 <> 3")
    out = files.ranked(rows, 64)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(arquivo" not in plan or "__block" in plan
    got = {r["posicao"]: r["lugar"] for r in out.collect()}
    want = [p for p in range(1000) if p % 10 != 3]
    assert [got[p] for p in want] == list(range(1, 631)) + list(range(1, 271))


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_more_lines_are_more_files(spark, monkeypatch):
    from tessela.plans import upkeep

    monkeypatch.setattr(upkeep, "FILE_LINES", 1_000)
    names = {r["arquivo"] for r in files.lines(spark, upkeep._unlike_files(spark, SF)).select("arquivo").distinct().collect()}
    assert len(names) == 2 * -(-spark.read.parquet(f"{SF}/lineitem.parquet").count() // 1_000)


def test_limits_go_to_the_rows_of_large_groups(spark):
    df = spark.range(2_000_000).selectExpr("id % 2 vaga", "double(id % 1000) v", "'VENDA' oferta")
    for out in (quality.without_outliers(df, "v", ["vaga"], few_groups=True), quality.without_outliers(df, "v", ["vaga"]), quality.offered_where_found(df, "VENDA")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan
        assert "SortMergeJoin" not in plan

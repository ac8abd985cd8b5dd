"""Outliers, tables and sinks on small literal tables, and what must hold between results."""

import pytest
from pyspark.sql import functions as F

from tessela.operators import awards, captures, quality, stock, studies, tiers, windows
from tessela.sources import schema, sinks, tables


def test_outliers_guards(spark):
    same = spark.createDataFrame([(5.0,)] * 8 + [(90.0,)], "v double")
    assert quality.without_outliers(same, "v").count() == 9
    assert quality.without_outliers(same, "v", guard_zero=False).count() == 8
    few = spark.createDataFrame([(float(i),) for i in range(18)] + [(900.0,)], "v double")
    assert quality.without_outliers(few, "v", least_rows=20).count() == 19
    assert quality.without_outliers(few, "v").count() == 18
    assert quality.without_outliers(spark.createDataFrame([(None,)] * 3, "v double"), "v").count() == 3


def test_offer_filter_only_where_found(spark):
    df = spark.createDataFrame([("COM", "VENDA"), ("COM", "ALUGUEL"), ("SEM", "ALUGUEL")], "vaga string, oferta string")
    assert sorted(map(tuple, quality.offered_where_found(df, "VENDA").collect())) == [("COM", "VENDA"), ("SEM", "ALUGUEL")]


def test_commission_of_sides_is_general(spark):
    df = spark.createDataFrame([("a", "b", "b", None, 100.0, 6.0), ("a", None, "-", "", 50.0, 3.0)], "v1 string, v2 string, c1 string, c2 string, valor double, com double")
    roles = awards.role_rows(awards.sides(df, ["v1", "v2"], ["c1", "c2"]), "valor", "com")
    sums = {r["lista"]: r["s"] for r in roles.groupBy("lista").agg(F.sum("vgc").alias("s")).collect()}
    assert sums["CAP"] + sums["VEND"] == pytest.approx(sums["GERAL"]) == pytest.approx(9.0)


def test_teams_of_contracts_and_people(spark):
    """A special manager's contract is the team AC's, all others are PP's; who is excepted goes from AC to PP."""
    rows = [("d", "v", "HELENA BRAGA", "OUTRO", 100.0, 6.0), ("x", "v", "OUTRO", "-", 50.0, 3.0), ("d", "x", "NINGUEM", "HELENA", 10.0, 1.0)]
    df = spark.createDataFrame(rows, "v1 string, c1 string, gv string, gc string, valor double, com double").withColumn("equipe", awards.team(["gv", "gc"], ("HELENA",)))
    roles = awards.role_rows(awards.sides(df, ["v1"], ["c1"]), "valor", "com", ("equipe",)).withColumn("equipe", awards.moved("equipe", "nome", ("X",)))
    sums = {(r["secao"], r["nome"]): (r["pos"], r["valor"]) for r in awards.sections(awards.ranking(roles, ("equipe", "lista"))).collect()}
    assert {k: v for k, v in sums.items() if k[0].endswith("VGV_GERAL")} == {("AC_VGV_GERAL", "D"): (1, 110.0), ("AC_VGV_GERAL", "V"): (2, 100.0), ("PP_VGV_GERAL", "X"): (1, 60.0), ("PP_VGV_GERAL", "V"): (2, 50.0)}


def test_contracts_of_brokers(spark):
    rows = [(1, " A1 ", "d", "v", 100.0, 6.0), (2, "", "d", None, 50.0, 3.0), (3, "A1", "d", "d", 70.0, 2.0), (4, None, "d", None, 30.0, 0.0), (5, "B", None, "d", 20.0, 1.0)]
    df = spark.createDataFrame(rows, "linha long, contrato string, v1 string, c1 string, valor double, com double").withColumn("valor", F.col("valor").cast("decimal(18,2)"))
    df = awards.sides(awards.with_contract_id(df, "contrato", "linha"), ["v1"], ["c1"])
    roles = awards.role_rows(df, "valor", "com", ("contrato", "linha")).filter("lista = 'GERAL'")
    out = {r["corretor"]: r for r in awards.broker_contracts(roles, "linha").collect()}
    assert float(out["D"]["vgv"]) == 270.0
    assert out["D"]["vgc"] == 9.0
    assert [(c["contrato"], float(c["valor"]), c["comissao"]) for c in out["D"]["contratos"]] == [("A1", 100.0, 5.0), ("Contrato_2", 50.0, 3.0), ("B", 20.0, 1.0)]
    assert [c["contrato"] for c in out["V"]["contratos"]] == ["A1"]


def test_contracts_of_a_month(spark):
    df = spark.createDataFrame([("2026-02-01",), ("28/02/2026",), ("28/02/2026 10:30",), ("2026-03-01",), (None,), ("soon",)], "d string")
    assert awards.in_month(df, "d", "2026-02-01", "2026-02-28").count() == 3
    assert awards.in_month(df, "d", "2026-02-01", "2026-02-28", midnight=True).count() == 2


def test_upsert_twice_is_once(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    once = stock.upsert(old, new, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, stock.upsert(once, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_tables_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.current(spark, path, "k int").count() == 0
    sinks.replace(spark.createDataFrame([(1,)], "k int"), path)
    sinks.replace(stock.upsert(sinks.current(spark, path, "k int"), spark.createDataFrame([(2,)], "k int"), ["k"]), path)
    assert sorted(r["k"] for r in sinks.current(spark, path, "k int").collect()) == [1, 2]


def test_csv_sources(spark, tmp_path):
    path = tmp_path / "base_2025-03-01.csv"
    path.write_text("﻿Código;Preço \n1;2,5\n", encoding="utf-8")
    df = tables.csv(spark, str(path), required=("Código",))
    assert df.columns == ["Código", "Preço"]
    assert schema.standardised(df).columns == ["codigo", "preco"]
    assert schema.column(df, "PRECO") == "Preço"
    assert tables.dated_csv(spark, [str(path)]).first()["arquivo_origem"] == path.name
    with pytest.raises(ValueError, match="creci"):
        tables.csv(spark, str(path), required=("creci",))
    sinks.to_csv(df, str(tmp_path / "out"), ";")
    assert tables.csv(spark, str(tmp_path / "out"), ";").count() == 1


def test_html_keeps_the_largest_table(spark):
    page = "<html><table><tr><td>x</td></tr></table><TABLE class=a><tr><th>A</th><th>B</th></tr><tr><td>1&nbsp;<b>m</b></td><td>2</td></tr></TABLE></html>"
    rows = tables.html_rows(spark.createDataFrame([("p", page)], "path string, html string")).orderBy("line").collect()
    assert [r["cells"] for r in rows] == [["A", "B"], ["1 m", "2"]]


def test_available(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"quantidade": 3, "lista": [{"codigo": 7}, {"codigo": "x"}, {"codigo": "7"}, {"codigo": 9}]}')
    assert [r["codigo"] for r in tables.available(spark, str(tmp_path)).collect()] == [7, 9]


def test_fit_needs_rows_and_pick_three(spark):
    assert tiers.fit_centres(spark.createDataFrame([(1.0, 2.0)] * 5, "a double, b double"), ["a", "b"]) is None
    df = spark.createDataFrame([(1, 10.0), (2, 100.0), (3, 104.0), (4, 200.0)], "cluster int, media double").withColumn("g", F.lit("x"))
    picked = {r["cluster"]: r["cluster_nome"] for r in tiers.pick_three(df, ["g"]).collect()}
    assert picked == {1: tiers.TIERS[0], 3: tiers.TIERS[1], 4: tiers.TIERS[2]}


def test_new_keys_number_on(spark):
    dim = spark.createDataFrame([("B7", "Asa Sul")], "id string, nome string")
    names = spark.createDataFrame([("asa sul", 1), ("Guará", 2), ("GUARA", 3), ("Lago", 4), (None, 5)], "n string, row int")
    rows = {r["nome"]: r["id"] for r in stock.new_keys(names, "n", "row", dim, "nome", "id").collect()}
    assert rows == {"Asa Sul": "B7", "Guará": "B8", "Lago": "B9"}


def test_readers_by_header_and_extension(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1;2\n")
    (tmp_path / "b.csv").write_text("x,y;z\n1,2\n")
    (tmp_path / "c.txt").write_text("only\n1\n")
    assert tables.load(spark, str(tmp_path / "a.csv")).columns == ["x", "y"]
    assert tables.load(spark, str(tmp_path / "b.csv")).columns == ["x", "y;z"]
    assert tables.load(spark, str(tmp_path / "c.txt")).columns == ["only"]
    spark.range(3).write.parquet(str(tmp_path / "d.parquet"))
    assert tables.load(spark, str(tmp_path / "d.parquet")).count() == 3
    with pytest.raises(ValueError, match="xls"):
        tables.load(spark, "e.xls")
    assert tables.sheet(spark, str(tmp_path / "b.csv")).columns == ["x", "y;z"]


def test_rows_with_more_cells_are_left_out(spark, tmp_path):
    (tmp_path / "a.csv").write_text('b,a\n1,2\n1,2,3\n4\n"x,y",5\n')
    assert sorted(tuple(r) for r in tables.strict_csv(spark, str(tmp_path / "a.csv"), ["a", "b"]).collect()) == [("2", "1"), ("5", "x,y"), ("None", "4")]
    with pytest.raises(ValueError, match="expected"):
        tables.strict_csv(spark, str(tmp_path / "a.csv"), ["a", "c"])


def test_many_dated_files(spark, tmp_path):
    for name in ("base_2025-03-01.csv", "base_02-04-2025.csv", "other.csv", "more_2025_05_06.csv"):
        (tmp_path / name).write_text("codigo,preco\n1,2\n")
    found = tables.dated_csv(spark, [f"{tmp_path}/base*.csv", f"{tmp_path}/[om]*.csv"], ",").collect()
    assert sorted(str(r["data"]) for r in found) == ["2025-03-01", "2025-04-02", "2025-05-06"]


def test_narrowed_listings_are_pushed_down(spark, tmp_path):
    rows = [("1", " asa sul ", "VENDA", 5.0, 50.0, "2025-01-01", 1), ("2", "ASA SUL", "ALUGUEL", 5.0, 50.0, "2025-01-02", 1), ("3", "Asa Sul", "venda", None, 50.0, "2025-01-02", 1), ("4", "ASA SUL", "VENDA", 5.0, 50.0, "2025-02-02", 1)]
    spark.createDataFrame(rows, "codigo string, bairro string, oferta string, preco double, area_util double, data_coleta string, extra int").write.parquet(str(tmp_path / "l"))
    df = spark.read.parquet(str(tmp_path / "l"))
    out = tables.narrowed(df, "2025-01-01", "2025-01-31", {"bairro": "asa sul", "oferta": ("VENDA", "PUBLICADO")}, {"preco": (1, 9)})
    assert [r["codigo"] for r in tables.conformed(out).collect()] == ["1"]
    assert "extra" not in out.columns


def test_appends_and_metrics(spark, tmp_path):
    df = spark.range(5).withColumnRenamed("id", "k")
    sinks.append_limited(df, str(tmp_path / "a"), "k", 3)
    sinks.append_limited(df, str(tmp_path / "a"), "k", 2)
    assert sorted(r["k"] for r in tables.csv(spark, str(tmp_path / "a")).collect()) == ["0", "0", "1", "1", "2"]
    sinks.append_results(spark.createDataFrame([(None, 1.5, "x")], "nome string, valor double, extra string"), str(tmp_path / "r"), {"nome": "string", "valor": "double", "amostra": "long"})
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "r")).collect()] == [("", 1.5, 0)]
    sinks.flags(spark.createDataFrame([(1, "SIM"), (2, "NAO"), (3, "SIM")], "codigo int, disponivel string"), str(tmp_path / "f"))
    assert tables.csv(spark, str(tmp_path / "f" / "disponiveis"), ";").count() == 2
    assert sinks.metrics(spark, str(tmp_path / "none")).count() == 0
    base = {"bairro": "a", "tipo": "b", "oferta": "c", "mes_alvo": "2025-01", "mes_ref": "2025-01", "segmento": "GERAL", "vaga_cat": "", "cluster_nome": "", "quartos": -1, "metragem_fx": "", "quadra": ""}
    row = lambda n: spark.createDataFrame([base], ", ".join(f"{c} {'int' if c == 'quartos' else 'string'}" for c in base)).selectExpr("*", "date'2024-11-01' janela_inicio", "date'2025-01-31' janela_fim", f"{n}L amostra", "1D m2_medio", "1D m2_mediana", "1D preco_mediana", "1D area_mediana", "timestamp'2025-02-01' gerado_em")
    for n in (5, 7):
        sinks.upsert_metrics(row(n), str(tmp_path / "m"))
    assert [r["amostra"] for r in sinks.metrics(spark, str(tmp_path / "m")).collect()] == [7]


def test_upserts_rewrite_touched_months_alone(spark, tmp_path):
    path = str(tmp_path / "m")
    keys = "bairro string, mes_alvo string, segmento string, amostra long"
    rest = "'t' tipo", "'v' oferta", "date'2024-11-01' janela_inicio", "date'2025-01-31' janela_fim", "mes_alvo mes_ref", "'' vaga_cat", "'' cluster_nome", "-1 quartos", "'' metragem_fx", "'' quadra", "1D m2_medio", "1D m2_mediana", "1D preco_mediana", "1D area_mediana"
    rows = lambda *r: spark.createDataFrame(list(r), keys).selectExpr("*", *rest)
    files = lambda m: {f.name for f in (tmp_path / "m" / f"mes_alvo={m}").glob("*.parquet")}
    found = lambda: sorted((r["bairro"], r["mes_alvo"], r["segmento"], r["amostra"]) for r in sinks.metrics(spark, path).collect())
    sinks.upsert_metrics(rows(("a", "2025-01", "G", 1), ("a", "2025-02", "G", 2), ("b", "2025-02", "G", 3)), path)
    before = {m: files(m) for m in ("2025-01", "2025-02")}
    sinks.upsert_metrics(rows(("a", "2025-02", "G", 9), ("a", "2025-02", "Q", 4), ("a", "2025-03", "G", 5)), path)
    want = [("a", "2025-01", "G", 1), ("a", "2025-02", "G", 9), ("a", "2025-02", "Q", 4), ("a", "2025-03", "G", 5), ("b", "2025-02", "G", 3)]
    assert found() == want
    assert files("2025-01") == before["2025-01"]
    assert not files("2025-02") & before["2025-02"]
    sinks.upsert_metrics(rows(("a", "2025-02", "G", 9), ("a", "2025-02", "Q", 4), ("a", "2025-03", "G", 5)), path)
    assert found() == want
    assert all(r["gerado_em"] is not None for r in sinks.metrics(spark, path).collect())


def test_tables_are_made_once(spark, tmp_path):
    for _ in range(2):
        sinks.ensure_table(spark, "estudos.metricas", sinks.METRIC_SCHEMA, str(tmp_path / "t"), "mes_alvo")
    assert [c for c in spark.table("estudos.metricas").columns if c != "mes_alvo"] == [x.split()[0] for x in sinks.METRIC_SCHEMA.split(", ") if not x.startswith("mes_alvo")]
    spark.sql("DROP DATABASE estudos CASCADE")


def test_schema_repair(spark):
    df = spark.createDataFrame([("x", None)], "a string, b double")
    assert schema.filled(df, {"c": "N/D", "b": 1.0}).first()["c"] == "N/D"
    assert schema.filled(df, {"b": 1.0}).first()["b"] is None
    assert schema.exactly(df, ["b", "a"]).columns == ["b", "a"]
    with pytest.raises(ValueError, match="expected"):
        schema.exactly(df, ["a"])
    assert tuple(schema.locked(df, {"a": "string", "b": "double", "z": "string", "n": "long"}).first()) == ("x", 0.0, "", 0)
    assert schema.column_with(spark.createDataFrame([(1,)], "`Preço total` int"), "valor", "preco") == "Preço total"


def test_purpose_and_period(spark):
    rows = [(" venda ", "Casa", "05/03/2026 10:11"), ("VENDA", "casa", "2026-04-01"), ("Aluguel", "casa", "2026-03-06"), (None, "casa", None)]
    df = spark.createDataFrame(rows, "Finalidade string, Destinacao string, DataCadastro string")
    assert captures.wanted_rows(df, "Venda", "CASA").count() == 2
    assert captures.wanted_rows(df, "Venda", None, ("2026-03-01", "2026-03-31")).count() == 1
    assert captures.wanted_rows(df).count() == 4


def test_combined_and_spans(spark):
    a = spark.createDataFrame([("CAP", "x", 1.0, 2.0)], "lista string, nome string, vgv double, vgc double")
    assert [tuple(r) for r in awards.combined(a, a).collect()] == [("CAP", "x", 2.0, 4.0)]
    spans = spark.sql("select date'2025-01-01' inicio, date'2025-03-31' fim")
    assert [str(x) for x in windows.training_span(spans, 2).first()] == ["2024-11-01", "2025-05-31"]
    assert studies.usual(spark.createDataFrame([("Luxo",), (" Luxo",), ("",), (None,), ("A",)], "p string"), "p", "Z").first()[0] == "Luxo"
    assert studies.usual(spark.createDataFrame([("",)], "p string"), "p", "Z").first()[0] == "Z"

"""Files of unlike kinds, HTML of all sorts, facts by day and keys in ranges."""

import re

import pytest
from pyspark.sql import functions as F

from tessela.operators import stock
from tessela.sources import files, tables


def _write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))


def test_each_file_by_its_own_header(spark, tmp_path):
    _write(tmp_path / "a.csv", 'Código,Preço,x;y\n1,"10,5",a\n2,20,"b ""q"" ;"\n\n3,30\n')
    _write(tmp_path / "b.csv", "﻿Valor;CODIGO;Setor\r\n7;70;Asa Sul\r\n8;80;;extra\r\n")
    _write(tmp_path / "c.csv", "codigo\n9\n")
    names = {"codigo": ("codigo", "id"), "preco": ("preço", "valor"), "bairro": ("bairro", "setor")}
    rows = files.many_csv(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/[bc].csv"], names=names, required=("codigo",)).orderBy("posicao").collect()
    assert [(r["codigo"], r["preco"], r["bairro"]) for r in rows] == [("1", "10,5", None), ("2", "20", None), ("3", "30", None), ("70", "7", "Asa Sul"), ("80", "8", None), ("9", None, None)]
    assert [r["linha"] for r in rows] == [1, 2, 4, 1, 2, 1]
    assert [r["posicao"] for r in rows] == [1, 2, 4, 6, 7, 9]
    with pytest.raises(ValueError, match="preco"):
        files.many_csv(spark, str(tmp_path), names=names, required=("preco",))


def test_dated_files_of_unlike_kinds(spark, tmp_path):
    _write(tmp_path / "base_2025-03-01.csv", "Código,Preço\n1,5\n")
    _write(tmp_path / "base 02-04-2025.csv", "\ufeffvalor;id anuncio;garagens\n7;2;1\n")
    _write(tmp_path / "undated.csv", "codigo\n3\n")
    names = {"codigo": ("codigo", "id_anuncio"), "preco": ("preco", "valor"), "vagas": ("vagas", "garagens"), "data": ("data",)}
    rows = files.dated_csv(spark, f"{tmp_path}/*.csv", names=names).collect()
    assert sorted((r["codigo"], r["preco"], r["vagas"], str(r["data"]), r["arquivo_origem"]) for r in rows) == [("1", "5", None, "2025-03-01", "base_2025-03-01.csv"), ("2", "7", "1", "2025-04-02", "base 02-04-2025.csv")]


def test_places_do_not_depend_on_splits(spark, tmp_path):
    for k in range(3):
        _write(tmp_path / f"{k}.csv", "id,v\n" + "".join(f"{k}{i:04},{'x' * (i % 50)}\n" for i in range(700)))
    want, before = None, spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1m", "3k", "700b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found = sorted((r["posicao"], r["linha"], r["texto"]) for r in files.lines(spark, str(tmp_path)).collect())
            assert [p for p, _, _ in found] == list(range(2103))
            assert want is None or found == want
            want = found
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [line for _, line, _ in want] == list(range(701)) * 3
    assert [t.split(",")[0] for _, _, t in want[702:704]] == ["10000", "10001"]


def test_html_files_by_content(spark, tmp_path):
    _write(tmp_path / "a.xls", "<html><table><tr><td>Preço</td></tr></table></html>")
    _write(tmp_path / "b.xls", "<DIV><table><tr><td>Preço</td></tr></table>", "latin-1")
    _write(tmp_path / "c.xls", "<table><tr><td>Preço</td></tr></table>", "utf-16")
    _write(tmp_path / "d.xls", "PK\x03\x04 no page")
    pages = tables.html_files(spark, str(tmp_path))
    rows = tables.html_rows(pages).collect()
    assert sorted(r["path"][-5:] for r in rows) == ["a.xls", "b.xls", "c.xls"]
    assert all(r["cells"] == ["Preço"] for r in rows)


def test_nested_tables_come_out_whole(spark):
    inner = "<table><tr><td>1<td>2<td>3</tr><tr><td>4<td>5<td>6</table>"
    pages = [
        ("outer", f"<table><tr><th>A<th>B<tr><td>x {inner} y<td>z<tr><td>p<td>q<tr><td>r<td>s</table>"),
        ("inner", f"<table><tr><td>menu {inner}</table>"),
        ("stray", "</table></table><table><tr><td>ok</td></tr></table>"),
        ("open", "<table><tr><td>never closed"),
        ("none", "no table"),
        ("null", None),
    ]
    found = {(r["p"], r["line"]): r["cells"] for r in tables.html_rows(spark.createDataFrame(pages, "p string, html string"), "p").collect()}
    assert found == {
        ("outer", 0): ["A", "B"],
        ("outer", 1): ["x 123456 y", "z"],
        ("outer", 2): ["p", "q"],
        ("outer", 3): ["r", "s"],
        ("inner", 0): ["1", "2", "3"],
        ("inner", 1): ["4", "5", "6"],
        ("stray", 0): ["ok"],
        ("open", 0): ["never closed"],
    }
    depths = {(r["depth"], r["text"]) for r in tables.html_cells(spark.createDataFrame(pages[1:2], "p string, html string"), "p").collect()}
    assert (2, "5") in depths
    assert (1, "menu 123456") in depths


def test_pages_are_gone_through_without_shuffles(spark):
    page = "<table><tr><td>a<table><tr><td>" + "x" * 50 + "</table>b</td><td>c</table><td>no"
    pages = spark.createDataFrame([(1, page), (None, page), (2, "<td>no<table><td>no<TR>no<td>yes<tré>")], "p int, html string")
    rows = tables.html_rows(pages, "p")
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted((str(r["p"]), r["line"], r["cells"]) for r in rows.collect()) == [("1", 0, ["a" + "x" * 50 + "b", "c"]), ("2", 0, ["yes"]), ("None", 0, ["a" + "x" * 50 + "b", "c"])]


def test_only_days_of_the_batch_are_read(spark, tmp_path):
    path = str(tmp_path / "fatos")
    spark.range(300).selectExpr("id Codigo", "date_add(date'2025-01-01', cast(id as int) % 100) DataSaida").write.partitionBy("DataSaida").parquet(path)
    facts = spark.read.parquet(path)
    batch = spark.createDataFrame([(5,), (6,), (105,), (999,)], "Codigo long").selectExpr("Codigo", "date_add(date'2025-01-01', cast(Codigo as int) % 100) DataSaida")
    known = stock.of_these_days(facts, batch, "DataSaida")
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*DataSaida#\d+ >= 2025-01-06", plan), plan
    assert known.select(F.input_file_name()).distinct().count() < facts.select(F.input_file_name()).distinct().count()
    out = stock.appended(facts, batch, ["Codigo", "DataSaida"], day="DataSaida")
    assert out.count() == 301
    assert stock.of_these_days(facts, batch.filter("false"), "DataSaida").count() == 0


def test_exit_facts_in_seven_columns(spark):
    feed = spark.createDataFrame([("10.0", "Vendido", " ", "2025-03-01"), ("11", "VAGO / DISPONÍVEL", None, "2025-03-01"), ("12", None, None, "2025-03-02"), ("13", "Locado", "Preço", "2025-03-03"), ("", "Vendido", None, "2025-03-03"), ("10", "Vendido", None, "2025-03-01")], "Codigo string, Situacao string, Motivo string, DataSaida string")
    facts = spark.createDataFrame([("13.0", "2025-03-03")], "Codigo string, d string").selectExpr("Codigo", "date(d) DataSaida")
    caps = spark.createDataFrame([("10", "Ana", None, None, "G1", "2025-01-01", 1), ("10", "Bia", "Caio", "", "G2", "2025-01-01", 2), ("10", "Old", "", "", "G0", None, 3), ("12", "", "", "", "", "2025-01-05", 4)], "Codigo string, Captador1 string, Captador2 string, Captador3 string, Gerente string, d string, ordem int").selectExpr("*", "date(d) DataEntrada")
    out = stock.exit_facts(feed, facts, caps, "ordem", "2025-04-01")
    assert tuple(out.columns) == stock.EXIT_FACT
    rows = sorted(tuple(map(str, r)) for r in out.collect())
    assert rows == [("10", "Bia", "Caio", "", "G2", "Vendido", "2025-03-01")] * 2 + [("12", "", "", "", "", "NAO INFORMADO", "2025-03-02")]
    undated = stock.exit_facts(feed.select("Codigo"), facts, caps, "ordem", "2025-04-01")
    assert {str(r["DataSaida"]) for r in undated.collect()} == {"2025-04-01"}


def test_ranges_are_even_where_first_rows_crowd(spark):
    df = spark.range(20_000).selectExpr("cast(pow(id + 1, 3) as long) first")  # as of Zipf's law: most at the start
    sizes = [r["count"] for r in stock.in_ranges(df, "first", 32).groupBy("__part").count().collect()]
    assert len(sizes) == 32
    assert max(sizes) < 2 * 20_000 / 32
    names = df.selectExpr("concat('n', first) n", "first")
    dim = spark.createDataFrame([("B3", "old")], "id string, nome string")
    keys = {r["nome"]: int(r["id"][1:]) for r in stock.new_keys(names, "n", "first", dim, "nome", "id").collect()}
    assert [keys[f"n{(i + 1) ** 3}"] for i in range(20_000)] == list(range(4, 20_004))

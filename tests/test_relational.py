"""Reading a database: the one that ships with Spark, in memory."""

from tessela.sources import tables

DRIVER = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_days_are_read_apart_and_filters_are_the_databases(spark):
    rows = [(str(i), [" asa sul", "ASA SUL", "Lago d'Oeste", ""][i % 4], "Venda" if i % 3 else "ALUGUEL", float(i), i % 40) for i in range(400)]
    df = spark.createDataFrame(rows, "codigo string, bairro string, oferta string, preco double, k int").selectExpr("codigo", "bairro", "oferta", "preco", "date_add(date'2025-01-01', k) data_coleta", "'x' extra")
    url = "jdbc:derby:memory:imoveis;create=true"
    df.write.format("jdbc").options(url=url, dbtable="imoveis", createTableColumnTypes="codigo varchar(20), bairro varchar(40), oferta varchar(20), extra varchar(2)", **DRIVER).save()
    out = tables.relational(spark, url, "imoveis", "2025-01-05", "2025-01-24", {"bairro": ("Asa Sul", "LAGO D'OESTE"), "oferta": "venda"}, {"preco": (50, 350)}, parts=4, **DRIVER)
    want = {c for c, b, o, p, k in rows if b and o.upper() == "VENDA" and 50 <= p <= 350 and 4 <= k <= 23}
    got = out.collect()
    assert {r["codigo"] for r in got} == want
    assert {r["bairro"] for r in got} == {"ASA SUL", "LAGO D'OESTE"}
    assert out.columns == ["codigo", "bairro", "oferta", "preco", "data_coleta"]
    assert out.rdd.getNumPartitions() == 4
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert """UPPER(TRIM("bairro")) IN ('ASA SUL', 'LAGO D''OESTE')""" in plan
    assert "Filter" not in plan.replace("PushedFilters", "")


def test_the_condition_as_sql():
    sql = tables.narrowed_sql("t", {"data_coleta": "Dia", "oferta": "o", "preco": "p"}, "2025-01-01", "2025-02-01", {"oferta": "o'x"}, {"preco": (1, 2)})
    assert sql == """SELECT "Dia", "o", "p" FROM t WHERE "Dia" BETWEEN DATE('2025-01-01') AND DATE('2025-02-01') AND UPPER(TRIM("o")) IN ('O''X') AND "p" BETWEEN 1.0 AND 2.0"""

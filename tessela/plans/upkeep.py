"""Queries of stock upkeep and of text repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessela.functions import numbers, text
from tessela.functions.dates import in_file_name, parsed, sheet_serial, shown
from tessela.functions.numbers import rounded
from tessela.operators import captures as captures_of
from tessela.operators import stock
from tessela.operators.segments import rooms_house
from tessela.plans.views import LISTING, captures, exit_feed, listing, table
from tessela.sources import files, sinks, tables
from tessela.sources.kept import folder


def exits_new(spark: SparkSession, sf: str) -> DataFrame:
    """Exits of odd users or late days that the fact table (even users of the first fortnight) lacks, with the latest capture."""
    feed = exit_feed(spark, sf).filter(stock.has_left(F.col("situacao")))
    feed = feed.withColumn("motivo", stock.exit_reason(F.col("motivo"), F.col("situacao")))
    facts = feed.filter((F.col("codigo") % 2 == 0) & (F.dayofmonth("data") < 15)).select("codigo", "data")
    latest = stock.latest(captures(spark, sf), "codigo", "data", "o_orderkey", ["captador1"])
    return stock.exits(feed, facts, latest, ["codigo", "data"], ["captador1"]).select("event_id", "codigo", shown(F.col("data")).alias("data"), "motivo", "captador1")


def capture_latest(spark: SparkSession, sf: str) -> DataFrame:
    return stock.latest(captures(spark, sf), "codigo", "data", "o_orderkey", ["o_orderkey", "captador1"])


def capture_append(spark: SparkSession, sf: str) -> DataFrame:
    rows = captures(spark, sf).filter("data is not null")
    old = rows.filter("o_orderkey % 3 = 0").select("codigo", "data", "captador1").distinct()
    new = rows.filter("o_orderkey % 2 = 0").select("codigo", "data", "captador1").distinct()
    return stock.appended(old, new, ["codigo", "data", "captador1"])


def dim_upsert(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("codigo"), F.col("p_type").alias("tipo"), F.col("p_retailprice").alias("valor"))
    source = parts.filter("codigo % 4 = 0").select((F.col("codigo") + 100).alias("codigo"), "tipo", (F.col("valor") * 2).alias("valor"))
    return stock.upsert(parts, source, ["codigo"])


def surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Brands numbered in the order of their first part, after the districts that are known."""
    dim = table(spark, sf, "nation").select(F.concat(F.lit("B"), F.col("n_nationkey") + 1).alias("id"), F.col("n_name").alias("nome"))
    return stock.new_keys(table(spark, sf, "part").select("p_brand", "p_partkey"), "p_brand", "p_partkey", dim, "nome", "id")


def focus_flags(spark: SparkSession, sf: str) -> DataFrame:
    districts = table(spark, sf, "nation").filter("n_nationkey % 3 = 0").select(F.col("n_name").alias("bairro"))
    df = stock.with_focus_districts(listing(spark, sf), districts, "bairro").withColumn("comissao", F.col("l_tax") * 100)
    home = stock.is_home(F.concat(F.lit("T"), F.col("l_suppkey") % 12))
    return df.withColumn("foco", stock.focus("preco", "comissao", home, 50_000)).groupBy("bairro", "foco").agg(F.count(F.lit(1)).alias("n"))


def codes_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Customer codes and as many beyond, with those that no order has."""
    codes = table(spark, sf, "customer").select(F.explode(F.array("c_custkey", -1 - F.col("c_custkey"))).alias("codigo"))
    found, missing = stock.in_table(codes, table(spark, sf, "orders").select(F.col("o_custkey").alias("codigo")), "codigo")
    return found.withColumn("achado", F.lit(True)).unionByName(missing.withColumn("achado", F.lit(False)))


def availability_flag(spark: SparkSession, sf: str) -> DataFrame:
    codes = table(spark, sf, "events").select(F.col("user_id").alias("codigo"))
    there = table(spark, sf, "events").filter("event_type = 'purchase' and value > 90").select(F.col("user_id").alias("codigo"))
    return stock.found_and_missing(codes, there, "codigo")


def _capture_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a capture export: texts in the export's spelling, several rows of a code, blank dates and names."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    df = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return df.select(
        k.alias("ordem"),
        F.when(k % 13 > 0, (F.col("o_custkey") % 900).cast("string")).otherwise("sem código").alias("Codigo"),
        F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("  novo "), F.lower("n_name"))).otherwise(F.col("n_name")).alias("Bairro"),
        F.concat(F.lit("R$ "), numbers.money(F.col("o_totalprice"))).alias("Valor"),
        F.col("o_orderpriority").alias("Tipo"),
        (k % 7).cast("string").alias("ComissaoVenda"),
        F.when(k % 3 > 0, F.date_format(day, "dd/MM/yyyy HH:mm")).alias("DataCadastro"),
        F.when(k % 2 > 0, F.date_format(F.date_add(day, 1), "yyyy-MM-dd")).otherwise("").alias("DataHoraUltimaAlteracao"),
        F.lit(None).cast("string").alias("DataHoraUltimaSituacao"),
        F.concat(F.lit("Broker "), k % 40, F.when(k % 4 > 0, F.concat(F.lit(" | broker "), k % 7)).otherwise("")).alias("Captadores"),
        F.when(k % 5 > 0, " venda ").otherwise("Aluguel").alias("Finalidade"),
    )


def _captured(spark: SparkSession, sf: str) -> captures_of.Dimensions:
    nations, suppliers, parts = (table(spark, sf, t) for t in ("nation", "supplier", "part"))
    orders = table(spark, sf, "orders")
    dims = captures_of.Dimensions(
        bairros=nations.filter("n_nationkey < 20").select(F.concat(F.lit("B"), F.col("n_nationkey") + 1).alias("IdBairro"), F.col("n_name").alias("Nome"), F.col("n_nationkey").alias("ordem")),
        tipos=orders.filter("o_orderpriority < '5'").select(F.concat(F.lit("T"), F.substring("o_orderpriority", 1, 1).cast("int") + 5).alias("IdTipo"), F.lower("o_orderpriority").alias("Nome"), F.lit(0).alias("ordem")).distinct(),
        corretores=suppliers.filter("s_suppkey < 30").select(F.concat(F.lit("C"), "s_suppkey").alias("IdCorretor"), F.concat(F.lit("BROKER "), "s_suppkey").alias("Nome"), F.concat(F.lit("G"), "s_nationkey").alias("IdGerente"), F.col("s_suppkey").alias("ordem")),
        imoveis=parts.select(F.col("p_partkey").cast("int").alias("Codigo"), F.lit("T1").alias("Tipo"), F.col("p_retailprice").alias("Valor"), F.lit("B1").alias("Bairro"), F.lit(False).alias("FocoPP"), F.lit(False).alias("FocoAC")),
        fatos=orders.filter("o_orderkey % 11 = 0").select((F.col("o_custkey") % 900).cast("int").alias("Codigo"), F.concat(F.lit("C"), F.col("o_orderkey") % 40).alias("Captador1"), F.lit("").alias("Captador2"), F.lit("").alias("Captador3"), F.lit("").alias("Gerente"), F.to_date("o_orderdate").alias("DataEntrada")),
    )
    focus = [captures_of.Focus(districts, least) for districts, least in ((("NATION_1", "NATION_2", "NATION_4"), 50_000), (("NATION_5", "NOVO NATION_6"), 90_000))]
    rows = captures_of.wanted_rows(_capture_rows(spark, sf), purpose="Venda")
    codes = table(spark, sf, "events").select((F.col("user_id") * 3).cast("int").alias("codigo"))
    return captures_of.captured(rows, dims, "ordem", "2001-01-01", *focus, codes=codes)


def capture_listings(spark: SparkSession, sf: str) -> DataFrame:
    """The listing dimension after a capture export, by district name."""
    done = _captured(spark, sf)
    return done.imoveis.join(done.bairros.select(F.col("IdBairro").alias("Bairro"), text.fold(F.col("Nome")).alias("NomeBairro")), "Bairro", "left").drop("Bairro")


def capture_facts(spark: SparkSession, sf: str) -> DataFrame:
    return _captured(spark, sf).fatos


def _stock_export(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf, "part").select(
        F.when(k % 10 > 0, F.concat(F.lit(" "), k)).otherwise(" nan").alias("Código"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit(" | ")), F.when(k % 2 == 0, F.concat(F.lit("|"), "p_brand")).otherwise("")).alias("Captadores"),
        F.col("p_type").alias("Categoria"),
        F.col("p_size").alias("Quartos"),
        F.col("p_retailprice").alias("Preço"),
        F.col("p_brand").alias("Endereço"),
        F.when(k % 3 == 0, k.cast("string")).alias("Numero"),
        F.when(k % 4 == 0, "s/n").when(k % 4 == 1, "A").alias("Bloco"),
    )


def stock_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return captures_of.snapshot(_stock_export(spark, sf), "1998-01-01")


def stock_standard(spark: SparkSession, sf: str) -> DataFrame:
    return captures_of.standard(_stock_export(spark, sf))


def html_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as pages with two tables each; the larger one comes back cell by cell."""
    cell = lambda c: F.concat(F.lit("<td class=x> "), c, F.lit("</td>"))
    body = F.concat(F.lit("<html><table><tr><td>menu</td></tr></table><TABLE><tr><th>nome</th><th>saldo</th></tr><tr>"), cell(F.concat(F.lit("<b>"), "c_name", F.lit("</b>"))), cell(F.col("c_acctbal").cast("decimal(18,2)").cast("string")), F.lit("</tr></TABLE></html>"))
    rows = tables.html_rows(table(spark, sf, "customer").select("c_custkey", body.alias("html")), "c_custkey")
    return rows.select("c_custkey", F.col("line").cast("int").alias("line"), F.array_join("cells", "|").alias("cells"))


def html_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Orders' lines as pages: a table whose rows hold tables of their own, tags left open, and a closing tag too many before."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").cast("string").alias("q"), F.col("l_returnflag").alias("f"))
    inner = F.concat(F.lit("<td>"), "q", F.lit(" un<TABLE border=1><tr><th>a<th>b<tr><td>"), "f", F.lit("</td></table> fim<td>"), F.col("l_linenumber").cast("string"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", inner.alias("h")))), lambda x: F.concat(F.lit("<tr class='x'>"), x["h"])), "\n")
    page = F.concat(F.lit("<html></table><!-- <table><tr><td>no --><script>var t = '<table>';</script><table><tr><th>Qtde<th>Linha"), body, F.lit("</table></html>"))
    rows = tables.html_rows(lines.groupBy("l_orderkey").agg(page.alias("html")), "l_orderkey")
    return rows.select("l_orderkey", F.col("line").cast("int").alias("line"), F.array_join("cells", "|").alias("cells"))


#: Lines that a file has, where there are more than three files.
FILE_LINES = 1_000_000


def _unlike_files(spark: SparkSession, sf: str) -> list[str]:
    """Lines of orders as files: one half with commas, the other with semicolons, other headers in another order and a byte order mark. Files are in order of the lines; the more lines, the more files."""
    df = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("codigo"), F.col("l_linenumber").alias("linha"), F.col("l_extendedprice").cast("decimal(18,2)").alias("preco"), F.concat(F.lit('Q "'), F.col("l_returnflag"), F.lit('", x;y')).alias("quadra"))
    base, out = folder(spark), []
    parts = max(3, -(-df.count() // FILE_LINES))
    for part, sep, columns in ((0, ",", {"codigo": "Código", "linha": "n", "preco": "Preço", "quadra": "Quadra"}), (1, ";", {"quadra": "\ufeffQUADRA", "preco": "Valor Total", "codigo": "id anuncio", "linha": "N"})):
        half = df.filter(F.col("codigo") % 2 == part).repartitionByRange(parts, "codigo", "linha").sortWithinPartitions("codigo", "linha")
        out.append(f"{base}/{part}")
        half.select(*[F.col(c).alias(name) for c, name in columns.items()]).write.option("header", True).option("sep", sep).option("escape", '"').csv(out[-1])
    return out


_FILE_NAMES = {"codigo": ("codigo", "id_anuncio"), "linha_id": ("n",), "preco": ("preco", "valor_total"), "quadra": ("quadra",), "cep": ("cep",)}


def files_unlike(spark: SparkSession, sf: str) -> DataFrame:
    """Files of two kinds read as one table, with a place for each row that counts on over all files."""
    rows = files.many_csv(spark, _unlike_files(spark, sf), names=_FILE_NAMES, required=("codigo", "preco"))
    headers = F.col("posicao") - F.col("linha")
    rows = files.ranked(rows).select(F.col("codigo").cast("long").alias("codigo"), F.col("linha_id").cast("int").alias("n"), F.col("preco").cast("double").alias("preco"), "quadra", "cep", (F.col("lugar") == F.col("linha")).alias("na_ordem"), (headers >= 0).alias("depois"))
    return rows


def files_first_last(spark: SparkSession, sf: str) -> DataFrame:
    """The first and the last row of each code over all files, by place."""
    rows = files.many_csv(spark, _unlike_files(spark, sf), names=_FILE_NAMES)
    ends = rows.groupBy(F.col("codigo").cast("long").alias("codigo")).agg(F.min_by("linha_id", "posicao").alias("a"), F.max_by("linha_id", "posicao").alias("b"), F.count(F.lit(1)).alias("n"))
    return ends.select("codigo", F.col("a").cast("int").alias("primeira"), F.col("b").cast("int").alias("ultima"), "n")


def exit_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The exit facts' new rows in their seven columns; codes are written as decimals in the feed, captures have up to three brokers."""
    feed = exit_feed(spark, sf).select(F.concat(F.col("codigo").cast("string"), F.lit(".0")).alias("Codigo"), F.col("situacao").alias("Situacao"), F.col("motivo").alias("Motivo"), F.col("data").alias("DataSaida"))
    facts = exit_feed(spark, sf).filter((F.col("codigo") % 2 == 0) & (F.dayofmonth("data") < 15)).select(F.col("codigo").cast("string").alias("Codigo"), F.col("data").alias("DataSaida"))
    orders = table(spark, sf, "orders")
    caps = orders.select(
        (F.col("o_custkey") % 150).cast("string").alias("Codigo"),
        F.col("o_orderpriority").alias("Captador1"),
        F.col("o_orderstatus").alias("Captador2"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("C3")).alias("Captador3"),
        F.concat(F.lit("G"), F.col("o_orderkey") % 5).alias("Gerente"),
        F.when(F.col("o_orderkey") % 11 > 0, F.col("o_orderdate").cast("date")).alias("DataEntrada"),
        "o_orderkey",
    )
    out = stock.exit_facts(feed, facts, caps, "o_orderkey", "1998-01-01")
    return out.withColumn("DataSaida", shown(F.col("DataSaida")))


def repaired_values(spark: SparkSession, sf: str) -> DataFrame:
    """Parts whose values are written in the ways that exports write them, repaired."""
    k = F.col("p_partkey")
    pick = lambda *texts: F.get(F.array(*[F.lit(x) for x in texts]), (k % len(texts)).cast("int"))
    value = F.when(k % 3 == 0, 0.0).when(k % 3 == 1, 7.5)
    words = pick("TRUE", " sim ", "não", "1", "Verdadeiro", None, "2")
    return table(spark, sf, "part").select(
        "p_partkey",
        rounded(numbers.per_area_if_missing(value, F.col("p_retailprice"), F.col("p_size") - 10)).alias("valor_m2"),
        numbers.number_or(pick("12", "1.5", "x", None)).alias("numero"),
        numbers.number_or(pick("12", "1.5", "x", None), -1.0).alias("numero_ou"),
        text.code(F.concat(k.cast("string"), pick(".0", ".00", " ", ".5", "A.0"))).alias("codigo"),
        text.is_true(words).alias("verdadeiro"),
        text.unquoted_upper(F.concat(F.lit("'"), pick("true", "False", "sim"))).alias("marca"),
        rooms_house(F.col("p_size") % 8 - 1, upper=True).alias("quartos"),
        sheet_serial(F.date_add(F.lit("1999-12-25").cast("date"), F.col("p_size"))).alias("dia"),
        in_file_name(F.concat(F.lit("base_"), pick("2025-03-01", "02_04_2025", "none"), F.lit(".csv"))).alias("data"),
    )


def sinks_back(spark: SparkSession, sf: str) -> DataFrame:
    """What each writer wrote, read again: delimited text, a limited append, two appends in a target's columns, flags with their lists, a table that was replaced."""
    base = folder(spark)
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("codigo"), F.col("p_brand").alias("marca"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_retailprice").cast("decimal(18,2)")).alias("preco"))
    sinks.to_csv(parts, f"{base}/csv", ";")
    for _ in range(2):
        sinks.append_limited(parts, f"{base}/primeiros", "codigo", 40)
        sinks.append_results(parts.drop("marca"), f"{base}/resultados", {"marca": "string", "codigo": "long", "preco": "double"})
    asked = parts.select(F.explode(F.array("codigo", -F.col("codigo"))).alias("codigo"))
    sinks.flags(stock.found_and_missing(asked, parts, "codigo"), f"{base}/marcas")
    for k in (1, 2):
        sinks.replace(parts.select((F.col("codigo") * k).alias("codigo")), f"{base}/tabela")
    read = {
        "csv": tables.csv_any(spark, f"{base}/csv").select("codigo", "marca", "preco"),
        "primeiros": tables.load(spark, f"{base}/primeiros", "csv").select("codigo", "marca", "preco"),
        "resultados": tables.load(spark, f"{base}/resultados", "parquet").select("codigo", "marca", "preco"),
        "todos": tables.csv(spark, f"{base}/marcas/todos", required=("codigo", "disponivel")).select("codigo", F.col("disponivel").alias("marca"), F.lit(None).alias("preco")),
        "disponiveis": tables.codes(tables.sheet(spark, f"{base}/marcas/disponiveis", ";"), "codigo").select("codigo", F.lit(None).alias("marca"), F.lit(None).alias("preco")),
        "indisponiveis": tables.codes(tables.sheet(spark, f"{base}/marcas/indisponiveis", ";"), "codigo").select("codigo", F.lit(None).alias("marca"), F.lit(None).alias("preco")),
        "tabela": sinks.current(spark, f"{base}/tabela", "codigo long").select("codigo", F.lit(None).alias("marca"), F.lit(None).alias("preco")),
    }
    out = None
    for name, df in read.items():
        part = df.select(F.lit(name).alias("destino"), F.col("codigo").cast("long").alias("codigo"), F.col("marca").cast("string").alias("marca"), F.col("preco").cast("double").alias("preco"))
        out = part if out is None else out.unionByName(part)
    return out


def lookup_names(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers with their district's id by name; every fifth is spelled in lower case, every seventh is unknown."""
    dim = table(spark, sf, "nation").select(F.concat(F.lit("B"), "n_nationkey").alias("id"), F.col("n_name").alias("nome"), F.col("n_nationkey").alias("ordem"))
    names = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    spelled = F.when(F.col("s_suppkey") % 7 == 0, F.lit("Não há")).when(F.col("s_suppkey") % 5 == 0, F.concat(F.lit("  "), F.lower("n_name"))).otherwise(F.col("n_name"))
    return stock.lookup(names.select("s_suppkey", spelled.alias("bairro")), dim, "bairro", "nome", "id", "ordem", "id_bairro", fallback=True)


def norm_text(spark: SparkSession, sf: str) -> DataFrame:
    """The digest of each document's folded text."""
    return table(spark, sf, "documents").select("doc_id", F.md5(text.fold(F.col("text"))).alias("digest"))


def parse_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Prices as texts in several spellings, read back, in each reader's way."""
    df = table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("p"), "l_linenumber")
    n = F.col("l_linenumber") % 4
    spelled = F.when(n == 0, F.concat(F.lit("R$ "), numbers.money(F.col("p")))).when(n == 1, F.replace(F.col("p").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))).when(n == 2, F.lit("-")).otherwise(F.col("p").cast("decimal(18,2)").cast("string"))
    df = df.select(n.alias("forma"), spelled.alias("t"))
    return df.groupBy("forma").agg(F.count(numbers.either_decimal(F.col("t"))).alias("lidos"), numbers.rounded(F.sum(numbers.either_decimal_or_zero(F.col("t"))), 2, 1e-4).alias("soma"), F.count(numbers.comma_decimal(F.col("t"))).alias("lidos_br"), F.sum(numbers.whole(numbers.either_decimal(F.col("t")).cast("string"))).alias("inteiros"))


def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates in several spellings, read back and shown."""
    n = F.col("o_orderkey") % 6
    day = F.col("o_orderdate")
    spelled = F.when(n == 5, F.lit("x"))
    for i, f in enumerate(("yyyy-MM-dd", "dd/MM/yyyy", "dd-MM-yyyy", "yyyy/MM/dd", "dd/MM/yyyy HH:mm")):
        spelled = spelled.when(n == i, F.date_format(day, f))
    return table(spark, sf, "orders").select("o_orderkey", shown(parsed(spelled)).alias("data"))


def address_compose(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    block = F.when(k % 3 == 0, "n/a").when(k % 3 == 1, F.substring("c_mktsegment", 1, 1))
    return table(spark, sf, "customer").select("c_custkey", text.address(F.when(k % 5 > 0, F.col("c_name")), F.when(k % 4 > 0, k.cast("string")), block, F.when(k % 2 == 0, F.lit(" nan "))).alias("endereco"))


def brokers_split(spark: SparkSession, sf: str) -> DataFrame:
    """Names of a product's words as lists with several separators."""
    listed = F.concat(F.replace("p_name", F.lit(" "), F.lit(" | ")), F.lit(";"), F.col("p_type"), F.lit(", /"), F.col("p_brand"), F.lit(";"), F.col("p_type"))
    df = table(spark, sf, "part").select("p_partkey", listed.alias("t"))
    a, b, c = text.three_names(F.col("t"))
    return df.select("p_partkey", F.array_join(text.names(F.col("t")), "+").alias("nomes"), text.joined_names(a, F.lit("nan"), c).alias("juntos"), b.alias("segundo"))


_FOLD = "trim(regexp_replace(translate(upper({c}), 'ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ', 'AAAAAEEEEIIIIOOOOOUUUUCN'), '[\\s\\x{{00A0}}]+', ' ', 'g'))"
_LEFT = "event_type <> 'view'"
_LATEST = "SELECT codigo, arg_max(o_orderkey, k) AS o_orderkey, arg_max(captador1, k) AS captador1 FROM (SELECT *, (coalesce(data, DATE '0001-01-01'), o_orderkey) AS k FROM c) GROUP BY codigo"
_CAPTURES = "c AS (SELECT o_orderkey, o_custkey % 150 AS codigo, o_orderpriority AS captador1, CASE WHEN o_orderkey % 11 > 0 THEN CAST(o_orderdate AS DATE) END AS data FROM orders)"
_CAPTURED = """e AS (
  SELECT o_orderkey AS k, (o_custkey % 900)::INTEGER AS codigo, CASE WHEN n_nationkey % 3 = 0 THEN 'NOVO ' || n_name ELSE n_name END AS bairro,
         round(o_totalprice, 2) AS valor, o_orderpriority AS p, o_orderdate AS d
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  WHERE o_orderkey % 13 > 0 AND o_orderkey % 5 > 0 AND (o_custkey % 900) IN (SELECT user_id * 3 FROM events)
), r AS (
  SELECT *, CASE WHEN p < '5' THEN 'T' || (CAST(p[1] AS INTEGER) + 5) ELSE '' END AS tipo, p >= '5' OR CAST(p[1] AS INTEGER) < 2 AS casa, k % 40 AS b1,
         CASE WHEN k % 4 > 0 THEN k % 7 END AS b2,
         CASE WHEN k % 3 > 0 THEN CAST(d AS DATE) WHEN k % 2 > 0 THEN CAST(d AS DATE) + 1 ELSE DATE '2001-01-01' END AS dia
  FROM e QUALIFY row_number() OVER (PARTITION BY codigo ORDER BY k DESC) = 1
)"""

QUERIES = {f.__name__: f for f in (exits_new, capture_latest, capture_append, dim_upsert, surrogate_keys, focus_flags, codes_missing, availability_flag, capture_listings, capture_facts, stock_snapshot, stock_standard, html_rows, html_nested, files_unlike, files_first_last, exit_fact, repaired_values, sinks_back, lookup_names, norm_text, parse_numbers, parse_dates, address_compose, brokers_split)}
ORACLE_SQL = {
    "exits_new": f"WITH {_CAPTURES}, l AS ({_LATEST}), e AS (SELECT event_id, user_id AS codigo, CAST(ts AS DATE) AS d, event_type AS motivo FROM events WHERE {_LEFT}), f AS (SELECT DISTINCT codigo, d FROM e WHERE codigo % 2 = 0 AND day(d) < 15) SELECT event_id, e.codigo, strftime(e.d, '%d/%m/%Y') AS data, motivo, coalesce(l.captador1, '') AS captador1 FROM e ANTI JOIN f ON e.codigo = f.codigo AND e.d = f.d LEFT JOIN l ON l.codigo = e.codigo",
    "capture_latest": f"WITH {_CAPTURES} {_LATEST}",
    "capture_append": f"WITH {_CAPTURES}, r AS (SELECT * FROM c WHERE data IS NOT NULL) SELECT DISTINCT codigo, data, captador1 FROM r WHERE o_orderkey % 3 = 0 OR o_orderkey % 2 = 0",
    "dim_upsert": "WITH p AS (SELECT p_partkey AS codigo, p_type AS tipo, p_retailprice AS valor FROM part), s AS (SELECT codigo + 100 AS codigo, tipo, valor * 2 AS valor FROM p WHERE codigo % 4 = 0) SELECT * FROM p WHERE codigo NOT IN (SELECT codigo FROM s) UNION ALL SELECT * FROM s",
    "surrogate_keys": "SELECT 'B' || (n_nationkey + 1) AS id, n_name AS nome FROM nation UNION ALL SELECT 'B' || ((SELECT count(*) FROM nation) + row_number() OVER (ORDER BY min(p_partkey))), p_brand FROM part GROUP BY p_brand",
    "focus_flags": f"WITH {LISTING} SELECT bairro, coalesce(n_nationkey % 3 = 0 AND preco >= 50000 AND l_tax * 100 >= 3.5 AND l_suppkey % 12 NOT IN (7, 8, 9, 10, 11), false) AS foco, count(*) AS n FROM listing JOIN nation ON bairro = n_name GROUP BY ALL",
    "codes_missing": "WITH c AS (SELECT c_custkey AS codigo FROM customer UNION SELECT -1 - c_custkey FROM customer) SELECT codigo, codigo IN (SELECT o_custkey FROM orders) AS achado FROM c",
    "capture_listings": f"WITH {_CAPTURED} SELECT p_partkey::INTEGER AS Codigo, 'T1' AS Tipo, p_retailprice AS Valor, false AS FocoPP, false AS FocoAC, 'NATION_0' AS NomeBairro FROM part WHERE p_partkey NOT IN (SELECT codigo FROM r) UNION ALL SELECT codigo, tipo, valor, coalesce(bairro IN ('NATION_1', 'NATION_2', 'NATION_4') AND valor >= 50000 AND k % 7 >= 3.5 AND casa, false), coalesce(bairro IN ('NATION_5', 'NOVO NATION_6') AND valor >= 90000 AND k % 7 >= 3.5 AND casa, false), bairro FROM r",
    "capture_facts": f"WITH {_CAPTURED}, c AS (SELECT * FROM supplier WHERE s_suppkey < 30), n AS (SELECT codigo AS Codigo, CASE WHEN x.s_suppkey IS NOT NULL THEN 'C' || b1 ELSE 'Broker ' || b1 END AS Captador1, CASE WHEN b2 IS NULL THEN '' WHEN y.s_suppkey IS NOT NULL THEN 'C' || b2 ELSE 'broker ' || b2 END AS Captador2, '' AS Captador3, coalesce('G' || x.s_nationkey, '') AS Gerente, dia AS DataEntrada FROM r LEFT JOIN c x ON x.s_suppkey = b1 LEFT JOIN c y ON y.s_suppkey = b2), f AS (SELECT (o_custkey % 900)::INTEGER AS Codigo, 'C' || (o_orderkey % 40) AS Captador1, '' AS Captador2, '' AS Captador3, '' AS Gerente, CAST(o_orderdate AS DATE) AS DataEntrada FROM orders WHERE o_orderkey % 11 = 0) SELECT * FROM f UNION ALL SELECT * FROM n ANTI JOIN f ON n.Codigo = f.Codigo AND n.DataEntrada = f.DataEntrada AND n.Captador1 = f.Captador1",
    "stock_snapshot": "SELECT CAST(p_partkey AS VARCHAR) AS Codigo, split_part(p_name, ' ', 1) AS Captador1, split_part(p_name, ' ', 2) AS Captador2, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END AS Captador3, '' AS Gerente, DATE '1998-01-01' AS DataEstoque FROM part WHERE p_partkey % 10 > 0",
    "stock_standard": "SELECT CASE WHEN p_partkey % 10 > 0 THEN ' ' || p_partkey ELSE ' nan' END AS Codigo, replace(p_name, ' ', ' | ') || CASE WHEN p_partkey % 2 = 0 THEN '|' || p_brand ELSE '' END AS Captadores, p_type AS Tipo, p_size AS NumeroQuarto, p_retailprice AS Valor, concat_ws(' ', p_brand, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey AS VARCHAR) END, CASE WHEN p_partkey % 4 = 1 THEN 'Bloco A' END) AS Endereco, 'N/D' AS Bairro, 'N/D' AS PublicacaoNaInternet, 'N/D' AS Exclusivo, 'N/D' AS AreaLote, 'N/D' AS AreaInterna FROM part",
    "repaired_values": """SELECT p_partkey, CASE WHEN p_partkey % 3 = 1 THEN 7.5 WHEN p_size > 10 THEN round(1e-7 + p_retailprice / (p_size - 10), 4) WHEN p_partkey % 3 = 0 THEN 0.0 END AS valor_m2,
      CAST(CASE p_partkey % 4 WHEN 0 THEN 12.0 WHEN 1 THEN 1.5 END AS DOUBLE) AS numero, CAST(CASE p_partkey % 4 WHEN 0 THEN 12.0 WHEN 1 THEN 1.5 ELSE -1.0 END AS DOUBLE) AS numero_ou,
      p_partkey || CASE p_partkey % 5 WHEN 3 THEN '.5' WHEN 4 THEN 'A.0' ELSE '' END AS codigo, p_partkey % 7 IN (0, 1, 3, 4) AS verdadeiro,
      CASE p_partkey % 3 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'FALSE' ELSE 'SIM' END AS marca, CASE WHEN p_size % 8 < 1 THEN NULL WHEN p_size % 8 <= 5 THEN 'ATÉ 4' ELSE '5 OU MAIS' END AS quartos,
      CAST(36519 + p_size AS INTEGER) AS dia, CASE p_partkey % 3 WHEN 0 THEN DATE '2025-03-01' WHEN 1 THEN DATE '2025-04-02' END AS data FROM part""",
    "sinks_back": """WITH p AS (SELECT p_partkey AS codigo, p_brand AS marca, CASE WHEN p_partkey % 2 = 0 THEN CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) END AS preco FROM part), f AS (FROM p ORDER BY codigo LIMIT 40)
      SELECT 'csv' AS destino, * FROM p UNION ALL SELECT 'primeiros', * FROM f UNION ALL SELECT 'primeiros', * FROM f
      UNION ALL SELECT 'resultados', codigo, '', coalesce(preco, 0) FROM p UNION ALL SELECT 'resultados', codigo, '', coalesce(preco, 0) FROM p
      UNION ALL SELECT DISTINCT 'todos', codigo, 'SIM', NULL FROM p UNION ALL SELECT DISTINCT 'todos', -codigo, CASE WHEN codigo = 0 THEN 'SIM' ELSE 'NAO' END, NULL FROM p WHERE codigo <> 0
      UNION ALL SELECT DISTINCT 'disponiveis', codigo, NULL, NULL FROM p UNION ALL SELECT DISTINCT 'indisponiveis', -codigo, NULL, NULL FROM p WHERE codigo <> 0
      UNION ALL SELECT 'tabela', codigo * 2, NULL, NULL FROM p""",
    "html_nested": "SELECT l_orderkey, 0 AS line, 'Qtde|Linha' AS cells FROM lineitem GROUP BY l_orderkey UNION ALL SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, CAST(l_quantity AS INTEGER) || ' ', l_returnflag), CAST(l_quantity AS INTEGER) || ' unab' || l_returnflag || ' fim|' || l_linenumber FROM lineitem",
    "files_unlike": """SELECT l_orderkey AS codigo, CAST(l_linenumber AS INTEGER) AS n, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS preco, 'Q "' || l_returnflag || '", x;y' AS quadra, CAST(NULL AS VARCHAR) AS cep, true AS na_ordem, true AS depois FROM lineitem""",
    "files_first_last": "SELECT l_orderkey AS codigo, CAST(min(l_linenumber) AS INTEGER) AS primeira, CAST(max(l_linenumber) AS INTEGER) AS ultima, count(*) AS n FROM lineitem GROUP BY l_orderkey",
    "exit_fact": "WITH f AS (SELECT CAST(user_id AS VARCHAR) AS c, user_id AS u, CAST(ts AS DATE) AS d, event_type AS t FROM events WHERE event_type <> 'view'), e AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS c, CAST(ts AS DATE) AS d FROM events WHERE user_id % 2 = 0 AND day(ts) < 15), k AS (SELECT CAST(o_custkey % 150 AS VARCHAR) AS c, arg_max(struct_pack(a := o_orderpriority, b := o_orderstatus, d := CASE WHEN o_orderkey % 3 = 0 THEN 'C3' ELSE '' END, g := 'G' || (o_orderkey % 5)), (CASE WHEN o_orderkey % 11 > 0 THEN CAST(o_orderdate AS DATE) ELSE DATE '0001-01-01' END, o_orderkey)) AS x FROM orders GROUP BY 1) SELECT f.c AS \"Codigo\", coalesce(x.a, '') AS \"Captador1\", coalesce(x.b, '') AS \"Captador2\", coalesce(x.d, '') AS \"Captador3\", coalesce(x.g, '') AS \"Gerente\", f.t AS \"Motivo\", strftime(f.d, '%d/%m/%Y') AS \"DataSaida\" FROM f LEFT JOIN k USING (c) WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.c = f.c AND e.d = f.d)",
    "html_rows": "SELECT c_custkey, 0 AS line, 'nome|saldo' AS cells FROM customer UNION ALL SELECT c_custkey, 1, c_name || '|' || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) FROM customer",
    "availability_flag": "SELECT user_id AS codigo, CASE WHEN bool_or(event_type = 'purchase' AND value > 90) THEN 'SIM' ELSE 'NAO' END AS disponivel FROM events GROUP BY user_id",
    "lookup_names": "SELECT s_suppkey, CASE WHEN s_suppkey % 7 = 0 THEN 'Não há' WHEN s_suppkey % 5 = 0 THEN '  ' || lower(n_name) ELSE n_name END AS bairro, CASE WHEN s_suppkey % 7 = 0 THEN 'Não há' ELSE 'B' || n_nationkey END AS id_bairro FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "norm_text": f"SELECT doc_id, md5({_FOLD.format(c="replace(coalesce(text, ''), 'ß', 'ss')")}) AS digest FROM documents",
    "parse_numbers": "SELECT l_linenumber % 4 AS forma, count_if(l_linenumber % 4 <> 2) AS lidos, round(1e-4 + sum(CASE WHEN l_linenumber % 4 = 2 THEN 0 ELSE l_extendedprice END), 2) AS soma, count_if(l_linenumber % 4 IN (1, 3)) AS lidos_br, sum(CASE WHEN l_linenumber % 4 <> 2 THEN CAST(floor(l_extendedprice) AS BIGINT) END)::BIGINT AS inteiros FROM lineitem GROUP BY 1",
    "parse_dates": "SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 5 THEN '' ELSE strftime(o_orderdate, '%d/%m/%Y') END AS data FROM orders",
    "address_compose": "SELECT c_custkey, coalesce(nullif(concat_ws(' ', CASE WHEN c_custkey % 5 > 0 THEN c_name END, CASE WHEN c_custkey % 4 > 0 THEN CAST(c_custkey AS VARCHAR) END, CASE WHEN c_custkey % 3 = 1 THEN 'Bloco ' || c_mktsegment[1] END), ''), 'N/D') AS endereco FROM customer",
    "brokers_split": "WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS n, p_type, p_brand FROM part) SELECT p_partkey, array_to_string((CASE WHEN n[1] = n[2] THEN [n[1], p_type, p_brand] ELSE [n[1], n[2], p_type] END), '+') AS nomes, n[1] AS juntos, n[2] || ';' || p_type || ', /' || p_brand || ';' || p_type AS segundo FROM w",
}

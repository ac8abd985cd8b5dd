"""Queries of the studies, the sales awards and the advertiser registries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessela.functions.numbers import rounded
from tessela.operators import awards, registry, studies
from tessela.plans.market import APARTMENT_SQL, HOUSE_SQL, ROOMS_APARTMENT_SQL, ROOMS_HOUSE_SQL
from tessela.plans.views import CONTRACT, LISTING, contract, managers, registries, valued

SELLERS, CAPTURERS = ["venda_1", "venda_2"], ["cap_1", "cap_2"]
PAYOUTS = [("VEND", "venda_1", "pago_v1"), ("VEND", "venda_2", "pago_v2"), ("CAP", "cap_1", "pago_c1"), ("CAP", "cap_2", "pago_c2")]
APARTMENT = studies.Study("America", "apt", "VENDA", cidade="AMERICA")
LEGACY = studies.Study("Europe", "apt-legacy", cidade="EUROPE")
HOUSE = studies.Study("Nation 3", "house", "VENDA", bairro="NATION_3")
STRICT = studies.Study("Publicado", "house-strict", "PUBLICADO")
SEVERAL = (studies.Study("Nation 7", "apt", "VENDA", bairro="NATION_7"), studies.Study("Nation 8", "apt-legacy", bairro="NATION_8"), studies.Study("Nation 3", "house", "VENDA", bairro="NATION_3", padrao="Luxo"), studies.Study("Nowhere", "house", "VENDA", bairro="NOWHERE"))
DAY = "1997-05-20"
#: The managers whose contracts are the special team's, the brokers who count for the other team, and the month of awards.
SPECIAL, EXCEPTIONS = ("MANAGER 2", "MANAGER 5"), ("BROKER 1", "BROKER 7")
MONTH = ("1997-05-01", "1997-05-31")


def _scaled(spark: SparkSession, sf: str, by: int) -> DataFrame:
    """Listings with areas times 5 (apartments) or 25 (houses), so that all bands occur."""
    return valued(spark, sf).select(*studies.LOOKED_AT).withColumn("area_util", F.col("area_util") * by)


def study_apt(spark: SparkSession, sf: str) -> DataFrame:
    return studies.groups(studies.selected(_scaled(spark, sf, 5), APARTMENT), APARTMENT, DAY)


def study_apt_legacy(spark: SparkSession, sf: str) -> DataFrame:
    return studies.groups(studies.selected(_scaled(spark, sf, 5), LEGACY), LEGACY, DAY)


def study_house(spark: SparkSession, sf: str) -> DataFrame:
    rows = studies.selected(_scaled(spark, sf, 25), HOUSE)
    return studies.with_pattern(studies.groups(rows, HOUSE, DAY), rows, "Luxo")


def study_house_strict(spark: SparkSession, sf: str) -> DataFrame:
    rows = studies.selected(_scaled(spark, sf, 25), STRICT, DAY)
    return studies.with_pattern(studies.groups(rows, STRICT, DAY), rows, "N/A", 60_000)


def study_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """The tiers of the house study: of each parking group the nine clusters with the least sum of squares, and three of these."""
    return studies.tier_rows(studies.selected(valued(spark, sf).select(*studies.LOOKED_AT), HOUSE), DAY)


def studies_all(spark: SparkSession, sf: str) -> DataFrame:
    """Several studies as one table, with tiers and patterns."""
    df = _scaled(spark, sf, 25).withColumn("padrao", F.when(F.col("quartos") % 2 == 0, "Alto").when(F.col("quartos") == 1, "Baixo").otherwise(" "))
    return studies.all_results(df, SEVERAL, DAY)


def study_pattern(spark: SparkSession, sf: str) -> DataFrame:
    """The usual offer and the single type of each district."""
    return valued(spark, sf).groupBy("bairro").agg(F.expr("mode(nullif(trim(oferta), ''), true)").alias("oferta"), studies.single_or_mixed("cidade").alias("cidade"), studies.single_or_mixed("tipo").alias("tipo"))


def _roles(spark: SparkSession, sf: str) -> DataFrame:
    df = contract(spark, sf).withColumn("equipe", awards.team(["gerente_venda", "gerente_captacao"], SPECIAL))
    return awards.role_rows(awards.sides(df, SELLERS, CAPTURERS), "valor", "comissao", ("contrato", "equipe"))


def rank_vgv(spark: SparkSession, sf: str) -> DataFrame:
    return awards.ranking(_roles(spark, sf)).select("lista", "nome", F.col("vgv").cast("double").alias("vgv"), F.col("pos_vgv").alias("pos"))


def rank_vgc(spark: SparkSession, sf: str) -> DataFrame:
    return awards.ranking(_roles(spark, sf)).select("lista", "nome", "vgc")


def rank_managers(spark: SparkSession, sf: str) -> DataFrame:
    df = awards.sides(contract(spark, sf), ["gerente_venda"], ["gerente_captacao"])
    return awards.ranking(awards.role_rows(df, "valor", "comissao")).select("lista", "nome", F.col("vgv").cast("double").alias("vgv"), "vgc")


def rank_sections(spark: SparkSession, sf: str) -> DataFrame:
    """The 22 tables of the report: by team, with two brokers who count for one team in any case, by all, and of managers."""
    roles = _roles(spark, sf).withColumn("equipe", awards.moved("equipe", "nome", EXCEPTIONS))
    roles = roles.select("lista", "nome", "vgv", "vgc", F.explode(F.array(F.concat(F.lit("CORRETORES_"), "equipe"), F.lit("CORRETORES_GERAL"))).alias("equipe"))
    bosses = awards.role_rows(awards.sides(contract(spark, sf), ["gerente_venda"], ["gerente_captacao"]), "valor", "comissao")
    bosses = bosses.select("lista", "nome", "vgv", "vgc", F.lit("GERENTES").alias("equipe"))
    out = awards.sections(awards.ranking(roles.unionByName(bosses), ("equipe", "lista")))
    return out.filter(~F.col("secao").isin("GERENTES_VGV_CAP", "GERENTES_VGV_VEND"))


def _managed(spark: SparkSession, sf: str) -> DataFrame:
    return awards.managed(contract(spark, sf), "contrato", "valor", "comissao", PAYOUTS, managers(spark, sf))


def manager_vgv_dim(spark: SparkSession, sf: str) -> DataFrame:
    detail = awards.manager_detail(_managed(spark, sf))
    return detail.groupBy("lista", "gerente").agg(rounded(F.sum("valor"), 2, 3e-6).alias("vgv"))


def manager_detail(spark: SparkSession, sf: str) -> DataFrame:
    return awards.manager_detail(_managed(spark, sf)).withColumn("valor", rounded("valor", 2, 3e-6))


def manager_vgc_dim(spark: SparkSession, sf: str) -> DataFrame:
    return awards.manager_commission(_managed(spark, sf))


def rank_month(spark: SparkSession, sf: str) -> DataFrame:
    """The rankings of a month's contracts, and of all the team's: the sum of both teams per name."""
    df = awards.in_month(contract(spark, sf), "data", *MONTH).withColumn("equipe", awards.team(["gerente_venda", "gerente_captacao"], SPECIAL))
    roles = awards.role_rows(awards.sides(df, SELLERS, CAPTURERS), "valor", "comissao", ("equipe",))
    of = lambda team: roles.filter(F.col("equipe") == team).groupBy("lista", "nome").agg(F.sum("vgv").alias("vgv"), F.sum("vgc").alias("vgc"))
    every = awards.combined(of(awards.SPECIAL), of(awards.OTHERS)).withColumn("equipe", F.lit("GERAL"))
    out = awards.ranking(roles.select("equipe", "lista", "nome", "vgv", "vgc").unionByName(every), ("equipe", "lista"))
    return out.select("equipe", "lista", "nome", F.col("vgv").cast("double").alias("vgv"), "vgc", "pos_vgv", "pos_vgc")


def _contract_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the list GERAL where every fifth contract shares its id with four others, and every seventh has none."""
    df = contract(spark, sf).withColumn("linha", F.col("contrato"))
    df = df.withColumn("contrato", F.when(F.col("linha") % 7 == 0, F.lit(" ")).when(F.col("linha") % 5 == 0, F.concat(F.lit(" C"), F.floor(F.col("linha") / 25))).otherwise(F.col("linha").cast("string")))
    df = df.withColumn("comissao", F.when(F.col("linha") % 11 > 0, F.col("comissao")).otherwise(F.lit(0).cast("decimal(18,4)")))
    df = awards.sides(awards.with_contract_id(df, "contrato", "linha"), SELLERS, CAPTURERS)
    return awards.role_rows(df, "valor", "comissao", ("contrato", "linha")).filter("lista = 'GERAL'")


def broker_contracts(spark: SparkSession, sf: str) -> DataFrame:
    """Each broker's totals, with the whole list as text."""
    out = awards.broker_contracts(_contract_rows(spark, sf), "linha")
    line = lambda c: F.concat_ws(":", c["contrato"], c["valor"].cast("string"), F.format_number(c["comissao"], 2))
    return out.select("corretor", F.col("vgv").cast("double").alias("vgv"), "vgc", F.size("contratos").alias("n_contratos"), F.concat_ws("|", F.transform("contratos", line)).alias("contratos"))


def contract_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The same lists as rows."""
    return awards.contract_lines(_contract_rows(spark, sf), "linha").select("corretor", "contrato", F.col("valor").cast("double").alias("valor"), rounded("vgc", 2, 3e-6).alias("comissao"))


def _consolidated(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    a, b = map(registry.normalised, registries(spark, sf))
    return a, b, registry.compared(registry.by_licence(a), registry.by_licence(b))


def registry_compare(spark: SparkSession, sf: str) -> DataFrame:
    return _consolidated(spark, sf)[2]


def registry_invalid(spark: SparkSession, sf: str) -> DataFrame:
    """Of both registries, those with most listings first."""
    a, b, _ = _consolidated(spark, sf)
    side = lambda df, name: registry.invalid(df).withColumn("origem", F.lit(name))
    return side(a, "A").unionByName(side(b, "B"))


def registry_totals(spark: SparkSession, sf: str) -> DataFrame:
    return registry.totals(*_consolidated(spark, sf))


def registry_report(spark: SparkSession, sf: str) -> DataFrame:
    """The report's five tables as one: the licences of either registry alone, those of both, and the invalid ones of each; those with most listings first."""
    a, b, both = _consolidated(spark, sf)
    out = None
    for name, df, order in (
        ("APENAS_A", both.filter("origem = 'A'").select("creci", F.col("anunciante_a").alias("anunciante"), F.col("anuncios_a").alias("anuncios")), "creci"),
        ("APENAS_B", both.filter("origem = 'B'").select("creci", F.col("anunciante_b").alias("anunciante"), F.col("anuncios_b").alias("anuncios")), "creci"),
        ("AMBOS", both.filter("origem = 'AMBOS'").select("creci", F.col("anunciante_a").alias("anunciante"), (F.col("anuncios_a") + F.col("anuncios_b")).alias("anuncios")), "creci"),
        ("INVALIDOS_A", registry.invalid(a).select(F.lit("-").alias("creci"), "anunciante", "anuncios"), "anunciante"),
        ("INVALIDOS_B", registry.invalid(b).select(F.lit("-").alias("creci"), "anunciante", "anuncios"), "anunciante"),
    ):
        part = registry.shown(df, [("anuncios", True), (order, False)]).withColumn("tabela", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def _kept_sql(where: str, value: str) -> str:
    return f"WITH {LISTING}, chosen AS (SELECT *, {value} AS valor, CASE WHEN vagas > 0 THEN 'Com Vaga' ELSE 'Sem Vaga' END AS vaga FROM valued v WHERE {where}), q AS (SELECT *, quantile_cont(valor, 0.25) OVER w AS q1, quantile_cont(valor, 0.75) OVER w AS q3 FROM chosen WINDOW w AS (PARTITION BY vaga)), kept AS (SELECT * FROM q WHERE q3 = q1 OR valor BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))"


def _study_sql(where: str, value: str, keys: list[tuple[str, str, str]], zero: list[str], pattern: str = "", drop: str = "") -> str:
    """``keys``: prefix, value and what stands for a missing one; ``zero``: names that are listed in any case."""
    parts = " UNION ALL ".join(f"SELECT '{p}' || coalesce({c}, '{m}') AS nome, vaga, round(1e-7 + avg(valor), 4) AS valor, count(*) AS amostra FROM kept GROUP BY 1, 2" for p, c, m in keys)
    listed = ", ".join(f"('{z}')" for z in zero)
    return (
        f"{_kept_sql(where, value)}, parts AS ({parts}), "
        f"every AS (SELECT * FROM parts{drop} UNION ALL SELECT z.nome, v.vaga, NULL, 0 FROM (SELECT DISTINCT vaga FROM kept) v CROSS JOIN (VALUES {listed}) z(nome)) SELECT nome, vaga, max(valor) AS valor, CAST(sum(amostra) AS BIGINT) AS amostra, DATE '{DAY}' AS data{pattern} FROM every GROUP BY nome, vaga"
    )


def _tiers_sql(where: str, value: str, pattern: str = "", k: int = 9) -> str:
    """The best ``k`` clusters by the number of clusters and the value that the last one ends with, and three of them."""
    sql = f"""{_kept_sql(where, value)}, vc AS (
  SELECT vaga, valor AS v, count(*) AS n, row_number() OVER (PARTITION BY vaga ORDER BY valor) AS j FROM kept GROUP BY vaga, valor
), x AS (SELECT *, v - sum(n * v) OVER (PARTITION BY vaga) / sum(n) OVER (PARTITION BY vaga) AS c FROM vc
), s AS MATERIALIZED (
  SELECT vaga, j, sum(n) OVER w AS w, sum(n * c) OVER w AS s, sum(n * c * c) OVER w AS q FROM x WINDOW w AS (PARTITION BY vaga ORDER BY j)
), p1 AS MATERIALIZED (SELECT vaga, j, q - s * s / w AS d, 0 AS i FROM s)"""
    for m in range(2, k + 1):
        sql += f"""
, p{m} AS MATERIALIZED (
  SELECT b.vaga, b.j, min(p.d + b.q - a.q - (b.s - a.s) * (b.s - a.s) / (b.w - a.w)) AS d, arg_min(a.j, p.d + b.q - a.q - (b.s - a.s) * (b.s - a.s) / (b.w - a.w)) AS i
  FROM p{m - 1} p JOIN s a ON a.vaga = p.vaga AND a.j = p.j JOIN s b ON b.vaga = a.vaga AND b.j > a.j GROUP BY b.vaga, b.j
)"""
    sql += f"\n, e{k} AS (SELECT vaga, max(j) AS j FROM s GROUP BY vaga HAVING max(w) >= 9)"
    for m in range(k, 1, -1):
        sql += f", e{m - 1} AS (SELECT e.vaga, p.i AS j FROM e{m} e JOIN p{m} p USING (vaga, j))"
    ends = " UNION ALL ".join(f"SELECT vaga, j, {m} AS cluster FROM e{m}" for m in range(1, k + 1))
    return (
        sql
        + f""", ends AS ({ends}), cl AS (SELECT vaga, cluster, j AS hi, coalesce(lag(j) OVER (PARTITION BY vaga ORDER BY cluster), 0) AS lo FROM ends
), m AS (SELECT cl.vaga, cluster, sum(n * v) / sum(n) AS media, CAST(sum(n) AS BIGINT) AS amostra FROM cl JOIN vc ON vc.vaga = cl.vaga AND vc.j > lo AND vc.j <= hi GROUP BY ALL
), r AS (SELECT *, cluster AS r, CAST({k} AS BIGINT) AS k FROM m
), c AS (SELECT *, max(CASE WHEN r = k // 2 + 1 THEN media END) OVER (PARTITION BY vaga) AS mid FROM r
), t AS (SELECT *, coalesce(max(CASE WHEN r < k // 2 + 1 AND media <= 0.9 * mid THEN r END) OVER (PARTITION BY vaga), 1) AS lo, coalesce(min(CASE WHEN r > k // 2 + 1 AND media >= 1.1 * mid THEN r END) OVER (PARTITION BY vaga), k) AS hi FROM c)
SELECT CASE WHEN r = hi THEN '03 - Reformado' WHEN r = k // 2 + 1 THEN '02 - Semi-Reformado' ELSE '01 - Original' END AS nome, vaga, round(1e-7 + media, 4) AS valor, amostra, DATE '{DAY}' AS data{pattern} FROM t WHERE r IN (lo, hi, k // 2 + 1)"""
    )


_ZERO_APARTMENT = [f"Metragem {x}" for x in ("<50", "50-75", "75-90", "90-130", "130-160", "160-200", ">200")] + [f"Quartos {x}" for x in ("1", "2", "3", "4", "+5")]
_ZERO_HOUSE = [f"Metragem {x}" for x in ("<400", "400-600", "600-800", "800-1000", ">1000")] + ["Quartos Até 4", "Quartos 5 ou mais"]
_APARTMENT_KEYS = [("Metragem ", APARTMENT_SQL.format(c="(area_util * 5)"), "nan"), ("Quartos ", ROOMS_APARTMENT_SQL, "nan"), ("Bairro ", "bairro", "<NA>"), ("Quadra ", "upper(quadra)", "<NA>")]
_LEGACY_KEYS = [_APARTMENT_KEYS[0], ("Quartos ", f"CASE WHEN quartos > 0 THEN {ROOMS_APARTMENT_SQL} END", "nan"), *_APARTMENT_KEYS[2:]]
_HOUSE_KEYS = [("Metragem ", HOUSE_SQL.format(c="(area_util * 25)"), "Sem Faixa"), ("Quartos ", ROOMS_HOUSE_SQL, "Sem Faixa"), ("Bairro ", "bairro", "Sem Bairro")]
_POSTCODE = ("CEP ", "cep", "<NA>")
_PATTERN = ", (SELECT CASE WHEN min(valor) >= 60000 THEN 'Alto Padrão' WHEN max(valor) < 60000 THEN 'Padrão' ELSE 'Misto' END FROM kept k WHERE k.vaga = every.vaga) AS padrao"


_HOUSE_WHERE = "bairro = 'NATION_3' AND (oferta = 'VENDA' OR (vagas > 0) NOT IN (SELECT vagas > 0 FROM valued WHERE bairro = 'NATION_3' AND oferta = 'VENDA'))"
_USUAL = ", (SELECT p FROM (SELECT CASE WHEN quartos % 2 = 0 THEN 'Alto' WHEN quartos = 1 THEN 'Baixo' END AS p, count(*) AS n FROM kept GROUP BY 1) WHERE p IS NOT NULL ORDER BY n DESC, p LIMIT 1) AS padrao"
_NONE = ", CAST(NULL AS VARCHAR) AS padrao"
_AT_25 = ("Metragem ", APARTMENT_SQL.format(c="(area_util * 25)"), "nan")
_BLOCK = ("Quadra ", "upper(quadra)", "Sem Quadra")


def _several_sql() -> str:
    apt, legacy = ("bairro = 'NATION_7' AND oferta IN ('VENDA', 'PUBLICADO')", "valor_m2"), ("bairro = 'NATION_8'", "valor_m2")
    parts = (
        ("Nation 7 (apt)", _tiers_sql(*apt, _NONE), _study_sql(*apt, [_AT_25, *_APARTMENT_KEYS[1:], _POSTCODE], _ZERO_APARTMENT, _NONE)),
        ("Nation 8 (apt-legacy)", _tiers_sql(*legacy, _NONE), _study_sql(*legacy, [_AT_25, *_LEGACY_KEYS[1:]], _ZERO_APARTMENT, _NONE, drop=" WHERE nome NOT IN ('Bairro <NA>', 'Quadra <NA>')")),
        ("Nation 3 (house)", _tiers_sql(_HOUSE_WHERE, "preco", _USUAL), _study_sql(_HOUSE_WHERE, "preco", [*_HOUSE_KEYS, _BLOCK], _ZERO_HOUSE, _USUAL)),
    )
    return " UNION ALL ".join(f"SELECT *, '{name}' AS estudo FROM ({sql})" for name, *both in parts for sql in both)


_ROLES = f"""WITH {CONTRACT}, s AS (
  SELECT *, CASE WHEN venda_2 IS NULL THEN [venda_1] ELSE [venda_1, venda_2] END AS vend,
         CASE WHEN cap_2 IS NULL THEN [cap_1] ELSE [cap_1, cap_2] END AS cap,
         CASE WHEN gerente_venda LIKE '%MANAGER 2%' OR gerente_venda LIKE '%MANAGER 5%' OR gerente_captacao LIKE '%MANAGER 2%' OR gerente_captacao LIKE '%MANAGER 5%' THEN 'AC' ELSE 'PP' END AS equipe
  FROM contract
), side AS (
  SELECT contrato, equipe, 'CAP' AS lista, unnest(cap) AS nome, valor AS vgv, comissao / 2.0 / len(cap) AS vgc FROM s
  UNION ALL SELECT contrato, equipe, 'VEND', unnest(vend), valor, comissao / 2.0 / len(vend) FROM s
), roles AS (
  SELECT * FROM side UNION ALL SELECT contrato, any_value(equipe), 'GERAL', nome, any_value(vgv), sum(vgc) FROM side GROUP BY contrato, nome
)"""
_LINES = f"""WITH {CONTRACT}, c AS (
  SELECT contrato AS linha, valor, CASE WHEN contrato % 11 > 0 THEN comissao ELSE 0 END AS comissao, venda_1, venda_2, cap_1, cap_2,
         CASE WHEN contrato % 7 = 0 THEN 'Contrato_' || contrato WHEN contrato % 5 = 0 THEN 'C' || (contrato // 25) ELSE CAST(contrato AS VARCHAR) END AS id
  FROM contract
), v AS (SELECT linha, unnest(list_distinct([venda_1, coalesce(venda_2, venda_1)])) AS corretor, comissao / 2.0 / len(list_distinct([venda_1, coalesce(venda_2, venda_1)])) AS vgc FROM c
), k AS (SELECT linha, unnest(list_distinct([cap_1, coalesce(cap_2, cap_1)])) AS corretor, comissao / 2.0 / len(list_distinct([cap_1, coalesce(cap_2, cap_1)])) AS vgc FROM c
), r AS (SELECT linha, corretor, sum(vgc) AS vgc FROM (FROM v UNION ALL FROM k) GROUP BY ALL
), sums AS (SELECT corretor, sum(valor) AS vgv, sum(vgc) AS vgc FROM r JOIN c USING (linha) GROUP BY corretor
), lines_of AS (
  SELECT corretor, id AS contrato, arg_min(valor, linha) AS valor, sum(vgc) AS comissao, min(linha) AS linha FROM r JOIN c USING (linha) WHERE vgc > 0 GROUP BY corretor, id
)"""
_MANAGED = f"""WITH {CONTRACT}, paid AS (
  SELECT contrato, valor, comissao, 'VEND' AS lado, venda_1 AS corretor FROM contract WHERE pago_v1 > 0
  UNION SELECT contrato, valor, comissao, 'VEND', venda_2 FROM contract WHERE pago_v2 > 0
  UNION SELECT contrato, valor, comissao, 'CAP', cap_1 FROM contract WHERE pago_c1 > 0
  UNION SELECT contrato, valor, comissao, 'CAP', cap_2 FROM contract WHERE pago_c2 > 0
), m AS (SELECT paid.*, gerente FROM paid JOIN managers USING (corretor)
), listed AS (
  SELECT contrato, valor, lado, gerente, corretor FROM m
  UNION ALL SELECT DISTINCT contrato, valor, 'GERAL', gerente, corretor FROM m
), detail AS (
  SELECT lado AS lista, gerente, corretor, sum(CAST(valor AS DOUBLE) / k) AS valor
  FROM (SELECT *, count(*) OVER (PARTITION BY contrato, lado, gerente) AS k FROM listed) GROUP BY ALL
)"""
_REGISTRY = """WITH a0 AS (
  SELECT c_custkey AS codigo, CAST(c_custkey AS VARCHAR) AS creci, CASE WHEN c_custkey % 9 > 0 THEN c_name END AS anunciante FROM customer
), b0 AS (
  SELECT s_suppkey AS codigo, CAST(s_suppkey + (SELECT count(*) FROM customer) - (SELECT count(*) FROM supplier) // 2 AS VARCHAR) AS creci, s_name AS anunciante FROM supplier
), a AS (SELECT creci, arg_min(anunciante, codigo) FILTER (anunciante IS NOT NULL) AS anunciante_a, count(DISTINCT codigo) AS anuncios_a FROM a0 WHERE length(creci) >= 4 GROUP BY creci
), b AS (SELECT creci, arg_min(anunciante, codigo) FILTER (anunciante IS NOT NULL) AS anunciante_b, count(DISTINCT codigo) AS anuncios_b FROM b0 WHERE length(creci) >= 4 GROUP BY creci
), f AS (
  SELECT coalesce(a.creci, b.creci) AS creci, anunciante_a, anuncios_a, anunciante_b, anuncios_b,
         CASE WHEN b.creci IS NULL THEN 'A' WHEN a.creci IS NULL THEN 'B' ELSE 'AMBOS' END AS origem
  FROM a FULL JOIN b ON a.creci = b.creci
)"""

QUERIES = {f.__name__: f for f in (study_apt, study_apt_legacy, study_house, study_house_strict, study_tiers, studies_all, study_pattern, rank_vgv, rank_vgc, rank_managers, rank_sections, rank_month, manager_vgv_dim, manager_detail, manager_vgc_dim, broker_contracts, contract_lines, registry_compare, registry_invalid, registry_totals, registry_report)}
ORACLE_SQL = {
    "study_apt": _study_sql("cidade = 'AMERICA' AND oferta IN ('VENDA', 'PUBLICADO')", "valor_m2", [*_APARTMENT_KEYS, _POSTCODE], _ZERO_APARTMENT),
    "study_apt_legacy": _study_sql("cidade = 'EUROPE'", "valor_m2", _LEGACY_KEYS, _ZERO_APARTMENT, drop=" WHERE nome NOT IN ('Bairro <NA>', 'Quadra <NA>')"),
    "study_house": _study_sql(_HOUSE_WHERE, "preco", [*_HOUSE_KEYS, _BLOCK], _ZERO_HOUSE, ", 'Luxo' AS padrao"),
    "study_house_strict": _study_sql(f"oferta = 'PUBLICADO' AND data_coleta = DATE '{DAY}'", "preco", [*_HOUSE_KEYS, ("Quadra ", "quadra", "Sem Quadra"), ("Cidade ", "cidade", "Sem Cidade"), ("CEP ", "cep", "Sem CEP")], _ZERO_HOUSE, _PATTERN),
    "study_tiers": _tiers_sql(_HOUSE_WHERE, "preco"),
    "studies_all": _several_sql(),
    "study_pattern": f"WITH {LISTING}, c AS (SELECT bairro, oferta, count(*) AS n FROM valued GROUP BY ALL), o AS (SELECT bairro, oferta FROM c QUALIFY row_number() OVER (PARTITION BY bairro ORDER BY n DESC, oferta) = 1) SELECT bairro, any_value(o.oferta) AS oferta, CASE WHEN count(DISTINCT cidade) = 1 THEN max(cidade) ELSE 'Misto' END AS cidade, CASE WHEN count(DISTINCT tipo) = 1 THEN max(tipo) ELSE 'Misto' END AS tipo FROM valued JOIN o USING (bairro) GROUP BY bairro",
    "rank_vgv": f"{_ROLES} SELECT lista, nome, CAST(sum(vgv) AS DOUBLE) AS vgv, row_number() OVER (PARTITION BY lista ORDER BY sum(vgv) DESC, nome) AS pos FROM roles GROUP BY lista, nome",
    "rank_vgc": f"{_ROLES} SELECT lista, nome, round(3e-6 + sum(vgc), 2) AS vgc FROM roles GROUP BY lista, nome",
    "rank_managers": f"WITH {CONTRACT}, x AS (SELECT contrato, valor, comissao / CASE WHEN gerente_captacao = '-' THEN 1.0 ELSE 2.0 END AS parte, gerente_venda AS v, nullif(gerente_captacao, '-') AS c FROM contract), side AS (SELECT contrato, 'VEND' AS lista, v AS nome, valor AS vgv, parte AS vgc FROM x UNION ALL SELECT contrato, 'CAP', c, valor, parte FROM x WHERE c IS NOT NULL), roles AS (SELECT * FROM side UNION ALL SELECT contrato, 'GERAL', nome, any_value(vgv), sum(vgc) FROM side GROUP BY contrato, nome) SELECT lista, nome, CAST(sum(vgv) AS DOUBLE) AS vgv, round(3e-6 + sum(vgc), 2) AS vgc FROM roles GROUP BY lista, nome",
    "rank_sections": f"{_ROLES}, moved AS (SELECT 'CORRETORES_' || CASE WHEN nome IN ('BROKER 1', 'BROKER 7') THEN 'PP' ELSE equipe END AS equipe, lista, nome, vgv, vgc FROM roles), boss AS (SELECT contrato, valor, comissao / CASE WHEN gerente_captacao = '-' THEN 1.0 ELSE 2.0 END AS parte, gerente_venda AS v, nullif(gerente_captacao, '-') AS c FROM contract), bs AS (SELECT contrato, 'VEND' AS lista, v AS nome, valor AS vgv, parte AS vgc FROM boss UNION ALL SELECT contrato, 'CAP', c, valor, parte FROM boss WHERE c IS NOT NULL), br AS (SELECT lista, nome, vgv, vgc FROM bs UNION ALL SELECT 'GERAL', nome, any_value(vgv), sum(vgc) FROM bs GROUP BY contrato, nome), alle AS (SELECT * FROM moved UNION ALL SELECT 'CORRETORES_GERAL', lista, nome, vgv, vgc FROM moved UNION ALL SELECT 'GERENTES', * FROM br), t AS (SELECT equipe, lista, nome, CAST(sum(vgv) AS DOUBLE) AS g, round(3e-6 + sum(vgc), 2) AS c FROM alle GROUP BY ALL), l AS (SELECT equipe || '_VGV_' || lista AS secao, nome, g AS v FROM t UNION ALL SELECT equipe || '_VGC_' || lista, nome, c FROM t), p AS (SELECT *, row_number() OVER (PARTITION BY secao ORDER BY v DESC, nome) AS pos FROM l) SELECT secao, pos, nome, round(1e-7 + v, 2) AS valor FROM p WHERE pos <= 30 AND secao NOT IN ('GERENTES_VGV_CAP', 'GERENTES_VGV_VEND')",
    "manager_vgv_dim": f"{_MANAGED} SELECT lista, gerente, round(3e-6 + sum(valor), 2) AS vgv FROM detail GROUP BY ALL",
    "manager_detail": f"{_MANAGED} SELECT lista, gerente, corretor, round(3e-6 + valor, 2) AS valor FROM detail",
    "manager_vgc_dim": f"{_MANAGED}, one AS (SELECT DISTINCT contrato, comissao, lado, gerente FROM m), k AS (SELECT *, count(*) OVER (PARTITION BY contrato, lado) AS n FROM one), z AS (SELECT k.*, (SELECT count(DISTINCT lado) FROM one o WHERE o.contrato = k.contrato) AS lados FROM k), e AS (SELECT gerente, lado AS lista, CAST(comissao AS DOUBLE) / lados / n AS vgc FROM z) SELECT lista, gerente, round(3e-6 + sum(vgc), 2) AS vgc FROM (SELECT * FROM e UNION ALL SELECT gerente, 'GERAL', vgc FROM e) GROUP BY lista, gerente",
    "rank_month": f"{_ROLES}, mes AS (SELECT roles.* FROM roles JOIN contract USING (contrato) WHERE data >= DATE '{MONTH[0]}' AND data <= DATE '{MONTH[1]}'), t AS (SELECT equipe, lista, nome, vgv, vgc FROM mes UNION ALL SELECT 'GERAL', lista, nome, vgv, vgc FROM mes), z AS (SELECT equipe, lista, nome, CAST(sum(vgv) AS DOUBLE) AS vgv, round(3e-6 + sum(vgc), 2) AS vgc FROM t GROUP BY ALL) SELECT *, row_number() OVER (PARTITION BY equipe, lista ORDER BY vgv DESC, nome) AS pos_vgv, row_number() OVER (PARTITION BY equipe, lista ORDER BY vgc DESC, nome) AS pos_vgc FROM z",
    "broker_contracts": f"{_LINES} SELECT corretor, CAST(any_value(vgv) AS DOUBLE) AS vgv, round(3e-6 + any_value(vgc), 2) AS vgc, count(contrato) AS n_contratos, coalesce(string_agg(contrato || ':' || valor || ':' || format('{{:,.2f}}', floor((comissao + 3e-6) * 100 + 0.5) / 100), '|' ORDER BY linha), '') AS contratos FROM sums LEFT JOIN lines_of USING (corretor) GROUP BY corretor",
    "contract_lines": f"{_LINES} SELECT corretor, contrato, CAST(valor AS DOUBLE) AS valor, round(3e-6 + comissao, 2) AS comissao FROM lines_of",
    "registry_compare": f"{_REGISTRY} SELECT * FROM f",
    "registry_invalid": f"{_REGISTRY} SELECT 'A' AS origem, anunciante, count(DISTINCT codigo) AS anuncios, count(*) AS linhas FROM a0 WHERE length(creci) < 4 GROUP BY anunciante UNION ALL SELECT 'B', anunciante, count(DISTINCT codigo), count(*) FROM b0 WHERE length(creci) < 4 GROUP BY anunciante",
    "registry_report": f"{_REGISTRY}, t AS (SELECT 'APENAS_A' AS tabela, creci, anunciante_a AS anunciante, anuncios_a AS anuncios, creci AS k FROM f WHERE origem = 'A' UNION ALL SELECT 'APENAS_B', creci, anunciante_b, anuncios_b, creci FROM f WHERE origem = 'B' UNION ALL SELECT 'AMBOS', creci, anunciante_a, anuncios_a + anuncios_b, creci FROM f WHERE origem = 'AMBOS' UNION ALL SELECT 'INVALIDOS_A', '-', anunciante, count(DISTINCT codigo), anunciante FROM a0 WHERE length(creci) < 4 GROUP BY anunciante UNION ALL SELECT 'INVALIDOS_B', '-', anunciante, count(DISTINCT codigo), anunciante FROM b0 WHERE length(creci) < 4 GROUP BY anunciante), o AS (SELECT *, row_number() OVER (PARTITION BY tabela ORDER BY anuncios DESC, k NULLS LAST) AS linha FROM t) SELECT tabela, linha, creci, anunciante, CAST(anuncios AS VARCHAR) AS anuncios FROM o WHERE linha <= 40 UNION ALL SELECT tabela, 41, '... total de ' || count(*) || ' registros. Exibindo apenas os primeiros 40.', '', '' FROM o GROUP BY tabela HAVING count(*) > 40",
    "registry_totals": f"{_REGISTRY} SELECT 'linhas_a' AS medida, count(*) AS total FROM a0 UNION ALL SELECT 'validas_a', coalesce(count_if(length(creci) >= 4), 0) FROM a0 UNION ALL SELECT 'invalidas_a', coalesce(count_if(length(creci) < 4), 0) FROM a0 UNION ALL SELECT 'linhas_b', count(*) FROM b0 UNION ALL SELECT 'validas_b', coalesce(count_if(length(creci) >= 4), 0) FROM b0 UNION ALL SELECT 'invalidas_b', coalesce(count_if(length(creci) < 4), 0) FROM b0 UNION ALL SELECT 'creci_a', coalesce(count_if(origem = 'A'), 0) FROM f UNION ALL SELECT 'creci_b', coalesce(count_if(origem = 'B'), 0) FROM f UNION ALL SELECT 'creci_ambos', coalesce(count_if(origem = 'AMBOS'), 0) FROM f",
}

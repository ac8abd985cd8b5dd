"""Rankings of brokers and managers by sales value and shared commission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessela.functions.dates import in_period, parsed
from tessela.functions.numbers import rounded
from tessela.functions.text import person


def sides(df: DataFrame, sellers: list[str], capturers: list[str]) -> DataFrame:
    """Adds ``vend`` and ``cap``: the distinct names of each side, placeholders left out."""
    distinct = lambda cols: F.array_distinct(F.filter(F.array(*[person(F.col(c)) for c in cols]), lambda x: x != ""))
    return df.withColumn("vend", distinct(sellers)).withColumn("cap", distinct(capturers))


def role_rows(df: DataFrame, value: str, commission: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per contract, list (CAP, VEND, GERAL) and person: ``vgv`` in full, ``vgc`` as the person's share.

    The commission is halved between the sides that have someone and split equally within a side; in GERAL a
    person on both sides counts once for the value and has both shares of the commission.
    """
    both = (F.size("cap") > 0) & (F.size("vend") > 0)
    part = F.col(commission).cast("double") * F.when(both, 0.5).otherwise(1.0)
    share = lambda side: F.try_divide(part, F.size(side))
    general = F.transform(
        F.array_union("cap", "vend"),
        lambda p: F.struct(
            F.lit("GERAL").alias("lista"),
            p.alias("nome"),
            (F.when(F.array_contains("cap", p), share("cap")).otherwise(0.0) + F.when(F.array_contains("vend", p), share("vend")).otherwise(0.0)).alias("vgc"),
        ),
    )
    one = lambda name, side: F.transform(side, lambda p: F.struct(F.lit(name).alias("lista"), p.alias("nome"), share(side).alias("vgc")))
    rows = F.concat(one("CAP", "cap"), one("VEND", "vend"), general)
    return df.select(*keep, F.col(value).alias("vgv"), F.explode(rows).alias("r")).select(*keep, "r.lista", "r.nome", "vgv", "r.vgc")


def ranking(roles: DataFrame, by: tuple[str, ...] = ("lista",), top: int | None = None) -> DataFrame:
    """Sums per person with places by value and by commission; names break ties."""
    sums = roles.groupBy(*by, "nome").agg(F.sum(F.col("vgv").cast("decimal(18,2)")).alias("vgv"), rounded(F.sum("vgc"), 2, 3e-6).alias("vgc"))
    place = lambda c: F.row_number().over(Window.partitionBy(*by).orderBy(F.col(c).desc(), F.col("nome")))
    out = sums.withColumn("pos_vgv", place("vgv")).withColumn("pos_vgc", place("vgc"))
    return out if top is None else out.filter((F.col("pos_vgv") <= top) | (F.col("pos_vgc") <= top))


#: The team of the contracts of special managers, and the team of all others.
SPECIAL, OTHERS = "AC", "PP"


def team(manager_columns: list[str], tokens: tuple[str, ...], inside: str = SPECIAL, outside: str = OTHERS) -> Column:
    """The team of a contract: ``inside`` if a token is part of one of its managers' names."""
    found = F.lit(False)
    for c in manager_columns:
        for t in tokens:
            found = found | F.contains(person(F.col(c)), F.lit(t))
    return F.when(found, inside).otherwise(outside)


def moved(team_column: str, name: str, exceptions: tuple[str, ...], to: str = OTHERS) -> Column:
    """People whose sums in the special team go to the other one, so that they have a place in that alone."""
    return F.when(F.col(name).isin(*exceptions), to).otherwise(F.col(team_column))


def sections(rank: DataFrame, top: int = 30) -> DataFrame:
    """The report's tables as one: a section per list (and team) and measure, with places from 1."""
    long = rank.select("equipe", "lista", "nome", F.expr("stack(2, 'VGV', cast(vgv as double), 'VGC', vgc) as (medida, valor)"))
    section = F.concat_ws("_", "equipe", "medida", "lista")
    pos = F.row_number().over(Window.partitionBy("equipe", "medida", "lista").orderBy(F.col("valor").desc(), F.col("nome")))
    return long.withColumn("pos", pos).filter(F.col("pos") <= top).select(section.alias("secao"), "pos", "nome", rounded("valor", 2).alias("valor"))


#: Entries of managers that go along with the contracts' rows.
CARRIED = 1_000_000


def managed(df: DataFrame, contract: str, value: str, commission: str, brokers: list[tuple[str, str, str]], managers: DataFrame) -> DataFrame:
    """One row per contract, side, broker paid and the broker's manager. ``brokers``: (side, broker column, payout column).

    ``managers`` has (corretor, gerente), the last entry of a broker counts; brokers without manager drop out. A broker
    may have very many contracts, so up to ``CARRIED`` managers go to the rows and these stay where they are; more are
    joined by broker.
    """
    paid = F.array(*[F.struct(F.lit(s).alias("lado"), F.col(b).alias("corretor"), F.col(p).cast("double").alias("pago")) for s, b, p in brokers])
    each = df.select(F.col(contract).alias("contrato"), F.col(value).alias("vgv"), F.col(commission).alias("vgc"), F.explode(paid).alias("x")).select("contrato", "vgv", "vgc", "x.*")
    each = each.filter((F.col("pago") > 0) & F.col("corretor").isNotNull()).select("contrato", "vgv", "vgc", "lado", "corretor").distinct()
    few = managers.limit(CARRIED + 1).count() <= CARRIED
    return each.join(F.broadcast(managers) if few else managers, "corretor")


def manager_detail(rows: DataFrame) -> DataFrame:
    """(lista, gerente, corretor, valor): each contract's value once for a manager, in equal parts for its brokers there.

    A contract's rows are read once: the first of a broker and manager, whatever the side, stands for both sides.
    """
    rows = rows.select("contrato", "vgv", "lado", "gerente", "corretor").dropna(subset=["contrato", "lado", "gerente"])
    first = F.row_number().over(Window.partitionBy("contrato", "gerente", "corretor", "vgv").orderBy("lado")) == 1
    listed = rows.withColumn("__first", first).withColumn("lado", F.explode(F.array_compact(F.array("lado", F.when(F.col("__first"), F.lit("GERAL"))))))
    each = listed.withColumn("k", F.count(F.lit(1)).over(Window.partitionBy("contrato", "gerente", "lado")))
    return each.groupBy(F.col("lado").alias("lista"), "gerente", "corretor").agg(F.sum(F.col("vgv").cast("double") / F.col("k")).alias("valor"))


def manager_commission(rows: DataFrame) -> DataFrame:
    """(lista, gerente, vgc): halved between the sides that have a manager, equal per manager; GERAL is both."""
    one = rows.select("contrato", "vgc", "lado", "gerente").dropna(subset=["contrato", "lado"]).distinct()
    each = one.withColumn("k", F.count(F.lit(1)).over(Window.partitionBy("contrato", "lado")))
    each = each.withColumn("lados", F.size(F.collect_set("lado").over(Window.partitionBy("contrato"))))
    share = F.col("vgc").cast("double") / F.col("lados") / F.col("k")
    each = each.select("gerente", F.explode(F.array("lado", F.lit("GERAL"))).alias("lista"), share.alias("vgc"))
    return each.groupBy("lista", "gerente").agg(rounded(F.sum("vgc"), 2, 3e-6).alias("vgc"))


def in_month(df: DataFrame, day: str, start: str | None = None, last_day: str | None = None, midnight: bool = False) -> DataFrame:
    """The contracts signed within a period; days are texts or timestamps, those that can't be read drop out if there is a period."""
    when = F.col(day) if dict(df.dtypes)[day] != "string" else parsed(F.col(day))
    return df.filter(in_period(when.cast("timestamp"), start, last_day, midnight))


def with_contract_id(df: DataFrame, contract: str, row: str) -> DataFrame:
    """The contract's id as text, blanks at its ends cut off; where it is blank, Contrato_ and the row's number."""
    own = F.trim(F.col(contract).cast("string"))
    return df.withColumn(contract, F.when(F.coalesce(own, F.lit("")) == "", F.concat(F.lit("Contrato_"), F.col(row).cast("string"))).otherwise(own))


def contract_lines(roles: DataFrame, row: str) -> DataFrame:
    """(corretor, contrato, valor, vgc, __row): the contracts of each broker that paid commission, one line each.

    ``roles`` has the rows of the list GERAL. Rows of one contract id are one line: it has the value of the first of them
    (by ``row``) that paid, and the commission of all.
    """
    paid = roles.filter(F.col("vgc") > 0).groupBy(F.col("nome").alias("corretor"), "contrato")
    return paid.agg(F.min_by("vgv", row).alias("valor"), F.sum("vgc").alias("vgc"), F.min(row).alias("__row"))


def broker_contracts(roles: DataFrame, row: str) -> DataFrame:
    """(corretor, vgv, vgc, contratos): a broker's totals, over all rows, and the lines of the contracts that paid commission, in the order of their first rows.

    A broker's list is one value; ``contract_lines`` has the same as rows, for brokers of any size.
    """
    lines = contract_lines(roles, row).groupBy("corretor").agg(F.array_sort(F.collect_list(F.struct("__row", "contrato", "valor", rounded("vgc", 2, 3e-6).alias("comissao")))).alias("x"))
    sums = roles.groupBy(F.col("nome").alias("corretor")).agg(F.sum(F.col("vgv").cast("decimal(18,2)")).alias("vgv"), rounded(F.sum("vgc"), 2, 3e-6).alias("vgc"))
    listed = F.transform("x", lambda c: F.struct(c["contrato"].alias("contrato"), c["valor"].alias("valor"), c["comissao"].alias("comissao")))
    empty = F.array().cast("array<struct<contrato: string, valor: decimal(18,2), comissao: double>>")
    return sums.join(lines, "corretor", "left").select("corretor", "vgv", "vgc", F.coalesce(listed.cast("array<struct<contrato: string, valor: decimal(18,2), comissao: double>>"), empty).alias("contratos"))


def combined(*rankings: DataFrame) -> DataFrame:
    """Several result sets as one, summed per name."""
    out = rankings[0]
    for r in rankings[1:]:
        out = out.unionByName(r)
    return out.groupBy("lista", "nome").agg(F.sum("vgv").alias("vgv"), F.sum("vgc").alias("vgc"))

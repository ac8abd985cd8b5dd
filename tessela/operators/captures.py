"""From a capture export to the listing dimension and the capture facts, and the stock files made of stock exports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessela.functions.dates import in_period, parsed_within
from tessela.functions.numbers import either_decimal_or_zero, whole
from tessela.functions.text import address, first_text, fold, joined_names, names, safe, three_names
from tessela.operators.stock import appended, is_home, lookup, new_keys, upsert
from tessela.sources.schema import column

#: The columns of the two stock files, with the headers that exports use for them.
SNAPSHOT = ("Codigo", "Captador1", "Captador2", "Captador3", "Gerente", "DataEstoque")
STANDARD = ("Codigo", "Captadores", "Tipo", "NumeroQuarto", "Valor", "Endereco", "Bairro", "PublicacaoNaInternet", "Exclusivo", "AreaLote", "AreaInterna")
HEADERS = {
    "Codigo": ("Codigo", "Código"),
    "Tipo": ("Tipo", "Categoria"),
    "NumeroQuarto": ("NumeroQuarto", "NúmeroQuarto", "Quartos", "Dormitorios"),
    "Valor": ("Valor", "Preco", "Preço"),
    "Bairro": ("Bairro",),
    "PublicacaoNaInternet": ("PublicacaoNaInternet", "PublicaçãoNaInternet"),
    "Exclusivo": ("Exclusivo",),
    "AreaLote": ("AreaLote", "ÁreaLote", "Area do Lote"),
    "AreaInterna": ("AreaInterna", "ÁreaInterna", "Area Interna"),
}


@dataclass(frozen=True)
class Focus:
    """The districts that a team looks for, and how dear and well paid a listing has to be."""

    districts: tuple[str, ...]
    least_price: float
    least_commission: float = 3.5

    def holds(self, district: Column, price: Column, commission: Column, home: Column) -> Column:
        return fold(district).isin(*self.districts) & (price >= self.least_price) & (commission >= self.least_commission) & home


@dataclass(frozen=True)
class Dimensions:
    """bairros (IdBairro, Nome, ordem), tipos (IdTipo, Nome, ordem), corretores (IdCorretor, Nome, IdGerente, ordem), imoveis, fatos."""

    bairros: DataFrame
    tipos: DataFrame
    corretores: DataFrame
    imoveis: DataFrame
    fatos: DataFrame


def wanted_rows(df: DataFrame, purpose: str | None = None, use: str | None = None, period: tuple[str, str] | None = None) -> DataFrame:
    """Rows of a purpose and a use, whatever their case and blanks, registered within a period; what is None filters nothing."""
    for name, value in (("Finalidade", purpose), ("Destinacao", use)):
        if value is not None and name in df.columns:
            df = df.filter(F.upper(F.trim(name)) == value.strip().upper())
    return df if period is None else df.filter(in_period(parsed_within(F.col("DataCadastro")), *period))


def with_code(df: DataFrame, code: str = "Codigo") -> DataFrame:
    """Rows whose code is a number."""
    return df.withColumn(code, whole(F.col(code))).filter(F.col(code).isNotNull())


def entry_day(run_day: str) -> Column:
    """The day registered, else of the last change, else of the last status, else of the run."""
    text = first_text(F.col("DataCadastro"), F.col("DataHoraUltimaAlteracao"), F.col("DataHoraUltimaSituacao"))
    return F.coalesce(F.to_date(parsed_within(text)), F.lit(run_day).cast("date"))


def captured(rows: DataFrame, dims: Dimensions, order: str, run_day: str, pp: Focus, ac: Focus, codes: DataFrame | None = None) -> Dimensions:
    """The dimensions and facts after an export's rows.

    The last row of a code counts. Districts not seen yet get numbers of their own; unknown types have the empty id and
    count as homes; brokers without id keep their name, the first one's manager is the listing's.
    """
    rows = with_code(rows)
    if codes is not None:
        rows = rows.join(codes.select(F.col("codigo").alias("Codigo")).distinct(), "Codigo", "left_semi")
    rows = rows.groupBy("Codigo").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "Codigo"]), order).alias("x")).select("Codigo", "x.*")
    bairros = new_keys(rows, "Bairro", order, dims.bairros, "Nome", "IdBairro")
    rows = lookup(rows, bairros.withColumn("ordem", F.lit(0)), "Bairro", "Nome", "IdBairro", "ordem", "__bairro")
    rows = lookup(rows, dims.tipos, "Tipo", "Nome", "IdTipo", "ordem", "__tipo")
    for i in range(3):
        rows = rows.withColumn(f"__nome{i}", F.coalesce(F.get(names(F.col("Captadores")), F.lit(i)), F.lit("")))
        rows = lookup(rows, dims.corretores, f"__nome{i}", "Nome", "IdCorretor", "ordem", f"__corretor{i}", fallback=True)
    managers = dims.corretores.groupBy("IdCorretor").agg(F.max_by("IdGerente", "ordem").alias("__gerente"))
    rows = rows.join(managers, F.col("__corretor0") == F.col("IdCorretor"), "left")
    price, commission, home = either_decimal_or_zero(F.col("Valor")), either_decimal_or_zero(F.col("ComissaoVenda")), is_home(F.nullif(F.col("__tipo"), F.lit("")))
    flag = lambda team: team.holds(F.col("Bairro"), price, commission, home)
    listed = rows.select("Codigo", F.col("__tipo").alias("Tipo"), price.alias("Valor"), F.col("__bairro").alias("Bairro"), flag(pp).alias("FocoPP"), flag(ac).alias("FocoAC"))
    facts = rows.select("Codigo", *[F.col(f"__corretor{i}").alias(f"Captador{i + 1}") for i in range(3)], F.coalesce("__gerente", F.lit("")).alias("Gerente"), entry_day(run_day).alias("DataEntrada"))
    return Dimensions(bairros, dims.tipos, dims.corretores, upsert(dims.imoveis, listed, ["Codigo"]), appended(dims.fatos, facts, ["Codigo", "DataEntrada", "Captador1"]))


def snapshot(df: DataFrame, day: str) -> DataFrame:
    """The stock of a day: code, three brokers, an empty manager, the day; rows without a code drop out."""
    own = column(df, "Codigo")
    if own is None:
        raise ValueError(f"no column for the code among {df.columns}")
    brokers = three_names(F.col("Captadores") if "Captadores" in df.columns else F.lit(""))
    out = df.select(safe(F.col(own)).alias("Codigo"), *[b.alias(f"Captador{i + 1}") for i, b in enumerate(brokers)], F.lit("").alias("Gerente"), F.lit(day).cast("date").alias("DataEstoque"))
    return out.filter("Codigo <> ''").select(*SNAPSHOT)


def standard(df: DataFrame) -> DataFrame:
    """The stock in eleven columns, whatever the export's headers; a column that it lacks is N/D."""
    found = {name: column(df, *headers) for name, headers in HEADERS.items()}
    if found["Codigo"] is None:
        raise ValueError(f"no column for the code among {df.columns}")
    given = lambda *headers: F.col(c) if (c := column(df, *headers)) else F.lit(None).cast("string")
    cols = {name: F.col(c) if c else F.lit("N/D") for name, c in found.items()}
    brokers = [c for c in (column(df, f"Captador{i}", f"Captador_{i}") for i in (1, 2, 3)) if c]
    cols["Captadores"] = safe(F.col("Captadores")) if "Captadores" in df.columns else joined_names(*[F.col(c) for c in brokers]) if brokers else F.lit("N/D")
    cols["Endereco"] = address(given("Endereco"), given("EnderecoNumero", "Numero"), given("Bloco"), given("Complemento"))
    return df.select(*[cols[c].alias(c) for c in STANDARD])

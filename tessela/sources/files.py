"""Many text files as one table, each read by its own separator and header, with a number for each of their lines.

A line's number comes from the file and the place where its split begins, and from the order of rows in a split: splits
are counted (a row for each), and the counts of those before are added. So numbers don't depend on how files are split
or spread over tasks. A record is a line: line breaks within quotes are not looked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessela.functions.dates import in_file_name
from tessela.sources.kept import kept
from tessela.sources.schema import ALIASES

#: Accented letters and their plain ones, as headers have them.
_ACCENTS = ("áàâãäéèêëíìîïóòôõöúùûüçñ", "aaaaaeeeeiiiiooooouuuucn")


def lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(arquivo, linha, posicao, texto): the lines of all files with their number in the file and in all files, in order of path; both from 0."""
    text = spark.read.text(paths)
    rows = text.select(F.col("_metadata.file_path").alias("arquivo"), F.col("_metadata.file_block_start").alias("__at"), F.monotonically_increasing_id().alias("__id"), F.col("value").alias("texto"))
    splits = rows.groupBy("arquivo", "__at").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = lambda w: F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select(F.col("arquivo").alias("__file"), F.col("__at").alias("__start"), "__first", before(Window.partitionBy("arquivo").orderBy("__at")).alias("__in_file"), before(Window.orderBy("arquivo", "__at")).alias("__in_all"))
    met = rows.join(F.broadcast(splits), (F.col("arquivo") == F.col("__file")) & (F.col("__at") == F.col("__start")))
    own = F.col("__id") - F.col("__first")
    return met.select("arquivo", (F.col("__in_file") + own).alias("linha"), (F.col("__in_all") + own).alias("posicao"), "texto")


def plain_header(c: Column) -> Column:
    """A header without byte order mark and accents, in lower case, words joined by underscores."""
    bare = F.lower(F.trim(F.replace(c, F.lit("﻿"), F.lit(""))))
    return F.translate(F.regexp_replace(F.trim(F.replace(bare, F.lit('"'), F.lit(""))), r"[\s ]+", "_"), *_ACCENTS)


def headers(rows: DataFrame, candidates: str = ",;") -> DataFrame:
    """(arquivo, sep, cabecalho): of each file the candidate that its first line holds most often (of equal ones the first), and its columns by it."""
    first = rows.filter("linha = 0").select("arquivo", "texto")
    count = lambda c: F.length("texto") - F.length(F.replace("texto", F.lit(c), F.lit("")))
    best = F.greatest(*[count(c) for c in candidates]) if len(candidates) > 1 else count(candidates)
    sep, cells = F.when(F.lit(False), ""), F.when(F.lit(False), F.array().cast("array<string>"))
    for c in candidates:
        sep = sep.when(count(c) == best, c)
        cells = cells.when(count(c) == best, F.split("texto", f"[{c}]"))
    return first.select("arquivo", sep.alias("sep"), F.transform(cells, plain_header).alias("cabecalho"))


def many_csv(spark: SparkSession, paths: str | list[str], candidates: str = ",;", names: dict[str, tuple[str, ...]] = ALIASES, required: tuple[str, ...] = ()) -> DataFrame:
    """(arquivo, linha, posicao, columns of ``names``) as text, whatever the separator, order and headers of each file.

    A column is the first of its aliases that a file has, null where it has none; a file without a column of
    ``required`` raises. Blank lines are left out. ``posicao`` rises over all files, so that "first" and "last" mean the
    same whatever reads them.
    """
    rows = lines(spark, paths)
    heads = headers(rows, candidates)
    plain = lambda x: x.lower().translate(str.maketrans(*_ACCENTS))
    place = lambda aliases: F.coalesce(*[F.nullif(F.array_position("cabecalho", a), F.lit(0)) for a in dict.fromkeys(map(plain, aliases))])
    heads = kept(heads.select("arquivo", "sep", F.size("cabecalho").alias("n"), *[place(aliases).cast("int").alias(f"__{c}") for c, aliases in names.items()]))
    for c in required:
        bad = heads.filter(F.col(f"__{c}").isNull()).first()
        if bad:
            raise ValueError(f"{bad['arquivo']} has no column {c}")
    width = heads.agg(F.max("n")).first()[0] or 1  # of the widest file
    kind = ", ".join(f"c{i} string" for i in range(width))
    cells = lambda sep: F.from_csv("texto", kind, {"sep": sep, "escape": '"'})
    met = rows.filter((F.col("linha") > 0) & (F.trim("texto") != "")).join(F.broadcast(heads.withColumnRenamed("arquivo", "__file")), F.col("arquivo") == F.col("__file"))
    parsed = F.when(F.lit(False), cells(candidates[0]))
    for c in candidates:
        parsed = parsed.when(F.col("sep") == c, cells(c))
    # a line is taken apart once
    met = met.withColumn("__row", parsed).withColumn("__cells", F.array(*[F.col(f"__row.c{i}") for i in range(width)]))
    return met.select("arquivo", "linha", "posicao", *[F.try_element_at("__cells", F.col(f"__{c}")).alias(c) for c in names])


#: Places of a block of rows that are numbered in one task.
BLOCK = 1 << 16


def ranked(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Adds ``lugar``: a row's place, from 1, among the rows of its file in order of ``posicao``; files may be of any size.

    Rows are numbered within blocks of places and moved up by the blocks before, of which there is a row each, so no
    task gets a file.
    """
    rows = rows.withColumn("__block", F.floor(F.col("posicao") / block))
    sizes = rows.groupBy(F.col("arquivo").alias("__file"), F.col("__block").alias("__b")).agg(F.count(F.lit(1)).alias("__k"))
    before = F.coalesce(F.sum("__k").over(Window.partitionBy("__file").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("__file", "__b", before.alias("__before"))
    own = F.row_number().over(Window.partitionBy("arquivo", "__block").orderBy("posicao"))
    met = rows.withColumn("__own", own).join(F.broadcast(sizes), (F.col("arquivo") == F.col("__file")) & (F.col("__block") == F.col("__b")))
    return met.withColumn("lugar", F.col("__before") + F.col("__own")).drop("__block", "__file", "__b", "__before", "__own")


def dated_csv(spark: SparkSession, paths: str | list[str], candidates: str = ",;", names: dict[str, tuple[str, ...]] = ALIASES, required: tuple[str, ...] = ()) -> DataFrame:
    """``many_csv`` with ``arquivo_origem``, the file's name, and ``data``, the date that it holds; undated files drop out."""
    rows = many_csv(spark, paths, candidates, {c: a for c, a in names.items() if c != "data"}, required)
    rows = rows.withColumn("arquivo_origem", F.url_decode(F.replace(F.substring_index("arquivo", "/", -1), F.lit("+"), F.lit("%2B"))))
    return rows.withColumn("data", in_file_name(F.col("arquivo_origem"))).filter("data is not null")

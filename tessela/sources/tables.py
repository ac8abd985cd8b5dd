"""Readers of exports: delimited text, tables in HTML, availability responses, relational tables.

Text comes in as strings; a conform step gives types.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessela.functions.dates import in_file_name
from tessela.functions.text import strip, upper_or_null
from tessela.sources.schema import exactly

#: The columns of a listing table.
LISTING = ("codigo", "bairro", "cidade", "tipo", "oferta", "preco", "area_util", "quartos", "vagas", "latitude", "longitude", "quadra", "cep", "valor_m2", "data_coleta")


def separator(spark: SparkSession, path: str, candidates: str = ",;", lines: int = 1) -> str:
    """The candidate that the first lines hold most often; of equal ones the first."""
    text = " ".join(r["value"] for r in spark.read.text(path).limit(lines).collect())[:5000]
    return max(candidates, key=lambda c: (text.count(c), -candidates.index(c)))


def csv(spark: SparkSession, path: str | list[str], sep: str | None = None, required: tuple[str, ...] = ()) -> DataFrame:
    """All columns as text, headers stripped; raises if a required column is missing."""
    first = path if isinstance(path, str) else path[0]
    df = spark.read.option("header", True).option("sep", sep or separator(spark, first)).csv(path)
    df = df.toDF(*[c.replace("﻿", "").strip() for c in df.columns])
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def dated_csv(spark: SparkSession, paths: list[str], sep: str | None = None) -> DataFrame:
    """Many files or globs as one table with ``arquivo_origem`` and the date of the file's name; undated files drop out."""
    df = spark.read.option("header", True).option("sep", sep or separator(spark, paths[0])).csv(paths)
    df = df.select("*", F.col("_metadata.file_name").alias("arquivo_origem"))
    return df.withColumn("data", in_file_name(F.col("arquivo_origem"))).filter("data is not null")


def csv_any(spark: SparkSession, path: str, candidates: str = ",;") -> DataFrame:
    """By the first candidate that parts the header into several columns; as one column if none does."""
    header = spark.read.text(path).limit(1).collect()
    line = header[0]["value"] if header else ""
    return csv(spark, path, sep=next((c for c in candidates if c in line), candidates[0]))


def strict_csv(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """The columns in this order, if the header has these and no others; rows with more cells are left out, missing cells are the text None."""
    found = csv(spark, path, sep)
    exactly(found, columns)
    header = found.columns
    schema = ", ".join(f"`{c}` string" for c in header) + ", `__line` string"
    df = spark.read.schema(schema).option("header", True).option("sep", sep).option("columnNameOfCorruptRecord", "__line").csv(path)
    cells = F.size(F.split(F.regexp_replace("__line", r'"(?:[^"]|"")*"', ""), re.escape(sep)))
    return df.filter(F.col("__line").isNull() | (cells <= len(header))).select(*columns).na.fill("None")


def load(spark: SparkSession, path: str, kind: str | None = None, **options: str) -> DataFrame:
    """By format, else by the path's extension: csv and txt, parquet, json; others raise."""
    kind = kind or path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind in ("csv", "txt"):
        return csv(spark, path, **options) if options else csv_any(spark, path)
    if kind not in ("parquet", "json", "orc"):
        raise ValueError(f"no reader for {kind}: export it as CSV")
    return spark.read.format(kind).options(**options).load(path)


def sheet(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A tab exported as CSV: empty rows drop out, empty cells are empty texts."""
    return csv(spark, path, sep).dropna("all").na.fill("")


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def narrowed_sql(table: str, columns: dict[str, str], start: str, end: str, where: dict[str, str | tuple[str, ...]] | None = None, limits: dict[str, tuple[float, float]] | None = None) -> str:
    """What ``narrowed`` asks for, as a database's SQL: the whole condition is worked out there. ``columns``: names with those that the table has for them."""
    name = lambda c: '"' + columns[c].replace('"', '""') + '"'
    tests = [f"{name('data_coleta')} BETWEEN DATE({_literal(start)}) AND DATE({_literal(end)})"]
    for c, wanted in (where or {}).items():
        values = ", ".join(_literal(w.strip().upper()) for w in ((wanted,) if isinstance(wanted, str) else wanted))
        tests.append(f"UPPER(TRIM({name(c)})) IN ({values})")
    tests += [f"{name(c)} BETWEEN {float(low)!r} AND {float(high)!r}" for c, (low, high) in (limits or {}).items()]
    return f"SELECT {', '.join(name(c) for c in columns)} FROM {table} WHERE {' AND '.join(tests)}"


def relational(spark: SparkSession, url: str, table: str, start: str, end: str, where: dict[str, str | tuple[str, ...]] | None = None, limits: dict[str, tuple[float, float]] | None = None, parts: int = 8, **properties: str) -> DataFrame:
    """A typed, normalised projection of a listing table within a span of days, read over ``parts`` connections that have some of the days each; all filters are the database's.

    ``where``: texts that a column equals, whatever its case and blanks, or one of several; ``limits``: ranges of
    numbers, both ends included, nulls left out. ``data_coleta`` has to be a column of dates.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**properties)
    found = {c.lower(): c for c in reader.option("dbtable", table).load().columns}
    asked = narrowed_sql(table, {c: found[c] for c in LISTING if c in found}, start, end, where, limits)
    bounds = {"partitionColumn": found["data_coleta"], "lowerBound": start, "upperBound": end, "numPartitions": str(parts)}
    df = spark.read.format("jdbc").option("url", url).options(**properties).option("dbtable", f"({asked}) asked").options(**bounds).load()
    return conformed(df.toDF(*[c.lower() for c in df.columns]))


def narrowed(df: DataFrame, start: str, end: str, where: dict[str, str | tuple[str, ...]] | None = None, limits: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """The columns of listings that a table has, and the rows that are asked for."""
    df = df.select(*[c for c in LISTING if c in df.columns]).filter(F.col("data_coleta").between(start, end))
    for c, wanted in (where or {}).items():
        df = df.filter(F.upper(F.trim(c)).isin(*[w.strip().upper() for w in ((wanted,) if isinstance(wanted, str) else wanted)]))
    for c, (low, high) in (limits or {}).items():
        df = df.filter(F.col(c).between(low, high))
    return df


def conformed(df: DataFrame) -> DataFrame:
    """Texts stripped and upper-cased, numbers tried, null rooms and spaces as 0."""
    text, real, whole = ("bairro", "cidade", "tipo", "oferta", "quadra"), ("preco", "area_util", "valor_m2"), ("quartos", "vagas")
    for c in df.columns:
        if c in text:
            df = df.withColumn(c, upper_or_null(F.col(c)))
        elif c in real:
            df = df.withColumn(c, F.col(c).try_cast("double"))
        elif c in whole:
            df = df.withColumn(c, F.coalesce(F.col(c).try_cast("double").try_cast("int"), F.lit(0)))
    return df


def codes(df: DataFrame, column: str) -> DataFrame:
    """A column's distinct whole numbers, in order."""
    return df.select(F.col(column).try_cast("double").try_cast("long").alias("codigo")).dropna().distinct().orderBy("codigo")


def available(spark: SparkSession, path: str) -> DataFrame:
    """The distinct codes of saved availability responses; entries that are no number are skipped."""
    df = spark.read.option("multiLine", True).schema("quantidade long, lista array<struct<codigo: string>>").json(path)
    return codes(df.select(F.explode("lista").alias("x")).select("x.codigo"), "codigo")


def html_files(spark: SparkSession, paths: str | list[str], sniffed: int = 2048) -> DataFrame:
    """(path, html): the files that look like HTML at their beginning, whatever their extension, as text.

    The bytes tell the encoding: UTF-16 by its mark, UTF-8 if they are valid as such, else Latin-1.
    """
    raw = spark.read.format("binaryFile").load(paths).select("path", "content")
    mark = F.hex(F.substring("content", 1, 2))
    html = F.when(mark.isin("FFFE", "FEFF"), F.decode("content", "UTF-16")).when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    html = F.replace(html.otherwise(F.decode("content", "ISO-8859-1")), F.lit("﻿"), F.lit(""))
    return raw.select("path", html.alias("html")).filter(F.lower(F.substring("html", 1, sniffed)).rlike("<(html|div|table)"))


#: What is no content, and the tags that tables are told by.
_NO_CONTENT = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
_TAGS = re.compile(r"<(?:(/?table)|(tr)|t[dh])\b", re.IGNORECASE)
#: Characters of cells that a task holds before it hands them on.
_HELD = 8_000_000


def _scanned(page: str) -> Iterator[tuple[int, int, int, int, str]]:
    """(table, depth, line, cell, html) of a page's cells, in one go over its tags with a stack of the tables that are open."""
    stack: list[list] = []  # of each: place, line, cell, where the cell begins

    def ended(at: int) -> Iterator[tuple[int, int, int, int, str]]:
        table, line, cell, begin = stack[-1]
        if begin is not None:
            yield table, len(stack), line, cell, page[begin:at]
            stack[-1][3] = None

    for tag in _TAGS.finditer(page):
        at, kind = tag.start(), tag.lastindex
        if kind == 1 and len(tag[1]) == 5:
            stack.append([at, -1, -1, None])
        elif stack:
            yield from ended(at)
            top = stack[-1]
            if kind == 1:
                stack.pop()
            elif kind == 2:
                top[1:3] = top[1] + 1, -1
            elif top[1] >= 0:
                top[2:4] = top[2] + 1, at
    while stack:
        yield from ended(len(page))
        stack.pop()


def _largest(page: str) -> Iterator[tuple[int, list[str]]]:
    """(line, cells) of the page's largest table."""
    tables: dict[int, dict[int, list[str]]] = {}
    for table, _, line, _, text in _scanned(page):
        tables.setdefault(table, {}).setdefault(line, []).append(text)
    if tables:
        yield from tables[max(tables, key=lambda t: (len(tables[t]) * len(tables[t].get(0, ())), -t))].items()


def _by_page(html: DataFrame, name: str, content: str, scan: Callable[[str], Iterator[tuple]], fields: str) -> DataFrame:
    """What a scan finds in each page, beside the page's name; tasks hand it on in parts."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, rows, held = [], [], 0
            for i, page in enumerate(batch.column(1)):
                for row in scan(page.as_py() or ""):
                    own.append(i)
                    rows.append(row)
                    held += len(row[-1]) if isinstance(row[-1], str) else sum(map(len, row[-1]))
                    if held > _HELD:
                        yield taken(batch, own, rows)
                        own, rows, held = [], [], 0
            if rows:
                yield taken(batch, own, rows)

    kinds = [pa.list_(pa.string()) if kind == "array<string>" else pa.string() if kind == "string" else pa.int64() for kind in (f.split()[1] for f in fields.split(", "))]
    names = [name, *(f.split()[0] for f in fields.split(", "))]

    def taken(batch: pa.RecordBatch, own: list[int], rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), *columns], names=names)

    pages = html.select(name, F.regexp_replace(content, _NO_CONTENT, "").alias("__page"))
    return pages.mapInArrow(found, f"`{name}` {html.schema[name].dataType.simpleString()}, {fields}")


def html_cells(html: DataFrame, name: str = "path", content: str = "html") -> DataFrame:
    """(name, table, depth, line, cell, text): the cells of all tables of each page, by a scan that keeps the tables that are open.

    ``table`` is the place where a table begins. Cells and rows end where the next one begins or the table ends; a cell
    has the text of the tables within it too, and these are tables of their own. Closing tags without an opening one
    count for nothing. A page is one value, gone through once in its task, so pages aren't shuffled; rows of one name are pages of their own.
    """
    cells = _by_page(html, name, content, _scanned, "table long, depth long, line long, cell long, text string")
    return cells.withColumn("text", _plain(F.col("text")))


def html_rows(html: DataFrame, name: str = "path", content: str = "html") -> DataFrame:
    """(name, line, cells) of the largest table (rows x cells of its first row; of equal ones the first) of each page, nested ones too."""
    rows = _by_page(html, name, content, _largest, "line long, cells array<string>")
    return rows.withColumn("cells", F.transform("cells", _plain))


def _plain(cell: Column) -> Column:
    text = F.regexp_replace(cell, r"(?s)<[^>]*>", "")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return strip(text)

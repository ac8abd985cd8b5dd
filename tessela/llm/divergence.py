r"""How the sources of a language differ in their words: exact divergences over a vocabulary kept as transducers.

Terms are counted by document first; a language keeps those in ``MIN_DOCS`` documents or more. Its vocabulary, in
order, is cut into ranges: each kept term whose hash is 0 modulo ``RANGE`` begins one, so a range holds about ``RANGE``
terms however large the vocabulary is, and nobody has to sort it as a whole. In a second pass the texts' terms stream
to their range, summed up for each language and source on the way; there the range's kept terms become a minimal
acyclic transducer, the stream runs through it, and what it accepts is counted by its ordinal. Range and ordinal give
the term's place in the language's order: they stand for the term from here on, in the sums over pairs and as the
second key of ranks, and become text again in the result alone.

The terms of a range meet all sources of the language in one task, which adds up their pairs in matrices of ``BLOCK``
sources a side; what is shuffled then is a row for each range and pair. The best terms of a source are cut in each task
before they meet. A source or language of any size is spread over all tasks in every step that reads its texts or terms.

Defined results: null text, lang and source are empty texts; a text without terms still makes its group known; rows
that share a doc_id are documents of their own; texts may be of any length; a term that a document repeats counts once
for keeping and each time in the counts; equal values rank by the item's UTF-8; a language with no kept term has pairs
of value 0 and no term rows, one with a single source no pairs; other columns, whatever their names, are not looked at;
an empty table gives an empty table.
"""

from __future__ import annotations

import bisect
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessela.llm.shared import written
from tessela.llm.tokens import NOT_ALNUM, bytes_of
from tessela.llm.transducer import Transducer

MIN_DOCS = 3
TOP = 200
UNIT = 1_000_000_000
#: Terms of a range of the vocabulary, about.
RANGE = 1 << 14
#: Sources that a matrix of pairs has on a side.
BLOCK = 128
#: Terms that a matrix has at once.
TERMS = 2048
#: Distinct terms that a task holds before it passes them on.
HELD = 1 << 19

#: Digits are no part of a term; A-Z in lower case, what parts terms as blanks.
_DIGITS = b"0123456789"
_TERMS = bytes(b + 32 if 65 <= b <= 90 else 32 if b in NOT_ALNUM or b in _DIGITS else b for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8: runs of ASCII letters and of all that is not ASCII."""
    return text.translate(_TERMS).split()


def _columns(docs: DataFrame) -> DataFrame:
    own = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(own("lang").alias("lang"), own("source").alias("source"), own("text").cast("binary").alias("text"))


def _held(batches: Iterator[pa.RecordBatch], key: Callable[[tuple], tuple], once: bool) -> Iterator[dict[tuple, Counter]]:
    """Terms counted by ``key`` of a row's (lang, source), over a task's texts or as many as give ``HELD`` terms."""
    held: defaultdict[tuple, Counter] = defaultdict(Counter)
    size = 0
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            counter, found = held[key((lang, source))], terms(bytes(text.as_buffer()))
            size -= len(counter)
            counter.update(set(found) if once else found)
            size += len(counter)
            if size > HELD:
                yield held
                held, size = defaultdict(Counter), 0
    yield held


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, docs), a row for each term and task, or a few where a task has very many terms."""
    for held in _held(batches, lambda k: k[:1], True):
        for (lang,), docs in held.items():
            yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(docs)), pa.array(docs.keys(), pa.binary()), pa.array(docs.values(), pa.int64())], names=["lang", "term", "docs"])


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term), the term's bytes."""
    each = docs.mapInArrow(_counted, "lang string, term binary, docs long")
    return each.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).select("lang", "term")


def _part(words: Iterable[bytes], cuts: list[bytes]) -> pa.Array:
    """The range of each term."""
    return pa.array([bisect.bisect_right(cuts, t) for t in words] if cuts else [0] * len(words), type=pa.int32())


def _streamed(batches: Iterator[pa.RecordBatch], cuts: dict[str, list[bytes]]) -> Iterator[pa.RecordBatch]:
    """(lang, source, part, term, n): the terms of the texts with the range they belong to, summed up by task."""
    for held in _held(batches, lambda k: k, False):
        for (lang, source), n in held.items():
            part = _part(n.keys(), cuts.get(lang, []))
            yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(n)), pa.repeat(source, len(n)), part, pa.array(n.keys(), pa.binary()), pa.array(n.values(), pa.int64())], names=["lang", "source", "part", "term", "n"])


def _parted(batches: Iterator[pa.RecordBatch], cuts: dict[str, list[bytes]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, words = (c.to_pylist() for c in batch.columns)
        part = [bisect.bisect_right(cuts.get(lang, []), t) for lang, t in zip(langs, words, strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, type=pa.int32())], names=["lang", "term", "part"])


def _recounted(key: tuple, vocabulary: pa.Table, stream: pa.Table) -> pa.Table:
    """A range's stream (source, term, n) through the transducer of its kept terms: (lang, part, source, at, n)."""
    automaton = Transducer(sorted(vocabulary.column("term").to_pylist()))
    data, at = bytes_of(stream.column("term").combine_chunks().cast(pa.string()))
    ordinal = automaton.ordinals(data, at[:-1], at[1:])
    good = ordinal >= 0
    lang, part = (pa.repeat(k, int(good.sum())) for k in key)
    source, n = (stream.column(c).filter(pa.array(good)) for c in ("source", "n"))
    return pa.table({"lang": lang, "part": part, "source": source, "at": pa.array(ordinal[good]), "n": n})


def _pairs(key: tuple, shares: pa.Table, sources: pa.Table) -> pa.Table:
    """The sums of (p - q)^2 / q, rounded down, over a range's terms, for each pair of sources.

    ``shares`` has (source, at, p) of the terms that a source has, ``sources`` (source, p) of those that it doesn't.
    """
    number, absent = (sources.column(c).to_numpy() for c in ("source", "p"))
    order = np.argsort(number)
    number, absent = number[order], absent[order]
    row, at, p = np.searchsorted(number, shares.column("source").to_numpy()), shares.column("at").to_numpy(), shares.column("p").to_numpy()
    order = np.argsort(at, kind="stable")
    row, at, p = row[order], at[order], p[order]
    total = np.zeros((len(number), len(number)), dtype=np.int64)
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, TERMS):
        span = slice(*np.searchsorted(at, (low, low + TERMS)))
        share = np.repeat(absent[:, None], min(TERMS, int(at[-1]) + 1 - low), axis=1)
        share[row[span], at[span] - low] = p[span]
        for a in range(len(number)):
            for b in range(0, len(number), BLOCK):
                q = share[b : b + BLOCK]
                d = share[a] - q
                total[a, b : b + BLOCK] += (d * d // q).sum(axis=1)
    a, b = np.nonzero(~np.eye(len(number), dtype=bool))
    return pa.table({"lang": pa.repeat(key[0], len(a)), "source": pa.array(number[a]), "other": pa.array(number[b]), "value": pa.array(total[a, b])})


def _share(n: str, of: str) -> Column:
    """1 + floor(UNIT * (n + 1) / of), exact for counts of any size."""
    return F.expr(f"1 + (cast({n} + 1 as decimal(20,0)) * cast({UNIT} as decimal(10,0))) div cast({of} as decimal(20,0))")


def _excess(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def divergences(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, size: int = RANGE) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from the others, and by which terms from its language."""
    docs = _columns(docs)
    kept = written(kept_terms(docs, min_docs))
    cuts: dict[str, list[bytes]] = {}
    for r in kept.filter(F.pmod(F.xxhash64("lang", "term"), F.lit(size)) == 0).collect():  # one of ``size`` terms
        cuts.setdefault(r["lang"], []).append(bytes(r["term"]))
    cuts = {lang: sorted(c) for lang, c in cuts.items()}
    vocabulary = written(kept.mapInArrow(lambda b: _parted(b, cuts), "lang string, term binary, part int"))
    stream = docs.mapInArrow(lambda b: _streamed(b, cuts), "lang string, source string, part int, term binary, n long")
    stream = stream.groupBy("lang", "source", "part", "term").agg(F.sum("n").alias("n"))
    counts = vocabulary.groupBy("lang", "part").cogroup(stream.groupBy("lang", "part")).applyInArrow(_recounted, "lang string, part int, source string, at long, n long")
    counts = written(counts)
    # the groups with a number each, the sizes, and the share of a term that a group doesn't have
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    terms_of = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    groups = docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(terms_of, "lang", "left").na.fill(0, ["total", "terms"])
    groups = groups.withColumns({"number": F.row_number().over(Window.partitionBy("lang").orderBy("source")), "whole": F.col("total") + F.col("terms")})
    groups = written(groups.withColumn("p", F.when(F.col("terms") > 0, _share("0L", "whole"))))
    langs = groups.groupBy("lang").agg((F.sum("total") + F.max("terms")).alias("lang_whole"))
    shares = counts.join(groups.select("lang", "source", "number", "whole"), ["lang", "source"]).withColumn("p", _share("n", "whole"))
    shares = written(shares.select("lang", "part", F.col("number").alias("source"), "at", "n", "p"))
    ranges = vocabulary.select("lang", "part").distinct().join(groups.select("lang", F.col("number").alias("source"), "p"), "lang")
    summed = shares.select("lang", "part", "source", "at", "p").groupBy("lang", "part").cogroup(ranges.groupBy("lang", "part")).applyInArrow(_pairs, "lang string, source int, other int, value long")
    summed = summed.groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    side = lambda n, name: groups.select("lang", F.col("number").alias(n), F.col("source").alias(name), "terms")
    pairs = summed.join(side("source", "name").drop("terms"), ["lang", "source"]).join(side("other", "item").drop("terms"), ["lang", "other"]).select("lang", F.col("name").alias("source"), "item", "value")
    bare = side("n", "source").filter("terms = 0").join(side("m", "item").drop("terms"), "lang").filter("n <> m").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pairs.unionByName(bare).select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))
    # each term's share in its language, beside its shares in the sources
    of_term = Window.partitionBy("lang", "part", "at")
    rows = shares.withColumn("all", F.sum("n").over(of_term)).join(langs, "lang").withColumn("q", _share("all", "lang_whole")).filter("p > q")
    by_place = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "part", "at")
    best = rows.withColumn("value", _excess("p", "q")).withColumn("rank", F.row_number().over(by_place)).filter(F.col("rank") <= top)
    named = vocabulary.select("lang", "part", "term", (F.row_number().over(Window.partitionBy("lang", "part").orderBy("term")) - 1).cast("long").alias("at"))
    best = best.select("lang", F.col("source").alias("number"), "part", "at", "value", "rank").join(named, ["lang", "part", "at"]).join(groups.select("lang", "number", "source"), ["lang", "number"])
    return pairs.unionByName(best.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", "rank"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents."""
    return divergences(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "source", "text"))


OP13_SQL = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS MATERIALIZED (SELECT r, lang, source, unnest(w) AS term FROM d
), k AS MATERIALIZED (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}
), g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d
), v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang
), c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL
), s AS (SELECT lang, source, sum(n) AS s FROM c GROUP BY ALL
), p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, CAST(1 + CAST({UNIT} AS HUGEINT) * (coalesce(n, 0) + 1) // (CAST(coalesce(s, 0) AS HUGEINT) + v) AS BIGINT) AS p
  FROM g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN s ON s.lang = g.lang AND s.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), l AS (
  SELECT lang, term, CAST(1 + CAST({UNIT} AS HUGEINT) * (a + 1) // (CAST(sum(a) OVER (PARTITION BY lang) AS HUGEINT) + count(*) OVER (PARTITION BY lang)) AS BIGINT) AS q
  FROM (SELECT lang, term, sum(n) AS a FROM p GROUP BY lang, term)
), f AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (FROM pairs UNION ALL FROM terms) QUALIFY part = 'pair' OR rank <= {TOP}
"""

r"""Quality rules: base counts of a text, and a hashed n-gram log-likelihood ratio, with SQL functions alone.

Words and pairs of neighbouring words are hashed to ``BUCKETS`` buckets each. Two multinomials over the buckets
are counted: the trusted target (documents whose ``quality`` label is 1) and the raw corpus (all documents). A
document's score is the sum over its n-grams of log(target share / raw share), with ``SMOOTHING`` added to each
count, divided by the number of its n-grams. A document is kept if no base rule fails and its score is at least
``THRESHOLD``: a fixed number, so every document is decided on its own and reruns agree.

The ratios are a table of fixed size (2 x BUCKETS) that goes into the plan as one literal, so scoring is a
projection without shuffle. Counting shuffles a row for each bucket and task. The trusted multinomial is fitted on
at most ``TRUSTED_DOCS`` labelled documents (all, or those with the least hashes of doc_id), whose ids are broadcast, so no
text is shuffled to meet its label; the raw multinomial counts every document.

Defined results: a null or blank text has no words, fails the base and has score 0; a label without document is
left out, several labels of one document count once (any 1 makes it trusted), rows with equal doc_id are scored
one by one; texts of any length are counted whole; documents of equal score are decided alike; with no trusted
document all ratios are 0; other columns pass through, but those named as one that is added (or used in between, with
two underscores in front) give way; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessela.llm.columns import SPACE, lines, words
from tessela.llm.shared import sampled, written

BUCKETS = 10_000
SMOOTHING = 5.0
#: Labelled documents that the trusted multinomial is fitted on at most: the ids are sent to all tasks.
TRUSTED_DOCS = 100_000
THRESHOLD = -0.2
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_ADDED = ("__words", "__lines", "__n_words", "__word_chars", "__n_symbols", "__n_dup_lines", "__n_repeat_words", "__base_failed", "__windows", "__sorted", "__at", "__score", "__kept")
#: Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"


def ngram_buckets(w: Column, buckets: int = BUCKETS) -> Column:
    """The buckets of a text's words (from 0) and pairs (from ``buckets``)."""
    one = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int"))
    two = F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda x, y: (F.pmod(F.xxhash64(x, y), F.lit(buckets)) + buckets).cast("int"))
    return F.concat(one, two)


def ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """(bucket, ratio) for each bucket: log of the target's share over the raw corpus's."""
    trusted = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").try_cast("long").alias("__id")).distinct()
    trusted = sampled(trusted, "__id", TRUSTED_DOCS).withColumn("__t", F.lit(1))
    marked = docs.select(F.col("doc_id").try_cast("long").alias("doc_id"), "text").join(F.broadcast(trusted), F.col("doc_id") == F.col("__id"), "left")
    marked = marked.withColumn("__words", words(F.col("text")))
    each = marked.select(F.coalesce("__t", F.lit(0)).alias("t"), F.explode(ngram_buckets(F.col("__words"), buckets)).alias("bucket"))
    counted = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("target"))
    every = docs.sparkSession.range(2 * buckets).select(F.col("id").cast("int").alias("bucket"))
    counted = written(every.join(counted, "bucket", "left").select("bucket", (F.col("bucket") >= buckets).alias("pair"), F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target")))
    sums = counted.groupBy("pair").agg(F.sum("raw").alias("raws"), F.sum("target").alias("targets"))
    share = lambda n, of: (F.col(n) + smoothing) / (F.col(of) + smoothing * buckets)
    ratio = F.when(F.col("targets") > 0, F.log(share("target", "targets") / share("raw", "raws"))).otherwise(0.0)
    return counted.join(sums, "pair").select("bucket", ratio.alias("ratio"))


def with_repeat_words(docs: DataFrame) -> DataFrame:
    """Adds ``__n_repeat_words``: how many of ``__words`` lie in windows of three words that the text has twice or more.

    Windows are 64-bit hashes: equal ones are neighbours once sorted with their places. Texts whose windows are
    all different, by far the most, skip the sort. Each step is a column of its own, lest a lambda repeat it.
    """
    w, n = F.col("__words"), F.size("__words")
    windows = F.transform(F.arrays_zip(F.slice(w, 1, n - 2).alias("a"), F.slice(w, 2, n - 2).alias("b"), F.slice(w, 3, n - 2).alias("c")), lambda x: F.xxhash64(x["a"], x["b"], x["c"]))
    out = docs.withColumn("__windows", F.when(n >= 4, windows))
    again = F.size(F.array_distinct("__windows")) < F.size("__windows")
    out = out.withColumn("__sorted", F.when(again, F.array_sort(F.transform("__windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    m, none = F.size("__sorted") - 1, F.array(F.lit(None).cast("bigint"))
    hashes = lambda start: F.transform(F.slice("__sorted", start, m), lambda x: x["h"])
    around = F.arrays_zip(F.col("__sorted").alias("x"), F.concat(none, hashes(1)).alias("p"), F.concat(hashes(2), none).alias("n"))
    twice = F.filter(around, lambda y: F.coalesce(y["x"]["h"] == y["p"], F.lit(False)) | F.coalesce(y["x"]["h"] == y["n"], F.lit(False)))
    out = out.withColumn("__at", F.transform(twice, lambda y: y["x"]["i"]))
    every = F.array_distinct(F.concat("__at", F.transform("__at", lambda i: i + 1), F.transform("__at", lambda i: i + 2)))
    return out.withColumn("__n_repeat_words", F.coalesce(F.size(every), F.lit(0)).cast("long")).drop("__windows", "__sorted", "__at")


def base(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__words`` and the base counts ``__n_words``, ``__word_chars``, ``__n_symbols``, ``__n_dup_lines``, ``__n_repeat_words``, ``__base_failed``."""
    docs = docs.drop(*_ADDED)
    text = F.coalesce(F.col("text"), F.lit(""))
    full = F.filter(lines(text), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0)
    out = docs.withColumn("__words", words(F.col("text"))).withColumn("__lines", full)
    out = out.withColumn("__n_words", F.size("__words").cast("long"))
    out = out.withColumn("__word_chars", F.length(F.translate(text, SPACE, "")).cast("long"))
    out = out.withColumn("__n_symbols", (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"))
    out = out.withColumn("__n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
    out = with_repeat_words(out)
    failed = (F.col("__n_words") < MIN_WORDS) | (100 * F.col("__n_repeat_words") > MAX_REPEAT_PERCENT * F.col("__n_words"))
    return out.withColumn("__base_failed", failed).drop("__lines")


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with the base counts, ``__score`` and ``__kept``."""
    table = [r["ratio"] for r in ratios(docs, labels, buckets).orderBy("bucket").collect()]
    table = F.split(F.lit(",".join(map(repr, table))), ",").cast("array<double>")
    scored = base(docs)
    hashed = ngram_buckets(F.col("__words"), buckets)
    total = F.aggregate(hashed, F.lit(0.0), lambda acc, b: acc + F.get(table, b))
    scored = scored.withColumn("__score", F.when(F.col("__n_words") > 0, total / (2 * F.col("__n_words") - 1)).otherwise(0.0))
    return scored.withColumn("__kept", ~F.col("__base_failed") & (F.col("__score") >= threshold)).drop("__words")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base counts and the verdict on each document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", *(F.col(f"__{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")))

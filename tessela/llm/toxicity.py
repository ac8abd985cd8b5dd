r"""Toxicity of documents: misspelled terms by Levenshtein automata on a lexicon trie, weighed by their context.

The lexicon is learned: words, and stems that begin words, that labelled toxic documents hold more often than others,
by log odds of at least ``MIN_ODDS`` and with a likelihood-ratio statistic of at least ``SURE`` against chance. Its trie is intersected with the
Levenshtein automaton of distance 1 (terms of ``FUZZY_LENGTH`` bytes or more; stems and shorter terms only match as
they are); the product is determinised once on the driver and is a small table, so every word of a piece of text takes
its steps together in numpy.

A hit counts by its context: ``CONTEXT`` words to both sides. It is quoted if the last mark before it opens a
quotation and the first one after it closes one (apostrophes within words are no marks), or if a word of reporting
stands before it. A quoted hit has a tenth of the weight. A logistic model over a document's hits (exact, fuzzy and
stem evidence, per document and per word) gives the score.

Labels come from at most ``TRAIN_ROWS`` labelled documents (those with the least hashes of doc_id), none of them with
crc32(doc_id) mod 3 = 1, which are held out. Score and lexicon see the text alone. Edits are counted in UTF-8 bytes;
A-Z is lower-cased, words are runs of letters, between blanks and marks of ASCII and the usual typographic ones. Text
without blanks between words (as Chinese is written) is one word, whose beginning a stem may match.

Defined results: null and empty texts have no hits and get the score of such documents; texts of any length are
scanned whole; a doc_id with several labels is toxic if one is 1, one with several texts trains by the greatest of
them; rows with equal doc_id are scored one by one; a null doc_id is not held out and never trains; terms of equal
evidence are taken in the order of their letters; with no label all scores are 0; other columns pass through,
whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tessela.llm.columns import lower_ascii
from tessela.llm.shared import sampled, written
from tessela.llm.tokens import LOWER, Piece, pieces

TRAIN_ROWS = 8000
MIN_ODDS = 1.0
SURE = 16.0
MIN_SUPPORT = 3
SHORTEST = 3
STEM_LENGTHS = (4, 5, 6, 7, 8)
FUZZY_LENGTH = 5
CONTEXT = 6
QUOTED_WEIGHT = 0.1
THRESHOLD = 0.7

#: All bytes but letters, and words that report speech.
NOT_LETTERS = bytes([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
REPORTING = ("said", "says", "wrote", "called", "quote", "quoted", "according", "sagte", "schrieb", "dit", "écrit", "dijo", "escribió")
#: Typographic marks with what stands for them in the scan: marks that open (1) and close (2) a quotation,
#: those that do either (as the ASCII ones), and blanks.
TYPOGRAPHIC = {"\x01": " ", "\x02": " ", "«": "\x01", "„": "\x01", "‚": "\x01", "»": "\x02", "”": "\x02", "“": '"', "‘": "'", "’": "'", "…": " ", "–": " ", "—": " ", "‐": " ", "‑": " ", "·": " ", "•": " ", "¡": " ", "¿": " ", "\xa0": " ", "\u2009": " ", "\u202f": " ", "\u3000": " ", "\u200b": " ", "、": " ", "。": " ", "，": " ", "！": " ", "？": " "}
_REPORTED = re.compile(r"[^\W\d_]+")

EXACT, FUZZY, STEM = 0, 1, 2


@dataclass
class Automaton:
    """A table of states by classes of bytes; state 0 is dead, state 1 the start. ``ends``: term * 3 + kind or -1."""

    classes: np.ndarray
    table: np.ndarray
    ends: np.ndarray
    stops: np.ndarray

    def hits(self, piece: Piece) -> tuple[np.ndarray, np.ndarray]:
        """(word, term * 3 + kind) of the words that match."""
        length = piece.end - piece.start
        word = np.arange(len(length))
        state = np.ones(len(word), dtype=np.int32)
        kind = self.classes[piece.data]
        words, ends, step = [word[:0]], [self.ends[:0]], 0
        while len(word):
            state = self.table[state, kind[piece.start[word] + step]]
            step += 1
            done = (step == length[word]) | self.stops[state]
            good = done & (self.ends[state] >= 0)
            words.append(word[good])
            ends.append(self.ends[state[good]])
            on = (state > 0) & ~done  # all words but those of the trie's length end in the dead state
            word, state = word[on], state[on]
        return np.concatenate(words), np.concatenate(ends)


def compile_lexicon(terms: list[tuple[str, bool]]) -> Automaton:
    """(text, is a stem) to the product of their trie with the Levenshtein automata."""
    children: list[dict[int, int]] = [{}]
    full: dict[int, int] = {}
    stem: dict[int, int] = {}
    reach: list[bool] = [False]  # does a fuzzy term lie below?
    for t, (text, is_stem) in enumerate(terms):
        raw, node = text.encode(), 0
        fuzzy = not is_stem and len(raw) >= FUZZY_LENGTH
        for byte in raw:
            reach[node] |= fuzzy
            if byte not in children[node]:
                children[node][byte] = len(children)
                children.append({})
                reach.append(False)
            node = children[node][byte]
        reach[node] |= fuzzy
        (stem if is_stem else full)[node] = t
    used = sorted({b for c in children for b in c})
    classes = np.zeros(256, dtype=np.int32)
    classes[used] = np.arange(1, len(used) + 1)
    classes = classes[LOWER]

    def closed(states: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        """With a letter of the term left out."""
        more = {(child, 1) for node, e in states if e == 0 for child in children[node].values() if reach[child]}
        return frozenset(states | more)

    start = closed({(0, 0)})
    number, todo = {frozenset(): 0, start: 1}, [start]
    table: list[list[int]] = [[0] * (len(used) + 1), []]
    while todo:
        here = todo.pop()
        row = []
        for byte in [-1, *used]:
            to: set[tuple[int, int]] = set()
            for node, e in here:
                if byte in children[node] and (e == 0 or reach[children[node][byte]]):
                    to.add((children[node][byte], e))
                if e == 0 and reach[node]:
                    to.add((node, 1))
                    to.update((child, 1) for child in children[node].values() if reach[child])
            key = closed(to)
            if key not in number:
                number[key] = len(number)
                table.append([])
                todo.append(key)
            row.append(number[key])
        table[number[here]] = row
    ends, stops = np.full(len(number), -1, dtype=np.int32), np.zeros(len(number), dtype=bool)
    for states, k in number.items():
        exact = min((full[n] for n, e in states if e == 0 and n in full), default=None)
        begun = min((stem[n] for n, e in states if e == 0 and n in stem), default=None)
        near = min((full[n] for n, e in states if e == 1 and n in full and reach[n]), default=None)
        if begun is not None:
            ends[k], stops[k] = begun * 3 + STEM, True
        elif exact is not None:
            ends[k] = exact * 3 + EXACT
        elif near is not None:
            ends[k] = near * 3 + FUZZY
    return Automaton(classes, np.asarray(table, dtype=np.int32), ends, stops)


def _marks(text: str) -> list[bool]:
    """Of each mark of quotation: does it open? Marks between letters are apostrophes."""
    out = []
    for i, c in enumerate(text):
        if c in "\x01\x02":
            out.append(c == "\x01")
        elif c in "\"'":
            left, right = text[i - 1] if i else " ", text[i + 1] if i + 1 < len(text) else " "
            if not left.isalnum() and right.isalnum():
                out.append(True)
            elif not right.isalnum() and not left.isspace():
                out.append(False)
    return out


def _quoted(piece: Piece, word: int, row: int) -> bool:
    """Does the window around a word mark it as a quotation?"""
    first, last = piece.word_at[row], piece.word_at[row + 1] - 1
    a, b = max(first, word - CONTEXT), min(last, word + CONTEXT)
    left = piece.start[a] if a > first else piece.text_at[row]
    right = piece.end[b] if b < last else piece.text_at[row + 1]
    before = piece.data[left : piece.start[word]].tobytes().decode(errors="replace")
    after = piece.data[piece.end[word] : right].tobytes().decode(errors="replace")
    opened, closed = _marks(before + "x"), _marks("x" + after)
    if opened and opened[-1] and closed and not closed[0]:
        return True
    return any(w in REPORTING for w in _REPORTED.findall(before.lower()))


def _evidence(batches: Iterator[pa.RecordBatch], machine: Automaton) -> Iterator[tuple[pa.RecordBatch, Piece, np.ndarray, np.ndarray, np.ndarray]]:
    """For each piece: row, end and weight of each hit."""
    for batch in batches:
        for piece in pieces(batch.column(batch.num_columns - 1), NOT_LETTERS):
            word, end = machine.hits(piece)
            row = np.searchsorted(piece.word_at, word, side="right") - 1
            quoted = [_quoted(piece, w, r) for w, r in zip(word.tolist(), row.tolist(), strict=True)]
            yield batch, piece, row, end, np.where(quoted, QUOTED_WEIGHT, 1.0)


@dataclass
class Model:
    machine: Automaton
    weight: np.ndarray  # by term * 3 + kind
    beta: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def features(self, piece: Piece, row: np.ndarray, end: np.ndarray, weight: np.ndarray) -> np.ndarray:
        words = np.maximum(np.diff(piece.word_at), 1)
        value = weight * self.weight[end]
        out = [np.bincount(row[end % 3 == k], value[end % 3 == k], minlength=piece.rows) for k in (EXACT, FUZZY, STEM)]
        most = np.zeros(piece.rows)
        np.maximum.at(most, row, value)
        total = sum(out)
        return np.stack([np.log1p(np.maximum(x, 0)) for x in out] + [most, np.log1p(100 * np.maximum(total, 0) / words), np.log1p(100 * np.maximum(out[STEM], 0) / words)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(((x - self.mean) / self.scale) @ self.beta[1:] + self.beta[0], -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Newton steps on the mean log loss; the intercept comes first."""
    z, beta = np.c_[np.ones(len(x)), x], np.zeros(x.shape[1] + 1)
    keep = np.diag([0.0] + [ridge] * x.shape[1]) + 1e-9 * np.eye(len(beta))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z / len(x) + keep, z.T @ (p - y) / len(x) + keep @ beta)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def plain(text: Column) -> Column:
    """A text as it is scanned: typographic marks as ASCII ones."""
    return F.translate(text.cast("string"), "".join(TYPOGRAPHIC), "".join(TYPOGRAPHIC.values()))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, y, text) of at most ``rows`` labelled documents that are not held out, a row for each doc_id; the ids are few, so they are sent to the texts."""
    ids = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").try_cast("long").alias("__id")).agg(F.max("toxic").cast("long").alias("y"))
    ids = sampled(ids, "__id", rows)
    texts = docs.select(F.col("doc_id").try_cast("long").alias("doc_id"), plain(F.col("text")).alias("text"))
    return texts.join(F.broadcast(ids), F.col("doc_id") == F.col("__id")).groupBy("doc_id", "y").agg(F.max("text").alias("text"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def lexicon(train: DataFrame) -> list[tuple[str, bool]]:
    """The words and stems that mark toxic documents, best first; a stem stands for all that it begins."""
    counts = train.agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n")).first()
    pos, neg = counts["p"] or 0, counts["n"] or 0
    if not pos:
        return []
    found = F.array_distinct(F.filter(F.split(lower_ascii(F.col("text")), r"[^A-Za-z\x{80}-\x{10FFFF}]+"), lambda w: F.length(w) >= SHORTEST))
    stems = F.flatten(F.transform("w", lambda w: F.array_compact(F.array(*[F.when(F.length(w) > k, F.substring(w, 1, k)) for k in STEM_LENGTHS]))))
    each = train.select("y", found.alias("w")).select("y", "w", F.array_distinct(stems).alias("s"))
    marks = each.select("y", F.explode("w").alias("term"), F.lit(False).alias("stem")).unionByName(each.select("y", F.explode("s").alias("term"), F.lit(True).alias("stem")))
    table = marks.groupBy("term", "stem").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n")).filter(F.col("p") >= MIN_SUPPORT)
    odds = F.log((F.col("p") + 0.5) / (pos + 1)) - F.log((F.col("n") + 0.5) / (neg + 1))
    # twice the log-likelihood of the four cells (toxic or not, with the term or without) over that of chance
    cell = lambda seen, of: F.when(seen > 0, seen * F.log(seen * (pos + neg) / of)).otherwise(0.0)
    p, n = F.col("p"), F.col("n")
    chance = 2 * (cell(p, (p + n) * pos) + cell(n, (p + n) * neg) + cell(pos - p, (pos + neg - p - n) * pos) + cell(neg - n, (pos + neg - p - n) * neg))
    table = table.withColumn("odds", odds).filter((F.col("odds") >= MIN_ODDS) & (chance >= SURE))
    # what passes comes from a bounded sample, so the list is bounded too
    best = table.orderBy((F.col("odds") * F.sqrt("p")).desc(), F.length("term"), "term", "stem").collect()
    words = [r for r in best if not r["stem"]]
    out: list[tuple[str, bool]] = []
    for r in best:
        # a stem that is no more than one word of the lexicon says nothing new
        if r["stem"] and any(w["term"].startswith(r["term"]) and w["p"] >= 0.8 * r["p"] for w in words):
            continue
        if any(s and r["term"].startswith(t) for t, s in out):
            continue
        out.append((r["term"], r["stem"]))
    return out


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    train = written(training_rows(docs, labels))
    terms = lexicon(train)
    if not terms:
        return None
    machine = compile_lexicon(terms)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, piece, row, end, weight in _evidence(batches, shared.value):
            ids = batch.column(0).slice(piece.first_row, piece.rows)
            y = batch.column(1).slice(piece.first_row, piece.rows)
            order = np.argsort(row, kind="stable")
            at = np.searchsorted(row[order], np.arange(piece.rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(v[order].astype(np.float64))) for v in (end, weight)]
            yield pa.RecordBatch.from_arrays([ids, y.cast(pa.int64()), pa.array(np.diff(piece.word_at).astype(np.int64)), *lists], names=["doc_id", "y", "words", "ends", "weights"])

    rows = train.mapInArrow(count, "doc_id long, y long, words long, ends array<double>, weights array<double>").orderBy("doc_id").collect()
    y = np.array([r["y"] for r in rows], dtype=float)
    pos, neg = np.zeros(3 * len(terms)), np.zeros(3 * len(terms))
    for r in rows:
        for e in {int(e) for e in r["ends"]}:
            (pos if r["y"] else neg)[e] += 1
    weight = np.log((pos + 0.5) / (y.sum() + 1)) - np.log((neg + 0.5) / ((1 - y).sum() + 1))
    weight = np.where(pos + neg > 0, weight, 1.0)
    model = Model(machine, weight, np.zeros(7), np.zeros(6), np.ones(6))
    x = np.zeros((len(rows), 6))
    for i, r in enumerate(rows):
        one = Piece(0, np.zeros(0, np.uint8), np.zeros(2, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.array([0, r["words"]]))
        ends = np.array(r["ends"], dtype=np.int64)
        x[i] = model.features(one, np.zeros(len(ends), dtype=np.int64), ends, np.array(r["weights"], dtype=float))[0]
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    model.beta = fit_logistic((x - model.mean) / model.scale, y)
    return model


def scores(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``__toxicity``; a column of that name gives way."""
    docs = docs.drop("__toxicity")
    if model is None:
        return docs.withColumn("__toxicity", F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # columns go by place, so their names can't clash with what is added
    own = [f"c{i}" for i in range(len(docs.columns))]
    schema = StructType([*(StructField(c, f.dataType) for c, f in zip(own, docs.schema.fields, strict=True)), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, piece, row, end, weight in _evidence(batches, shared.value.machine):
            part = batch.slice(piece.first_row, piece.rows)
            score = pa.array(shared.value.score(shared.value.features(piece, row, end, weight)))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], score], names=[*own, "score"])

    return docs.select("*", plain(F.col("text")).alias("__plain")).toDF(*own, "scanned").mapInArrow(run, schema).toDF(*docs.columns, "__toxicity")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's score."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = scores(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__toxicity").alias("score"), (F.col("__toxicity") >= THRESHOLD).cast("int").alias("predicted"))

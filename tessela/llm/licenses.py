r"""License texts in documents, by an exact set-similarity join with license templates.

A template is a set of words with the share of them that a match must hold: ``THRESHOLD`` for whole texts and notices,
all for short sentences. A document's blocks are, for each template, all runs of ``SPAN`` times as many words as its
text has, whatever line and sentence ends lie in them. Every block that holds the share is found:

- words are ordered by how often all documents hold them, the rarest first (one pass over the corpus);
- prefix filter: a template of n words that must share a of them meets a match in its n - a + 1 rarest words, so only
  places of these are looked at;
- length filter: around a place there must be at least a words of the template;
- positional filter: at the place of the i-th word only words from the i-th on count, as a block with a rarer one is
  met at that one's place; at least a of them must be near.

What passes is compared in full by a window that slides over the places of the template's words. Templates come as a
table of at most ``MAX_TEMPLATES`` rows (more raise) and go to the tasks.

Beside this, base phrases are counted wherever their words stand side by side.

Defined results: null and empty texts have no words and no label; texts may be of any length; words are runs of ASCII
letters, digits and non-ASCII characters, A-Z lower-cased; words equally frequent are ordered by their letters; a
template without words matches nothing; repeated rows are scanned one by one; other columns, whatever their names,
are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessela.llm.license_texts import SENTENCES, TEXTS
from tessela.llm.tokens import NOT_ALNUM, Piece, pieces

THRESHOLD = 0.8
#: Words of a block over those of the template's text: room for some that are put in between.
SPAN = 1.25
MAX_TEMPLATES = 10_000

#: The base phrases with their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: (label, text, share of words that must be held).
TEMPLATES = (*((label, text, THRESHOLD) for label, text in TEXTS), *((label, text, 1.0) for label, text in SENTENCES))

Templates = tuple[tuple[str, str, float], ...]

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.translate(_LOWER))


def _hashes(words: list[str]) -> np.ndarray:
    (piece,) = pieces(pa.array([" ".join(words)]), NOT_ALNUM)
    return piece.hashes()


class Vocabulary:
    """Finds a few words among many: their hashes, sorted, behind a bitmap."""

    def __init__(self, words: list[str]) -> None:
        self.words = sorted(set(words))
        hashes = _hashes(self.words)
        self.order = np.argsort(hashes)
        self.hash = hashes[self.order]
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[(self.hash >> np.uint64(44)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, number of the word)."""
        at = np.flatnonzero(self.seen[(h >> np.uint64(44)).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.hash, h[at]), len(self.hash) - 1)
        good = self.hash[k] == h[at]
        return at[good], self.order[k[good]]


def frequencies(docs: DataFrame, vocabulary: Vocabulary) -> dict[str, int]:
    """How often all documents hold each word of the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value.words), dtype=np.int64)
        for batch in batches:
            for piece in pieces(batch.column(0), NOT_ALNUM):
                total += np.bincount(shared.value.find(piece.hashes())[1], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["word", "n"])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {vocabulary.words[r["word"]]: r["n"] for r in rows}


@dataclass
class Template:
    """``rank`` is a word's place among the template's, the rarest first, by the vocabulary's numbers; -1 for others."""

    label: str
    words: int
    need: int
    span: int
    rank: np.ndarray


class Matcher:
    def __init__(self, templates: Templates, phrases: tuple[tuple[str, str], ...], frequency: dict[str, int]) -> None:
        split = [(label, words_of(text), share) for label, text, share in templates]
        split = [x for x in split if x[1]]
        self.phrases = [(words_of(text), label) for text, label in phrases]
        self.vocabulary = Vocabulary([w for _, t, _ in split for w in t] + [w for p, _ in self.phrases for w in p])
        number = {w: i for i, w in enumerate(self.vocabulary.words)}
        self.phrases = [([number[w] for w in p], label) for p, label in self.phrases]
        self.templates = []
        for label, text, share in split:
            rank = np.full(len(number), -1, dtype=np.int32)
            for i, w in enumerate(sorted(set(text), key=lambda w: (frequency.get(w, 0), w))):
                rank[number[w]] = i
            n = len(set(text))
            self.templates.append(Template(label, n, max(1, math.ceil(share * n - 1e-9)), math.ceil(SPAN * len(text) - 1e-9), rank))
        #: Places looked at, and left after each filter, to see what they prune.
        self.passed = {"words": 0, "prefix": 0, "length": 0, "positional": 0}

    def passages(self, at: np.ndarray, word: np.ndarray, word_at: np.ndarray) -> dict[tuple[int, int], float]:
        """Text and template, and the largest containment in a block, of those that meet. ``at`` ascends."""
        out: dict[tuple[int, int], float] = {}
        for t, template in enumerate(self.templates):
            rank = template.rank[word]
            place, rank = at[rank >= 0], rank[rank >= 0]
            hit = np.flatnonzero(rank <= template.words - template.need)
            row = np.searchsorted(word_at, place[hit], side="right") - 1
            low = np.searchsorted(place, np.maximum(place[hit] - template.span + 1, word_at[row]), side="left")
            high = np.searchsorted(place, np.minimum(place[hit] + template.span, word_at[row + 1]), side="left")
            enough = np.flatnonzero(high - low >= template.need)
            self.passed["words"] += len(place)
            self.passed["prefix"] += len(hit)
            self.passed["length"] += len(enough)
            for k in enough.tolist():
                i, first = int(row[k]), int(rank[hit[k]])
                if out.get((i, t)) == 1.0:
                    continue
                own = low[k] + np.flatnonzero(rank[low[k] : high[k]] >= first)
                if len(own) < template.need:
                    continue
                self.passed["positional"] += 1
                best = _most(place[own].tolist(), rank[own].tolist(), template.span)
                if best >= template.need:
                    out[i, t] = max(best / template.words, out.get((i, t), 0.0))
        return out

    def scan(self, piece: Piece, ids: pa.Array) -> pa.RecordBatch:
        n = piece.rows
        count = np.diff(piece.word_at)
        at, word = self.vocabulary.find(piece.hashes())
        row = np.searchsorted(piece.word_at, at, side="right") - 1
        n_base, first, last = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        base: list[set[str]] = [set() for _ in range(n)]
        number = np.full(len(piece.start) + 8, -1, dtype=np.int32)
        number[at] = word
        for phrase, label in self.phrases:
            start = at[word == phrase[0]]
            for j, w in enumerate(phrase):
                start = start[number[start + j] == w]
            r = np.searchsorted(piece.word_at, start, side="right") - 1
            inside = start + len(phrase) <= piece.word_at[r + 1]
            start, r = start[inside], r[inside]
            n_base += np.bincount(r, minlength=n)
            place = start - piece.word_at[r]
            for i, p in zip(r.tolist(), place.tolist(), strict=True):
                base[i].add(label)
                first[i] = p if first[i] < 0 else min(first[i], p)
                last[i] = max(last[i], p)
        none = first < 0
        every, score = [set(x) for x in base], (n_base > 0) * 1.0
        for (i, t), share in self.passages(at, word, piece.word_at).items():
            every[i].add(self.templates[t].label)
            score[i] = max(score[i], share)
        joined = lambda sets: pa.array([",".join(sorted(x)) for x in sets], type=pa.string())
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        return pa.RecordBatch.from_arrays([ids, pa.array(count.astype(np.int64)), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none), joined(base), joined(every), pa.array(score)], names=names)


def _most(places: list[int], words: list[int], span: int) -> int:
    """The most different words within ``span`` places."""
    count: dict[int, int] = {}
    best = left = 0
    for p, w in zip(places, words, strict=True):
        count[w] = count.get(w, 0) + 1
        while p - places[left] >= span:
            gone = words[left]
            left += 1
            count[gone] -= 1
            if not count[gone]:
                del count[gone]
        best = max(best, len(count))
    return best


def template_rows(table: DataFrame) -> Templates:
    """A table (label, text, share) as templates; rows without label, text or share are left out."""
    rows = table.select("label", "text", F.col("share").cast("double").alias("share")).dropna().limit(MAX_TEMPLATES + 1).collect()
    if len(rows) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    return tuple(sorted((r["label"], r["text"], r["share"]) for r in rows))


def scan(docs: DataFrame, templates: Templates | DataFrame = TEMPLATES, phrases: tuple[tuple[str, str], ...] = PHRASES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of each document."""
    templates = template_rows(templates) if isinstance(templates, DataFrame) else templates
    words = Vocabulary([w for _, t, _ in templates for w in words_of(t)])
    matcher = docs.sparkSession.sparkContext.broadcast(Matcher(templates, phrases, frequencies(docs, words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(1), NOT_ALNUM):
                yield matcher.value.scan(piece, batch.column(0).slice(piece.first_row, piece.rows))

    texts = docs.select(F.col("doc_id").try_cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's license labels."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))

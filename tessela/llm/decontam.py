r"""Benchmark passages in documents, by SimHash fingerprints of item-sized windows.

A passage is compared as a weighted multiset of shingles of five words; a shingle's weight falls with the number of
items that hold it. For every item length that occurs, documents are looked at through windows of as many words, at
every word; a document that is shorter than an item is one window for it as a whole. A window gets a 128-bit SimHash. It is a candidate for an item of its length if at most ``RADIUS`` bits
differ: the fingerprint is cut into ``BLOCKS`` blocks of 16 bits, and of two within the radius some block differs in
at most ``RADIUS // BLOCKS`` bits, so an equi-join with all neighbours of the items' blocks finds every one.
Candidates are verified by exact weighted similarity of at least ``SIMILARITY``. At exactly that similarity about 98 %
of windows lie within the radius, above 0.8 practically all: the radius is what the method guarantees.

A window whose shingles known from items of its length have less than ``SIMILARITY`` of its weight can't be similar
to any of them, so its fingerprint isn't worked out: nothing is lost by that. Equal windows of many documents are
joined once. Benchmarks of any size are worked off in slices of about ``SLICE`` shingles, each sent to the tasks.

Defined results: words as for near-duplicates; an item of fewer than five words is one shingle, as is a window for
it; null and blank items and texts match nothing; repeated items and documents give their own pairs, but equal
(doc_id, item_id) only once, with the best of their windows; a null doc_id or item_id takes part like any other (all
rows without an item_id are one item); texts of any length are looked at whole; other columns, whatever their names,
are not looked at; an empty table gives no pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessela.llm.shared import written
from tessela.llm.tokens import Piece, mix64, pieces

SHINGLE = 5
SIMILARITY = 0.75
RADIUS = 31
BLOCKS = 8
SLICE = 400_000

_U = np.uint64
_MASKS = [sum(1 << b for b in bits) for n in range(RADIUS // BLOCKS + 1) for bits in combinations(range(16), n)]


def _grams(h: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros(max(len(h) - k + 1, 0), dtype=_U)
    for j in range(k):
        out = mix64(out + h[j : j + len(out)] + _U(j + 1))
    return out


def _fingerprints(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Rows of shingles and weights to rows of 8 blocks of 16 bits."""
    out = np.zeros((len(shingles), BLOCKS), dtype=np.int32)
    for i in range(0, len(shingles), 64):
        s = shingles[i : i + 64]
        two = np.stack([s, mix64(s + _U(77))], axis=-1)
        bits = np.unpackbits(two.view(np.uint8).reshape(*s.shape, 16), axis=-1).astype(np.float32)
        signs = np.einsum("wm,wmb->wb", weights[i : i + 64].astype(np.float32), 2 * bits - 1) >= 0
        out[i : i + 64] = np.packbits(signs, axis=-1).reshape(len(s), BLOCKS, 2).astype(np.int32) @ np.array([256, 1], dtype=np.int32)
    return out


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch.column(1)):
            h = piece.hashes()
            length = np.diff(piece.word_at)
            grams = [_grams(h[piece.word_at[i] : piece.word_at[i + 1]], min(SHINGLE, max(int(length[i]), 1))) for i in range(piece.rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(piece.first_row, piece.rows), pa.array(length.astype(np.int32)), pa.array([g.view(np.int64) for g in grams], type=pa.list_(pa.int64()))], names=["item_id", "length", "shingles"])


class Index:
    """The shingles of a slice of items: sorted hashes with weights, and the lengths of the items that hold them."""

    def __init__(self, rows: list[tuple[int, int, float]], unknown: float) -> None:
        hashes = np.array([r[0] for r in rows], dtype=np.int64).view(_U)
        order = np.argsort(hashes, kind="stable")
        self.hash = hashes[order]
        self.length = np.array([r[1] for r in rows], dtype=np.int32)[order]
        self.weight = np.array([r[2] for r in rows], dtype=np.float64)[order]
        self.unknown = unknown
        self.seen = np.zeros(1 << 22, dtype=bool)
        self.seen[(self.hash >> _U(42)).astype(np.int64)] = True
        self.sizes = sorted({min(SHINGLE, int(n)) for n in self.length})

    def find(self, grams: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, length, weight) of each place whose gram an item has, for each length of such items."""
        place = np.flatnonzero(self.seen[(grams >> _U(42)).astype(np.int64)])
        low, high = (np.searchsorted(self.hash, grams[place], side=s) for s in ("left", "right"))
        n = high - low
        at = np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        place, length, weight = np.repeat(place, n), self.length[at], self.weight[at]
        good = np.minimum(length, SHINGLE) == k
        return place[good], length[good], weight[good]


def _windows(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch.column(1)):
            h = piece.hashes()
            for k in index.sizes:
                grams = _grams(h, k)
                if not len(grams):
                    continue
                place, length, weight = index.find(grams, k)
                if not len(place):
                    continue
                each = np.full(len(grams), index.unknown)
                each[place] = weight
                total = np.r_[0, np.cumsum(each)]
                for n in np.unique(length).tolist():
                    m = max(n - SHINGLE + 1, 1)
                    at, w = place[length == n], weight[length == n]
                    start = np.unique((at[:, None] - np.arange(m)).ravel())
                    start = start[(start >= 0) & (start + m <= len(grams))]
                    row = np.searchsorted(piece.word_at, start, side="right") - 1
                    start = start[start + n <= piece.word_at[row + 1]]
                    # texts that are shorter than the item, by the number of their grams
                    row = np.unique(np.searchsorted(piece.word_at, at, side="right") - 1)
                    words = piece.word_at[row + 1] - piece.word_at[row]
                    short = {int(g): piece.word_at[row[words == g]] for g in np.unique(words[(words < n) & (words >= k)])}
                    for size, begin in ((m, start), *((g - k + 1, at_) for g, at_ in short.items())):
                        yield from _described(batch, piece, grams, each, total, at, w, n, size, begin)


def _described(batch: pa.RecordBatch, piece: Piece, grams: np.ndarray, each: np.ndarray, total: np.ndarray, at: np.ndarray, w: np.ndarray, n: int, size: int, start: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The windows of ``size`` grams from ``start`` on, for items of ``n`` words, of which enough is known."""
    known = np.r_[0, np.cumsum(w)]
    share = known[np.searchsorted(at, start + size)] - known[np.searchsorted(at, start)]
    start = start[share >= (SIMILARITY - 1e-9) * (total[start + size] - total[start])]
    if not len(start):
        return
    row = np.searchsorted(piece.word_at, start, side="right") - 1
    span = start[:, None] + np.arange(size)
    shingles, weights = grams[span], each[span]
    name = np.zeros((2, len(start)), dtype=_U)
    for j in range(size):
        name = mix64(name + shingles[:, j] + _U(1) + np.array([[0], [99]], dtype=_U))
    ids = batch.column(0).slice(piece.first_row, piece.rows).take(pa.array(row))
    ends = pa.array(np.arange(0, len(start) + 1, dtype=np.int32) * size)
    blocks = pa.ListArray.from_arrays(pa.array(np.arange(0, len(start) + 1, dtype=np.int32) * BLOCKS), pa.array(_fingerprints(shingles, weights).ravel()))
    yield pa.RecordBatch.from_arrays(
        [ids, pa.array(np.full(len(start), n, dtype=np.int32)), pa.array(name[0].view(np.int64)), pa.array(name[1].view(np.int64)), blocks, pa.ListArray.from_arrays(ends, pa.array(shingles.ravel().view(np.int64))), pa.ListArray.from_arrays(ends, pa.array(weights.ravel()))],
        names=["doc_id", "length", "a", "b", "blocks", "shingles", "weights"],
    )


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the exact similarity of two weighted multisets, those of all rows at once."""
    for batch in batches:
        ours, our_weights, theirs, their_weights = (batch.column(k) for k in range(3, 7))
        row = np.concatenate([np.repeat(np.arange(batch.num_rows), c.value_lengths().to_numpy(zero_copy_only=False)) for c in (ours, theirs)])
        name = np.concatenate([c.flatten().to_numpy() for c in (ours, theirs)])
        weight = np.concatenate([c.flatten().to_numpy() for c in (our_weights, their_weights)])
        mine = np.arange(len(row)) < len(ours.flatten())
        order = np.lexsort((~mine, name, row))  # of a shingle that both have ours comes first, and its weight counts
        row, name, weight, mine = row[order], name[order], weight[order], mine[order]
        first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (name[1:] != name[:-1])]) if len(row) else np.zeros(0, np.int64)
        a = np.add.reduceat(mine.astype(np.int64), first) if len(first) else first
        b = np.add.reduceat((~mine).astype(np.int64), first) if len(first) else first
        both, either = (np.bincount(row[first], f(a, b) * weight[first], minlength=batch.num_rows) for f in (np.minimum, np.maximum))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(both / np.maximum(either, 1e-300))], names=["a", "b", "item_id", "similarity"])


def _fingerprint_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shingles, weights = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("shingles", "weights"))
        prints = [_fingerprints(np.array([s], dtype=np.int64).view(_U), np.array([w]))[0] for s, w in zip(shingles, weights, strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, type=pa.list_(pa.int32()))], names=[*batch.schema.names, "blocks"])


def _distance(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, length, shingles, weights, blocks) of the items that have words."""
    items = benchmark.select(F.col("item_id").try_cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = written(items.mapInArrow(_items, "item_id long, length int, shingles array<long>").filter("length > 0"))
    each = items.select("item_id", "length", "shingles", F.posexplode("shingles").alias("place", "shingle"))
    held = each.groupBy("shingle").agg(F.countDistinct(F.coalesce(F.col("item_id").cast("string"), F.lit(""))).alias("df"))
    n = items.count()
    weight = F.log(1 + F.lit(float(n)) / F.col("df"))
    listed = each.join(held, "shingle").groupBy("item_id", "length", "shingles").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", weight.alias("w")))), lambda x: x["w"]).alias("weights"))
    # items that occur twice have each weight twice
    listed = listed.withColumn("weights", F.when(F.size("weights") == F.size("shingles"), F.col("weights")).otherwise(F.transform("shingles", lambda _, i: F.get("weights", (i * F.size("weights") / F.size("shingles")).cast("int")))))
    return written(listed.mapInArrow(_fingerprint_items, "item_id long, length int, shingles array<long>, weights array<double>, blocks array<int>"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity): each item that a document holds a passage of, with its best window."""
    spark = docs.sparkSession
    items = items_of(benchmark)
    n, total = items.agg(F.count(F.lit(1)), F.sum(F.size("shingles"))).first()
    texts = docs.select(F.col("doc_id").try_cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    slices = -(-(total or 0) // SLICE)
    out = None
    for k in range(slices):
        part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == k)
        rows = part.select("length", F.explode(F.arrays_zip("shingles", "weights")).alias("x")).select("x.shingles", "length", "x.weights").distinct().collect()
        index = spark.sparkContext.broadcast(Index([tuple(r) for r in rows], float(np.log(1 + n))))
        found = _leaks(texts, part, index)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "doc_id long, item_id long, similarity double")
    return out


def _leaks(texts: DataFrame, items: DataFrame, index) -> DataFrame:  # noqa: ANN001 (a broadcast variable)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _windows(batches, index.value)

    windows = written(texts.mapInArrow(run, "doc_id long, length int, a long, b long, blocks array<int>, shingles array<long>, weights array<double>"))
    one = windows.groupBy("length", "a", "b").agg(F.first("blocks").alias("blocks"), F.first("shingles").alias("shingles"), F.first("weights").alias("weights"))
    one = written(one)
    probes = one.select("length", "a", "b", F.posexplode("blocks").alias("block", "value"))
    masks = F.split(F.lit(",".join(map(str, _MASKS))), ",").cast("array<int>")
    near = items.select("item_id", "length", F.posexplode("blocks").alias("block", "v")).select("item_id", "length", "block", F.explode(F.transform(masks, lambda m: F.col("v").bitwiseXOR(m))).alias("value"))
    # the neighbours are many times the items, which the planner can't know
    close = probes.join(near.hint("merge"), ["length", "block", "value"]).select("a", "b", "item_id").distinct()
    full = close.join(one.select("a", "b", "blocks", "shingles", "weights"), ["a", "b"])
    full = full.join(items.select(F.col("item_id").alias("i2"), F.col("length").alias("l2"), F.col("blocks").alias("theirs"), F.col("shingles").alias("s2"), F.col("weights").alias("w2")), F.col("item_id").eqNullSafe(F.col("i2")))
    full = full.filter(_distance("blocks", "theirs") <= RADIUS)
    sure = full.select("a", "b", "item_id", "shingles", "weights", "s2", "w2").mapInArrow(_similar, "a long, b long, item_id long, similarity double").filter(F.col("similarity") >= SIMILARITY)
    return windows.select("doc_id", "a", "b").join(sure, ["a", "b"]).groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a passage of a benchmark item, with the item."""
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

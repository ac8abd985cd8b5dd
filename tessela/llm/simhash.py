r"""Near-duplicate documents by SimHash, joined in a grid of segment bit counts.

A document's fingerprint has bit i if more than half of its shingles' XXH64 have it. Documents of one fingerprint are
one vertex. A fingerprint is embedded as the bit counts of its 32 segments of two bits: the Manhattan distance of two
embeddings is at most the Hamming distance of the fingerprints. So of fingerprints within ``RADIUS`` the embeddings lie
within ``RADIUS`` too, and in one of the ``GRIDS`` parts of their dimensions within ``RADIUS // GRIDS`` = 1: in the same
cell of that part's grid, or in two that differ by one in one dimension. Each fingerprint is a member of its own cell
of each grid, and looks into those one step up (the lower one of two neighbours finds the higher). What meets in a cell
is verified on the fingerprints themselves, exactly.

A cell with more than ``BLOCK`` members or others is cut into blocks of members times others, each a group of its own;
small cells share groups of about ``GROUP`` rows. A group returns a forest of its links, at most one row for each
fingerprint, so that hot cells make no rows that grow with pairs. Components are those of all forests.

Defined results: words are runs without white space, A-Z lower-cased; repeated shingles count; fewer than four words
are one shingle; null and blank texts have fingerprint 0 and link like any other; texts may be of any length; rows that
share a doc_id are looked at one by one; ties of bits (half of the shingles) give 0; ties of components go to the least
doc_id; a null doc_id, and one that is no whole number, joins its class but names none (component null if the class has
no other); other columns, whatever their names, are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessela.llm.graph import components
from tessela.llm.shared import written

SHINGLE = 4
SEED = 42
RADIUS = 4
#: Bits of a segment are two; the parts of the 32 segments that have a grid each.
GRIDS = (range(11), range(11, 22), range(22, 32))
#: Members, and others, of a cell that meet in one task at most.
BLOCK = 4096
#: Rows of the small cells that are worked on together.
GROUP = 100_000
#: Shingles hashed, and pairs verified, at once.
CHUNK = 1 << 16
PIECE_HITS = 1 << 22

_EVEN = 0x5555555555555555
_hash = functools.partial(xxhash.xxh64_intdigest, seed=SEED)


def fingerprint(text: bytes) -> int:
    """The 64 bits of a text in UTF-8."""
    words = text.lower().split()  # of bytes: A-Z alone, and ASCII white space alone
    if not words:
        return 0
    k = min(SHINGLE, len(words))
    n, line = len(words) - k + 1, b" ".join(words)
    start = np.r_[0, np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        stop = min(at + CHUNK, n)
        spans = zip(start[at:stop].tolist(), (start[at + k : stop + k] - 1).tolist(), strict=True)
        hashes = np.array([_hash(line[a:b]) for a, b in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = (x.as_buffer() for x in batch.column(1))
        out = np.fromiter((fingerprint(bytes(t)) if t is not None else 0 for t in texts), dtype=np.uint64, count=batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for each document; the fingerprint's bits as a signed number."""
    return docs.select(F.col("doc_id").try_cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(_prints, "doc_id long, fp long")


def _signed(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


def segment_counts(fp: Column) -> Column:
    """The embedding: the bit count of each segment in the segment's two bits."""
    other = F.shiftrightunsigned(fp, 1)
    one, two = fp.bitwiseXOR(other).bitwiseAND(F.lit(_EVEN)), fp.bitwiseAND(other).bitwiseAND(F.lit(_EVEN))
    return one.bitwiseOR(F.shiftleft(two, 1))


def _cells(prints: DataFrame) -> DataFrame:
    """(fp, cell, member): a fingerprint's own cell of each grid, and those one step up in one dimension.

    A cell is the embedding with all but a grid's dimensions set to 0, so cells of two grids differ, but for the one
    without any bit, which they share.
    """
    counts, look = segment_counts(F.col("fp")), []
    for grid in GRIDS:
        cell = counts.bitwiseAND(_signed(sum(3 << 2 * s for s in grid)))
        look.append(F.struct(cell.alias("cell"), F.lit(True).alias("member")))
        for s in grid:
            here = F.shiftrightunsigned(counts, 2 * s).bitwiseAND(F.lit(3))
            step = F.when(here == 0, _signed(1 << 2 * s)).when(here == 1, _signed(3 << 2 * s))  # 0 to 1, 1 to 2
            look.append(F.when(here < 2, F.struct(cell.bitwiseXOR(step).alias("cell"), F.lit(False).alias("member"))))
    return prints.select("fp", F.explode(F.array_compact(F.array(*look))).alias("x")).select("fp", "x.cell", "x.member")


def _forest(u: np.ndarray, v: np.ndarray, labels: np.ndarray) -> None:
    """Joins the components that ``labels`` has (the least node of each) by the links (u, v)."""
    while len(u):
        a, b = labels[u], labels[v]
        apart = a != b
        if not apart.any():
            return
        u, v = u[apart], v[apart]
        np.minimum.at(labels, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (further := labels[labels] != labels).any():
            labels[further] = labels[labels[further]]


def _linked(rows: pa.Table) -> pa.Table:
    """Of a group's rows (fp, cell, member, other): a forest of the links between members and others of equal cells."""
    fp, cell = rows.column("fp").to_numpy().view(np.uint64), rows.column("cell").to_numpy()
    nodes, at = np.unique(fp, return_inverse=True)
    member, other = (np.flatnonzero(rows.column(c).to_numpy(zero_copy_only=False)) for c in ("member", "other"))
    member = member[np.argsort(cell[member], kind="stable")]
    low, high = (np.searchsorted(cell[member], cell[other], side=side) for side in ("left", "right"))
    labels, total, i = np.arange(len(nodes)), np.r_[0, np.cumsum(high - low)], 0
    while i < len(other):
        j = max(i + 1, int(np.searchsorted(total, total[i] + PIECE_HITS, side="right")) - 1)
        k = high[i:j] - low[i:j]
        met = member[np.repeat(low[i:j] - np.r_[0, np.cumsum(k)[:-1]], k) + np.arange(k.sum())]
        asks = np.repeat(other[i:j], k)
        near = np.flatnonzero(np.bitwise_count(fp[met] ^ fp[asks]) <= RADIUS)
        _forest(at[met[near]], at[asks[near]], labels)
        i = j
    tied = np.flatnonzero(labels != np.arange(len(nodes)))
    return pa.table({"u": pa.array(nodes[tied].view(np.int64)), "v": pa.array(nodes[labels[tied]].view(np.int64))})


def links(prints: DataFrame, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """(u, v): links between distinct fingerprints that give the components of all pairs within ``RADIUS``. ``prints`` has (fp), each once."""
    rows = _cells(prints)
    groups = max(1, prints.count() * 28 // group)
    size = rows.groupBy("cell").agg(F.count_if("member").alias("members"), F.count(F.lit(1)).alias("others"))
    hot = written(size.filter((F.col("members") > 0) & (F.col("others") > block)))
    rows = rows.join(hot, "cell", "left")
    own = lambda salt, n: F.pmod(F.xxhash64("fp", F.lit(salt)), F.coalesce(F.ceil(F.col(n) / block), F.lit(1)))
    rows = rows.withColumns({"r": own(1, "members"), "c": own(2, "others"), "rs": F.coalesce(F.ceil(F.col("members") / block), F.lit(1)), "cs": F.coalesce(F.ceil(F.col("others") / block), F.lit(1))})
    # a block is a row of members and a column of others: members go to all columns, others to all rows
    along = lambda n, f: F.transform(F.sequence(F.lit(0).cast("long"), F.col(n) - 1), f)
    down = along("rs", lambda r: F.struct(r.alias("r"), F.col("c").alias("c")))
    across = along("cs", lambda c: F.struct(F.col("r").alias("r"), c.alias("c")))
    rows = rows.select("fp", "cell", "member", "members", F.col("r").alias("row"), F.col("c").alias("col"), F.explode(F.when(F.col("member"), F.array_union(across, down)).otherwise(down)).alias("b"))
    key = F.when(F.col("members").isNull(), F.pmod(F.xxhash64("cell"), F.lit(groups))).otherwise(F.xxhash64("cell", "b.r", "b.c"))
    dealt = rows.select(key.alias("key"), "fp", "cell", (F.col("member") & (F.col("b.r") == F.col("row"))).alias("member"), (F.col("b.c") == F.col("col")).alias("other"))
    return dealt.groupBy("key").applyInArrow(_linked, "u long, v long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id), a row for each document."""
    each = written(fingerprints(docs))
    prints = written(each.groupBy("fp").agg(F.min("doc_id").alias("first")))
    comps = components(links(prints.select("fp"))).select(F.col("node").alias("fp"), "component")
    placed = written(prints.join(comps, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("component")))
    named = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    named = written(placed.join(named, "component").select("fp", "component_id"))
    return each.join(named, "fp").select("doc_id", "fp", "component_id")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's fingerprint and component."""
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

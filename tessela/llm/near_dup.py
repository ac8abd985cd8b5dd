r"""Near-duplicate documents by a chosen-path set similarity join over minwise tokens.

A document is the set of its distinct shingles of five words. Documents with the same set are one vertex. Each
vertex has minwise tokens: for each of ``TOKENS`` hash functions the least hash of its shingles. The join grows
``TREES`` trees: a node chooses positions of the tokens, and its documents go to the child of their token there, so
two documents of similarity s follow each other into a child with probability s. Trees begin with two positions of
their own; down to depth ``WIDE`` nodes choose two, below 4 / 3 on the average, the threshold's inverse.

Nodes of at most ``SMALL`` documents are compared exhaustively. In a larger one the documents are compared with a few
pivots first, which leaves few components in a group of copies. If the largest component then holds one in ``DENSE``
of the node, branching would not tell its surroundings apart: what is not in it is compared with all of it, in
blocks (``_grid``), and the node goes on without it. What a node has left is compared within itself if it is at most
``MEDIUM`` documents (in blocks too, those whose sketch is like another's), and branches otherwise. A node whose documents are all in one component ends. What
is still large at ``DEPTH`` is compared within itself whatever its size. Blocks give at most one link for each
document and component, so hot groups make no rows that grow with pairs.

In small nodes and for pivots a sketch passes pairs on: the hash range is cut into ``BINS`` bins, and a set keeps two
bits of its least hash in each. In a bin where two sets differ lies a shingle that only one of them has. Sets of up to
``SURE`` shingles are passed on unless there are more such bins than a linked pair can have, so no link of theirs is
refused. For larger sets the share of equal bins gives the similarity or (by chance hits) more, to 0.02; estimates
below ``ESTIMATE`` are five deviations under what the threshold gives. Links are confirmed on the full sets, read
again from the texts, and no pair of these is confirmed twice.

Defined results: words are runs without white space, A-Z lower-cased; fewer than five words are one shingle; null
and blank texts have no shingle, link with nothing and are kept; texts may be of any length, a set is compared whole;
rows that share a doc_id are one vertex, ties go to the least doc_id; a null doc_id joins its class but names none
(component null if the class has no other, and then kept); other columns, whatever their names, are not looked at;
an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessela.llm.graph import components
from tessela.llm.shared import written
from tessela.llm.tokens import PIECE_ROWS, bytes_of, mix64, pieces, shingle_sets

SHINGLE = 5
PERCENT = 75
TOKENS = 64
#: Parts of the hash range; a set's sketch has two bits of its least hash in each, or none.
BINS = 256
TREES = 6
#: Positions that the roots branch by; the deeper nodes choose among the others.
ROOTS = TREES * 2
WIDE = 1
DEPTH = 10
SMALL = 32
MEDIUM = 4096
PIVOTS = 4
DENSE = 4
#: Sets of more shingles are passed on by estimate.
SURE = 128
ESTIMATE = 0.66
#: Shingles of a chunk, the ratio of sizes between classes, and equal shingles looked at together.
CHUNK = 1 << 18
SIZE_STEP = 1.4
PIECE_HITS = 1 << 22

_U = np.uint64
_FACTORS = mix64(np.arange(1, TOKENS + 1, dtype=_U)) | _U(1)
_SHIFTS = mix64(np.arange(1001, TOKENS + 1001, dtype=_U))


def _sketch(keys: np.ndarray, rows: int) -> np.ndarray:
    """Of sorted keys (row, hash): for each bin of the hash range 1 to 3 by the first hash in it, 0 if there is none."""
    place = (keys >> _U(52 - BINS.bit_length() + 1)).astype(np.int64)  # row and bin
    first = np.r_[True, place[1:] != place[:-1]] if len(place) else np.zeros(0, bool)
    codes = np.zeros(rows * BINS, dtype=np.uint8)
    codes[place[first]] = (mix64(keys[first] & _U((1 << 52) - 1)) % _U(3)).astype(np.uint8) + 1
    return (codes.reshape(rows, -1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=2, dtype=np.uint8).view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for piece in pieces(batch.column(1)):
            keys = shingle_sets(piece, SHINGLE)
            row, token = (keys >> _U(52)).astype(np.int64), mix64(keys & _U((1 << 52) - 1))
            n = np.bincount(row, minlength=piece.rows)
            full = np.flatnonzero(n)
            at = np.r_[0, np.cumsum(n[full])[:-1]].astype(np.int64)
            a, b = np.zeros(piece.rows, dtype=_U), np.zeros(piece.rows, dtype=_U)
            least = np.zeros((piece.rows, TOKENS), dtype=np.int32)
            if len(full):
                a[full], b[full] = np.add.reduceat(token, at), np.add.reduceat(mix64(token), at)
                for j in range(TOKENS):
                    hashed = ((token * _FACTORS[j] + _SHIFTS[j]) >> _U(32)).astype(np.uint32)
                    least[full, j] = np.minimum.reduceat(hashed, at).view(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, piece.rows + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel())) for x in (least, _sketch(keys, piece.rows))]
            yield pa.RecordBatch.from_arrays([ids.slice(piece.first_row, piece.rows), pa.array(n.astype(np.int64)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), *lists], names=["doc_id", "n", "a", "b", "sig", "packed"])


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n, a, b, sig, packed): size, 128-bit name and minwise tokens and sketch of each document's shingle set."""
    return docs.select(F.col("doc_id").try_cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_sets, "doc_id long, n long, a long, b long, sig array<int>, packed array<bigint>")


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = np.zeros(batch.num_rows, dtype=bool)
        weight = np.diff(bytes_of(batch.column(2))[1]) + np.diff(bytes_of(batch.column(3))[1])
        row, total = 0, np.r_[0, np.cumsum(weight)]
        while row < batch.num_rows:
            stop = min(row + PIECE_ROWS, batch.num_rows, max(row + 1, int(np.searchsorted(total, total[row] + (1 << 22), side="right")) - 1))
            left, right = (_numbered(batch.column(k).slice(row, stop - row)) for k in (2, 3))
            sizes = np.bincount((left >> _U(52)).astype(np.int64), minlength=stop - row) + np.bincount((right >> _U(52)).astype(np.int64), minlength=stop - row)
            both = np.sort(np.concatenate([left, right]))
            both = np.bincount((both[1:][both[1:] == both[:-1]] >> _U(52)).astype(np.int64), minlength=stop - row)
            good[row:stop] = (both > 0) & (100 * both >= PERCENT * (sizes - both))
            row = stop
        mask = pa.array(good)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["u", "v"])


def _numbered(column: pa.Array) -> np.ndarray:
    parts = [shingle_sets(p, SHINGLE) + (_U(p.first_row) << _U(52)) for p in pieces(column)]
    return np.concatenate(parts) if parts else np.zeros(0, _U)


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) whose full shingle sets are similar enough; ``texts`` has (id, text)."""
    side = lambda k: texts.select(F.col("id").alias(k), F.col("text").alias(f"text_{k}"))
    full = pairs.select("u", "v").join(side("u"), "u").join(side("v"), "v").select("u", "v", "text_u", "text_v")
    return full.mapInArrow(_confirm, "u long, v long")


def _alike(a: str, b: str) -> Column:
    """May two signatures belong to linked sets? Sizes decide exactly; sketches refuse no link of small sets, and few of large ones."""
    n, m = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    # of sets with similarity s at most (1 - s) / (1 + s) of n + m are in one only
    able = _differ(a, b) * (100 + PERCENT) <= (n + m) * (100 - PERCENT)
    return (n * 100 >= m * PERCENT) & F.when(m <= SURE, able).otherwise(_estimate(a, b) >= ESTIMATE)


def _bins(a: str, b: str, of: Callable[[Column, Column], Column]) -> Column:
    """How many bins ``of`` leaves in the two sketches: one bit for each."""
    total = F.lit(0)
    for k in range(BINS // 32):
        x = of(F.get(f"{a}.packed", F.lit(k)), F.get(f"{b}.packed", F.lit(k)))
        total = total + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return total


def _differ(a: str, b: str) -> Column:
    """The bins in which the sketches of two sets have different codes."""
    return _bins(a, b, lambda x, y: x.bitwiseXOR(y))


def _estimate(a: str, b: str) -> Column:
    """The similarity of two sets by their sketches: bins with equal codes over bins in use. Chance hits only raise it."""
    used = _bins(a, b, lambda x, y: x.bitwiseOR(y))
    return F.try_divide(used - _differ(a, b), used)


def _children(rows: DataFrame, depth: int) -> DataFrame:
    """The rows of the next level: each goes to the nodes of its tokens at the positions that its node chooses.

    Nodes near the root choose two positions; deeper ones choose a second one in a third of all cases, so that the
    branches shared by two sets of the threshold's similarity neither grow nor die out, and those of others die out.
    """
    position = lambda k: (F.lit(ROOTS) + F.pmod(F.xxhash64("node", F.lit(k)), F.lit(TOKENS - ROOTS))).cast("int")
    child = lambda k: F.xxhash64(F.col("node"), F.lit(k), F.get("sig", position(k)))
    both = F.lit(True) if depth < WIDE else F.pmod(F.xxhash64("node", F.lit(-1)), F.lit(3)) == 0
    go = F.when(both, F.array(child(0), child(1))).otherwise(F.array(child(0)))
    return rows.withColumn("node", F.explode(go))


_ROW = ("node", "rep", "n", "comp")


def _measured(rows: DataFrame) -> DataFrame:
    """Adds a node's ``size``, its largest component ``top`` and ``held``, how many are in it; nodes of one component end.

    What is known of the nodes is written before it meets their rows, so that the engine can split a hot node.
    """
    each = rows.groupBy("node", "comp").agg(F.count(F.lit(1)).alias("k"))
    state = each.groupBy("node").agg(F.sum("k").alias("size"), F.max(F.struct("k", "comp")).alias("m"), F.count(F.lit(1)).alias("comps")).filter("comps > 1")
    state = written(state.select("node", "size", F.col("m.comp").alias("top"), F.col("m.k").alias("held")))
    return rows.select(*_ROW).join(state, "node")


class _Links:
    """What is known so far: confirmed links as components, and the pairs that were confirmed or refused."""

    def __init__(self, docs: DataFrame, sets: DataFrame) -> None:
        self.docs = docs.select(F.col("doc_id").try_cast("long").alias("id"), F.col("text").cast("string").alias("text"))
        self.sets, self.texts, self.comps, self.tried = sets, None, None, None

    def need(self, ids: DataFrame) -> None:
        """Reads the texts of all that will ever be compared."""
        self.texts = written(self.docs.join(ids.distinct(), "id"))

    def untried(self, pairs: DataFrame) -> DataFrame:
        pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        pairs = written(pairs if self.tried is None else pairs.join(self.tried, ["u", "v"], "left_anti"))
        self.tried = pairs if self.tried is None else self.tried.unionByName(pairs)
        return pairs

    def add(self, found: DataFrame) -> None:
        """Takes confirmed links. Later ones are first brought to the components they lie in, so only what is new is worked out."""
        found = written(found)
        if self.comps is None:
            self.comps = components(found)
            return
        of = lambda c: self.comps.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
        edges = found.join(of("u"), "u", "left").join(of("v"), "v", "left").select(F.coalesce("of_u", "u").alias("u"), F.coalesce("of_v", "v").alias("v"))
        edges = written(edges.filter("u <> v").distinct())
        if edges.isEmpty():
            return
        joined = components(edges)
        moved = joined.select(F.col("node").alias("__n"), F.col("component").alias("__to"))
        old = self.comps.join(moved, F.col("component") == F.col("__n"), "left").select("node", F.coalesce("__to", "component").alias("component"))
        new = joined.join(self.comps.select("node"), "node", "left_anti")
        self.comps = written(old.unionByName(new.select("node", "component")))

    def now(self, rows: DataFrame) -> DataFrame:
        """Rows with their component as it is by now."""
        known = self.comps.select(F.col("node").alias("__n"), F.col("component"))
        return rows.drop("comp").join(known, F.col("rep") == F.col("__n"), "left").withColumn("comp", F.coalesce("component", "rep")).select(*_ROW)

    def compare(self, members: DataFrame, others: DataFrame) -> None:
        """Compares each of ``others`` with all ``members`` of its ``group``, both (group, id, comp, n); see ``_grid``."""
        self.add(_grid(members, others, self.texts))


def links(sets: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, component) over all vertices that have a link. ``sets`` has (rep, n, sig, packed).

    Rows of the trees are slim; tokens and sketches join them where they are looked at.
    """
    # the roots branch by positions of their own, so that no two trees begin alike
    roots = F.array(*[F.xxhash64(F.lit(j), F.get("sig", F.lit(j))) for j in range(ROOTS)])
    slim = sets.select("rep", "n", F.col("rep").alias("comp"), F.explode(roots).alias("node"))
    shared = slim.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("top")).filter("size > 1")
    shared = written(shared)
    rows = written(slim.join(shared, "node").select(*_ROW, "top", "size"))
    sketches = sets.select("rep", "packed")
    state = _Links(docs, sets)
    for depth in range(DEPTH + 1):
        small, large = rows.filter(F.col("size") <= SMALL), rows.filter(F.col("size") > SMALL)
        pairs = state.untried(_exhaustive(small.join(sketches, "rep")).unionByName(_pivots(large.join(sketches, "rep"))))
        if depth == 0:
            state.need(pairs.select(F.col("u").alias("id")).unionByName(pairs.select(F.col("v").alias("id"))).unionByName(large.select(F.col("rep").alias("id"))))
        if depth == 0 or not pairs.isEmpty():
            state.add(confirmed(pairs, state.texts))
        if large.isEmpty():
            break
        after = written(_measured(written(state.now(large))).withColumn("dense", F.col("held") * DENSE >= F.col("size")))
        outside = F.col("comp") != F.col("top")
        # what is outside of a dense node's largest component meets the whole of that
        asked = written(after.filter(F.col("dense") & outside).select(F.col("top").alias("of"), F.col("rep").alias("id"), "comp", "n").distinct())
        members = state.comps.select(F.col("component").alias("of"), F.col("node").alias("id"), F.col("component").alias("comp"))
        members = members.join(asked.select("of").distinct(), "of", "left_semi").join(sets.select(F.col("rep").alias("id"), "n"), "id")
        whole = lambda df: df.select(F.xxhash64(F.lit("component"), "of").alias("group"), "id", "comp", "n")
        # and each other, as do all in other nodes, unless there are many: these go on to children
        left = after.filter(~F.col("dense") | outside).withColumn("left", F.col("size") - F.when(F.col("dense"), F.col("held")).otherwise(0))
        within = left.filter(F.col("left") <= MEDIUM).join(sketches, "rep").select(*_ROW, "packed")
        within = within.groupBy("node").applyInArrow(_near_another, "node long, rep long, n long, comp long")
        if depth == DEPTH:
            within = within.unionByName(left.filter(F.col("left") > MEDIUM).select(*_ROW))
        within = written(within).select(F.col("node").alias("group"), F.col("rep").alias("id"), "comp", "n")
        if not asked.isEmpty() or not within.isEmpty():
            state.compare(whole(members).unionByName(within), whole(asked).unionByName(within))
        further = left.filter(F.col("left") > MEDIUM)
        if depth == DEPTH or further.isEmpty():
            break
        rows = written(_children(state.now(further).join(sets.select("rep", "sig"), "rep"), depth).select(*_ROW))
        rows = written(_measured(rows).select(*_ROW, "top", "size"))
    return state.comps


def _near_another(rows: pa.Table) -> pa.Table:
    """Of the rows of a node, at most ``MEDIUM``, those whose sketch is like that of one in another component; as ``_alike`` has it."""
    n, comp = rows.column("n").to_numpy(), rows.column("comp").to_numpy()
    sketch = rows.column("packed").combine_chunks().flatten().to_numpy().view(_U).reshape(len(rows), -1)
    bins = lambda x: np.bitwise_count((x | (x >> _U(1))) & _U(0x5555555555555555)).sum(axis=-1, dtype=np.int64)
    good = np.zeros(len(rows), dtype=bool)
    for i in range(0, len(rows), 128):
        own = slice(i, i + 128)
        least, most = np.minimum(n[own, None], n[None, :]), np.maximum(n[own, None], n[None, :])
        a, b = np.nonzero((least * 100 >= most * PERCENT) & (comp[own, None] != comp[None, :]))
        x, y = sketch[i + a], sketch[b]
        differ, used, least, most = bins(x ^ y), bins(x | y), least[a, b], most[a, b]
        able = np.where(most <= SURE, differ * (100 + PERCENT) <= (least + most) * (100 - PERCENT), (used - differ) >= ESTIMATE * used)
        good[i + a[able]] = True
    return rows.filter(pa.array(good)).select(["node", "rep", "n", "comp"])


def _exhaustive(rows: DataFrame) -> DataFrame:
    """The pairs of small nodes that lie in different components: what is not in a node's largest one, with all."""
    rows = rows.select("node", "rep", "n", "packed", "comp", "top")
    once = (F.col("b.comp") == F.col("b.top")) | (F.col("a.rep") < F.col("b.rep"))
    return rows.filter("comp <> top").alias("a").join(rows.alias("b"), (F.col("a.node") == F.col("b.node")) & (F.col("a.comp") != F.col("b.comp")) & once & _alike("a", "b")).select(F.col("a.rep").alias("u"), F.col("b.rep").alias("v"))


def _pivots(rows: DataFrame) -> DataFrame:
    """For each document of a large node the pivot that resembles it most, of another component."""
    one = F.struct("rep", "n", "packed", "comp")
    pivots = rows.groupBy("node", F.pmod(F.xxhash64("rep"), F.lit(PIVOTS)).alias("k")).agg(F.min_by(one, F.xxhash64("node", "rep")).alias("p"))
    pivots = written(pivots.select(F.col("node").alias("node"), "p.*"))
    met = rows.alias("a").join(pivots.alias("b"), (F.col("a.node") == F.col("b.node")) & (F.col("a.comp") != F.col("b.comp")) & _alike("a", "b"))
    met = met.select(F.col("a.rep").alias("u"), F.struct(_estimate("a", "b").alias("s"), F.col("b.rep").alias("v")).alias("x"))
    return met.groupBy("u").agg(F.max("x").alias("x")).select("u", F.col("x.v").alias("v"))


def _grid(members: DataFrame, others: DataFrame, texts: DataFrame) -> DataFrame:
    """The links (u, v) between ``others`` and ``members`` of their groups, one for each other, component and block.

    Sets linked differ little in size, so both sides are dealt to classes of size first. Of each group and class the
    members form chunks of about ``CHUNK`` shingles, the others too, and a task compares one chunk with another in
    full: what is shuffled grows with members times others over the documents of a chunk, not with pairs.
    """
    size = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(SIZE_STEP))).cast("int")
    members = members.withColumn("class", size)
    others = others.withColumn("class", F.explode(F.array(size - 1, size, size + 1)))
    chunks = lambda df, name: df.groupBy("group", "class").agg(F.ceil(F.sum("n") / CHUNK).cast("int").alias(name))
    blocks = written(chunks(members, "rows").join(chunks(others, "cols"), ["group", "class"]))

    def dealt(df: DataFrame, own: str, every: str) -> DataFrame:
        """A side's rows by block, each once for every chunk of the other side; columns are named anew, as both sides share tables."""
        here = df.join(blocks, ["group", "class"]).join(texts, "id")
        here = here.select("group", "class", F.pmod(F.xxhash64("id"), F.col(own)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.col(every) - 1)).alias(every), "id", "comp", "text")
        return here.select(*[F.col(c).alias(c) for c in here.columns])

    key = ("group", "class", "rows", "cols")
    left, right = dealt(members, "rows", "cols"), dealt(others, "cols", "rows")
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_linked, "u long, v long")
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _linked(members: pa.Table, others: pa.Table) -> pa.Table:
    """Of two chunks (..., id, comp, text): for each other and each component of members one member that it is linked to."""
    none = pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
    if not len(members) or not len(others):
        return none
    ids, comps = ([t.column(c).to_numpy() for t in (members, others)] for c in ("id", "comp"))
    row, token = _rows_and_tokens(members.column("text"))
    mine, asked = _rows_and_tokens(others.column("text"))
    order = np.argsort(token, kind="stable")
    row, token = row[order], token[order]
    m, n = np.bincount(row, minlength=len(members)), np.bincount(mine, minlength=len(others))
    low, high = np.searchsorted(token, asked, side="left"), np.searchsorted(token, asked, side="right")
    at = np.searchsorted(mine, np.arange(len(others) + 1))
    total = np.r_[0, np.cumsum(high - low)][at]
    u, v = [], []
    i = 0
    while i < len(others):
        # as many others at once as meet about PIECE_HITS equal shingles
        j = max(i + 1, int(np.searchsorted(total, total[i] + PIECE_HITS, side="right")) - 1)
        span = slice(at[i], at[j])
        k = high[span] - low[span]
        hit = np.repeat(low[span] - np.r_[0, np.cumsum(k)[:-1]], k) + np.arange(k.sum())
        both = np.bincount(np.repeat(mine[span] - i, k) * len(members) + row[hit], minlength=(j - i) * len(members)).reshape(j - i, len(members))
        good = (both > 0) & (100 * both >= PERCENT * (n[i:j, None] + m[None, :] - both)) & (comps[1][i:j, None] != comps[0][None, :])
        a, b = np.nonzero(good)
        _, first = np.unique(np.stack([a, comps[0][b]]), axis=1, return_index=True) if len(a) else (None, np.zeros(0, np.int64))
        u.append(ids[1][i:j][a[first]])
        v.append(ids[0][b[first]])
        i = j
    return pa.table({"u": pa.array(np.concatenate(u)), "v": pa.array(np.concatenate(v))})


def _rows_and_tokens(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle) of the distinct shingles of each text, by text."""
    parts = []
    for piece in pieces(column.combine_chunks()):
        keys = shingle_sets(piece, SHINGLE)
        parts.append(((keys >> _U(52)).astype(np.int64) + piece.first_row, keys & _U((1 << 52) - 1)))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each document."""
    each = written(signatures(docs))
    classes = written(each.filter("n > 0").groupBy("a", "b", "n").agg(F.min("doc_id").alias("rep")))
    # of rows that share a representative's doc_id any one gives tokens, as they are one vertex
    of_rep = (F.col("doc_id") == F.col("rep")) & (F.col("a") == F.col("a_")) & (F.col("b") == F.col("b_"))
    chosen = each.select("doc_id", "n", "a", "b", "sig", "packed").join(classes.select("rep", F.col("a").alias("a_"), F.col("b").alias("b_")), of_rep)
    sets = written(chosen.select("rep", "n", "sig", "packed"))
    comps = links(sets, docs)
    named = classes.select("a", "b", "n", "rep").join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left").select("a", "b", "n", F.coalesce("component", "rep").alias("component"))
    out = each.select("doc_id", "n", "a", "b").join(named, ["a", "b", "n"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's component and whether it stays."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [md5(array_to_string(w, ' '))]
    ELSE list_transform(range(1, len(w) - 3), lambda i: md5(array_to_string(w[i:i + 4], ' '))) END) AS h
  FROM d
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), c AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
  SELECT u, v FROM c JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 75 * (x.n + y.n - k)
), r AS (
  SELECT doc_id AS u, doc_id AS v FROM d UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u
), m AS (SELECT u AS doc_id, min(v) AS component_id FROM r GROUP BY u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN m ON m.doc_id = d.doc_id
"""

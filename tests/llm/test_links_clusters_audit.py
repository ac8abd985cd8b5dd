"""SimHash classes, pivot-table clustering and the divergence audit: against brute force, and on awkward rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tessela.llm import centroids, divergence, simhash
from tessela.llm.transducer import Transducer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def fingerprint(text):
    w = WORD.findall((text or "").translate(LOW))
    grams = [" ".join(w[i : i + 4]) for i in range(max(len(w) - 3, 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    """Index to the least index that can be reached."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocab = ["".join(rng.choices("abcdeilnorst", k=rng.randint(2, 8))) for _ in range(300)]
    out = [" ".join(rng.choices(vocab, k=rng.randint(5, 90))) for _ in range(60)]
    for i in range(40):  # copies with a word changed: few bits differ in long ones
        w = out[i % 20].split(" ") * 3
        w[rng.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    return out + [None, "", " \n\t\x0b ", "one", "ONE", "one two three", "One  two\nthree", "İ ſ K naïve É", "x\x85y z w v", "a b c d " * 20_000, "Tie tie tie tie tie"]


def test_simhash_against_brute_force(spark, texts):
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string, fp int").repartition(4)
    found = {r["doc_id"]: r for r in simhash.near_duplicates(df).collect()}
    prints = [fingerprint(t) for t in texts]
    assert [found[i]["fp"] % (1 << 64) for i in range(len(texts))] == prints
    assert [found[i]["component_id"] for i in range(len(texts))] == classes(prints)


def test_simhash_links_in_hot_cells(spark):
    """Prints around a few centres, so that cells are crowded and cut into blocks; chains through several others."""
    rng = random.Random(8)
    prints = []
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(60):
            x = base
            for b in rng.sample(range(64), rng.randint(0, 7)):
                x ^= 1 << b
            prints.append(x)
    prints = sorted({*prints, 0, 1, (1 << 64) - 1, (1 << 64) - 9})
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    df = spark.createDataFrame(signed, "fp long")
    want = classes(prints)
    for block in (8, 4096):
        out = simhash.links(df, block=block, group=500).collect()
        root = {p[0]: p[0] for p in signed}
        find = lambda x: x if root[x] == x else find(root[x])
        for r in out:
            assert ((r["u"] ^ r["v"]) % (1 << 64)).bit_count() <= 64
            root[find(r["u"])] = find(r["v"])
        groups = defaultdict(set)
        for i, (p,) in enumerate(signed):
            groups[find(p)].add(i)
        assert {frozenset(g) for g in groups.values()} == {frozenset(i for i in range(len(prints)) if want[i] == k) for k in set(want)}


def test_simhash_ids(spark):
    """Null ids and ids that are no number join classes but name none; rows of one id are looked at one by one."""
    same, other = "the very same words here", "quite another text of words"
    df = spark.createDataFrame([("7", same), (None, same), ("d1", same), ("3", other), ("3", same), (None, "alone with no number at all")], "doc_id string, text string")
    got = Counter((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df).collect())
    assert got == Counter({(7, 3): 1, (None, 3): 2, (3, 3): 2, (None, None): 1})
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []


def clustered(vectors, k=8, rounds=10):
    """(vec_id, vector) to (vec_id, cluster, distance) and the centroids, in Python's whole numbers."""
    start = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in vectors if i is not None)[:k]
    c = [list(v) for _, v in start]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, x, strict=True)), j) for j, x in enumerate(c))
    for _ in range(rounds):
        held = defaultdict(list)
        for _, v in vectors:
            held[near(v)[1]].append(v)
        for j, vs in held.items():
            c[j] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in vectors), key=str), c


def test_centroids_against_brute_force(spark):
    rng = random.Random(2)
    groups = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [x + rng.uniform(-0.2, 0.2) for x in groups[i % 5]]) for i in range(150)]
    rows += [(i, rows[0][1]) for i in range(200, 260)]  # one vector many times, more than a cluster's share
    rows += [(3, rows[4][1]), (None, rows[5][1])]
    bad = [(500, None), (501, [0.1] * 63), (502, [0.1] * 63 + [None]), (503, [float("nan")] + [0.0] * 63), (504, [float("inf")] + [0.0] * 63), (505, [])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows + bad], "vec_id long, embedding array<double>, v int, cluster string").repartition(5)
    out, c = centroids.clusters(centroids.whole(df))
    want, want_c = clustered([(i, tuple(int(np.floor(1024 * x)) for x in v)) for i, v in rows])
    assert sorted((tuple(r) for r in out.collect()), key=str) == want
    assert c.tolist() == want_c


def test_centroids_few_and_none(spark):
    kind = "vec_id long, embedding array<float>"
    assert centroids.clusters(centroids.whole(spark.createDataFrame([], kind)))[0].collect() == []
    assert centroids.clusters(centroids.whole(spark.createDataFrame([(None, [0.5] * 64)], kind)))[0].collect() == []
    out, c = centroids.clusters(centroids.whole(spark.createDataFrame([(4, [0.5] * 64), (5, [0.5] * 64)], kind)))
    assert {r["cluster"] for r in out.collect()} == {0}  # equal centroids: the smaller number
    assert len(c) == 2
    with pytest.raises(Exception, match="beyond"):
        centroids.clusters(centroids.whole(spark.createDataFrame([(1, [1e30] * 64)], kind)))


def test_pivot_bounds_spare_measurements():
    """On vectors in groups most centroids are ruled out, and the nearest one is never."""
    rng = np.random.default_rng(4)
    middle = rng.integers(-2000, 2000, (8, 64))
    x = middle[rng.integers(0, 8, 3000)] + rng.integers(-100, 100, (3000, 64))
    pivots = centroids.chosen_pivots(x[:200])
    d = np.sqrt(((x[:, None, :] - pivots[None]) ** 2).sum(axis=2).astype(float))
    best, least, measured = centroids.nearest(x, d, middle, centroids._to_pivots(middle, pivots))
    every = ((x[:, None, :] - middle[None]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all()
    assert (least == every.min(axis=1)).all()
    assert measured < 1.5 * len(x)


def test_transducer_is_minimal_and_ordered():
    rng = random.Random(1)
    words = sorted({"".join(rng.choices("abé", k=rng.randint(1, 6))).encode() for _ in range(400)})
    t = Transducer(words)
    asked = [*words, b"", b"a" * 50, b"zz", "ü".encode(), words[0] + b"\xff"]
    data = np.frombuffer(b"".join(asked), dtype=np.uint8)
    at = np.r_[0, np.cumsum([len(w) for w in asked])]
    assert t.ordinals(data, at[:-1], at[1:]).tolist() == [*range(len(words)), *[-1] * 5]
    # as many states as there are different sets of what may follow
    rest = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in {w[:i] for w in words for i in range(len(w) + 1)}}
    assert t.n_states == len(rest)
    none = Transducer([])
    assert none.ordinals(data, at[:-1], at[1:]).tolist() == [-1] * len(asked)
    with pytest.raises(ValueError, match="order"):
        Transducer([b"b", b"a"])


def audited(rows, min_docs=3, top=200):
    docs = [(x or "", s or "", [t.translate(LOW) for t in TERM.findall(text or "")]) for x, s, text in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        df = Counter(t for x, _, w in docs if x == lang for t in set(w))
        kept = {t for t, n in df.items() if n >= min_docs}
        count = {s: Counter(t for x, o, w in docs if (x, o) == (lang, s) for t in w if t in kept) for s in {d[1] for d in docs if d[0] == lang}}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in count.items()}, share(sum(count.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // b
        for s in count:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in count if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                for k, (item, v) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))):
                    if part == "pair" or k < top:
                        out.add((lang, s, part, item, v, k + 1))
    return out


def test_pairs_in_small_matrices(monkeypatch):
    """The sums don't depend on how many terms and sources a matrix has."""
    rng = np.random.default_rng(6)
    n = 400
    cells = rng.permutation(9 * 100)[:n]
    shares = pa.table({"source": pa.array(cells % 9 + 1), "at": pa.array(cells // 9), "p": pa.array(rng.integers(2, 10**9, n))})
    sources = pa.table({"source": pa.array(rng.permutation(9) + 1), "p": pa.array(rng.integers(1, 50, 9))})
    key = (pa.scalar("en"), pa.scalar(0))
    whole = divergence._pairs(key, shares, sources).to_pylist()
    monkeypatch.setattr(divergence, "TERMS", 7)
    monkeypatch.setattr(divergence, "BLOCK", 2)
    assert divergence._pairs(key, shares, sources).to_pylist() == whole
    assert len(whole) == 72


def test_divergence_against_brute_force(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdeZÉñ漢", k=rng.randint(1, 4))) for _ in range(150)]
    rows = []
    for i in range(160):
        lang = ("en", "de", None, "")[i % 4]
        own = words[(i % 5) * 20 : (i % 5) * 20 + 60]
        rows.append((lang, f"s{i % 5}" if i % 7 else None, " 3".join(rng.choices(own, k=rng.randint(0, 40)))))
    rows += [("xx", "a", "rare words"), ("xx", "b", None), ("xx", "c", ""), ("solo", "only", "same same"), ("solo", "only", "same"), ("solo", "only", "SAME-same")]
    rows += [("en", "s1", "tie_a tie_b " * 3)] * 3 + [("en", "long", "word " * 300_000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, number int, part string").repartition(4)
    want = audited(rows)
    assert {tuple(r) for r in divergence.divergences(df).collect()} == want
    # many ranges
    assert {tuple(r) for r in divergence.divergences(df, size=5).collect()} == want
    assert {tuple(r) for r in divergence.divergences(df, top=3).collect()} == audited(rows, top=3)
    assert divergence.divergences(df.filter(F.lit(False))).collect() == []

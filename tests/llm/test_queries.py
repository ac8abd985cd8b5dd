"""The registered queries on whole tables: against SQL where there is some, else against brute force of their contracts."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest
import xxhash

from tessela.llm import queries, toxicity

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text, source FROM read_parquet('{SF}/documents.parquet')").fetchall()


def run(spark, name, columns):
    df = queries.QUERIES[name](spark, SF)
    assert df.columns[: len(columns)] == columns
    rows = df.collect()
    assert len({r["doc_id"] for r in rows}) == len(rows)
    return {r["doc_id"]: r for r in rows}


@pytest.mark.parametrize(("name", "sf"), [(n, SF) for n in sorted(queries.ORACLE_SQL)] + [("op7_near_dup", "/root/testdata/sf0.01")])
def test_sql(spark, name, sf):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS FROM read_parquet('{sf}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    want = con.sql(queries.ORACLE_SQL[name])
    place = [want.columns.index(c) for c in columns]
    assert sorted(str(tuple(r[c] for c in columns)) for r in df.collect()) == sorted(str(tuple(r[i] for i in place)) for r in want.fetchall())


def test_op1(spark, docs):
    found = run(spark, "op1_quality", ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"])
    assert len(found) == len(docs)
    for i, text, _ in docs:
        w = WORD.findall(text or "")
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        count = Counter(grams)
        covered = {p for k, g in enumerate(grams) if count[g] > 1 for p in (k, k + 1, k + 2)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        r = found[i]
        assert tuple(r)[1:6] == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r["kept"] and r["base_failed"])


def test_op2(spark):
    """On a table with some documents in each source, so that words can come near to the targets."""
    large = "/root/testdata/sf0.01"
    docs = duckdb.sql(f"SELECT doc_id, text, source FROM read_parquet('{large}/documents.parquet')").fetchall()
    rows = queries.QUERIES["op2_mixing"](spark, large)
    assert rows.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    found = {r["doc_id"]: r for r in rows.collect()}
    assert len(found) == len(docs)
    size, taken = Counter(), Counter()
    for i, text, source in docs:
        n = len(WORD.findall(text or ""))
        assert found[i]["size"] == n
        assert 0 <= found[i]["taken"] <= 2 * n
        size[source] += n
        taken[source] += found[i]["taken"]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(size, key=lambda s: (s is None, s)))}
    target, left, open_ = {}, 1.5 * sum(size.values()), set(size)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * size[s]}
        target |= {s: 2.0 * size[s] for s in over} if over else {s: level * weight[s] for s in open_}
        left -= sum(2 * size[s] for s in over)
        open_ = open_ - over if over else set()
    for i, _, source in docs:
        assert found[i]["source_size"] == size[source]
        assert found[i]["target"] == pytest.approx(target[source])
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] + 1 for s in size)


def test_op4(spark, docs):
    found = defaultdict(set)
    for r in queries.QUERIES["op4_decontam"](spark, SF).collect():
        found[r["doc_id"]].add(r["item_id"])
    items = duckdb.sql(f"SELECT item_id, text FROM read_parquet('{SF}/benchmark.parquet')").fetchall()
    words = lambda t: WORD.findall((t or "").translate(LOW))
    whole = {item: " ".join(words(t)) for item, t in items if len(words(t)) >= 5}
    for i, text, _ in docs:  # passages word for word are found, and what is found shares words with its item
        own = f" {' '.join(words(text))} "
        assert {item for item, t in whole.items() if f" {t} " in own} <= found[i]
        for item in found[i]:
            w = whole[item].split()
            assert any(f" {' '.join(w[k : k + 5])} " in own for k in range(len(w) - 4))


BASE5 = {"assign": r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}
BASE9 = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def _good(kind, m):
    digits = re.sub(r"[^0-9]", "", m[0])
    return {
        "assign": lambda: len(m[2]) >= 6,
        "access": lambda: len(m[0]) >= 20,
        "hex": lambda: len(m[0]) >= 24,
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
        "card": lambda: 12 <= len(digits) <= 19 and _luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


@pytest.mark.parametrize(("name", "base"), [("op5_secrets", BASE5), ("op9_pii", BASE9)])
def test_op5_and_op9(spark, docs, name, base):
    kinds = list(base)
    found = run(spark, name, ["doc_id", *(f"n_{k}" for k in kinds), "base_sha256", "spans"])
    for i, text, _ in docs:
        spans = [(k, m.start(), m.end()) for k, p in base.items() for m in re.finditer(p, text or "", re.ASCII) if _good(k, m)]
        listed = [f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))]
        r = found[i]
        assert [r[f"n_{k}"] for k in kinds] == [sum(k == s[0] for s in spans) for k in kinds]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [x for x in r["spans"].split(",") if x and not x.startswith("model")] == listed


def test_op8(spark, docs):
    found = run(spark, "op8_licenses", ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    for i, text, _ in docs:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
        at, labels = [], set()
        for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
            p = phrase.split()
            own = [k for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
            at += own
            labels |= {label} if own else set()
        r = found[i]
        assert tuple(r)[1:6] == (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))
        every = set(filter(None, r["labels"].split(",")))
        assert labels <= every
        assert (r["score"] > 0) == bool(every)
        assert 0 <= r["score"] <= 1


def test_op10(spark, docs):
    """On a table with enough labels: nine of ten held-out toxic documents are found, at most one in a hundred others."""
    large = "/root/testdata/sf0.1"
    toxic = dict(duckdb.sql(f"SELECT doc_id, max(toxic) FROM read_parquet('{large}/labels.parquet') GROUP BY doc_id").fetchall())
    rows = queries.QUERIES["op10_toxicity"](spark, large).collect()
    seen = Counter()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
        assert r["predicted"] == (r["score"] >= toxicity.THRESHOLD)
        if r["held_out"] and r["doc_id"] in toxic:
            seen[toxic[r["doc_id"]], r["predicted"]] += 1
    assert seen[1, 1] >= 0.9 * (seen[1, 1] + seen[1, 0])
    assert seen[0, 1] <= 0.01 * (seen[0, 0] + seen[0, 1])
    assert len(run(spark, "op10_toxicity", ["doc_id", "held_out", "score", "predicted"])) == len(docs)


def test_op11(spark, docs):
    """Fingerprints and classes of all documents by brute force."""
    found = run(spark, "op11_simhash", ["doc_id", "fingerprint", "component_id"])
    prints = {}
    for i, text, _ in docs:
        w = WORD.findall((text or "").translate(LOW))
        hashes = [xxhash.xxh64_intdigest(" ".join(w[k : k + 4]).encode(), 42) for k in range(max(len(w) - 3, 1))] if w else []
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert found[i]["fingerprint"] == f"{prints[i]:016x}"
    near = defaultdict(set)
    for i, a in prints.items():
        for j, b in prints.items():
            if (a ^ b).bit_count() <= 4:
                near[i].add(j)
    for i in prints:
        reached, left = {i}, [i]
        while left:
            fresh = near[left.pop()] - reached
            reached |= fresh
            left += fresh
        assert found[i]["component_id"] == min(reached)

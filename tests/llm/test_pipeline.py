"""The pipeline's stages, one after another, on the smallest tables."""

from pathlib import Path

import pytest

import corpus_pipeline
from tessela.llm import decontam, near_dup, toxicity

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    raw = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"] for r in docs.collect()}
        out = corpus_pipeline.written(stage(spark, docs, SF))
        after = {r["doc_id"] for r in out.collect()}
        assert after <= before
        if name == "toxicity":
            model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            scored = toxicity.scores(docs, model).collect()
            assert after == {r["doc_id"] for r in scored if r["__toxicity"] < toxicity.THRESHOLD}
        elif name == "line_dedup":
            assert after == before
            assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
        elif name == "near_dup":
            assert near_dup.near_duplicates(out).filter("not kept").count() == 0
        elif name == "decontamination":
            assert decontam.leaks(out, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
        if name != "mixing":
            assert out.columns == raw.columns
        docs = out
    sums = docs.groupBy().sum("size", "taken").first()
    assert 1.3 < sums[1] / sums[0] < 1.6


def test_the_mix_has_a_row_for_each_draw(spark):
    docs = spark.createDataFrame([(i, "w " * 20, f"s{i % 3}") for i in range(600)], "doc_id long, text string, source string")
    want = {r["doc_id"]: r["__draws"] for r in corpus_pipeline.mixing.mix(docs).collect()}
    assert {len(x) for x in want.values()} >= {0, 2}
    out = corpus_pipeline.mixed(spark, docs, "").collect()
    got = sorted((r["shard"], r["place"], r["doc_id"]) for r in out)
    order = sorted((x["shard"], x["key"], i) for i, d in want.items() for x in d)
    assert [(s, i) for s, _, i in got] == [(s, i) for s, _, i in order]
    for shard in {s for s, _, _ in got}:
        places = [p for s, p, _ in got if s == shard]
        assert places == list(range(len(places)))


def _tables(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(0, 90)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "seven wise owls count the silver stars above a quiet northern harbour while nine boats wait for more"), (2, None), (None, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


SCHEMA = "doc_id long, text string, source string, n_chars long, size string, __size int, key string"


def test_awkward_rows(spark, tmp_path):
    word = lambda i, k: f"w{(i * 7919 + k * 104729) % 5003}"
    long = lambda i, n: " ".join(word(i, k) for k in range(n))
    leak = "so seven wise owls count the silver stars above a quiet northern harbour while nine boats wait for more of it"
    line = "this very line stands in many of the documents of this table"
    texts = {i: long(i, 60) + ("\nyou utter scumbag you" if i % 4 == 0 else "") for i in range(90)}
    texts |= {100 + i: long(500 + i, 80) + "\n" + line for i in range(6)}
    texts |= {200: long(900, 70), 201: long(900, 70), 202: long(900, 70) + " more", 300: leak + " " + long(950, 40), 400: None, 401: "", 402: " \n\t ", 500: long(1000, 50_000)}
    rows = [(i, t, "s" if i % 3 else None, 1, "x", 7, "k") for i, t in texts.items()]
    rows += [rows[5], (None, long(1200, 30), "s", None, None, None, None), (None, None, None, None, None, None, None)]
    _tables(spark, tmp_path, rows, SCHEMA)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, str(tmp_path)))
        kept[name] = docs.collect()
        if name != "mixing":
            assert docs.columns == [c.strip().split(" ")[0] for c in SCHEMA.split(",")]
    ids = {name: [r["doc_id"] for r in found] for name, found in kept.items()}
    assert {1, 2, 3, 5, 400, 401, 402, 500, None} <= set(ids["toxicity"])
    assert not set(ids["toxicity"]) & {i for i in range(90) if i % 4 == 0}
    assert sorted(map(str, ids["line_dedup"])) == sorted(map(str, ids["toxicity"]))
    assert [r["doc_id"] for r in kept["line_dedup"] if r["text"] and line in r["text"]] == [105]
    assert set(ids["line_dedup"]) - set(ids["near_dup"]) == {201, 202}
    assert set(ids["near_dup"]) - set(ids["decontamination"]) == {300}
    assert {r["taken"] for r in kept["mixing"] if r["doc_id"] in (400, 401, 402)} <= {0}
    assert {r["doc_id"]: r["size"] for r in kept["mixing"] if r["size"] is not None}[500] == 50_000
    assert [r for r in kept["mixing"] if r["doc_id"] == 5]


def test_ids_that_are_texts(spark, tmp_path):
    word = lambda i, k: f"w{(i * 7919 + k * 104729) % 5003}"
    long = lambda i, n: " ".join(word(i, k) for k in range(n))
    leak = "so seven wise owls count the silver stars above a quiet northern harbour while nine boats wait for more of it"
    line = "this very line stands in many of the documents of this table"
    texts = {str(i): long(i, 60) + ("\nyou utter scumbag you" if i % 4 == 0 else "") for i in range(90)}
    texts |= {f"d{i}": long(500 + i, 80) + "\n" + line for i in range(6)} | {"7": long(7, 60)}
    texts |= {"a": long(900, 70), "b": long(900, 70) + " more", "leak": leak + " " + long(950, 40), "none": None, "": "x"}
    rows = [(i, t, "s", 1, "x", 7, "k") for i, t in texts.items()] + [(None, "y", "s", 1, "x", 7, "k")]
    _tables(spark, tmp_path, rows, SCHEMA.replace("doc_id long", "doc_id string"))
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, str(tmp_path)))
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(texts) - set(kept["toxicity"]) == {str(i) for i in range(0, 90, 4)}
    assert set(kept["line_dedup"]) == set(kept["toxicity"])
    assert sum(line in (t or "") for t in kept["line_dedup"].values()) == 1
    gone = set(kept["line_dedup"]) - set(kept["near_dup"])
    assert len(gone) == 1 and gone <= {"a", "b"}
    assert set(kept["near_dup"]) - set(kept["decontamination"]) == {"leak"}
    assert {None, "", "none"} <= set(kept["decontamination"])


def test_an_empty_table(spark, tmp_path):
    _tables(spark, tmp_path, [], SCHEMA)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

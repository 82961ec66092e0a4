"""The stages against brute force on a small table with planted cases."""
import random

import pytest

import corpus_pipeline
from doctext.llm import quality
from doctext.llm.tokens import default_path, encoder

from .test_simhash import groups, plain


@pytest.fixture
def planted(spark, tmp_path):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7)))
    good = [" ".join(word() for _ in range(rng.randint(30, 120))) + "." for _ in range(60)]
    passage = " ".join(word() for _ in range(70))
    rows = [(i, t, f"s{i % 4}") for i, t in enumerate(good)]
    rows += [(100 + i, " ".join(f"{word().upper()}!! $$$" for _ in range(40)), "s0") for i in range(20)]
    rows += [(200 + i, good[i], "s1") for i in range(5)]                                   # copies
    rows += [(300 + i, " ".join(word() for _ in range(60)) + "\n" + passage, "s2") for i in range(6)]
    rows += [(400, None, None), (401, "", "s3")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 0 if 100 <= i < 200 else 1) for i, t, _ in rows if t], "doc_id long, quality int").write.parquet(
        f"{tmp_path}/labels.parquet")
    return str(tmp_path), rows, passage


def test_stages(spark, planted):
    sf, rows, passage = planted
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "simhash", "substring", "mixing", "packing"]

    a = stage["quality"](spark, docs, sf).cache()
    field = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    score = {(r["doc_id"], r["score"] >= 0.7) for r in quality.score(docs, field).collect()}
    ids = {r["doc_id"] for r in a.collect()}
    assert ids == {i for i, ok in score if ok} and a.columns == docs.columns
    assert not ids & set(range(100, 120)) and set(range(60)) <= ids

    b = stage["simhash"](spark, a, sf).cache()
    kept = a.collect()
    comp = groups([plain(r["text"]) for r in kept], [r["doc_id"] for r in kept], 2)
    assert sorted(r["doc_id"] for r in b.collect()) == sorted(set(comp))

    c = stage["substring"](spark, b, sf).cache()
    with_passage = [r for r in c.collect() if r["text"] and passage in r["text"].replace("\n", " ")]
    assert [r["doc_id"] for r in with_passage] == [300] and c.count() == b.count()

    d = stage["mixing"](spark, c, sf).cache()
    assert d.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in c.collect()}
    assert all(texts[r["doc_id"]] == r["text"] for r in d.collect())
    assert max(r["count"] for r in d.groupBy("doc_id").count().collect()) <= 3

    e = stage["packing"](spark, d, sf).toPandas()
    tok = encoder(default_path())
    assert e.length.sum() == sum(len(tok.encode(r["text"] or "")) // 4 + 1 for r in d.collect())


def test_run_applies_all_stages(spark, planted):
    out = corpus_pipeline.run(spark, planted[0])
    assert "sequence_id" in out.columns and out.count() > 0


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, comp string, rank int, `__k` string, `a.b` int"


def test_null_ids_repeated_rows_and_clashing_columns(spark, planted, tmp_path):
    sf, rows, _ = planted
    extra = lambda i, t, s: (i, t, "en", s, len(t or ""), "c", 3, "k", 4)
    rows = [extra(*r) for r in rows]
    lone = "quiet rivers carry old stones over seven plains while nobody counts them until winter ends again today."
    rows += [extra(None, lone, None), extra(None, None, "s1"), extra(None, rows[3][1], "s2")]
    rows += [rows[7]] * 4 + [extra(12, "another text for an id that is taken, with words of its own here and there.", "s1")]
    docs = spark.createDataFrame(rows, SCHEMA)
    stage = dict(corpus_pipeline.STAGES)

    field = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    a = stage["quality"](spark, docs, sf).cache()
    good = sorted((r["doc_id"] or -1, r["score"]) for r in quality.score(docs, field).collect() if r["score"] >= 0.7)
    assert a.schema == docs.schema and sorted(r["doc_id"] or -1 for r in a.collect()) == [i for i, _ in good]
    assert sum(r["doc_id"] == 7 for r in a.collect()) == 5

    b = stage["simhash"](spark, a, sf).cache()
    got, kept = b.collect(), a.collect()
    classes = groups([plain(r["text"]) for r in kept], list(range(len(kept))), 2)
    assert b.schema == docs.schema and len(got) == len(set(classes))
    assert sum(r["doc_id"] == 7 for r in got) == 1
    assert (lone in {r["text"] for r in got}) == (lone in {r["text"] for r in kept})

    c = stage["substring"](spark, b, sf).cache()
    assert c.schema == docs.schema and c.count() == len(got)
    d = stage["mixing"](spark, c, sf).cache()
    assert d.schema == docs.schema
    e = stage["packing"](spark, d, sf).toPandas()
    tok = encoder(default_path())
    assert e.length.sum() == sum(len(tok.encode(r["text"] or "")) // 4 + 1 for r in d.collect())


def test_empty_table(spark, planted, tmp_path):
    sf, _, _ = planted
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    empty = docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, sf)
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)

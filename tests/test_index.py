"""Stored index: against counting by hand, pruning, batches, replays."""

import random
import re
from collections import Counter

import pytest

from doctext.operators import search
from doctext.operators.index import SearchIndex, buckets_of, merge_and_index, term_bucket
from doctext.operators.keys import key_bits, near_keys, split_by_keys
from doctext.operators.state import merge_actions
from pyspark.sql import functions as F

TEXTS = "package_id string, text string"
FT = "id string, resource_id string, package_id string, text string, text_clear string"


def counted(rows):
    out = Counter()
    for p, t in rows:
        out.update((w, p) for w in re.split(r"[^\w]+|_", (t or "").lower()) if w)
    return dict(out)


def got(index):
    return {(r.term, r.package_id): r.tf for r in index.postings().collect()}


ROWS = [("p1", "Alpha beta, beta"), ("p1", "gamma"), ("p2", None), ("p3", ""), ("p4", "é Äpfel 12 alpha"), ("p5", "..."),
        ("p6", "alpha " * 3000), (None, "lost")]


def test_build_and_read(spark, tmp_path):
    index = SearchIndex.build(spark.createDataFrame(ROWS, TEXTS), str(tmp_path), buckets=8)
    want = counted(ROWS)
    assert got(index) == want
    assert index.n_docs == len({p for _, p in want}) and index.n_terms == sum(want.values())
    assert {(r.package_id, r.matched_terms, r.tf) for r in index.match(["Alpha"]).collect()} == {
        ("p1", 1, 1), ("p4", 1, 1), ("p6", 1, 3000)}
    assert {r.package_id for r in index.match(["alpha", "beta"]).collect()} == {"p1"}
    assert index.match(["nowhere"]).count() == 0 and index.bm25(["nowhere"], 1).count() == 0
    t = spark.createDataFrame([(w,) for w in ("alpha", "é", "日")], "t string").select("t", term_bucket("t", 8).alias("b"))
    assert all([r.b] == buckets_of([r.t], 8) for r in t.collect())


def test_empty_table(spark, tmp_path):
    index = SearchIndex.build(spark.createDataFrame([], TEXTS), str(tmp_path))
    assert index.match(["a"]).count() == 0 and index.bm25(["a"], 1).count() == 0 and got(index) == {}
    index = index.apply(spark.createDataFrame([("p", None, "a b a")], "package_id string, old_text string, new_text string"), 1)
    assert got(index) == {("a", "p"): 2, ("b", "p"): 1} and (index.n_docs, index.n_terms) == (1, 3)


def test_search_reads_its_buckets_only(spark, tmp_path, capsys):
    index = SearchIndex.build(spark.createDataFrame(ROWS, TEXTS), str(tmp_path), buckets=8)
    index.match(["alpha", "beta"]).explain("formatted")
    plan = capsys.readouterr().out
    wanted = ", ".join(map(str, buckets_of(["alpha", "beta"], 8)))
    assert re.search(rf"PartitionFilters: \[.*bucket#\d+ IN \({wanted.replace(', ', ',')}\)|PartitionFilters: .*bucket#\d+ = ", plan)
    assert "In(term, [alpha,beta])" in plan and "text" not in re.findall(r"ReadSchema: (.*)", plan)[0]


def table(spark, rows):
    return spark.createDataFrame([(f"f{r}", f"r{r}", f"p{r // 3}", t, "c") for r, t in rows.items()], FT)


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_equal_a_rebuild(spark, tmp_path, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "c", "d e", "NOT_AVAILABLE", "", " "])
    rows = {r: " ".join(word() for _ in range(rng.randint(0, 6))) for r in range(30) if rng.random() < .8}
    packages = spark.createDataFrame([(f"p{p}", "deleted" if p % 5 == 4 else "active") for p in range(10)], "package_id string, state string")
    listed = spark.createDataFrame([(f"p{r // 3}", f"r{r}") for r in range(30) if r % 7], "package_id string, resource_id string")
    ft = table(spark, rows)
    texts = lambda t: t.join(listed, ["package_id", "resource_id"], "left_semi").select("package_id", "text")
    index = SearchIndex.build(texts(ft), f"{tmp_path}/i", buckets=4)
    for batch in (1, 2):
        sent = [(f"p{r // 3}", f"r{r}", " ".join(word() for _ in range(4))) for r in range(30) if r // 3 in rng.sample(range(10), 3)]
        incoming = spark.createDataFrame(sent, "package_id string, resource_id string, text string")
        before = index
        ft2, index = merge_and_index(before, ft, incoming, packages, listed, batch)
        again = merge_and_index(before, ft, incoming, packages, listed, batch)[1]     # a replay
        ft = spark.createDataFrame(ft2.collect(), FT)
        want = counted(texts(ft).collect())
        assert got(index) == want == got(again)
        assert (index.n_docs, index.n_terms) == (len({p for _, p in want}), sum(want.values())) == (again.n_docs, again.n_terms)
    assert got(index.compact(f"{tmp_path}/c")) == want


def test_bitmap_of_keys(spark):
    df = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("k"), "id")
    keys = df.where("id % 10 = 0").select("k")
    near, away = split_by_keys(df, keys, "k")
    assert near.count() + away.count() == 2000
    assert near.join(keys, "k", "left_semi").count() == 200 and away.join(keys, "k", "left_semi").count() == 0
    assert near.count() < 220
    assert near_keys(df, keys, "k", bits=7).count() >= 200      # a small bitmap lets more through, loses none
    assert key_bits(df, "k", bits=9).count() <= 8
    nulls = spark.createDataFrame([(None,), ("a",)], "k string")
    assert near_keys(nulls, nulls.where("k is null"), "k").count() == 1
    assert near_keys(df, keys.limit(0), "k").count() == 0


def test_merge_moves_texts_of_the_batch_only(spark, capsys):
    old = spark.range(3000).select(F.concat(F.lit("f"), "id").alias("id"), F.concat(F.lit("r"), "id").alias("resource_id"),
                                   F.concat(F.lit("p"), F.expr("id div 3")).alias("package_id"), F.lit("x").alias("text"),
                                   F.lit(None).cast("string").alias("text_clear"))
    incoming = spark.createDataFrame([("p1", "r3", "new"), ("p1", "r9999", "more")], "package_id string, resource_id string, text string")
    packages = spark.createDataFrame([("p1", "active")], "package_id string, state string")
    acts = merge_actions(old, incoming, packages)
    n = {r.action: r["count"] for r in acts.groupBy("action").count().collect()}
    assert n == {"keep": 2997, "update": 1, "insert": 1, "delete": 2}
    acts.explain("formatted")
    plan = capsys.readouterr().out
    # Above the filter by the bitmap there is an exchange on one side only.
    assert plan.count("_near") or "shiftright" in plan
    tree = plan.split("\n\n")[0]
    away = tree.split("FullOuter")[-1].split("Union")[-1]
    assert "Union" in tree and "SortMergeJoin FullOuter" in tree and away


def test_pages_far_down(spark):
    df = spark.range(20_000_000).select(F.col("id").alias("n"), ((F.col("id") * 7919) % 20_000_003).alias("score"))
    order = [F.col("score").desc(), F.col("n")]
    rows = search.page_at(df, 10_000_000, 5, order, range_rows=2_000_000).orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(10_000_001, 10_000_006))
    top = sorted(((i * 7919) % 20_000_003 for i in range(20_000_000)), reverse=True)[10_000_000:10_000_005]
    assert [r["score"] for r in rows] == top
    small = spark.range(100).select(F.col("id").alias("n"), (F.col("id") % 5).alias("score"))
    whole = [r["n"] for r in small.orderBy(*order).collect()]
    for start in (0, 37, 95, 100, 500):
        assert [r["n"] for r in search.page_at(small, start, 7, order, range_rows=9).orderBy("rank").collect()] == whole[start:start + 7]
    last, seen = None, []
    while page := search.page_after(small, [("score", True), ("n", False)], last, 30).collect():
        seen += [r["n"] for r in page]
        last = (page[-1]["score"], page[-1]["n"])
    assert seen == whole
    assert search.page_at(small.limit(0), 3, 5, order).count() == 0

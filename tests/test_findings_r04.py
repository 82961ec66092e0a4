"""What the findings of the round asked for."""

import datetime as dt
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from doctext import session
from doctext.functions.digests import md5_heads
from doctext.functions.packs import packs_udf
from doctext.functions.spans import _cuts
from doctext.operators import index, repair, search, state
from doctext.operators.state import FT_COLS
from doctext.plans.q_pipeline import batch_run
from doctext.schema import Settings


def test_ranked_is_in_order(spark):
    """all matches by relevance, then newest first, then id; the order
    outlives a rounded score."""
    day = lambda n: dt.datetime(2024, 1, n)
    scored = spark.createDataFrame([(f"p{i}", s) for i, s in enumerate((0.5, 2.0004, 2.0001, 0.5, 0.5, 3.0))],
                                   "package_id string, score double").repartition(4)
    packages = spark.createDataFrame([(f"p{i}", day(d)) for i, d in enumerate((1, 1, 2, 3, 1, 1))],
                                     "package_id string, metadata_modified timestamp").repartition(3)
    got = search.ranked(scored, packages).withColumn("score", F.round("score", 3))
    assert [r.package_id for r in got.collect()] == ["p5", "p1", "p2", "p3", "p0", "p4"]
    # A page has its own top-k; the whole sort is not made for it.
    page = search.page(search.ranked(scored, packages), 1, 2)
    assert "rangepartitioning" not in page._jdf.queryExecution().executedPlan().toString()
    assert [r.package_id for r in page.orderBy("rank").collect()] == ["p1", "p2"]


def test_digests_of_words():
    """the digests of many words at once are those of each by itself."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcXYZ09|\0äß€😀") for _ in range(n)) for n in range(140) for _ in range(3)] + ["a" * n for n in range(130)]
    want = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) for w in words]
    for some, values in ((words, want), (words[:1], want[:1]), ([], []), (words * 40, want * 40)):
        assert md5_heads(some, np.array([len(w) for w in some], dtype=np.int64)).tolist() == values


def test_candidates_are_added_up_where_they_are_made(spark):
    """the sums are those of the candidate rows (compounds, characters of
    several bytes, repeated keys, texts with nothing), and no row per word
    reaches a shuffle."""
    s, mark = Settings(), "|" * 9
    words = spark.createDataFrame([("ab",), ("cd",), ("straße",)], "word string")
    docs = spark.createDataFrame(
        [(1, "a b cd-ab e fg hij klm ab-cd x"), (1, "zwei str aße Über ab.cd 12 a1 \0\0\0\0\0\0\0\0\0 q"), (2, "😀 a@b.cd http x y"), (3, None), (4, ""),
         (5, "ab-cd"), (None, "u v w")] + [(10 + i, "n o p q " * (i + 1)) for i in range(20)], "doc_id long, text string")
    pre = repair.prepared(docs, "doc_id", "text", words, s)
    one = F.replace("word", F.lit(repair.COMPOUND_GLUE), F.lit(mark))
    want = repair.candidates(pre, "doc_id", s).withColumn("word", one).groupBy("doc_id", "j").agg(
        F.count(F.lit(1)), F.sum(F.length("word")), F.min("word"), F.max("word"),
        F.sum(F.conv(F.left(F.md5("word"), F.lit(8)), 16, 10).cast("long")))
    sums = repair.candidates(pre, "doc_id", s, mark)
    got = sums.groupBy("doc_id", "j").agg(F.sum("n"), F.sum("chars"), F.min("first_word"), F.max("last_word"), F.sum("checksum"))
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(got) == rows(want) and len(rows(want)) > 40
    assert sums.count() < sum(r[2] for r in rows(want)) / 2


def test_texts_are_cut_by_bytes():
    b = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(["aa", "bbbb", None, "c" * 9, "d", "e", "f"])], ["k", "t"])
    assert [x.num_rows for x in _cuts(b, 3, 6)] == [3, 1, 3]
    assert [x.num_rows for x in _cuts(b.slice(0, 0), 3, 6)] == []


FT = ", ".join(f"{c} string" for c in FT_COLS)
SENT = "package_id string, resource_id string, text string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def odd_table(spark):
    rows = [("f1", "r1", "p1", "one", "c"), ("f1", "r1", "p1", "one", "c"), ("g1", "r1", "p1", "UNPROCESSED_FULLTEXT", None),
            ("f2", "r2", "p1", None, "c"), (None, "r3", "p1", "no id", "c"), ("f4", "r4", "p2", "four", "c"), ("f5", "r5", "p3", "five", "c"),
            ("f6", None, "p1", "six", "c"), ("f7", "r7", None, "seven", "c"), ("f8", "r8", "p4", "eight", "c"), ("f9", "r1", "p9", "moved", "c")]
    return spark.createDataFrame(rows, FT)


def test_merged_rows_are_those_of_the_actions(spark):
    """the rows a batch writes, by keys of the old rows only; repeated and
    null keys, packages that come twice, are deleted or not there."""
    old = odd_table(spark)
    sent = spark.createDataFrame([("p1", "r1", "new"), ("p1", "r1", "twice"), ("p1", "r2", " "), ("p1", "r3", "x"), ("p1", None, "y"), ("p2", "r4", "z"),
                                  ("p2", "r44", "z"), ("p3", "r5", "five"), (None, "r7", "lost"), ("p5", "r50", "in"), ("p9", "r9", None)], SENT)
    packages = spark.createDataFrame([("p1", "active"), ("p1", "draft"), ("p2", "deleted"), ("p3", None), (None, "deleted"), ("p4", "active")],
                                     "package_id string, state string")
    old = old.unionByName(spark.createDataFrame([(None, "r31", "p1", "no id", "c"), (None, None, "p3", "no id", "c"), (None, "r41", "p2", "no id", "c")], FT))
    acts = state.merge_actions(old, sent, packages)
    want = acts.where("action in ('update', 'insert') or (action = 'keep' and package_id is null and text is null)").select(*FT_COLS)
    got = state.merge_rows(old.select("id", "resource_id", "package_id"), sent, packages, 3)
    assert rows_of(got) == rows_of(want) and got.count() > 12


def test_merge_moves_no_other_text(spark, tmp_path):
    """the table after a batch is the merge's; old texts are not written
    again, and one exchange holds all texts of the index's differences."""
    old = odd_table(spark)
    sent = spark.createDataFrame([("p1", "r1", "new"), ("p1", "r2", " "), ("p3", "r5", "five"), ("p5", "r50", "in and in")], SENT)
    packages = spark.createDataFrame([(f"p{i}", "active") for i in range(10)], "package_id string, state string")
    listed = spark.createDataFrame([("p1", "r1"), ("p1", "r2"), ("p1", "r2"), ("p3", "r5"), ("p5", "r50"), ("p4", "r8"), (None, "r7")],
                                   "package_id string, resource_id string")
    shown = index.listed_texts(old, listed.distinct(), 1000)
    made = index.SearchIndex.build(shown, f"{tmp_path}/i", buckets=4)
    table, after = index.merge_and_index(made, old, sent, packages, listed, 1)
    assert rows_of(table) == rows_of(state.merge_result(old, sent, packages))
    assert {(r.term, r.package_id): r.tf for r in after.postings().collect() if r.package_id in ("p3", "p4", "p5")} == {
        ("five", "p3"): 1, ("eight", "p4"): 1, ("in", "p5"): 2, ("and", "p5"): 1}
    # A fresh index is read as it lies, without a shuffle.
    assert "Exchange" not in made.postings()._jdf.queryExecution().executedPlan().toString()


def test_differences_of_texts(spark):
    """what is taken off and added is what pairs of old and new rows
    of a resource differ by, also for repeated rows; equal texts go nowhere."""
    a = [("p1", "r1", "f1", "a b"), ("p1", "r1", "f1", "a b"), ("p1", "r1", "g1", "not kept"), ("p1", "r2", "f2", "same"), ("p2", "r3", "f3", "gone"),
         ("p2", "r4", "f4", None), ("p3", "r6", "f6", "hidden"), (None, "r7", "f7", "x"), ("p2", "r8", "f8", None)]
    b = [("p1", "r1", "f1", "b c"), ("p1", "r2", "f2", "same"), ("p2", "r4", "f4", "there"), ("p2", "r5", "n5", "new new"), ("p2", "r5", "n5", "new"),
         ("p3", "r6", "f6", "hidden too"), ("p2", "r8", "f8", None)]
    schema = "package_id string, resource_id string, id string, text string"
    listed = spark.createDataFrame([(f"p{p}", f"r{r}") for p in (1, 2) for r in range(9)] * 2, "package_id string, resource_id string")
    old, new = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    got = index.text_differences(old, index.shown_keys(old, listed), new, index.shown_keys(new, listed), 100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(package_id#\d+, \d+\), REPARTITION_BY_NUM", plan)) == 1
    assert rows_of(got) == sorted([("p1", "a b", -1), ("p1", "a b", -1), ("p1", "b c", 2), ("p2", "gone", -1), ("p2", None, -1), ("p2", "there", 1),
                                   ("p2", "new new", 1), ("p2", "new", 1), ("p2", None, -1), ("p2", None, 1)], key=repr)
    assert "hashpartitioning(term" not in index.postings(got)._jdf.queryExecution().executedPlan().toString()


def test_postings_packed_and_unpacked(spark):
    """packed where they lie, in rows of a package and bucket."""
    rows = [(f"t{i % 37}", f"p{i % 11}" if i % 11 else None, i - 300, i % 3) for i in range(700)]
    post = spark.createDataFrame(rows, "term string, package_id string, tf long, bucket int").repartition(2)
    for pack, most in ((index.packed(post), 2 * 33), (index.gathered(post), 33)):
        assert pack.count() <= most and rows_of(index.unpacked(pack).select("term", "package_id", "tf", "bucket")) == sorted(rows, key=repr)
    batch = pa.RecordBatch.from_pylist([{"package_id": p, "bucket": b, "term": t, "tf": n} for t, p, n, b in rows])
    for size in (1, 100, 1 << 20):
        parts = [*packs_udf(["package_id", "bucket", "terms", "tfs"], size)(iter([batch.slice(0, 50), batch.slice(50, 0), batch.slice(50)]))]
        assert sum(len(x) for b in parts for x in b.column(3).to_pylist()) == 700


def test_outcome_meets_keys_only(spark):
    """the write-back as a full outer join of whole rows has it; only keys
    of processed resources meet the outcome, other texts stay where they lie."""
    ft = odd_table(spark)
    out = spark.createDataFrame([("r1", "p1", "done", "k"), ("r3", "p1", "three", None), ("r4", "p2", "four", None), ("r4", "p2", "again", "k"),
                                 ("r77", "p7", "new", None), (None, "p1", "null", None)], "resource_id string, package_id string, text string, text_clear string")
    got = rows_of(state.apply_outcome(ft, out))
    assert got == sorted([
        ("f1", "r1", "p1", "done", "k"), ("f1", "r1", "p1", "done", "k"), ("r3-new", "r3", "p1", "three", None), ("f4", "r4", "p2", "four", None),
        ("f4", "r4", "p2", "again", "k"), ("r77-new", "r77", "p7", "new", None), (None, None, "p1", "null", None), ("f2", "r2", "p1", None, "c"),
        ("f5", "r5", "p3", "five", "c"), ("f6", None, "p1", "six", "c"), ("f7", "r7", None, "seven", "c"), ("f8", "r8", "p4", "eight", "c")], key=repr)


def test_index_differences_come_before_the_table(spark, catalog):
    """the run's differences are found while the table is as it was, so no
    copy of its old rows is written."""
    made = []
    real = session.scratch_path
    try:
        session.scratch_path = lambda spark, name: made.append(name) or real(spark, name)
        batch_run(catalog, index=True)
    finally:
        session.scratch_path = real
    assert "before" not in made and "postings" not in made and "outcome" not in made

"""What the findings of the round asked for."""

import pyarrow as pa
from pyspark.sql import functions as F

from doctext.functions.spans import walk_udf
from doctext.llm.extraction import content
from doctext.operators import index, repair
from doctext.operators.state import FT_COLS
from doctext.schema import Settings
from doctext.plans import catalog as _all  # noqa: F401  (registers every query)
from doctext.plans.registry import REGISTRY


def test_absent_key_keeps_whole_extras(catalog):
    """keys with their values, one row an extra, as the hidden set leaves them."""
    got = REGISTRY["hide_extras_list_absent"].build(catalog)
    want = REGISTRY["hide_extras_list"].build(catalog)
    assert got.columns == ["package_id", "key", "value"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_threshold_decides_in_marked_articles():
    """the paths' values decide in a marked article as elsewhere."""
    prose = "".join(f"<p>Sentence {i}, of the text, with stops. And one more; it is long, as prose goes.</p>" for i in range(8))
    got = content(f"<body><article><div><span>12 likes</span></div><h1>Title</h1>{prose}<div>7 views</div><div>print</div></article></body>")
    assert got[0] == "Title" and len(got) == 9 and got[-1].startswith("Sentence 7")


def test_index_texts_move_once(spark):
    """Kept rows of listed resources, as often
    as they are listed, in the tasks that the size asks for."""
    ft = spark.createDataFrame([("b", "r1", "p1", "UNPROCESSED_FULLTEXT", None), ("c", "r1", "p1", "one two one", None),
                                ("d", "r2", "p1", "two", None), ("e", "r3", "p2", "gone", None), ("f", None, "p1", "null", None),
                                ("g", "r4", None, "null", None), (None, "r5", "p1", "null", None), ("h", "r6", "p9", "other", None)],
                               ", ".join(f"{c} string" for c in FT_COLS))
    res = spark.createDataFrame([("p1", "r1"), ("p1", "r2"), ("p1", "r2"), ("p1", "r5"), ("p1", "r6"), ("p1", None), (None, "r4")],
                                "package_id string, resource_id string")
    got = index.listed_texts(ft, res, 5 * index.TASK_BYTES)
    assert sorted(map(tuple, got.collect())) == [("p1", "one two one"), ("p1", "two"), ("p1", "two")]
    assert got.rdd.getNumPartitions() == 5
    # The terms are counted where the texts lie: no second exchange.
    post = index.postings(got)
    assert "hashpartitioning(term" not in post._jdf.queryExecution().executedPlan().toString()
    assert {(r.term, r.tf) for r in post.collect()} == {("one", 2), ("two", 3)}


def test_walk_over_batches():
    """the walk goes on over the borders of batches, for null keys too."""
    rows = [(None, 0, 2, "ab"), (None, 0, 1, "a"), (None, 1, 2, "b"), ("x", 0, 3, "abc"), ("x", 2, 4, "cd"), ("x", 3, 4, "d"), ("y", 0, 1, "e")]
    schema = pa.schema([("k", pa.string()), ("pos", pa.int32()), ("end", pa.int32()), ("word", pa.string())])
    want = ["ab", "abc", "d", "e"]
    for size in (1, 2, 3, 7):
        parts = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + size]), schema.types)], schema=schema)
                 for i in range(0, len(rows), size)]
        got = [w for b in walk_udf(schema.names)(iter(parts)) for w in b.column(3).to_pylist()]
        assert got == want, size


def test_wrong_words_make_no_token_rows(spark):
    """only wrong words become rows; repeated and null keys are kept."""
    docs = spark.createDataFrame([("x", "ham burg zz qq"), ("x", "zz"), (None, "qq zz"), ("y", None)], "k string, text string")
    words = spark.createDataFrame([("hamburg",)], "word string")
    run = repair.repair(docs, "k", "text", words, Settings())
    plan = run.wrong._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    assert {(r.k, r.text_clear) for r in run.text.where("k is not null").collect()} == {("x", "hamburg"), ("y", "")}
    assert all(r.k in ("x", None) for r in run.wrong.collect())


def test_stream_files_by_size(catalog, monkeypatch):
    """a delivery is as many files as its texts take; every row is in one."""
    from doctext.plans import q_stream
    monkeypatch.setattr(q_stream, "FILE_BYTES", 1 << 14)
    seen = []
    monkeypatch.setattr(q_stream, "scratch_path", lambda spark, name: seen.append(__import__("tempfile").mkdtemp()) or seen[-1] + "/f")
    q_stream._files(catalog)
    got = catalog.spark.read.parquet(seen[0] + "/f")
    assert sorted(r[0] for r in got.select("doc_id").collect()) == sorted(r[0] for r in catalog.raw("documents").select("doc_id").collect())
    assert len(got.inputFiles()) > 4 and len(got.inputFiles()) % 4 == 0


def test_saved_texts_are_made_once(spark, tmp_path):
    """What is sent is read once, whatever is written from it."""
    from doctext.operators import save
    from doctext.operators.texttable import TextTable
    made = spark.sparkContext.accumulator(0)

    def count(t):
        made.add(1)
        return t
    table = TextTable(spark, f"{tmp_path}/t", 2)
    table.create(spark.createDataFrame([("f1", "r1", "p1", "old", None)], ", ".join(f"{c} string" for c in FT_COLS)))
    sent = spark.createDataFrame([("p1", "active", [("r1", "new")])], "package_id string, state string, resources array<struct<id:string,fulltext:string>>")
    once = F.udf(count, "string").asNondeterministic()
    saved = save.save_packages(sent.withColumn("state", once("state")), table, f"{tmp_path}/p")
    assert made.value == 1
    assert [r.text for r in saved.table.read().collect()] == ["new"]
    assert [(r.position, r.text) for r in saved.rows.collect()] == [(0, "new")]


def test_waiting_rows_carry_no_texts(spark):
    """what is unprocessed is found without the texts."""
    from doctext.streaming.ingest import marked
    df = spark.createDataFrame([("a", "UNPROCESSED_FULLTEXT", "x"), ("b", "long text", "y"), ("c", None, None)], "id string, text string, text_clear string")
    assert sorted(map(tuple, marked(df).collect())) == [("a", "UNPROCESSED_FULLTEXT", None), ("b", None, None), ("c", None, None)]

"""Streaming ingest: split packages, marks, restarts, outcomes, folding."""

from doctext.operators.texttable import TextTable
from doctext.streaming.ingest import batch_writer, decisions, fold, saved_as_sent, stream_ingest
from pyspark.sql import functions as F

ROWS = "package_id string, resource_id string, text string, version long, deleted boolean"
TEXTS = "id string, resource_id string, package_id string, text string, text_clear string"


def setup(spark, path, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, ROWS).coalesce(1).write.parquet(f"{path}/in/{i}")
    old = spark.createDataFrame([("o1", "r1", "p1", "x", "c"), ("o2", "r2", "p2", "y", "c"), ("o3", "r3", "p1", "z", "c"),
                                 ("o4", "r4", "p3", "w", "c"), ("o5", "r5", "p4", "v", "c")], TEXTS)
    pk = spark.createDataFrame([("p1", "active"), ("p2", "active"), ("p3", "deleted"), ("p4", "active")],
                               "package_id string, state string")
    return old, pk


def source(spark, path):
    return (spark.readStream.schema(ROWS).option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", 1).parquet(f"{path}/in"))


def texts(df):
    return {r.resource_id: r.text for r in df.collect()}


def test_split_packages_lose_nothing(spark, tmp_path):
    path = str(tmp_path)
    old, pk = setup(spark, path, [
        [("p1", "r1", "new", 1, False), ("p1", "r1", "newer", 2, False)], [("p1", "r9", "  ", 1, False)],
        [("p2", "r2", None, 1, True), ("p3", "r4", "again", 1, False)]])
    out = stream_ingest(spark, source(spark, path), old, pk, lambda b: b, f"{path}/t")
    assert texts(out) == {"r1": "newer", "r9": "NOT_AVAILABLE", "r3": "z", "r4": "again", "r5": "v"}
    # The same delivery with p1 and p3 declared whole.
    whole = spark.createDataFrame([("p1",), ("p3",)], "package_id string")
    out = stream_ingest(spark, source(spark, path), old, pk, lambda b: b, f"{path}/t", whole)
    assert texts(out) == {"r1": "newer", "r9": "NOT_AVAILABLE", "r5": "v"}


def test_restart_and_replay(spark, tmp_path):
    path = str(tmp_path)
    old, pk = setup(spark, path, [[("p1", "r1", "a", 1, False)]])
    go = lambda: texts(stream_ingest(spark, source(spark, path), old, pk, lambda b: b, f"{path}/t"))
    first = go()
    assert go() == first and first["r1"] == "a"  # no new files
    spark.createDataFrame([("p4", "r5", "b", 1, False)], ROWS).coalesce(1).write.parquet(f"{path}/in/more")
    assert go() == first | {"r5": "b"}
    # A batch that is run again leaves the same decisions.
    before = sorted(map(tuple, decisions(spark, f"{path}/t").collect()))
    again = spark.createDataFrame([("p4", "r5", "b", 1, False)], ROWS)
    batch_writer(spark, f"{path}/t", old, lambda b: b, saved_as_sent)(again, 1)
    assert sorted(map(tuple, decisions(spark, f"{path}/t").collect())) == before


def test_unprocessed_rows_are_decided_by_each_trigger(spark, tmp_path):
    path = str(tmp_path)
    old, pk = setup(spark, path, [[("p1", "r1", "a", 1, False)], [("p2", "r2", "b", 1, False)]])
    old = old.unionByName(spark.createDataFrame([("u1", "r7", "p4", "UNPROCESSED_FULLTEXT", None),
                                                 ("u2", "r2", "p2", "UNPROCESSED_FULLTEXT", None),
                                                 ("u3", "r8", "p4", "UNPROCESSED_FULLTEXT", "c")], TEXTS))
    fetch = spark.createDataFrame([("r7", "fetched"), ("r2", "late")], "resource_id string, raw string")
    decide = lambda t: t.select("package_id", "resource_id", F.coalesce(F.upper("text"), F.lit("ERROR_FULLTEXT")).alias("text"),
                                F.lit(None).cast("string").alias("text_clear"))
    out = stream_ingest(spark, source(spark, path), old, pk, lambda b: b, f"{path}/t", decide=decide, fetch=fetch)
    assert {(r.id, r.text, r.text_clear) for r in out.collect()} == {
        ("o1", "A", None), ("o2", "B", None), ("u2", "B", None), ("o3", "z", "c"), ("o4", "w", "c"), ("o5", "v", "c"),
        ("u1", "FETCHED", None), ("u3", "ERROR_FULLTEXT", None)}


def test_fold(spark, tmp_path):
    path = str(tmp_path)
    old, pk = setup(spark, path, [[("p1", "r1", "a", 1, False), ("p1", "r3", None, 1, True)]])
    table = TextTable(spark, f"{path}/table", 4)
    table.create(old)
    want = texts(stream_ingest(spark, source(spark, path), old, pk, lambda b: b, f"{path}/t"))
    assert len(fold(table, f"{path}/t")) == 1
    assert texts(table.read()) == want == {"r1": "a", "r2": "y", "r4": "w", "r5": "v"}
    fold(table, f"{path}/t")
    assert texts(table.read()) == want


def test_empty_folder(spark, tmp_path):
    path = str(tmp_path)
    old, pk = setup(spark, path, [[]])
    out = stream_ingest(spark, source(spark, path), old, pk, lambda b: b, f"{path}/t")
    assert texts(out) == texts(old)

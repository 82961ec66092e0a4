"""Selections, merge, outcome sentinels and visibility."""

from pyspark.sql import functions as F

from doctext.operators import select, state
from doctext.operators.assemble import attach_fulltext
from doctext.schema import Settings


def ft(spark, rows):
    return spark.createDataFrame(rows, "id string, resource_id string, package_id string, text string, "
                                       "text_clear string")


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_selection_modes(spark):
    t = ft(spark, [("1", "r1", "p1", "", None), ("2", "r2", "p2", "UNPROCESSED_FULLTEXT", None),
                   ("3", "r3", "p3", "ERROR_FULLTEXT", None), ("4", "r4", "p4", "_" * 21, None)])
    assert ids(select.work_selection(t, retry=False)) == ["p2"]
    assert ids(select.work_selection(t, retry=True)) == ["p2", "p3"]
    assert ids(select.work_selection(t, retry=True, max_size=20)) == ["p2", "p3", "p4"]


def test_length_bound_and_phrases(spark):
    sizes = ft(spark, [("1", "r1", "p1", "_" * 20, None), ("2", "r2", "p2", "_" * 21, None)])
    assert ids(select.packages_min_size(sizes, 20)) == ["p2"]
    t = ft(spark, [("3", "r3", "p3", "Wrong parameter set", None),
                   ("4", "r4", "p4", "  Wrong parameter set  ", None)])
    assert ids(select.packages_with_error(t)) == ["p3", "p4"]
    assert select.error_count(t).collect()[0][0] == 1          # untrimmed count


def test_dedupe_prefers_processed(spark):
    t = ft(spark, [("a", "r1", "p1", "UNPROCESSED_FULLTEXT", None), ("b", "r1", "p1", "text", None)])
    assert [r.id for r in state.dedupe_resource(t).collect()] == ["b"]


def test_merge(spark):
    old = ft(spark, [("o1", "r1", "p1", "x", "c"), ("o2", "r2", "p1", "y", "c"), ("o3", "r9", "p9", "z", "c"),
                     ("o4", "r5", "p5", "w", "c")])
    inc = spark.createDataFrame([("p1", "r1", 0, "new"), ("p1", "r3", 1, " "), ("p5", "r5", 0, "q")],
                                "package_id string, resource_id string, position long, text string")
    pk = spark.createDataFrame([("p1", "active"), ("p5", "deleted"), ("p9", "active")],
                               "package_id string, state string")
    out = {r.resource_id: (r.id, r.text, r.text_clear) for r in state.merge_result(old, inc, pk).collect()}
    assert out == {"r1": ("o1", "new", None), "r3": ("r3-new", "NOT_AVAILABLE", None), "r9": ("o3", "z", "c")}


def test_visibility_of_text(spark):
    t = ft(spark, [("1", "r1", "p1", "hello", None)])
    res = spark.createDataFrame([("r1", "p1", 0, "PDF"), ("r2", "p1", 1, "csv")],
                                "resource_id string, package_id string, position long, format string")
    got = {r.resource_id: (r.text, r.text_clear) for r in attach_fulltext(res, t).collect()}
    assert got == {"r1": ("hello", None), "r2": ("", "")}
    got = {r.resource_id: r.text for r in attach_fulltext(res, t, ["pdf"]).collect()}
    assert got == {"r1": "", "r2": ""}
    assert attach_fulltext(res, t, package_blacklist=["p1"]).count() == 0


def test_outcome_sentinels(spark):
    from doctext.plans.pipeline import outcome
    res = spark.createDataFrame([
        ("r1", "p1", "https://f.org/a.zip", "n", 10), ("r2", "p1", "https://f.org/b.pdf", "n", 10 ** 9),
        ("r3", "p1", "https://f.org/alkis_liegenschaftskarte/3", "n", 1), ("r4", "p1", "https://f.org/d.txt", "n", 1),
        ("r5", "p1", "https://f.org/e.txt", "n", 1)],
        "resource_id string, package_id string, url string, name string, file_size long")
    pk = spark.createDataFrame([("p1", "t")], "package_id string, title string")
    hv = spark.createDataFrame([], "package_id string, current boolean, state string, guid string, source_title string")
    fetched = spark.createDataFrame([("r4", "  some (text)\n"), ("r5", "404 Not Found   Not Found")],
                                    "resource_id string, raw string")
    arch = spark.createDataFrame([], "archive_id long, parent_id long, seq long, path string, text string")
    got = {r.resource_id: r.text for r in outcome(res, pk, hv, fetched, arch, Settings()).collect()}
    assert got == {"r1": "ERROR_FULLTEXT", "r2": "NOT_AVAILABLE", "r3": "NOT_AVAILABLE",
                   "r4": "some text", "r5": "ERROR_FULLTEXT"}


def test_ledger_first_failure_is_retry_one(spark):
    from doctext.operators.ledger import failure_report, retry_candidates
    a = spark.createDataFrame([("p1", 1, False, "ok"), ("p1", 2, True, "SearchIndexError"),
                               ("p2", 1, False, "ok")],
                              "package_id string, attempt_no long, failed boolean, error_class string") \
             .withColumn("ended_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    assert [(r.package_id, r.retry) for r in retry_candidates(a).collect()] == [("p1", 1)]
    none = a.filter("not failed")
    assert [r.line for r in failure_report(none).collect()] == ["No failed jobs found."]

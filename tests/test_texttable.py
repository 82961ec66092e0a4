"""Stored text table, saves and the batch run's write."""

import os

from doctext.operators.save import answer_full, answer_reduced, save_packages
from doctext.operators.texttable import TextTable
from doctext.plans.pipeline import outcome
from doctext.schema import Settings

FT = "id string, resource_id string, package_id string, text string, text_clear string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files(path):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def start(spark, tmp_path, buckets=8):
    rows = [(f"f{i}", f"r{i}", f"p{i // 2}", f"text {i}", "c") for i in range(40)] + [("g1", "r1", "p0", "UNPROCESSED_FULLTEXT", None)]
    table = TextTable(spark, f"{tmp_path}/t", buckets)
    table.create(spark.createDataFrame(rows, FT))
    return rows, table


def test_untouched_files_stay(spark, tmp_path):
    rows, table = start(spark, tmp_path)
    before = files(table.path)
    out = spark.createDataFrame([("r1", "p0", "new", "clear"), ("r99", "p0", "more", None)],
                                "resource_id string, package_id string, text string, text_clear string")
    touched = table.apply(out)
    assert len(touched) == 1
    after = files(table.path)
    same = {f for f in before if f"bucket={touched[0]}/" not in f}
    assert same and all(after.get(f) == before[f] for f in same)
    want = [r for r in rows if r[1] != "r1"] + [("f1", "r1", "p0", "new", "clear"), ("r99-new", "r99", "p0", "more", None)]
    assert rows_of(table.read()) == sorted(want, key=repr)
    table.apply(out)                                # again: the same table
    assert rows_of(table.read()) == sorted(want, key=repr)
    table.replace(table.read().limit(0), touched)   # a bucket that is left empty
    assert table.read(touched).count() == 0 and table.read().count() > 0
    assert table.apply(out.limit(0)) == []


def test_create_and_update(spark, tmp_path):
    rows, table = start(spark, tmp_path)
    schema = ("package_id string, name string, state string, url string, extras array<struct<key:string,value:string>>, "
              "resources array<struct<id:string,url:string,fulltext:string>>")
    ex = [("owner", "x"), ("topic", "y")]
    sent = spark.createDataFrame([
        ("p0", "a", "active", "u", ex, [("r1", "u1", "neu"), ("r50", "u2", None), ("r51", "u3", "  ")]),
        ("p1", "b", "deleted", "u", ex, [("r2", "u4", "gone")]),
        ("p2", "c", "active", "u", ex, []), ("p77", "d", "active", "u", ex, [("r70", "u5", "first")])], schema)
    saved = save_packages(sent, table, f"{tmp_path}/packages")
    now = {(r.package_id, r.resource_id, r.text) for r in table.read().collect()}
    assert {x for x in now if x[0] in ("p0", "p1", "p2", "p77")} == {
        ("p0", "r1", "neu"), ("p0", "r50", "NOT_AVAILABLE"), ("p0", "r51", "NOT_AVAILABLE"), ("p77", "r70", "first")}
    assert len(now) == 4 + 34
    full = {r.package_id: [(x.id, x.fulltext) for x in r.resources] for r in answer_full(saved).collect()}
    assert full == {"p0": [("r1", "neu"), ("r50", "NOT_AVAILABLE"), ("r51", "NOT_AVAILABLE")], "p1": [("r2", None)],
                    "p2": [], "p77": [("r70", "first")]}
    less = answer_reduced(saved, ["owner"], ["url"])
    assert "url" not in less.columns and [[tuple(e) for e in r.extras] for r in less.collect()] == [[("topic", "y")]] * 4
    assert less.schema["resources"].dataType.elementType.names == ["id", "url"]
    assert "fulltext" not in str(spark.read.parquet(f"{tmp_path}/packages").schema)


def test_rules_come_before_texts(spark, capsys):
    """Texts that no rule asks for are not moved: the plan filters them by a
    bitmap of the keys below its exchange."""
    res = spark.createDataFrame([("r1", "p1", "https://x.org/a.pdf", "n", 10, 0), ("r2", "p1", "https://x.org/a.gml", "n", 10, 1),
                                 ("r3", "p1", " ", "n", 10, 2), ("r4", "p1", "https://x.org/big.pdf", "n", 10 ** 9, 3),
                                 ("r5", "p9", "https://x.org/b.pdf", "n", 10, 0), ("r6", "p1", "https://x.org/a.zip", "n", 1, 4),
                                 ("r7", "p1", "https://x.org/alkis_liegenschaftskarte/1", "n", 1, 5), ("r8", "p1", "https://x.org/c", "n", 1, 6)],
                                "resource_id string, package_id string, url string, name string, file_size long, position long")
    packages = spark.createDataFrame([("p1", "t"), ("p9", "t")], "package_id string, title string")
    harvest = spark.createDataFrame([], "package_id string, current boolean, state string, guid string, source_title string")
    members = spark.createDataFrame([(6, None, 0, "a.txt", "zipped")], "archive_id long, parent_id long, seq long, path string, text string")
    fetched = spark.createDataFrame([(f"r{i}", f" body {i} ") for i in range(1, 8)], "resource_id string, raw string")
    s = Settings(format_blacklist=("gml",), package_blacklist=("p9",))
    o = outcome(res, packages, harvest, fetched, members, s)
    assert {r.resource_id: r.text for r in o.collect()} == {
        "r1": "body 1", "r2": "NOT_AVAILABLE", "r3": "NOT_AVAILABLE", "r4": "NOT_AVAILABLE", "r5": "NOT_AVAILABLE",
        "r6": "a.txt\nzipped", "r7": "NOT_AVAILABLE", "r8": "ERROR_FULLTEXT"}
    o.explain("formatted")
    plan = capsys.readouterr().out
    assert "shiftright" in plan and "routes" in plan

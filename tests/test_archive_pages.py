"""Nested archives, archive text, page text and redirects."""

from doctext.operators import archive
from doctext.sources import pages as pg


def members(spark):
    # root 1 holds test.txt, test.gml, test2.txt and nested archives 2 and 3
    # (each a copy of the root's files); archive 2 itself holds archive 4.
    rows = []
    files = [("test.txt", "test.txt"), ("test.gml", "test.gml")]
    rows += [(1, None, i, p, t) for i, (p, t) in enumerate(files)]
    rows += [(2, 1, i, p, t) for i, (p, t) in enumerate(files + [("test2.txt", "test2.txt")])]
    rows += [(3, 1, i, p, t) for i, (p, t) in enumerate(files + [("test2.txt", "test2.txt")])]
    rows += [(4, 2, 0, "test.txt", "test.txt"), (4, 2, 1, "test.gml", "test.gml")]
    return spark.createDataFrame(rows, "archive_id long, parent_id long, seq long, path string, text string")


def test_nested_counts_and_blacklist(spark):
    m = members(spark)
    assert archive.archive_members(m).count() == 10
    assert archive.archive_members(m, ["gml"]).count() == 6


def test_archive_text_order(spark):
    m = spark.createDataFrame([(1, None, 0, "a.txt", "A"), (1, None, 1, "b.txt", "  "),
                               (2, 1, 0, "c.txt", "C (x)")],
                              "archive_id long, parent_id long, seq long, path string, text string")
    got = archive.archive_text(m).collect()
    assert [(r.archive_id, r.text) for r in got] == [(1, "a.txt\nc.txt\nA\nC x")]


def test_page_text_and_xml(spark):
    xml = ("<?xml version='1.0'?><wfs:FeatureCollection><!-- c --><gml:name>Basis-DLM</gml:name>"
           "<x>a &amp; b</x></wfs:FeatureCollection>")
    df = spark.createDataFrame([(xml,), ("<script>var a;</script>  ",)], "html string")
    got = [r[0] for r in df.select(pg.page_text("html")).collect()]
    assert "Basis-DLM" in got[0] and "a & b" in got[0] and "<" not in got[0]
    assert got[1] is None


def test_redirects(spark):
    df = spark.createDataFrame([
        (1, "http://h.org/a/b.html", "<script>window.location.replace('http://o.org/x');</script>"),
        (2, "http://h.org/a/b.html", "<script>window.location.assign('./c.html');</script>"),
        (3, "http://h.org/a/b.html", "<p>no script</p>")], "page_id long, url string, html string")
    got = [r[0] for r in df.orderBy("page_id").select(pg.redirect_target("url", "html")).collect()]
    assert got == ["http://o.org/x", "http://h.org/a/c.html", "http://h.org/a/b.html"]


def test_deep_and_many_archives(spark):
    """A chain of 150, a cycle, an orphan, and two million flat archives."""
    schema = "archive_id long, parent_id long, seq long, path string, text string"
    chain = [(i, None if i == 1 else i - 1, 0, f"f{i}.txt", "t") for i in range(1, 151)]
    odd = [(1001, 1002, 0, "c.txt", "t"), (1002, 1001, 0, "c.txt", "t"), (1003, 999, 0, "o.txt", "t")]
    tree = {r.archive_id: r for r in archive.archive_tree(spark.createDataFrame(chain + odd, schema)).collect()}
    assert set(tree) == set(range(1, 151))
    assert tree[150].depth == 149 and tree[150].root_id == 1 and all(tree[i].depth == i - 1 for i in tree)
    flat = spark.range(1, 2_000_001).selectExpr(
        "id as archive_id", "if(id % 2 = 0, id - 1, null) as parent_id", "0L as seq", "'a' as path", "'t' as text")
    cycle = spark.createDataFrame([(5_000_001, 5_000_002, 0, "c", "t"), (5_000_002, 5_000_001, 0, "c", "t"),
                                   (5_000_003, 5_000_001, 0, "c", "t")], schema)
    tree = archive.archive_tree(flat.unionByName(cycle))
    got = tree.groupBy("depth").count().collect()
    assert {r["depth"]: r["count"] for r in got} == {0: 1_000_000, 1: 1_000_000}
    assert {f.dataType.simpleString() for f in tree.schema} <= {"bigint", "int"}    # numbers, no paths


def test_breadth_first_order_against_paths(spark):
    """Places within root and depth order archives as their paths of ids do."""
    import random
    rng = random.Random(4)
    parent = {}
    ids = rng.sample(range(1000), 300)
    for n, a in enumerate(ids):
        parent[a] = None if n < 5 else rng.choice(ids[max(0, n - 40):n])
    df = spark.createDataFrame([(a, p, 0, "f", "t") for a, p in parent.items()],
                               "archive_id long, parent_id long, seq long, path string, text string")

    def path(a):
        return (path(parent[a]) if parent[a] is not None else []) + [a]
    got = {r.archive_id: r for r in archive.archive_tree(df).collect()}
    assert set(got) == set(parent)
    for a in parent:
        assert (got[a].root_id, got[a].depth) == (path(a)[0], len(path(a)) - 1)
    groups = {}
    for a in parent:
        groups.setdefault((got[a].root_id, got[a].depth), []).append(a)
    for same in groups.values():
        assert sorted(same, key=lambda a: got[a].place) == sorted(same, key=path)


def test_pages_that_share_an_address_and_linear_scripts(spark):
    import time
    go = "<script>window.location.replace('http://t.org/x');</script>"
    df = spark.createDataFrame([(1, "http://t.org/x", "<p>first</p>"), (2, "http://t.org/x", "<p>second</p>"),
                                (3, "http://s.org/a", go), (4, "http://s.org/b", go), (5, "http://s.org/c", go.replace("/x", "/none")),
                                (6, None, None)], "page_id long, url string, html string")
    got = {r.page_id: (r.target_id, r.text) for r in pg.redirect_text(df).collect()}
    assert {k: got[k] for k in (1, 2, 3, 4, 5)} == {1: (1, "first"), 2: (1, "first"), 3: (1, "first"), 4: (1, "first"), 5: (None, None)}
    assert len(got) == 6
    many = spark.createDataFrame([("<script>" * 100_000,), ("<script " * 100_000,), ("<script>a</script>" * 50_000,),
                                  ("</script><SCRIPT x='1'>go</Script>",), (None,)], "html string")
    start = time.time()
    got = [r[0] for r in many.select(pg.first_script("html")).collect()]
    assert got == ["", "", "a", "go", ""] and time.time() - start < 10


def test_csv_members(spark):
    m = spark.createDataFrame([(1, None, 0, "a.csv", "x;y"), (1, None, 1, "b.txt", "x;y")],
                              "archive_id long, parent_id long, seq long, path string, text string")
    assert archive.archive_text(m).first()["text"] == "a.csv\nb.txt\nx y\nxy"


def test_entities_and_blocks(spark):
    cases = [
        ("M&uuml;ller &#252; &#xfc; &ndash; &unknown; &amp;lt; &", "Müller ü ü – &unknown; &lt; &"),
        ("a<SCRIPT type=x>var t='<script>';</Script>b<style>p{}</style>c<!-- <p> -->d", "a b c d"),
        ("a </script> b <!-- open", "a b <!-- open"), ("1 < 2 <b>x</b>", "1 x"), ("<p>&nbsp;</p>", None),
    ]
    df = spark.createDataFrame(cases, "html string, want string")
    for r in df.select("html", "want", pg.page_text("html").alias("got")).collect():
        assert r.got == r.want, r.html


def test_long_runs_are_linear(spark):
    import time

    from pyspark.sql import functions as F

    from doctext.functions import text as tx
    # Not literals: the engine would fold those, and print them in its plans.
    reps = spark.range(1_000_000, 1_000_001).select(F.col("id").cast("int").alias("n"))
    jobs = [reps.select(F.length(tx.strip_ws(F.concat(F.lit("a"), F.repeat(F.lit(" "), F.col("n")), F.lit("b")))).alias("n")),
            reps.select(F.length(pg.page_text(F.concat(F.repeat(F.lit("<a "), F.col("n")), F.lit("b")))).alias("n"))]
    for want, job in zip((1_000_002, 3_000_001), jobs):
        job.collect()
        start = time.time()
        assert job.first()["n"] == want
        assert time.time() - start < 20  # about a second alone; a quadratic scan takes hours

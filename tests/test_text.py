"""Word split, normalisation, predicates and URL functions."""

import urllib.parse

from pyspark.sql import functions as F

from doctext.functions import text as tx
from doctext.functions import urls as U


def one(spark, col_fn, value, schema="v string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(col_fn(F.col("v")).alias("r")).collect()[0]["r"]


def test_word_split_default(spark):
    cases = {"test": ["test"], "  test ": ["test"], "  t&est ": ["t", "est"], "  t...est ": ["t", "est"],
             "  t??est ": ["t", "est"], "[test]": ["test"], "[te]st]": ["te]st"], "[": []}
    for text, want in cases.items():
        assert one(spark, tx.words, text) == want, text


def test_word_split_custom(spark):
    assert one(spark, lambda c: tx.words(c, "   "), " te s   t") == ["te", "s", "t"]
    assert one(spark, lambda c: tx.words(c, " "), " te s   t") == ["te", "s", "t"]
    assert one(spark, lambda c: tx.words(c, "._-"), "st.pauli-x_y") == ["st", "pauli", "x", "y"]


def test_normalise(spark):
    assert one(spark, tx.normalise, "Ab-\ncd (x); y?\tz�") == "Abcd x y z"
    assert one(spark, lambda c: tx.normalise(c, is_csv=True), "a;b!c") == "a bc"
    assert one(spark, lambda c: tx.normalise(c, False), "a-\nb (c)") == "ab (c)"
    assert one(spark, tx.remove_specials, "1â\u0080¢ 2") == "1    2"


def test_predicates(spark):
    assert one(spark, tx.is_error_page, "x 404 Not Found   Not Found y") is True
    assert one(spark, tx.is_error_page, None) is False
    assert one(spark, tx.is_email_token, "test@me.de") is True
    assert one(spark, tx.is_email_token, "a@b.de") is False       # too short
    assert one(spark, tx.is_url_token, "http://x") is True
    assert one(spark, tx.is_upper_word, "STRAßE") is False
    assert one(spark, tx.is_upper_word, "BGM") is True
    assert one(spark, tx.is_blank, " \t\n") is True


def test_truncation(spark):
    t = "_" * 20
    assert one(spark, lambda c: tx.truncate(c, 30), t) == t
    assert one(spark, lambda c: tx.truncate(c, 10), t) == "_" * 10
    assert one(spark, lambda c: tx.truncate(c, 0), t) == t


def py_normalise_url(url):
    """The URL rule written with the Python standard library."""
    if url.startswith("/"):
        return url
    p = urllib.parse.urlparse(url)
    path = urllib.parse.quote(p.path.encode("utf-8")).replace("%25", "%")
    out = p.scheme + "://" + p.netloc + path
    return out + ("?" + p.query if p.query else "")


def test_normalise_url_matches_urllib(spark):
    urls = ["https://h.example.org/a b/ü~*+(1).html;v=3?q=1#frag",
            "http://x.example.com/p/%20done.pdf?a=b&c=d", "/srv/data/1.txt",
            "HTTP://Up.example.org/x/y z"]
    for u in urls:
        assert one(spark, U.normalise_url, u) == py_normalise_url(u), u


def test_case_file_url(spark):
    u = "http://h.example.org///svc/x/Akte:AB1.52-20/0008.pdf"
    assert one(spark, U.case_file_url, u) == "http://h.example.org//svc/x/AkteAB1.52-200008.pdf"


def test_resolve_relative(spark):
    df = spark.createDataFrame([("./next.html", "http://h.org/a/b/c.html"),
                                ("../up.html", "http://h.org/a/b/c.html"),
                                ("../../../../r", "http://h.org/a/b/c.html"),
                                ("./x", "http://h.org/c.html")], "rel string, url string")
    got = [r[0] for r in df.select(U.resolve_relative("rel", "url")).collect()]
    assert got == ["http://h.org/a/b/next.html", "http://h.org/a/up.html", "http://h.org/r",
                   "http://h.org/x"]


def test_file_stem(spark):
    assert one(spark, U.file_stem, "http://h.org/a.b/c.pdf") == "httph_orga_bc_pdf"
    assert one(spark, U.file_stem, "/tmp/x/report.final.pdf") == "report"


def test_meeting_urls(spark):
    df = spark.createDataFrame([
        ("https://sitzungsdienst.x.org/ti/vo020.asp?x=1", "Drucksache 3", "Sitzungsprotokoll (Druckversion) 1",
         "u#volfdnr=42#guid=420"),
        ("http://sitzungsdienst.x.org/bi/vo020.asp", "Drucksache 3", "res", "u#volfdnr=42#guid=420"),
        ("https://sitzungsdienst.x.org/ti/vo020.asp", "Drucksache 3", "res", None),
        ("https://files.x.org/a.pdf", "Drucksache 3", "res", "u#guid=1")],
        "url string, title string, name string, guid string")
    got = [r[0] for r in df.select(U.fulltext_url("url", "title", "name", "guid")).collect()]
    assert got == ["https://sitzungsdienst.x.org/ti/do027.asp?DOLFDNR=42&options=64&dtyp=116",
                   "http://sitzungsdienst.x.org/bi/do027.asp?DOLFDNR=420&options=64&dtyp=130",
                   "https://sitzungsdienst.x.org/ti/vo020.asp", "https://files.x.org/a.pdf"]

import html
import re
import time

from doctext.llm.extraction import content, extract, path_scores, read, smooth
from doctext.llm.queries import QUERIES


def article(page):
    """Blocks of the one article of a generated page, by its closing tags."""
    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S).group(1)
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(p for p in parts if p)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r[0]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op12_main_text"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == article(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"])
        assert r["url"] == pages[r["page_id"]]["url"]


def test_pages_without_a_marked_article():
    prose = "<p>First paragraph, it has words, and more. So it goes.</p><ul><li>one item</li><li>two</li></ul><p>Last, with text.</p>"
    side = "<div class='left-sidebar'><p>Side text, with words. And more.</p></div>"
    rest = ("<div id=userComments><p>I liked it, much. Yes!</p></div><div role=complementary><p>See also, this. Or that.</p></div>"
            "<p hidden>Not seen, at all. No.</p><form><p>Write, to us. Now!</p></form><footer>&copy; x</footer>")
    page = (f"<html><body class='has-sidebar'><header><h1>Site</h1></header><div class=cookie-notice><p>We use, cookies. Yes.</p></div>"
            f"{side}<div id=content><h2>Title here</h2>{prose}</div>{rest}</body></html>")
    want = ["Title here", "First paragraph, it has words, and more. So it goes.", "one item", "two", "Last, with text."]
    assert content(page) == want
    links = "<div><ul>" + "<li><a href=x>Some linked words</a></li>" * 8 + "</ul></div>"
    assert content(f"<body>{links}<div><p>Body, of the page. With stops.</p><p>More, of it. Yes.</p></div>{links}</body>") == [
        "Body, of the page. With stops.", "More, of it. Yes."]


def test_marked_articles():
    page = ("<p>Outside, of it. Yes.</p><article><header><h1>T</h1><p>by line</p></header><p>Body &lt;b&gt; text.<br>more"
            "<span class=ad> Buy!</span></p><div>loose <i>and</i> <div>deep</div> end</div>"
            "<section class='comments'><article class='comment'><p>no</p></article></section></article>")
    assert content(page) == ["T", "Body <b> text. more", "loose and", "deep", "end"]
    assert content("<article></article><p>Only, this. Yes.</p>") == ["Only, this. Yes."]
    assert content("<div class=sidebar><article><p>In.</p></article></div>") == ["In."]


def test_defined_results(spark):
    cases = {None: "", "": "", " \n": "", "plain &amp; text": "plain & text", "a < b and <b>c</b> > d": "a < b and c > d",
             "<p>cut <b>of": "cut of", "<p>x<script>if (a<b) '</p>'": "x", "<!-- never closed <p>x": "",
             "<p title=\"a>b\">y</p>": "y", "<form><h1>T</h1><p>In a form.</p></form>": "T\nIn a form.",
             "<table><tr><td>a<td>b<tr><td>c</table>": "a\nb\nc", "<p>one<p>two": "one\ntwo", "word " * 300000: ("word " * 300000).strip(),
             "<div class=widget><p>All there is.</p></div>": "All there is.", "&nbsp;x&#8212;y&nbsp;": "x—y"}
    rows = [(i, "u", h, 1, "t") for i, h in enumerate(cases)] + [(None, None, "<p>z", 1, "t")] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string")
    got = extract(df).collect()
    assert sorted((r["page_id"], r["text"]) for r in got if r["page_id"] is not None) == list(enumerate(cases.values()))
    assert [r["text"] for r in got if r["page_id"] is None] == ["z", "z"]
    assert extract(df.limit(0)).count() == 0


def test_time_is_linear():
    start = time.time()
    for page in ('<a "' * 50000, "<!--" * 50000, "<script>" * 50000, "<div>" * 20000, "<p class=\"" * 50000, "<li>" * 20000,
                 "<li><ul>" + "<i>" * 20000 + "<li></li>" * 20000, "<div><h1>" * 20000, "<" * 100000, "<p " + "a=\"" * 100000 + ">x"):
        content(page)
    assert time.time() - start < 20


def test_ratios_by_hand():
    assert smooth(__import__("numpy").array([3.0, 0.0, 0.0])).tolist() == [2.0, 0.75, 0.0]
    got = path_scores([1, 2, 2], [9, 30, 30], [0, 2, 4])
    # length 9, 30, 30 and punctuation 0, 3, 3 per block, smoothed with 1 2 1
    assert {k: round(v, 6) for k, v in got.items()} == {1: 16.0, 2: round((24.75 * 2.25 + 30 * 3) / 2, 6)}
    assert len(read("<p>a<p>b")[1]) == 2

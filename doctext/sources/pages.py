"""Plain text of stored pages and script redirects."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import _col
from ..functions.urls import resolve_relative
from ..operators.keys import near_keys
from ..session import written

WS = r"[\t\n\x{0B}\f\r ]"


#: Named entities of the Latin-1 letters and common marks (fixed values).
ENTITIES = {
    "nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "auml": "ä", "ouml": "ö", "uuml": "ü", "Auml": "Ä",
    "Ouml": "Ö", "Uuml": "Ü", "szlig": "ß", "eacute": "é", "egrave": "è", "ecirc": "ê", "agrave": "à", "acirc": "â",
    "ccedil": "ç", "ntilde": "ñ", "iacute": "í", "oacute": "ó", "uacute": "ú", "aacute": "á", "euro": "€",
    "sect": "§", "copy": "©", "reg": "®", "ndash": "–", "mdash": "—", "hellip": "…", "bdquo": "„", "ldquo": "“",
    "rdquo": "”", "laquo": "«", "raquo": "»", "middot": "·", "deg": "°",
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is named."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _drop_blocks(x: Column, opening: str, closing: str, end: str) -> Column:
    """Text outside ``opening ... closing`` blocks, each block a space: cut at
    every closing, and drop each piece from its first opening on.  A piece
    without an opening keeps its closing.  Linear, and the rest after the
    last closing stays whole, so an opening that never closes stays too."""
    def piece(p: Column) -> Column:
        return _let(F.regexp_instr(p, F.lit(opening)), lambda at: F.when(
            at > 0, F.concat(F.substr(p, F.lit(1), at - 1), F.lit(" "))).otherwise(F.concat(p, F.lit(end))))

    return _let(F.split(x, closing), lambda ps: F.concat(
        F.array_join(F.transform(F.slice(ps, F.lit(1), F.size(ps) - 1), piece), ""), F.element_at(ps, -1)))


def decode_entities(x: Column) -> Column:
    """Named, decimal and hexadecimal entities; unknown ones stay.  One cut
    at ``&``; ``&amp;`` is decoded like the others, so nothing is decoded twice."""
    names = F.create_map(*[F.lit(v) for pair in (ENTITIES | {"amp": "&"}).items() for v in pair])

    def decoded(name: Column) -> Column:
        code = (F.when(name.rlike("^#[0-9]{1,7}$"), F.substr(name, F.lit(2)).cast("int"))
                 .when(name.rlike("^#[xX][0-9a-fA-F]{1,6}$"), F.conv(F.substr(name, F.lit(3)), 16, 10).cast("int")))
        char = _let(code, lambda n: F.when((n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF),
                                           F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")))
        return F.coalesce(F.try_element_at(names, name), char)

    def one(p: Column) -> Column:
        """A piece after ``&``: its entity decoded, or the ``&`` put back."""
        end = F.instr(F.substr(p, F.lit(1), F.lit(10)), ";")
        return _let(end, lambda e: _let(F.when(e > 1, decoded(F.substr(p, F.lit(1), e - 1))), lambda got: F.when(
            got.isNotNull(), F.concat(got, F.substr(p, e + 1))).otherwise(F.concat(F.lit("&"), p))))

    return _let(F.split(x, "&"), lambda ps: F.concat(
        F.element_at(ps, 1), F.array_join(F.transform(F.slice(ps, F.lit(2), F.size(ps)), one), "")))


def page_text(c) -> Column:
    """Markup to plain text: script/style blocks and comments dropped,
    tags to spaces, entities decoded, white space collapsed and trimmed; an
    empty result is NULL.  Linear in the page, also with openings that never
    close (those stay as text)."""
    x = _col(c)
    for opening, closing, end in ((r"(?i)<script\b", "(?i)</script>", "</script>"),
                                  (r"(?i)<style\b", "(?i)</style>", "</style>"), ("<!--", "-->", "-->")):
        x = _drop_blocks(x, opening, closing, end)
    x = decode_entities(_drop_blocks(x, "<", ">", ">"))
    x = F.btrim(F.regexp_replace(x, WS + "+", " "), F.lit(" "))
    return F.nullif(x, F.lit(""))


def first_script(html) -> Column:
    """The inside of the first closed script block ('' without one).  Cut at
    the closings: the first piece that holds an opening is the block's, so
    every character is looked at a fixed number of times."""
    pieces = F.split(_col(html), "(?i)</script>")
    closed = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))
    inside = F.transform(closed, lambda p: _let(F.regexp_instr(p, F.lit(r"(?i)<script\b[^>]*>")), lambda at: F.when(
        at > 0, _let(F.substr(p, at), lambda q: F.substr(q, F.instr(q, ">") + 1)))))
    return F.coalesce(F.try_element_at(F.filter(inside, lambda x: x.isNotNull()), F.lit(1)), F.lit(""))


def redirect_target(url, html) -> Column:
    """Where a page's first script sends the browser.  The argument of
    ``window.location.<method>(...)`` (quotes stripped): absolute -> itself,
    starting with '.' -> resolved against the page URL, else the page URL."""
    u = _col(url)

    def argument(sub: Column) -> Column:
        a, b = F.instr(sub, "("), F.instr(sub, ")")
        end = F.when(b > 0, b - 1).otherwise(F.length(sub) - 1)
        return F.btrim(F.substring(sub, a + 1, F.greatest(end - a, F.lit(0))), F.lit("'"))

    def target(js: Column) -> Column:
        at = F.instr(js, "window.location.")
        sent = _let(argument(F.substring(js, at, 1 << 30)), lambda arg: F.when(arg.startswith("http"), arg)
                    .when(arg.startswith("."), resolve_relative(arg, u)).otherwise(u))
        return F.when(at == 0, u).otherwise(sent)

    # A page without the words has no script that sends on.
    return F.when(_col(html).contains("window.location."), _let(first_script(html), target)).otherwise(u)


def pages_by_url(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(target, target_id, text)``: one page for every wanted ``target`` that
    is a page's URL, the smallest id where pages share it.  The page is picked
    on narrow columns; only picked pages are turned into text."""
    first = (near_keys(pages.select(F.col("url").alias("target"), "page_id"), wanted, "target")
             .groupBy("target").agg(F.min("page_id").alias("target_id")))
    picked = written(first.join(wanted, "target", "left_semi"), "picked")
    body = near_keys(pages.select(F.col("page_id").alias("target_id"), "html"), picked, "target_id")
    return picked.join(body, "target_id").select("target", "target_id", page_text("html").alias("text"))


def redirect_text(pages: DataFrame) -> DataFrame:
    """J6 + S4: each page's target and the plain text of the target page.

    A target's page is picked and turned into text once, however many pages
    lead to it; a popular target is a skewed join key, which AQE's skew-join
    handling splits.
    """
    src = written(pages.select("page_id", redirect_target("url", "html").alias("target")), "targets")
    return src.join(pages_by_url(pages, src.select("target")), "target", "left").select(
        "page_id", "target", "target_id", "text")

"""Main text of web pages by tag-path ratios.

A page is read into blocks: runs of text between block-level tags, each with
the path of block-level tags from the root to it.  Per path, text length and
punctuation are summed and divided by the path's blocks; both ratios are laid
along the page, smoothed, and fused into one value per block, averaged again by
path.  Paths over the threshold are content.

Tags and attributes decide first what they say plainly: navigation, forms,
asides, page headers and footers, scripts, hidden elements and elements named
after adverts, notices, menus, sidebars or comments are never content, and
where a page marks its article, nothing outside it is.  What is left, in a
marked article as elsewhere, is content from the first to the last block whose
path is over the threshold, with the heading before it and without link lists.

The reader is one pass over the page's tags: an unclosed quote, comment or tag
is looked for once, so a page takes time in proportion to its length.

Defined results: a null or empty page has the empty text; broken and cut pages
are read as far as they go; very long pages are read whole; repeated rows and
null ids give a row each; extra columns are ignored; an empty table gives an
empty result.  A line break tag is white space.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed sets of tag names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt "
                    "ruby s samp small span strike strong sub sup time tt u var wbr").split())
NEVER = frozenset(("head nav header footer aside form script style textarea title xmp iframe noembed noframes noscript "
                   "button select option datalist label fieldset object svg canvas template dialog menu audio video "
                   "math map").split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that a new one of the same kind ends, up to the nearest holder.
ENDS_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"),
             "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
#: Words of class and id that name what is not the article.
HINTS = frozenset((
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar "
    "rail menu nav navbar navigation breadcrumb breadcrumbs masthead topbar footer cookie cookies consent gdpr notice "
    "notices notification popup modal overlay comment comments respond reply replies disqus share sharing social "
    "related recommended recommendations teaser widget newsletter subscribe subscription signup login search toolbar "
    "pagination pager paywall").split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())

PUNCTUATION = re.compile(r"[,.;:!?…，。；：！？、؟،]")
#: Smoothing weights over neighbouring blocks.
KERNEL = np.array([1.0, 2.0, 1.0])
#: Share of the standard deviation of the fused values that content exceeds.
THRESHOLD = 0.5
#: A path whose text is linked by more than this share is a link list.
LINKED = 0.7

_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s=>"'/][^\s=>/]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_STEP = re.compile(r"""[^>"']*""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_CLOSE = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


@dataclass
class Element:
    name: str
    up: int
    path: int                # number of the path of block-level tags to it
    never: bool = False      # by its tag, role or attributes
    hinted: bool = False     # by class or id
    main: bool = False       # article, main, or marked as such
    core: bool = False       # holds an article
    title: bool = False      # holds a first-level heading


@dataclass
class Block:
    path: int
    element: int
    parts: list[tuple[int, str]] = field(default_factory=list)


def tags(page: str) -> Iterator[tuple[str, str, str]]:
    """``(kind, name, rest)``: ``text``, ``open`` with its attributes, or
    ``close``; comments, declarations and the inside of raw elements go."""
    at, n = 0, len(page)
    last = {q: page.rfind(q) for q in "\"'"}
    raw_end = {}
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", "", page[at:]
            return
        m = _NAME.match(page, lt + 1)
        if m is None:
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 4)
            elif page[lt + 1:lt + 2] in ("!", "?", "/") and lt + 1 < n:
                end = page.find(">", lt + 2)
            else:  # a plain sign
                yield "text", "", page[at:lt + 1]
                at = lt + 1
                continue
            if lt > at:
                yield "text", "", page[at:lt]
            if end < 0:
                return
            at = end + (3 if page.startswith("<!--", lt) else 1)
            continue
        if lt > at:
            yield "text", "", page[at:lt]
        end = m.end()
        while True:
            end = _STEP.match(page, end).end()
            if end >= n or page[end] == ">":
                break
            quote = page[end]
            # Only a quote after an equals sign opens a value.
            if end < last[quote] and page[max(m.end(), end - 80):end].rstrip()[-1:] == "=":
                end = page.find(quote, end + 1) + 1
            else:
                end += 1
        if end >= n:
            return
        name = m.group(1).lower()
        at = end + 1
        if page[lt + 1] == "/":
            yield "close", name, ""
            continue
        yield "open", name, page[m.end():end]
        if name in RAW:
            if raw_end.get(name, 0) >= 0:
                m = _CLOSE[name].search(page, at)
                raw_end[name] = m.start() if m else -1
            if raw_end[name] < 0:
                return
            at = raw_end[name]


def attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    if text.strip(" /\t\r\n\f"):
        for name, a, b, c in _ATTRIBUTE.findall(text):
            out.setdefault(name.lower(), references.unescape(a or b or c))
    return out


def _element(name: str, rest: str, up: int, path: int) -> Element:
    a = attributes(rest)
    role = a.get("role", "").lower()
    e = Element(name, up, path)
    e.main = name in ("article", "main") or role == "main" or "articlebody" in a.get("itemprop", "").lower()
    e.never = (name in NEVER or role in ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true"
               or bool(_HIDDEN.search(a.get("style", ""))))
    named = f"{a.get('class', '')} {a.get('id', '')}"
    if named.strip() and name not in ("html", "body", "main"):
        e.hinted = any(w.lower() in HINTS for w in _WORDS.findall(named))
    return e


def read(page: str) -> tuple[list[Element], list[Block]]:
    """The elements of a page, parents first, and its blocks in order."""
    elements = [Element("", -1, 0)]
    stack: list[int] = [0]
    open_at: dict[str, list[int]] = {}       # depths of the open elements of a name
    paths: dict[tuple[int, str], int] = {}   # of the path above and a name
    blocks: list[Block] = []
    block: Block | None = None

    def deepest(*names: str) -> int:
        return max((open_at[x][-1] for x in names if open_at.get(x)), default=0)

    def end_at(depth: int) -> None:
        while len(stack) > depth:
            open_at[elements[stack.pop()].name].pop()

    for kind, name, rest in tags(page):
        if kind == "text":
            if block is None:
                block = Block(elements[stack[-1]].path, stack[-1])
                blocks.append(block)
            block.parts.append((stack[-1], references.unescape(rest) if "&" in rest else rest))
            continue
        if name == "br" and block is not None:
            block.parts.append((stack[-1], " "))
        if name not in INLINE:
            block = None
        if kind == "close":
            if open_at.get(name):
                end_at(open_at[name][-1])
            continue
        if name not in INLINE and open_at.get("p"):
            end_at(open_at["p"][-1])
        if name in ENDS_SAME:
            same = deepest("dt", "dd") if name in ("dt", "dd") else deepest(name)
            if same > deepest(*ENDS_SAME[name]):
                end_at(same)
        if name in VOID:
            continue
        up = stack[-1]
        path = elements[up].path
        if name not in INLINE:
            path = paths.setdefault((path, name), len(paths) + 1)
        e = _element(name, rest, up, path)
        elements.append(e)
        open_at.setdefault(name, []).append(len(stack))
        stack.append(len(elements) - 1)
        k = up
        while e.main and k > 0 and not elements[k].core:
            elements[k].core = True
            k = elements[k].up
        while name == "h1" and k > 0 and not elements[k].title:
            elements[k].title = True
            k = elements[k].up
    return elements, blocks


def barred(elements: list[Element], hints: bool = True) -> list[bool]:
    """Whether an element lies in one that is never content.  A class that
    stands around an article, or a form around its title, bars nothing; in an
    article's header the headings stay."""
    out, inside = [False] * len(elements), [False] * len(elements)
    for k, e in enumerate(elements[1:], 1):
        up = elements[e.up]
        inside[k] = inside[e.up] or e.main
        own = e.never and not (e.name == "form" and (e.core or e.title))
        own |= hints and e.hinted and not e.core
        out[k] = out[e.up] or own
        if e.name in HEADINGS and up.name == "header" and inside[e.up] and not out[up.up] and not own:
            out[k] = False
    return out


def main_elements(elements: list[Element], out: list[bool], sizes: list[int]) -> set[int]:
    """Outermost articles (or else main elements) that hold text: the one with
    the most, and those of half its size."""
    for kind in (lambda e: e.name == "article", lambda e: e.main):
        size: dict[int, int] = {}
        top = [-1] * len(elements)
        for k, e in enumerate(elements[1:], 1):
            top[k] = top[e.up] if top[e.up] >= 0 else (k if kind(e) and not out[k] else -1)
            if top[k] >= 0 and sizes[k]:
                size[top[k]] = size.get(top[k], 0) + sizes[k]
        if size:
            most = max(size.values())
            return {k for k, v in size.items() if 2 * v >= most}
    return set()


def smooth(x: np.ndarray) -> np.ndarray:
    """Weighted mean over neighbouring blocks; the ends have fewer."""
    k = len(KERNEL) // 2
    return np.convolve(x, KERNEL)[k:k + len(x)] / np.convolve(np.ones(len(x)), KERNEL)[k:k + len(x)]


def path_scores(paths: list[int], lengths: list[int], marks: list[int]) -> dict[int, float]:
    """Fused value of every path: length and punctuation per block of the
    path, laid along the blocks, smoothed, multiplied, averaged by path."""
    number = {p: i for i, p in enumerate(dict.fromkeys(paths))}
    at = np.array([number[p] for p in paths])
    times = np.bincount(at)
    long, full = np.bincount(at, lengths) / times, np.bincount(at, marks) / times
    fused = smooth(long[at]) * smooth(full[at])
    return dict(zip(number, (np.bincount(at, fused) / times).tolist()))


def content(page: str | None) -> list[str]:
    """Texts of the content blocks of a page, in order."""
    if not page:
        return []
    elements, blocks = read(page)
    for hints in (True, False):
        out = barred(elements, hints)
        found = []
        for b in blocks:
            parts = [(k, t) for k, t in b.parts if not out[k]]
            text = " ".join("".join(t for _, t in parts).split())
            if text:
                found.append((b, parts, text))
        if found:
            break
    if not found:
        return []
    sizes = [0] * len(elements)
    for _, parts, _ in found:
        for k, t in parts:
            sizes[k] += len(t.strip())
    roots = main_elements(elements, out, sizes)
    if roots:
        inside = [False] * len(elements)
        for k, e in enumerate(elements[1:], 1):
            inside[k] = inside[e.up] or k in roots
        found = [x for x in found if inside[x[0].element]]
    linked = [False] * len(elements)
    for k, e in enumerate(elements[1:], 1):
        linked[k] = linked[e.up] or e.name == "a"
    paths, lengths = [b.path for b, _, _ in found], [len(t) for _, _, t in found]
    score = path_scores(paths, lengths, [len(PUNCTUATION.findall(t)) for _, _, t in found])
    by_path: dict[int, list[int]] = {}
    for (b, parts, text), n in zip(found, lengths):
        total = by_path.setdefault(b.path, [0, 0, 0])
        total[0] += n
        total[1] += sum(len(t) for k, t in parts if linked[k])
        total[2] += 1
    links = {p for p, (n, a, times) in by_path.items() if a > LINKED * n and times > 1}
    values = np.array([score[p] for p in paths])
    limit = THRESHOLD * float(values.std())
    over = [i for i, p in enumerate(paths) if score[p] >= limit and p not in links]
    if not over:
        return []
    first, last = over[0], over[-1]
    if first and elements[found[first - 1][0].element].name in HEADINGS:
        first -= 1
    return [text for (b, _, text) in found[first:last + 1] if b.path not in links]


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``: the main text of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = ["\n".join(content(page.as_py())) for page in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])
    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))

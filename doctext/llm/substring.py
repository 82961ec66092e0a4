"""Substring deduplication behind a count-min prefilter.

A window is ``WINDOW`` consecutive words of one document; every word covered
by a window that also starts in a document with a smaller id goes.

1. Sketch.  A window is counted under its anchor, the smallest hash of the
   ``ANCHOR``-word runs inside it.  Equal windows have equal anchors, so an
   anchor's count never falls short of its windows' counts, and neighbouring
   windows mostly share one (about one anchor for 16 words).  Every task
   counts its anchors once per document into a count-min sketch of ``DEPTH``
   rows; the partial sketches are merged by adding cells.  The width follows
   the corpus (one text statistics pass), so the load of a cell does not.
2. Candidates.  Anchors whose every cell says two or more are estimated
   repeated; they are found by a semi-join with the hot cells, so no sketch
   is ever sent whole to a task.
3. Exact pass.  Only windows under such anchors are hashed to 128 bits and
   grouped exactly; a window whose smallest document is not the only one is
   removed from the others.  Over-estimates fall out here, and nothing
   repeated can be missing.

Texts equal as a whole are recognised first by digest: the later copies lose
all their words (if they have a window at all) and only the first takes part
in step 3, so groups of copies cost one row each.

Only texts that are copies or have a hot anchor are shuffled to meet what is
known about them, the others are told by a bitmap and cleaned where they lie.

Defined results: a null text has no words; texts shorter than a window lose
nothing; windows are judged on the input; a null doc_id sorts after every id;
rows that repeat a doc_id are one document in "a smaller doc_id" and each is
cleaned by itself; an empty table gives an empty result; extra columns are
kept by ``deduplicate`` (``n_chars`` follows the new text, if there is one).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import near_keys, split_by_keys
from .common import cut, hide, show

WINDOW, ANCHOR = 50, 20
#: Rows of the sketch, and cells of a row for one expected anchor.
DEPTH, ROOM = 2, 8
#: Bits for one key of the bitmap that holds other texts back, and at most (as a power of 2).
KEY_BITS, MOST_BITS = 8, 26
#: Words of one generation of a worker's hash table.
MAX_WORDS = 500_000
_BASE = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_MASK = (1 << 64) - 1


class _Hashes(dict):
    """64-bit hash of a word; a full table becomes the old one."""

    def __init__(self):
        super().__init__()
        self.old: dict[bytes, int] = {}

    def __missing__(self, word: bytes) -> int:
        h = self.old.get(word)
        if h is None:
            h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= MAX_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = h
        return h


_hashes = _Hashes()
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(4096, 1 << (n - 1).bit_length())
        up, down = np.full(size, base, dtype=np.uint64), np.full(size, pow(base, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        have = _powers[base] = (np.cumprod(up), np.cumprod(down))
    return have


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(h: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """Hash of every run of ``length`` values of ``h``."""
    n = len(h) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _power(_BASE[which], len(h))
    total = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum((mix(h + np.uint64(1)) if which else h) * up[:len(h)], out=total[1:])
    return mix((total[length:] - total[:-length]) * down[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def anchors(h: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> np.ndarray:
    """Anchor of every window (empty if the text is shorter than one)."""
    if len(h) < window:
        return np.zeros(0, dtype=np.uint64)
    return sliding_min(runs(h, anchor), window - anchor + 1)


def text_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _anchor_rows(window: int, anchor: int):
    """``(m, k)``: each document's distinct anchors beside its row key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, found = b.column(0).to_numpy(), []
            for t in b.column(1):
                found.append(np.unique(anchors(word_hashes(text_words(t.as_py())), window, anchor)))
            n = np.array([len(f) for f in found], dtype=np.int64)
            if n.sum():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.repeat(keys, n))], ["m", "k"])
    return run


def _partial_counts(window: int, anchor: int, flush: int = 1_000_000):
    """``(m, n)``: documents of this task under each anchor, in bounded steps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            m, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(m.view(np.int64)), pa.array(n)], ["m", "n"])
        for b in batches:
            for t in b.column(0):
                a = np.unique(anchors(word_hashes(text_words(t.as_py())), window, anchor))
                held.append(a)
                size += len(a)
                if size >= flush:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()
    return run


def _cell(row: int, bits: int):
    return F.xxhash64("m", F.lit(row)).bitwiseAND(F.lit((1 << bits) - 1))


def hot_cells(documents: DataFrame, bits: int, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Cells ``(row, cell)`` of the merged sketch that count two or more."""
    counts = documents.select("text").mapInArrow(_partial_counts(window, anchor), "m long, n long")
    cells = counts.select("n", F.explode(F.array(*[
        F.struct(F.lit(r).alias("row"), _cell(r, bits).alias("cell")) for r in range(DEPTH)])).alias("c"))
    return cells.groupBy("c.row", "c.cell").agg(F.sum("n").alias("n")).where("n > 1").select("row", "cell")


def _candidates(window: int, anchor: int):
    """``(w1, w2, doc, k)``: distinct windows of a document under its hot anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                c = b.slice(lo, 64)
                parts: list[list[np.ndarray]] = [[], [], []]
                for i, (t, hot) in enumerate(zip(c.column(2), c.column(3))):
                    h = word_hashes(text_words(t.as_py()))
                    at = np.flatnonzero(np.isin(anchors(h, window, anchor), hot.values.to_numpy().view(np.uint64)))
                    w1, first = np.unique(runs(h, window)[at], return_index=True)
                    parts[0].append(w1)
                    parts[1].append(runs(h, window, 1)[at[first]])
                    parts[2].append(np.full(len(w1), i))
                at = pa.array(np.concatenate(parts[2]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(parts[0]).view(np.int64)), pa.array(np.concatenate(parts[1]).view(np.int64)),
                     c.column(1).take(at), c.column(0).take(at)], ["w1", "w2", "doc", "k"])
    return run


def clean(text: str | None, windows: np.ndarray | None, copy: bool, window: int = WINDOW) -> tuple[int, int, list[bytes]]:
    """Words of the text, words removed, words kept."""
    words = text_words(text)
    n = len(words)
    if copy and n >= window:
        return n, n, []
    if windows is None or not len(windows) or n < window:
        return n, 0, words
    at = np.flatnonzero(np.isin(runs(word_hashes(words), window), windows))
    marks = np.zeros(n + 1, dtype=np.int64)
    np.add.at(marks, at, 1)
    np.add.at(marks, at + window, -1)
    gone = np.cumsum(marks[:-1]) > 0
    return n, int(gone.sum()), [w for w, g in zip(words, gone.tolist()) if not g]


def _marked(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``documents`` with ``__copy`` (an equal text has a smaller id) and
    ``__gone`` (hashes of the windows to remove)."""
    docs = documents.withColumn("__k", F.xxhash64("doc_id", "text"))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    same = cut(documents.select(F.xxhash64("doc_id", "text").alias("__k"), doc.alias("doc"),
                                F.md5(F.col("text").cast("binary")).alias("digest"),
                                F.octet_length("text").alias("size")), "digests")
    # At least two bytes to a word, and about one anchor to 16 words.
    total = (same.agg(F.sum("size")).first()[0] or 0) / 2 * 2 / (window - anchor + 2)
    bits = max(16, int(np.ceil(np.log2(max(1.0, total) * ROOM))))
    first = same.groupBy("digest").agg(F.min("doc").alias("first"))
    copies = cut(same.join(first, "digest").where("doc > first").select("__k").distinct(), "copies")

    hot = cut(hot_cells(documents, bits, window, anchor), "hot-cells")
    rows = docs.select("__k", "text").mapInArrow(_anchor_rows(window, anchor), "m long, k long")
    for r in range(DEPTH):
        cells = hot.where(F.col("row") == r).select(F.col("cell").alias("__c"))
        rows = rows.join(cells, _cell(r, bits) == F.col("__c"), "left_semi")
    rows = rows.join(copies.withColumnRenamed("__k", "k"), "k", "left_anti")
    lists = cut(rows.groupBy(F.col("k").alias("__k")).agg(F.collect_set("m").alias("__hot")), "hot-anchors")

    keys = lists.select("__k").unionByName(copies)
    wide = min(MOST_BITS, max(16, (KEY_BITS * (lists.count() + copies.count())).bit_length()))
    near = (near_keys(docs, lists, "__k", wide).join(lists, "__k").select("__k", doc.alias("__doc"), "text", "__hot")
            .mapInArrow(_candidates(window, anchor), "w1 long, w2 long, doc long, k long"))
    near = cut(near, "windows")
    twice = (near.groupBy("w1", "w2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
             .where("first < last").select("w1", "w2", "first"))
    gone = (near.join(twice, ["w1", "w2"]).where("doc > first")
            .groupBy(F.col("k").alias("__k")).agg(F.collect_set("w1").alias("__gone")))
    info = gone.join(copies.withColumn("__copy", F.lit(True)), "__k", "full")
    some, rest = split_by_keys(docs, keys, "__k", wide)
    return some.join(info, "__k", "left").unionByName(
        rest.withColumn("__gone", F.lit(None).cast("array<long>")).withColumn("__copy", F.lit(None).cast("boolean")))


def digests(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, gone, copy in zip(b.column(1), b.column(2), b.column(3).to_pylist()):
                n, removed, kept = clean(t.as_py(), _list(gone), bool(copy), window)
                out.append((n, removed, hashlib.sha256(b" ".join(kept)).hexdigest()))
            cols = list(zip(*out)) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"])
    return (_marked(documents.select("doc_id", "text"), window, anchor)
            .select(F.col("doc_id").cast("long").alias("doc_id"), "text", "__gone", "__copy")
            .mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string"))


def _list(x) -> np.ndarray | None:
    return x.values.to_numpy().view(np.uint64) if x.is_valid else None


def deduplicate(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """The documents with the repeated windows cut out: texts that lose words
    become their kept words joined by one space, others stay as they are."""
    hidden = hide(documents, "doc_id", "text")
    cols = hidden.columns
    at, n = cols.index("text"), len(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for t, gone, copy in zip(b.column(at), b.column(n), b.column(n + 1).to_pylist()):
                text = t.as_py()
                _, removed, kept = clean(text, _list(gone), bool(copy), window)
                texts.append(b" ".join(kept).decode("utf-8", "surrogatepass") if removed else text)
            out = [pa.array(texts, pa.string()) if i == at else b.column(i) for i in range(n)]
            yield pa.RecordBatch.from_arrays(out, cols)
    out = _marked(hidden, window, anchor).select(*cols, "__gone", "__copy").mapInArrow(run, hidden.schema)
    out = show(out, documents, "doc_id", "text")
    if "n_chars" not in documents.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))

"""Tokens of a batch of texts and their glued words, by arithmetic on token
masks.

The tokens of a batch lie in one long string without gaps; token i covers
``edge[i] : edge[i + 1]`` of it.  A glued word is a pair of edges, so which
pairs exist is decided for all starts at once, one window step at a time:
a step switches off the starts whose newest token or whose length ends them.
Glued words become strings only if their hash is in a bitmap of the word
list (fixed size; it lets some others through and holds back no listed one).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .digests import md5_heads

#: Bits of the bitmap's index: 1 MB, however long the word list is.
BITS = 23
_BASE = 0x9E3779B97F4A7C15
_DIGIT = re.compile(r"\d")
_EMAIL = re.compile(r"[^@]+@[^@]+\.[^@]+")
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        have = np.full(max(1 << 16, 1 << n.bit_length()), base, dtype=np.uint64)
        have[0] = 1
        have = _powers[name] = np.cumprod(have)
    return have[:n]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


class Hasher:
    """Bitmap positions of substrings of one lower-cased string."""

    def __init__(self, text: str):
        codes = _codes(text)
        self.sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum((codes + np.uint64(1)) * _power("up", _BASE, len(codes)), out=self.sums[1:])
        self.down = _power("down", pow(_BASE, -1, 1 << 64), len(codes) + 1)

    def at(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        x = (self.sums[hi] - self.sums[lo]) * self.down[lo]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (x >> np.uint64(64 - BITS)).astype(np.int64)


def positions(words: list[str]) -> np.ndarray:
    """Bitmap position of every word."""
    edge = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)
    return Hasher("".join(words)).at(edge[:-1], edge[1:])


class Rules:
    """Window rules, the lengths that occur in the word list and its bitmap
    (both None: every glued word is wanted)."""

    def __init__(self, window: int, shortest: int, limit: int, upper_ends: bool,
                 lengths: np.ndarray | None = None, bitmap: np.ndarray | None = None):
        self.window, self.shortest, self.limit, self.upper_ends = window, shortest, limit, upper_ends
        self.lengths, self.bitmap = lengths, bitmap


def _address(w: str) -> bool:
    return w.endswith((".de", ".com")) or w.startswith("http") or (len(w) > 7 and _EMAIL.match(w) is not None)


def spans(tokens: list[str], compound: np.ndarray, last: np.ndarray, glue: str, rules: Rules, wanted: bool = True):
    """For all starts: (start, offset, word) of the wanted glued words, and
    whether a skip rule fired.  ``last[i]`` is one past the end of token i's
    document; a compound is followed by ``glue`` inside a glued word.  Without
    ``wanted`` only the skip rules are worked out."""
    n = len(tokens)
    text = "".join([t + glue if c else t for t, c in zip(tokens, compound.tolist())] if compound.any() else tokens)
    # Every distinct token is looked at once.
    number: dict[str, int] = {}
    at_type = np.fromiter((number.setdefault(t, len(number)) for t in tokens), dtype=np.int64, count=n)
    types = list(number)
    edge = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, types), dtype=np.int64, count=len(types))[at_type] + len(glue) * compound, out=edge[1:])
    flag = lambda f: np.fromiter(map(f, types), dtype=bool, count=len(types))[at_type]
    opens, digit = flag(lambda t: t[:1].isupper()), flag(lambda t: _DIGIT.search(t) is not None)
    no_lower, has_upper = flag(lambda t: t.upper() == t), flag(lambda t: t.lower() != t)
    # Only spans with an @, with http at their start or a site's end at their
    # end can be addresses; edges say which those are.
    signs = np.searchsorted([m.start() for m in re.finditer("@", text)], edge)
    there = np.zeros((2, len(text) + 1), dtype=bool)
    there[0, [m.start() for m in re.finditer("http", text)]] = True
    there[1, [m.end() for m in re.finditer(r"\.de|\.com", text)]] = True
    opening, closing = there[0, edge], there[1, edge]
    low = text.lower()
    filtered = wanted and rules.bitmap is not None and len(low) == len(text) and "Σ" not in text
    hasher = Hasher(low) if filtered else None

    at = np.flatnonzero(~compound)
    skip = np.zeros(n, dtype=bool)
    caps, letter = np.ones(n, dtype=bool), np.zeros(n, dtype=bool)
    starts, offsets = [], []
    for j in range(rules.window):
        at = at[at + j < last[at]]
        if j:
            at = at[~opens[at + j]]
        if not len(at):
            break
        new = at + j
        size = edge[new + 1] - edge[at]
        caps[at] &= no_lower[new]
        letter[at] |= has_upper[new]
        short = size < rules.shortest
        ended = digit[new] | (~short & ((size >= rules.limit) | (rules.upper_ends & caps[at] & letter[at])))
        maybe = np.flatnonzero(~ended & ((signs[new + 1] > signs[at]) | opening[at] | closing[new + 1]))
        ended[maybe] = [_address(text[a:b]) for a, b in zip(edge[at[maybe]].tolist(), edge[new[maybe] + 1].tolist())]
        skip[at] |= ended | short
        if not wanted:
            at = at[~ended]
            continue
        good = ~ended & ~short
        if rules.lengths is not None:
            good &= rules.lengths[np.minimum(size, len(rules.lengths) - 1)]
        found = at[good]
        if filtered:
            found = found[rules.bitmap[hasher.at(edge[found], edge[found + j + 1])]]
        starts.append(found)
        offsets.append(np.full(len(found), j, dtype=np.int32))
        at = at[~ended]
    start = np.concatenate(starts) if starts else np.zeros(0, dtype=np.int64)
    offset = np.concatenate(offsets) if offsets else np.zeros(0, dtype=np.int32)
    words = [text[a:b] for a, b in zip(edge[start].tolist(), edge[start + offset + 1].tolist())]
    return start, offset, words, skip


def tokens_of(text: str | None, strip: str, patch: dict[str, list[tuple[str, bool]]]) -> list[tuple[str, bool]]:
    """(token, compound) of one text: cut at single spaces, stripped, empty
    ones dropped, and those in ``patch`` replaced."""
    out = []
    for w in (text or "").split(" "):
        if w := w.strip(strip):
            out += patch[w] if w in patch else [(w, False)]
    return out


def _batch(b: pa.RecordBatch, strip: str, glue: str, rules: Rules | None, wanted: bool = True):
    """Tokens of a batch ``(key, text, own, becomes, ...)``: spans (if there
    are rules), document and position of each token, tokens, compound flags."""
    tokens, marks, ends = [], [], [0]
    for text, own, becomes in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
        if own:
            patch = {w: [(x["t"], x["c"]) for x in xs] for w, xs in zip(own, becomes)}
            doc = tokens_of(text, strip, patch)
            marks += [len(tokens) + i for i, (_, c) in enumerate(doc) if c]
            tokens += [t for t, _ in doc]
        elif text:
            tokens += [t for w in text.split(" ") if (t := w.strip(strip))]
        ends.append(len(tokens))
    ends = np.array(ends)
    count = np.diff(ends)
    compound = np.zeros(len(tokens), dtype=bool)
    compound[marks] = True
    doc = np.repeat(np.arange(len(count)), count)
    pos = np.arange(len(tokens)) - np.repeat(ends[:-1], count)
    found = spans(tokens, compound, np.repeat(ends[1:], count), glue, rules, wanted) if rules else None
    return found, doc, pos, tokens, compound


def tokens_udf(strip: str, names: list[str], slice_rows: int = 256):
    """``(key, pos, token, compound)`` for every token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, slice_rows):
                b = whole.slice(lo, slice_rows)
                _, doc, pos, tokens, compound = _batch(b, strip, "", None)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(doc)), pa.array(pos.astype(np.int32)), pa.array(tokens, pa.string()),
                     pa.array(compound)], names)
    return run


def words_udf(strip: str, glue: str, rules: Rules, names: list[str], slice_rows: int = 256):
    """``(key, pos, j, word, compound)`` for every wanted glued word, and for
    every compound (its own word, j = 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, slice_rows):
                b = whole.slice(lo, slice_rows)
                (start, offset, words, _), doc, pos, tokens, compound = _batch(b, strip, glue, rules)
                own = np.flatnonzero(compound)
                words += [tokens[i] for i in own.tolist()]
                kind = np.repeat([False, True], [len(start), len(own)])
                start = np.concatenate([start, own])
                offset = np.concatenate([offset, np.zeros(len(own), dtype=np.int32)])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(doc[start])), pa.array(pos[start].astype(np.int32)), pa.array(offset),
                     pa.array(words, pa.string()), pa.array(kind)], names)
    return run


def _cuts(b: pa.RecordBatch, most_rows: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of so many rows and bytes of text at most, of one row at least."""
    size = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False).tolist()
    lo, held = 0, 0
    for i, n in enumerate(size):
        if i > lo and (i - lo == most_rows or held + n > most_bytes):
            yield b.slice(lo, i - lo)
            lo, held = i, 0
        held += n
    if size:
        yield b.slice(lo)


def sums_udf(strip: str, glue: str, mark: str, rules: Rules, names: list[str], slice_rows: int = 256, slice_bytes: int = 1 << 18):
    """``(key, j, n, chars, first_word, last_word, checksum)`` of the glued
    words of a row's text by their offset, with ``mark`` for ``glue`` in them.
    Every word is made and digested where it is found; it does not travel."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _cuts(whole, slice_rows, slice_bytes):
                (start, offset, words, _), doc, _, _, _ = _batch(b, strip, glue, rules)
                if not words:
                    continue
                if glue in "".join(words):
                    words = [w.replace(glue, mark) for w in words]
                own = doc[start]
                at = np.flatnonzero(np.concatenate(([True], (np.diff(own) != 0) | (np.diff(offset) != 0))))
                parts = [words[lo:hi] for lo, hi in zip(at.tolist(), [*at[1:].tolist(), len(words)])]
                chars = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(own[at])), pa.array(offset[at]), pa.array([len(x) for x in parts], pa.int64()),
                     pa.array(np.add.reduceat(chars, at)), pa.array([min(x) for x in parts], pa.string()),
                     pa.array([max(x) for x in parts], pa.string()), pa.array(np.add.reduceat(md5_heads(words, chars), at))], names)
    return run


def starts_udf(strip: str, glue: str, rules: Rules, names: list[str], slice_rows: int = 256):
    """``(key, pos, token, compound, skip)`` for every start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, slice_rows):
                b = whole.slice(lo, slice_rows)
                (_, _, _, skip), doc, pos, tokens, compound = _batch(b, strip, glue, rules, False)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(doc)), pa.array(pos.astype(np.int32)), pa.array(tokens, pa.string()),
                     pa.array(compound), pa.array(skip)], names)
    return run


def wrong_udf(strip: str, glue: str, rules: Rules, names: list[str], slice_rows: int = 256):
    """``(key, pos, word)`` of every start that no skip rule takes and no kept
    word reaches past, from ``(key, text, own, becomes, at, to)``: positions
    and ends of the document's kept words, in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, slice_rows):
                b = whole.slice(lo, slice_rows)
                (_, _, _, skip), doc, pos, tokens, _ = _batch(b, strip, glue, rules, False)
                edge = np.searchsorted(doc, np.arange(b.num_rows + 1))
                past = np.zeros(len(tokens), dtype=np.int64)
                for i, (at, to) in enumerate(zip(b.column(4), b.column(5))):
                    at = np.array(at.values if at.is_valid else [], dtype=np.int64)
                    if len(at):
                        inside = at < edge[i + 1] - edge[i]
                        mine = past[edge[i]:edge[i + 1]]
                        mine[at[inside]] = np.array(to.values, dtype=np.int64)[inside]
                        np.maximum.accumulate(mine, out=mine)
                wrong = np.flatnonzero(~skip & (past <= pos))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(doc[wrong])), pa.array(pos[wrong].astype(np.int32)),
                     pa.array([tokens[i] for i in wrong.tolist()], pa.string())], names)
    return run


def walk_udf(names: list[str]):
    """The left-to-right walk over ``(key, pos, end, word)`` in the order of
    key, position and falling end: of each position the longest word, and none
    that begins before the last kept one ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, after = pa.scalar(None), 0
        for b in batches:
            keys = b.column(0)
            code = keys.dictionary_encode(null_encoding="encode").indices.to_numpy()
            new = np.concatenate(([b.num_rows > 0 and keys[0] != last], np.diff(code) != 0))[:b.num_rows]
            kept = []
            for i, (fresh, pos, end) in enumerate(zip(new.tolist(), b.column(1).to_numpy().tolist(), b.column(2).to_numpy().tolist())):
                if fresh or pos >= after:
                    kept.append(i)
                    after = end
            if b.num_rows:
                last = keys[b.num_rows - 1]
            yield pa.RecordBatch.from_arrays(b.take(pa.array(kept, pa.int64())).columns, names)
    return run


def list_udf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(len, bit)``: the length and bitmap position of every listed word."""
    for b in batches:
        w = b.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([len(x) for x in w], pa.int32()), pa.array(positions(w).astype(np.int32))],
                                         ["len", "bit"])

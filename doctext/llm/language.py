"""Hierarchical Pitman-Yor language model over words.

Three levels: a restaurant for every preceding word (and one for the start of
a text), all sharing one parent restaurant of words, whose base is uniform
over the V words met in training and one unknown word (the same V + 1 outcomes
that the add-one base score has).  The context of a token is the word before
it, of the end token the last word.

Seating is sampled by Gibbs: each sweep seats the customers of a word anew in
every context restaurant given the parent's predictive, then the tables they
opened as customers of the parent, given the totals of all other words.  A
restaurant's dishes meet only in its totals (tables and customers), so words
are sampled in parallel and no restaurant is gathered; rounds over all words
settle the totals first.  Scores use predictive probabilities averaged over
several sweeps.  Table counts are exact draws for any number of customers.

Flow.  A block is a run of rows of an input file.  Each block hands its pairs
(word, context, count) to hash buckets of words; a bucket merges what all
blocks know about its words and is stored where later joins on the bucket find
it without moving it.  The totals of the contexts are a distributed table: a
bucket names its contexts once to hash shards of contexts, which keep where
each bucket's contexts stand; from then on only counts travel, from the buckets
to the shards, which add them, and back.  After sampling a bucket sends every
block the probabilities of the pairs it asked for, in the order in which the
block finds them again; blocks then score their texts.  Pairs travel once per
block and not once per token, numbers travel packed, and nothing but a few sums
reaches the driver.

Defined results: a null or empty text is its end token alone; repeated rows
are counted and scored each; a null doc_id is never held out; with nothing to
learn from every token has probability 1 (one outcome, the unknown); an empty
table gives an empty result; extra columns are ignored.  Words are told apart
by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, cut, held_out, stored
from .substring import mix
from .tiles import sorted_groups

FOLDS = 7
#: Discount and strength of the context restaurants and of their parent.
LEAF, ROOT = (0.8, 1.0), (0.75, 1.0)
ROUNDS, BURN, SAMPLES = 2, 2, 3
#: Customers of a dish whose seats are drawn each; later ones by waiting times.
ONE_BY_ONE = 16
#: Dishes that are left to be drawn by plain numbers instead of arrays.
FEW = 4
#: Bytes of text for one bucket of words, and for one block (and one text more).
BUCKET_BYTES, BLOCK_BYTES = 8 << 20, 32 << 20
#: Bytes of text that are cut into words at once.
AT_ONCE = 1 << 20
#: The end token as a word, the start of a text as a context.
END = 0
#: What each byte becomes: A-Z lower case, white space a space.
SPACE, _FOLD = 32, np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32
_FOLD[list(SPACES.encode())] = SPACE

#: A pair of a bucket; ``ctx`` is the place of its context among the bucket's.
ENTRY = np.dtype([("w", "<i8"), ("ctx", "<i4"), ("n", "<i8")])
ANSWER, COUNT = np.dtype([("key", "<u8"), ("p", "<f4")]), np.dtype([("w", "<i8"), ("c", "<i8")])
ASKED = np.dtype([("entry", "<i4"), ("block", "<i4")])


# Packed numbers -------------------------------------------------------------

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers from 0 as one compressed string; bytes of equal weight lie together."""
    head, body = [], []
    for a in arrays:
        size = next(k for k in (1, 2, 4, 8) if k == 8 or int(a.max(initial=0)) < 1 << 8 * k)
        a = np.ascontiguousarray(a.view(np.uint64) if a.dtype.itemsize == 8 == size else a.astype(f"<u{size}"))
        head += [len(a), size]
        body.append(a.view(np.uint8).reshape(len(a), size).T.tobytes())
    raw = b"".join(body)
    return np.array([len(arrays), len(raw), *head], dtype="<u4").tobytes() + pa.compress(raw, "zstd", asbytes=True)


def unpack(blob: bytes) -> list[np.ndarray]:
    """The arrays of ``pack``, 64 bits each."""
    k, size = np.frombuffer(blob, "<u4", 2).tolist()
    head = np.frombuffer(blob, "<u4", 2 * k, 8).tolist()
    raw = np.frombuffer(pa.decompress(memoryview(blob)[8 + 8 * k:], size, "zstd"), np.uint8)
    out, at = [], 0
    for n, width in zip(head[::2], head[1::2]):
        a = np.ascontiguousarray(raw[at:at + n * width].reshape(width, n).T).reshape(-1).view(f"<u{width}")
        out.append(a.view(np.int64) if width == 8 else a.astype(np.int64))
        at += n * width
    return out


def steps(a: np.ndarray) -> np.ndarray:
    """Differences of sorted 64-bit numbers; ``np.cumsum`` of them gives the numbers."""
    return np.diff(a.view(np.uint64), prepend=np.uint64(0))


# Contexts and words ---------------------------------------------------------

def _statistics(most: int):
    """Where blocks start, ``(path, start, n)`` with the bytes of their words:
    a block ends with the text that brings its bytes to ``most``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, start, due, size, held = None, 0, -1, 0, 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([path], pa.string()), pa.array([start], pa.int64()),
                                               pa.array([size], pa.int64())], ["path", "start", "n"])
        for b in batches:
            for p, row, n, whole in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), *_bytes(b.column(2))):
                if path is not None and (p != path or row != due or held >= most):
                    yield out()
                    path = None
                if path is None:
                    path, start, size, held = p, row, 0, 0
                due = row + 1
                size += n
                held += whole
        if path is not None:
            yield out()
    return run


def _bytes(texts: pa.Array) -> tuple[list[int], list[int]]:
    """Of each text the bytes of its words, with one space a word, and its own."""
    words = []
    for lo, hi in lots(texts):
        x = spelled(texts.slice(lo, hi - lo))
        ends = np.flatnonzero((x == SPACE) & (np.concatenate(([SPACE], x[:-1])) == SPACE))
        words += (np.diff(ends, prepend=-1) - 1).tolist()
    return words, pc.fill_null(pc.binary_length(texts), 0).to_pylist()


def lots(texts: pa.Array, block: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """Runs ``(from, to)`` of texts, of one block each and of ``AT_ONCE`` bytes and one text more at most."""
    if not len(texts):
        return
    lot = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // AT_ONCE
    new = lot[1:] != lot[:-1]
    if block is not None:
        new |= block[1:] != block[:-1]
    at = [0, *(np.flatnonzero(new) + 1).tolist(), len(texts)]
    yield from zip(at, at[1:])


def spelled(texts: pa.Array) -> np.ndarray:
    """The words of texts in lower case, a space behind each; one more space
    behind each text is its end token, an empty word."""
    parts = [t.as_buffer() if t.is_valid else b"" for t in texts]
    raw = _FOLD[np.frombuffer(b"  ".join([*parts, b""]), dtype=np.uint8)]
    keep = raw != SPACE
    keep[1:] |= keep[:-1].copy()
    keep[np.cumsum([len(x) + 2 for x in parts]) - 1] = True
    return raw[keep]


def tokens(spelled: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the words by their appearance, the end token (0) after each
    text; the hashes of the numbers; how many tokens each text has."""
    data = np.concatenate([np.array([SPACE], dtype=np.uint8), *spelled])
    ends = np.concatenate(([0], np.flatnonzero(data == SPACE) + 1))
    words = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1,
                                  [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
    w, known = words.indices.to_numpy()[1:], words.dictionary
    blob = np.frombuffer(known.buffers()[2], dtype=np.uint8, count=np.frombuffer(known.buffers()[1], np.int64)[len(known)])
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, blob.tobytes().split(b" ")[:-1]), dtype=np.uint64, count=len(known))
    h[h == 0] = 1
    h[END] = END
    return w, h.view(np.int64), np.diff(np.flatnonzero(w == END), prepend=-1)


def ordered(w: np.ndarray, hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the tokens of whole texts: hashes of the words, sorted; their
    places by bucket and hash; each token's place; and a key of its pair that
    sorts by bucket, word and context.  The context is the token before: a
    text ends with the token that the next one starts from."""
    known, rank = np.unique(hashes, return_inverse=True)
    order = np.argsort(_shard(known, buckets), kind="stable")
    place = np.empty(len(known), dtype=np.int64)
    place[order] = np.arange(len(known))
    at = place[rank][w]
    key = at * len(known)
    key[1:] += rank[w[:-1]]
    key[0] += rank[END]
    return known, order, at, key


def pair_key(w: np.ndarray, ctx: np.ndarray) -> np.ndarray:
    return mix(w.view(np.uint64) + mix(ctx.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15))


def _parts(shard: np.ndarray, shards: int) -> Iterator[tuple[int, int, int]]:
    """``(shard, from, to)`` of the shards that a sorted array has."""
    each = np.bincount(shard, minlength=shards)
    ends = np.cumsum(each)
    for i in np.flatnonzero(each).tolist():
        yield i, int(ends[i] - each[i]), int(ends[i])


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return (mix(h.view(np.uint64)) % np.uint64(shards)).astype(np.int64)


def _requests(buckets: int, most: int = 6_000_000):
    """``(bucket, block, pairs)``: what a block holds and asks for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, holds, size, block = [], [], 0, None

        def out() -> pa.RecordBatch:
            nonlocal held, holds, size
            w, hashes, each = tokens(held)
            hold = np.repeat(np.concatenate(holds), each)
            held, holds, size = [], [], 0
            known, order, _, key = ordered(w, hashes, buckets)
            key = 2 * key + hold
            del w, hold
            key.sort()
            n = 1 - (key & 1)
            key >>= 1
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            n = np.add.reduceat(n, first)
            place, ctx = np.divmod(key[first], len(known))
            words, k = known[order], np.bincount(place, minlength=len(known))
            ends = np.concatenate(([0], np.cumsum(k)))
            some, pairs = [], []
            for i, lo, hi in _parts(_shard(words, buckets), buckets):
                a, b = ends[lo], ends[hi]
                own, at = np.unique(ctx[a:b], return_inverse=True)
                some.append(i)
                pairs.append(pack(steps(words[lo:hi]), k[lo:hi], steps(known[own]), at, n[a:b]))
            return pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int64()), pa.array(np.full(len(some), block, dtype=np.int32)),
                 pa.array(pairs, pa.binary())], ["bucket", "block", "pairs"])
        for b in batches:
            blocks, hold, texts = b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False), b.column(2)
            for lo, hi in lots(texts, blocks):
                if held and (blocks[lo] != block or size > most):
                    yield out()
                block = blocks[lo]
                held.append(spelled(texts.slice(lo, hi - lo)))
                holds.append(hold[lo:hi])
                size += np.count_nonzero(held[-1] == SPACE)
        if held:
            yield out()
    return run


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: merged entries (w, ctx, n), its contexts, who asked for each
    entry, and the sums of what was met in training."""
    for g in sorted_groups(batches):
        words, k, contexts, at, n = zip(*map(unpack, g.column(2).to_pylist()))
        blocks = np.repeat(g.column(1).to_numpy(), list(map(len, at)))
        shift = np.cumsum([0, *map(len, contexts)])
        words, w = np.unique(np.concatenate([np.cumsum(x.view(np.uint64)).view(np.int64) for x in words]), return_inverse=True)
        contexts, c = np.unique(np.concatenate([np.cumsum(x.view(np.uint64)).view(np.int64) for x in contexts]), return_inverse=True)
        key = np.repeat(w, np.concatenate(k)) * len(contexts) + c[np.concatenate([x + s for x, s in zip(at, shift)])]
        order = np.argsort(key, kind="stable")
        key, blocks, n = key[order], blocks[order], np.concatenate(n)[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.flatnonzero(new)
        n = np.add.reduceat(n, first)
        w, ctx = np.divmod(key[first], len(contexts))
        some, rank = np.unique(blocks, return_inverse=True)
        rank = rank * len(first) + np.cumsum(new) - 1
        rank.sort()
        rank, entry = np.divmod(rank[np.concatenate(([True], rank[1:] != rank[:-1]))], len(first))
        each = np.bincount(rank)
        gap = np.diff(entry, prepend=0)
        starts = np.cumsum(each) - each
        gap[starts] = entry[starts]
        del key, order, blocks, new, rank, entry
        met = n > 0
        yield pa.RecordBatch.from_arrays(
            [g.column(0).slice(0, 1).combine_chunks(), pa.array([pack(steps(words), np.bincount(w), ctx, n)], pa.binary()),
             pa.array([pack(steps(contexts))], pa.binary()), pa.array([pack(some, each, gap)], pa.binary()),
             pa.array([int(n.sum())], pa.int64()), pa.array([int(met.sum())], pa.int64()),
             pa.array([np.count_nonzero(np.bincount(w[met]))], pa.int64())],
            ["bucket", "entries", "contexts", "asked", "total", "tables", "distinct"])


def _opened(entries: bytes, contexts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Entries and contexts of a bucket."""
    words, k, ctx, n = unpack(entries)
    e = np.empty(len(n), dtype=ENTRY)
    e["w"], e["ctx"], e["n"] = np.repeat(np.cumsum(words.view(np.uint64)).view(np.int64), k), ctx, n
    return e, np.cumsum(unpack(contexts)[0].view(np.uint64)).view(np.int64)


def _asked(asked: bytes) -> np.ndarray:
    some, each, gap = unpack(asked)
    out = np.empty(len(gap), dtype=ASKED)
    at = np.cumsum(gap)
    starts = np.cumsum(each) - each
    out["entry"], out["block"] = at - np.repeat(at[starts] - gap[starts], each), np.repeat(some, each)
    return out


# Sampling -------------------------------------------------------------------

def seat(customers: np.ndarray, new: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after seating its customers one by one; ``new`` is
    the weight of a new table (strength and discount mass times the parent).

    After ``ONE_BY_ONE`` customers only those who open a table are drawn.  With
    ``j`` seated at ``t`` tables, ``m`` more open none with the probability
    prod (b + i) / (a + b + i) over i < m, b = j - discount * t: a geometric
    waiting time whose rate is Beta(a, b), so the draw is exact for any count.
    """
    out = np.minimum(customers, 1).astype(float)
    order = np.flatnonzero(customers > 1)
    order = order[np.argsort(-customers[order], kind="stable")]
    c, a, t = customers[order], new[order], out[order]
    for j in range(1, ONE_BY_ONE):
        n = int(np.searchsorted(-c, -j, side="left"))  # those with more than j customers
        if not n:
            break
        t[:n] += rng.random(n) * (a[:n] + j - discount * t[:n]) < a[:n]
    at = np.arange(int(np.searchsorted(-c, -ONE_BY_ONE, side="left")))
    seated = np.full(len(at), float(ONE_BY_ONE))
    with np.errstate(divide="ignore"):  # a rate of 0 waits for ever
        while len(at) > FEW:
            rate = rng.beta(a[at], seated - discount * t[at])
            seated += np.maximum(np.ceil(rng.standard_exponential(len(at)) / -np.log1p(-rate)), 1)
            opens = seated <= c[at]
            at, seated = at[opens], seated[opens]
            t[at] += 1
    # The same draws for the last few dishes, which have by far the most tables.
    last = [[k, float(a[k]), int(c[k]), float(t[k]), x] for k, x in zip(at.tolist(), seated.tolist())]
    while last:
        rates = [rng.beta(x[1], x[4] - discount * x[3]) for x in last]
        for x, rate in zip(last, rates):
            wait = rng.standard_exponential()
            x[4] += 1 if rate >= 1 else max(float(np.ceil(wait / -math.log1p(-rate))), 1) if rate > 0 else math.inf
            x[3] += x[4] <= x[2]
            t[x[0]] = x[3]
        last = [x for x in last if x[4] <= x[2]]
    out[order] = t
    return out


class Totals:
    """Customers and tables of every context restaurant and of the parent."""

    def __init__(self, customers: np.ndarray, tables: np.ndarray, root_tables: float, distinct: float,
                 root_customers: float | None = None):
        """In a bucket the arrays hold its own contexts; ``root_customers``
        are the tables of all contexts."""
        self.customers, self.tables, self.root_tables, self.distinct = customers, tables, root_tables, distinct
        self.root_customers = float(tables.sum()) if root_customers is None else root_customers

    def open_leaf(self) -> np.ndarray:
        d, s = LEAF
        return np.where(self.customers > 0, (s + d * self.tables) / (s + self.customers), 1.0)

    def open_root(self) -> float:
        d, s = ROOT
        return (s + d * self.root_tables) / (s + self.root_customers) if self.root_customers else 1.0


def words_of(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First entry of each word, and the word number of each entry."""
    starts = np.flatnonzero(np.concatenate(([True], entries["w"][1:] != entries["w"][:-1])))
    return starts, np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(entries))))


def sweeps(entries: np.ndarray, totals: Totals, rng: np.random.Generator, burn: int, samples: int):
    """Gibbs sweeps over the words of a bucket, sorted by word and context.
    After ``burn`` of them yields the tables of every entry and, in the
    parent, of every word."""
    starts, word = words_of(entries)
    base = 1.0 / (totals.distinct + 1.0)
    (d2, s2), (d1, s1) = LEAF, ROOT
    root_open, root_norm = totals.open_root(), s1 + totals.root_customers
    met = np.minimum(entries["n"], 1).astype(float)
    below = np.add.reduceat(met, starts)
    root = np.minimum(below, 1.0)
    # One customer sits at one table: only entries of more are drawn.
    some = np.flatnonzero(entries["n"] > 1)
    n, word, tables = entries["n"][some], word[some], met[some]
    alone = below - np.bincount(word, minlength=len(starts))
    leaf = s2 + d2 * totals.tables[entries["ctx"][some]]
    for sweep in range(burn + samples):
        # A context's tables, given the parent without what they put there.
        rest = below[word] - tables
        others = np.maximum(rest - d1 * root[word] * rest / np.maximum(below[word], 1), 0) / root_norm
        tables = seat(n, leaf * (others + root_open * base), d2, rng)
        # The parent's tables of the word, given the tables below.
        below = alone + np.bincount(word, weights=tables, minlength=len(starts))
        root = seat(below.astype(np.int64), np.full(len(starts), (s1 + d1 * totals.root_tables) * base), d1, rng)
        if sweep >= burn:
            every = met.copy()
            every[some] = tables
            yield every, root


def sample(entries: np.ndarray, totals: Totals, rng: np.random.Generator, burn: int, samples: int):
    """Mean tables of the kept sweeps."""
    tables, roots = zip(*sweeps(entries, totals, rng, burn, samples))
    return sum(tables) / samples, sum(roots) / samples


def predictive(entries: np.ndarray, tables: np.ndarray, root: np.ndarray, totals: Totals) -> np.ndarray:
    """Probability of each entry's word in its context.  With ``totals`` the
    sums of these very tables, a context's probabilities add up to one."""
    starts, word = words_of(entries)
    (d2, s2), (d1, s1) = LEAF, ROOT
    parent = ((np.add.reduceat(tables, starts) - d1 * root) / (s1 + totals.root_customers)
              + totals.open_root() / (totals.distinct + 1.0))
    customers = totals.customers[entries["ctx"]]
    own = np.where(customers > 0, (entries["n"] - d2 * tables) / (s2 + customers), 0.0)
    return own + totals.open_leaf()[entries["ctx"]] * parent[word]


# Totals ---------------------------------------------------------------------

SENT = "shard long, bucket long, v binary, i int, x double"


def _by_shard(contexts: np.ndarray, shards: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order of a bucket's contexts by shard, and the parts of the shards in it."""
    b = _shard(contexts, shards)
    order = np.argsort(b, kind="stable")
    return order, list(_parts(b[order], shards))


def _first(shards: int):
    """Before any seating: a bucket's contexts with their customers, and their distinct words as tables."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bucket, x, y in zip(*(c.to_pylist() for c in b.columns)):
                e, contexts = _opened(x, y)
                k = len(contexts)
                v = [np.bincount(e["ctx"], weights=e["n"], minlength=k).astype(np.int64),
                     np.bincount(e["ctx"][e["n"] > 0], minlength=k)]
                order, parts = _by_shard(contexts, shards)
                contexts, v = contexts[order], [x[order] for x in v]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _, _ in parts], pa.int64()), pa.array([bucket] * len(parts), pa.int64()),
                     pa.array([pack(steps(contexts[lo:hi]), *(x[lo:hi] for x in v)) for _, lo, hi in parts], pa.binary())],
                    ["shard", "bucket", "v"])
    return run


def _register(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per shard and bucket: where the bucket's contexts stand in the shard, and their first totals."""
    for g in sorted_groups(batches):
        contexts, *v = zip(*map(unpack, g.column(2).to_pylist()))
        ends = np.cumsum(list(map(len, contexts)))[:-1]
        contexts, at = np.unique(np.concatenate([np.cumsum(x.view(np.uint64)) for x in contexts]), return_inverse=True)
        total = [np.bincount(at, weights=np.concatenate(x)).astype(np.int64)[at] for x in v]
        places = [pack(steps(x)) for x in np.split(at, ends)]
        totals = [pack(*x) for x in zip(*(np.split(x, ends) for x in total))]
        yield pa.RecordBatch.from_arrays([g.column(0).combine_chunks(), g.column(1).combine_chunks(), pa.array(places, pa.binary()),
                                          pa.array(totals, pa.binary())], ["shard", "bucket", "places", "totals"])


def _sum_up(places: pa.Table, sent: pa.Table) -> pa.Table:
    """Per shard of contexts: the shares added, and back to each bucket with the customers."""
    places, sent = places.sort_by("bucket"), sent.sort_by("bucket")
    assert places["bucket"].equals(sent["bucket"])
    at = [np.cumsum(unpack(x)[0]) for x in places["places"].to_pylist()]
    ends, every = np.cumsum(list(map(len, at)))[:-1], np.concatenate(at)
    total = [np.bincount(every, weights=np.concatenate(x)).astype(np.int64)[every]
             for x in zip(*map(unpack, sent["v"].to_pylist()))]
    back = [pack(unpack(c)[0], *x) for c, x in zip(places["totals"].to_pylist(), zip(*(np.split(x, ends) for x in total)))]
    return pa.table([places["bucket"], places["shard"], pa.array(back, pa.binary())], names=["bucket", "shard", "v"])


def _returned(places: DataFrame, sent: DataFrame) -> DataFrame:
    """``(bucket, shard, v)``: totals of all buckets for each bucket's contexts."""
    sent = sent.where("shard is not null").select("shard", "bucket", "v")
    return places.groupBy("shard").cogroup(sent.groupBy("shard")).applyInArrow(_sum_up, "bucket long, shard long, v binary")


def _back(order: np.ndarray, back: pa.Table) -> np.ndarray:
    """``v[context, total]``: the totals that came back, in the order of a bucket's sorted contexts."""
    v = np.concatenate([np.stack(unpack(x), axis=1) for x in back.sort_by("shard")["v"].to_pylist()])
    out = np.empty(v.shape)
    out[order] = v
    return out


def _add(df: DataFrame, size: int) -> np.ndarray:
    out = np.zeros(size)
    for i, v in df.where("i is not null").groupBy("i").agg(F.sum("x")).collect():  # `size` numbers, whatever the input
        out[i] = v
    return out


def _totals_of(contexts: np.ndarray, back: pa.Table, width: int) -> np.ndarray:
    """The totals that came back, in the order of a bucket's sorted contexts."""
    got = np.frombuffer(b"".join(back["contexts"].to_pylist()), dtype=np.int64)
    v = np.frombuffer(b"".join(back["v"].to_pylist()), dtype=float).reshape(-1, width)
    order = np.argsort(got)
    assert np.array_equal(got[order], contexts)
    return v[order]


def _bucket(words: pa.Table) -> tuple[int, np.ndarray, np.ndarray]:
    return (words["bucket"][0].as_py(), np.frombuffer(words["entries"][0].as_buffer(), dtype=ENTRY),
            np.frombuffer(words["contexts"][0].as_buffer(), dtype=np.int64))


def _seats(e: np.ndarray, drawn: list[tuple[np.ndarray, np.ndarray]]) -> bytes:
    """The kept sweeps of a bucket; one customer sits at one table."""
    some = np.flatnonzero(e["n"] > 1)
    return pack(*(x.astype(np.int64) for t, r in drawn for x in (t[some], r)))


def _seated(e: np.ndarray, seats: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    met, some, drawn = np.minimum(e["n"], 1).astype(float), np.flatnonzero(e["n"] > 1), unpack(seats)
    for t, r in zip(drawn[::2], drawn[1::2]):
        every = met.copy()
        every[some] = t
        yield every, r.astype(float)


def _sweep(root: tuple[float, float, float], seed: int, samples: int, shards: int, keep: bool = False):
    """A round: seats anew from the totals that came back (customers and
    tables) and sends the tables of every kept sweep; the last round keeps
    the seats themselves too, for the answers."""
    def run(words: pa.Table, back: pa.Table) -> pa.Table:
        bucket, (e, contexts) = words["bucket"][0].as_py(), _opened(words["entries"][0].as_py(), words["contexts"][0].as_py())
        order, parts = _by_shard(contexts, shards)
        v = _back(order, back)
        before = Totals(v[:, 0], v[:, 1], root[1], root[2], root[0])
        drawn = list(sweeps(e, before, np.random.default_rng([seed, bucket]), BURN, samples))
        tables, roots = zip(*drawn)
        v = [np.bincount(e["ctx"], weights=t, minlength=len(contexts)).astype(np.int64)[order] for t in tables]
        numbers = [x for t, r in zip(tables, roots) for x in (t.sum(), r.sum())]
        seats = [_seats(e, drawn)] if keep else []
        n, k, m = len(parts), len(seats), len(numbers)
        return pa.table([pa.array([i for i, _, _ in parts] + [None] * (k + m), pa.int64()),
                         pa.array([bucket] * (n + k) + [None] * m, pa.int64()),
                         pa.array([pack(*(x[lo:hi] for x in v)) for _, lo, hi in parts] + seats + [None] * m, pa.binary()),
                         pa.array([None] * (n + k) + list(range(m)), pa.int32()), pa.array([None] * (n + k) + numbers, pa.float64())],
                        names=["shard", "bucket", "v", "i", "x"])
    return run


def _answers(root: tuple[float, float, float], after: list[tuple[float, float]], seed: int):
    """``(block, pairs, counts)``: log probability and count of what each block
    asked.  ``back`` has the totals that the last round sampled from, and those
    that its sweeps gave; the predictives of the sweeps are averaged.  Sweeps
    whose ``seats`` were not kept are drawn again from the same seed."""
    def run(words: pa.Table, back: pa.Table, seats: bytes | None = None) -> pa.Table:
        bucket, e, contexts = _bucket(words)
        first = back["last"].to_numpy()
        v = _totals_of(contexts, back.filter(pa.array(~first)), 2)
        kept = _totals_of(contexts, back.filter(pa.array(first)), 1 + len(after))
        before = Totals(v[:, 0], v[:, 1], root[1], root[2], root[0])
        p = np.zeros(len(e))
        drawn = _seated(e, seats) if seats is not None else sweeps(e, before, np.random.default_rng([seed, bucket]), BURN, len(after))
        for i, (tables, seated) in enumerate(drawn):
            p += predictive(e, tables, seated, Totals(v[:, 0], kept[:, 1 + i], after[i][1], root[2], after[i][0]))
        p = np.log10(p / len(after))
        starts, word = words_of(e)
        key = pair_key(np.ascontiguousarray(e["w"]), contexts[e["ctx"]])
        count = np.add.reduceat(e["n"], starts)
        asked = np.frombuffer(words["asked"][0].as_buffer(), dtype=ASKED)
        asked = asked[np.argsort(asked["block"], kind="stable")]
        blocks, at = np.unique(asked["block"], return_index=True)
        pairs, counts = [], []
        for lo, hi in zip(at, np.append(at[1:], len(asked))):
            i = asked["entry"][lo:hi]
            rows = np.empty(len(i), dtype=ANSWER)
            rows["key"], rows["p"] = key[i], p[i]
            j = word[i]
            j = j[np.concatenate(([True], j[1:] != j[:-1]))]
            known = np.empty(len(j), dtype=COUNT)
            known["w"], known["c"] = e["w"][starts[j]], count[j]
            pairs.append(rows.tobytes())
            counts.append(known.tobytes())
        return pa.table([pa.array(blocks.astype(np.int32)), pa.array(pairs, pa.binary()), pa.array(counts, pa.binary())],
                        names=["block", "pairs", "counts"])
    return run


def _packed(answers, shards: int):
    """``answers`` on stored rows; probabilities and counts travel without keys,
    in the order of the block's pairs and words in the bucket."""
    def run(words: pa.Table, back: pa.Table) -> pa.Table:
        e, contexts = _opened(words["entries"][0].as_py(), words["contexts"][0].as_py())
        order, _ = _by_shard(contexts, shards)
        plain = lambda a: pa.array([a.tobytes()], pa.binary())
        kinds = [False, True]
        totals = [_back(order, back.filter(pc.equal(back["last"], k))).tobytes() for k in kinds]
        got = answers(
            pa.table([words["bucket"], plain(e), plain(contexts), plain(_asked(words["asked"][0].as_py()))],
                     names=["bucket", "entries", "contexts", "asked"]),
            pa.table([pa.array([contexts.tobytes()] * 2, pa.binary()), pa.array(totals, pa.binary()), pa.array(kinds)],
                     names=["contexts", "v", "last"]),
            back.filter(pc.is_null(back["last"]))["v"][0].as_py())
        out = [pack(np.ascontiguousarray(np.frombuffer(p, dtype=ANSWER)["p"]).view("<u4"), np.frombuffer(c, dtype=COUNT)["c"])
               for p, c in zip(got["pairs"].to_pylist(), got["counts"].to_pylist())]
        return pa.table([got["block"], pa.array([words["bucket"][0].as_py()] * len(out), pa.int64()), pa.array(out, pa.binary())],
                        names=["block", "bucket", "answers"])
    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(block, rows)``: the documents of a block, compressed."""
    for b in batches:
        block = b.column(0).to_numpy()
        cuts = np.flatnonzero(block[1:] != block[:-1]) + 1
        starts = [0, *cuts.tolist()] if len(block) else []
        rows = []
        for lo, hi in zip(starts, [*starts[1:], len(block)]):
            part = b.select(["doc_id", "held_out", "text"]).slice(lo, hi - lo)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(part)
            rows.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array(block[starts]), pa.array(rows, pa.binary())], ["block", "rows"])


def _score(total: int, distinct: int, buckets: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        ids, held, every = [], [], []
        for x in docs["rows"].to_pylist():
            for b in pa.ipc.open_stream(x):
                ids.append(b.column(0))
                held.append(b.column(1))
                every += [spelled(b.column(2).slice(lo, hi - lo)) for lo, hi in lots(b.column(2))]
        every, hashes, sizes = tokens(every)
        starts = np.cumsum(sizes) - sizes
        _, _, place, key = ordered(every, hashes, buckets)
        del every, hashes
        p, count = map(np.concatenate, zip(*map(unpack, answers.sort_by("bucket")["answers"].to_pylist())))
        p = p.astype("<u4").view("<f4").astype(float)
        base = np.log10(count + 1.0) - np.log10(total + distinct + 1.0)
        known = np.add.reduceat((count > 0).astype(np.int64)[place], starts)
        base = np.add.reduceat(base[place], starts)
        del place
        order = np.argsort(key)
        key = key[order]
        at = np.empty(len(key), dtype=np.int32)
        at[order] = np.cumsum(np.concatenate(([False], key[1:] != key[:-1])))
        del key, order
        assert at.max() + 1 == len(p)
        n = len(sizes)
        return pa.table([pa.chunked_array(ids), pa.chunked_array(held), pa.array(sizes), pa.array(known), pa.array([total] * n, pa.int64()),
                         pa.array(base), pa.array(np.add.reduceat(p[at], starts))],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def _scan(documents: DataFrame) -> DataFrame:
    """Documents as a plain file scan (anything else is written first)."""
    if documents._jdf.queryExecution().analyzed().getClass().getSimpleName().startswith("LogicalRelation"):
        return documents
    return cut(documents.select("doc_id", "text"), "documents")


def _starts(documents: DataFrame) -> list:
    """Starts of the blocks, about one row for ``BLOCK_BYTES`` of text."""
    at = documents.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("row"),
                          F.col("text").cast("string").alias("text"))
    return at.mapInArrow(_statistics(BLOCK_BYTES), "path string, start long, n long").orderBy("path", "start").collect()


def _blocks(documents: DataFrame, starts: list) -> DataFrame:
    """``(block, doc_id, text, held_out)``; a block is a run of rows of a file
    of at most ``BLOCK_BYTES`` and one text.  Its start was settled once, so
    blocks are the same in every job, also after executors are lost."""
    files: dict[str, list] = {}
    for i, r in enumerate(starts):
        files.setdefault(r["path"], [i, []])[1].append(r["start"])
    table = documents.sparkSession.createDataFrame([(p, i, rows) for p, (i, rows) in files.items()],
                                                   "path string, base int, starts array<long>")
    docs = documents.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("row"),
                            F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                            held_out(F.col("doc_id"), FOLDS).alias("held_out"))
    block = F.col("base") + F.size(F.filter("starts", lambda x: x <= F.col("row"))) - 1
    return docs.join(F.broadcast(table), "path").select(block.alias("block"), "doc_id", "text", "held_out")


def language_scores(documents: DataFrame, seed: int = 17) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score and score (log10)."""
    source = _scan(documents)
    starts = _starts(source)
    buckets = max(16, int(sum(r["n"] for r in starts) // BUCKET_BYTES))
    docs = _blocks(source, starts)

    asked = docs.select("block", "held_out", "text").mapInArrow(_requests(buckets), "bucket long, block int, pairs binary")
    words = stored(asked.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(
        _gather, "bucket long, entries binary, contexts binary, asked binary, total long, tables long, distinct long"),
        "words", "bucket", buckets)
    total, tables, distinct = (x or 0 for x in words.agg(F.sum("total"), F.sum("tables"), F.sum("distinct")).first())
    entries = words.select("bucket", "entries", "contexts")
    shards = max(16, buckets // 4)
    places = stored(entries.mapInArrow(_first(shards), "shard long, bucket long, v binary").repartition(shards, "shard")
                     .sortWithinPartitions("shard").mapInArrow(_register, "shard long, bucket long, places binary, totals binary"),
                     "places", "shard", shards)
    root, back = (tables, distinct, distinct), places.select("bucket", "shard", F.col("totals").alias("v"))
    for r in range(ROUNDS + 1):
        before, last, samples, at = root, back, SAMPLES if r == ROUNDS else 1, seed + r
        sent = cut(entries.groupBy("bucket").cogroup(last.groupBy("bucket"))
                   .applyInArrow(_sweep(before, at, samples, shards, r == ROUNDS), SENT), "totals")
        got = _add(sent, 2 * samples).reshape(-1, 2)
        root, back = (got[0, 0], got[0, 1], distinct), _returned(places, sent)
    both = (last.withColumn("last", F.lit(False)).unionByName(back.withColumn("last", F.lit(True)))
            .unionByName(sent.where("shard is null and i is null")
                         .select("bucket", "shard", "v", F.lit(None).cast("boolean").alias("last"))))
    answers = (words.select("bucket", "entries", "contexts", "asked").groupBy("bucket").cogroup(both.groupBy("bucket"))
               .applyInArrow(_packed(_answers(before, [tuple(x) for x in got.tolist()], at), shards),
                             "block int, bucket long, answers binary"))
    return (docs.mapInArrow(_texts, "block int, rows binary").groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(_score(total, distinct, buckets),
                          "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                          "base_score double, score double"))


def perplexity(scores: DataFrame) -> DataFrame:
    """Perplexity per token by fold, of the model and of the add-one base."""
    per = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scores.groupBy("held_out").agg(per("score").alias("perplexity"), per("base_score").alias("base_perplexity"))

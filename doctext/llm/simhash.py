"""SimHash near-duplicates by exact tiled comparison.

Every document gets a 64-bit fingerprint of its word shingles.  Distinct
fingerprints are sorted into tiles by the population counts of their four
16-bit quarters; two fingerprints within ``radius`` bits differ in those
counts by at most ``radius`` altogether, so only tile pairs that near are
compared (numpy exclusive-or and bit counts), and that loses no pair.  A tile
above ``TILE`` rows is split, so that a tile pair has a bounded size; a pair
of tiles hands on a spanning forest of its links, and components follow by
distributed contraction.

Defined results: texts without words (null, empty, white space) have
fingerprint zero and link like any other; fewer words than a shingle make one
shingle of all of them; equal texts share a fingerprint and are compared
once; repeated rows are kept; a null doc_id counts as larger than any id and
its class id is null only if no row of the class has one; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, hide, show
from .tiles import Forest, sorted_groups

SEED = 42
TILE = 4096
#: Signatures: four quarter counts of 0 to 16 each.
SIGNATURES = 17 ** 4
#: Shingles hashed before their bits are added up.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3, seed: int = SEED) -> int:
    """Bit b is set if more than half of the shingle hashes have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    hash_of = xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    lo = starts[:n].tolist()
    hi = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    ones = np.zeros(64, dtype=np.int64)
    for c in range(0, n, CHUNK):
        h = np.array([hash_of(line[a:b], seed) for a, b in zip(lo[c:c + CHUNK], hi[c:c + CHUNK])], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = ones * 2 > n
    return int(np.packbits(bits).view(">u8")[0])


def fingerprints(documents: DataFrame, shingle: int = 3, seed: int = SEED,
                 extra: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, fp)`` and long columns ``extra`` for every row, ``fp`` as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle, seed) for t in b.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), *b.columns[2:]],
                                             ["doc_id", "fp", *extra])
    return (documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                             *extra)
            .mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", "fp", *extra))))


def _steps(radius: int) -> np.ndarray:
    """All differences of quarter counts whose absolute sum is within the radius."""
    r = range(-radius, radius + 1)
    return np.array([d for d in product(r, repeat=4) if sum(map(abs, d)) <= radius], dtype=np.int64)


def signature(fp):
    quarter = lambda i: F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF)))
    return (quarter(0) + 17 * quarter(1) + 289 * quarter(2) + 4913 * quarter(3)).cast("int")


def near_links(fps: DataFrame, radius: int = 2, tile: int = TILE) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints within ``radius`` bits:
    a spanning forest of every tile pair's links, so all components are whole.

    ``fps(fp)`` must be distinct.
    """
    marked = fps.select("fp", signature(F.col("fp")).alias("sig"))
    counts = np.zeros(SIGNATURES, dtype=np.int64)  # at most 83,521 rows, whatever the input
    for sig, n in marked.groupBy("sig").agg(F.count(F.lit(1))).collect():
        counts[sig] = n
    n_tiles = -(-counts // tile)
    first = np.concatenate(([0], np.cumsum(n_tiles)[:-1]))
    steps, radix = _steps(radius), np.array([1, 17, 289, 4913])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each fingerprint to every tile pair that holds its own tile."""
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                b = batch.slice(lo, 2048)
                fp, sig = b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.int64)
                part = ((fp.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
                own = first[sig] + part % n_tiles[sig]
                near = (sig[:, None] // radix) % 17
                near = near[:, None, :] + steps[None]
                there = ((near >= 0) & (near <= 16)).all(axis=2)
                near = np.where(there, (near * radix).sum(axis=2), 0)
                many = np.where(there, n_tiles[near], 0)
                row = np.repeat(np.arange(len(fp)), many.sum(axis=1))
                flat, reps = near.ravel(), many.ravel()
                keep = reps > 0
                start = np.repeat(first[flat[keep]], reps[keep])
                step = np.arange(len(start)) - np.repeat(np.cumsum(reps[keep]) - reps[keep], reps[keep])
                other = start + step
                mine = own[row]
                pair = (np.minimum(mine, other) << 32) | np.maximum(mine, other)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(fp[row]), pa.array(mine <= other)],
                                                 ["pair", "fp", "low"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[np.ndarray] = []
        size = 0
        for g in sorted_groups(batches):
            pair = g.column(0)[0].as_py()
            fp, low = g.column(1).to_numpy().view(np.uint64), g.column(2).to_numpy()
            same = pair >> 32 == pair & 0xFFFFFFFF
            a, b = (fp, fp) if same else (fp[low], fp[~low])
            if (len(fp) < 2) if same else not (len(a) and len(b)):
                continue
            found = _links(a, b, same, radius)
            if len(found):
                out.append(found)
                size += len(found)
            if size > 50_000:
                yield _edges(out)
                out, size = [], 0
        if out:
            yield _edges(out)

    pairs = marked.mapInArrow(spread, "pair long, fp long, low boolean")
    return (pairs.repartition("pair").sortWithinPartitions("pair")
            .mapInArrow(compare, "a long, b long"))


def _edges(parts: list[np.ndarray]) -> pa.RecordBatch:
    e = np.concatenate(parts)
    return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], ["a", "b"])


def _links(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> np.ndarray:
    """Links of a tile pair as signed pairs; a spanning forest if there are more than rows."""
    n = len(a) if same else len(a) + len(b)
    forest, out = None, []
    got = 0
    for i in range(0, len(a), 512):
        x, y = np.nonzero(np.bitwise_count(a[i:i + 512, None] ^ b[None, :]) <= radius)
        x = x + i
        if same:
            keep = x < y
            x, y = x[keep], y[keep]
        if not len(x):
            continue
        if forest is None and got + len(x) > n:
            forest = Forest(n)
            out = [np.array(forest.link(e[:, 0], e[:, 1] + (0 if same else len(a))), dtype=np.int64).reshape(-1, 2)
                   - [[0, 0 if same else len(a)]] for e in out]
        e = np.stack([x, y], axis=1)
        if forest is not None:
            e = (np.array(forest.link(x, y + (0 if same else len(a))), dtype=np.int64).reshape(-1, 2)
                 - [[0, 0 if same else len(a)]])
        got += len(e)
        out.append(e)
    if not out:
        return np.empty((0, 2), dtype=np.int64)
    e = np.concatenate(out)
    return np.stack([a[e[:, 0]], b[e[:, 1]]], axis=1).view(np.int64)


def simhash_groups(documents: DataFrame, shingle: int = 3, radius: int = 2, seed: int = SEED,
                   extra: tuple[str, ...] = ()) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id, the
    fingerprint as a long (``fp``), and the class key (``comp``, its smallest
    fingerprint), which also tells classes apart that share a doc_id or have none."""
    docs = cut(fingerprints(documents, shingle, seed, extra), "fingerprints")
    reps = cut(docs.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fp")
    groups = components(near_links(reps.select("fp"), radius))
    reps = reps.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("comp", "fp").alias("comp"))
    reps = cut(reps, "fp-groups")
    ids = reps.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    reps = reps.join(ids, "comp").select("fp", "component_id", "comp")
    return docs.join(reps, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "fp", "comp", *extra)


def keep_first(documents: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One document of each group, with all its columns: the smallest doc_id
    (null last); of rows that share it, one with the smallest text hash."""
    text = F.xxhash64(F.col("text").cast("string"))
    hidden = hide(documents, "doc_id", "text").withColumn("__t", text)
    groups = simhash_groups(hidden, shingle, radius, extra=("__t",))
    # min() skips nulls, so the flag puts rows without an id last.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__t"))
    keep = groups.groupBy("comp").agg(first.alias("k")).select(F.col("k.doc_id").alias("__i"), F.col("k.__t").alias("__u"))
    d = hidden.join(keep.distinct(), F.col("doc_id").eqNullSafe(F.col("__i")) & (F.col("__t") == F.col("__u")), "left_semi")
    # Rows repeated many times meet as one partial row for each task.
    return show(d.dropDuplicates(["doc_id", "__t"]), documents, "doc_id", "text")

"""Embedding near-duplicates by Euclidean p-stable hashing.

Vectors are normalised; ``tables`` hash tables each quantise ``width`` random
projections into cells of side ``cell``; vectors of one label that share a
bucket in any table are compared exactly by cosine in double precision.
Equal vectors of a label are one class with a count, so copies never meet.
Buckets are cut into tiles of ``TILE`` classes and tile pairs are compared
one at a time; a pair that meets in several tables counts only in the first,
which both sides can tell from their keys, so no pair is ever written out:
a tile pair hands on link counts and a spanning forest.

With unit vectors at cosine 0.98 (distance 0.2), cells of side 1 and 8
projections, one table finds a pair with probability 0.25 and 24 tables with
0.999 (more for nearer pairs); the tests measure it against brute force.

Defined results: a vector that is null, empty, zero or has a null or
non-finite component, and a vector without label, links with nothing;
vectors of different lengths never link; rows that repeat a vec_id are
separate vectors; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut
from .tiles import Forest, sorted_groups

TABLES, WIDTH, CELL = 24, 8, 1.0
TILE = 2048


def projections(dim: int, tables: int, width: int, cell: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    return rng.standard_normal((dim, tables * width)), rng.uniform(0.0, cell, tables * width)


def _unit(values) -> np.ndarray | None:
    """The vector as float64 of length one, or None if it cannot link."""
    if values is None:
        return None
    v = np.array([np.nan if x is None else x for x in values], dtype=np.float64)
    if not len(v) or not np.isfinite(v).all():
        return None
    top = np.abs(v).max()
    if not top > 0:
        return None
    v = v / top  # no overflow or underflow in the norm
    return v / np.sqrt(v @ v)


def _prepare(tables: int, width: int, cell: float, seed: int):
    """Rows ``(vec_id, cid, label, unit, keys)``; cid is null if the vector cannot link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            cids, units, keys = [], [], []
            for values, label in zip(b.column(2).to_pylist(), b.column(1).to_pylist()):
                u = None if label is None else _unit(values)
                if u is None:
                    cids.append(None), units.append(None), keys.append(None)
                    continue
                if len(u) not in drawn:
                    drawn[len(u)] = projections(len(u), tables, width, cell, seed)
                p, shift = drawn[len(u)]
                cells = np.floor((u @ p + shift) / cell).astype(np.int64).reshape(tables, width)
                tag = np.int64(label).tobytes() + np.int64(len(u)).tobytes()
                keys.append(b"".join(xxhash.xxh3_64_digest(tag + bytes([t]) + cells[t].tobytes(), 1)
                                     for t in range(tables)))
                raw = (u + 0.0).tobytes()
                units.append(raw)
                cids.append(xxhash.xxh3_128_hexdigest(tag + raw))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cids, pa.string()), pa.array(units, pa.binary()), pa.array(keys, pa.binary())],
                ["vec_id", "cid", "unit", "keys"])
    return run


def _buckets(tables: int):
    """One row ``(bucket, cid)`` for each table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = np.frombuffer(b"".join(b.column(1).to_pylist()), dtype="<i8")
            n = np.tile(np.arange(tables, dtype=np.int32), b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k), pa.array(n), b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), tables)))],
                ["bucket", "t", "cid"])
    return run


def _compare(threshold: float, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches):
            low, t = g.column(1).to_numpy(), g.column(2)[0].as_py()
            same = g.column(3)[0].as_py()
            cid, n = np.array(g.column(4).to_pylist()), g.column(5).to_numpy()
            dim = len(g.column(6)[0].as_py()) // 8
            units = np.frombuffer(b"".join(g.column(6).to_pylist()), dtype=np.float64).reshape(-1, dim)
            keys = np.frombuffer(b"".join(g.column(7).to_pylist()), dtype="<i8").reshape(-1, tables)
            a = np.arange(len(cid)) if same else np.flatnonzero(low)
            b = a if same else np.flatnonzero(~low)
            if not len(a) or not len(b) or (same and len(a) < 2):
                continue
            links, forest = np.zeros(len(cid), dtype=np.int64), Forest(len(cid))
            for i in range(0, len(a), 256):
                x, y = np.nonzero(units[a[i:i + 256]] @ units[b].T >= threshold - 1e-9)
                x, y = a[x + i], b[y]
                if same:
                    x, y = x[x < y], y[x < y]
                for s in range(0, len(x), 65536):
                    p, q = x[s:s + 65536], y[s:s + 65536]
                    ok = np.einsum("ij,ij->i", units[p], units[q]) >= threshold
                    if t:  # counted where the two meet first
                        ok &= ~(keys[p, :t] == keys[q, :t]).any(axis=1)
                    p, q = p[ok], q[ok]
                    np.add.at(links, p, n[q])
                    np.add.at(links, q, n[p])
                    forest.link(p, q)
            hit = np.flatnonzero(links)
            if len(hit):
                root = [forest.root(i) for i in hit.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cid[hit]), pa.array(links[hit]), pa.array(cid[root])], ["cid", "links", "root"])
    return run


def embedding_groups(embeddings: DataFrame, threshold: float = 0.98, tables: int = TABLES, width: int = WIDTH,
                     cell: float = CELL, seed: int = 3, tile: int = TILE) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    rows = cut(embeddings.select("vec_id", F.col("label").cast("long").alias("label"), "embedding")
               .mapInArrow(_prepare(tables, width, cell, seed),
                           "vec_id long, cid string, unit binary, keys binary"), "vectors")
    some = rows.where("cid is not null")
    # Copies collapse here; min() of equal values is that value.
    classes = cut(some.groupBy("cid").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id"),
                                          F.min("unit").alias("unit"), F.min("keys").alias("keys")), "classes")
    at = classes.select("cid", "keys").mapInArrow(_buckets(tables), "bucket long, t int, cid string")
    full = (at.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
            .select("bucket", F.ceil(F.col("m") / tile).cast("int").alias("tiles")))
    # Each class to every tile pair of its bucket that holds its own tile.
    at = at.join(full, "bucket").withColumn("own", F.expr("pmod(xxhash64(cid), tiles)").cast("int"))
    at = at.withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    at = at.select(
        F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("pair"),
        (F.col("own") <= F.col("other")).alias("low"), "t", (F.expr("own = other")).alias("same"), "cid")
    # A tile's own pair is keyed apart from its pairs with others by own = other.
    near = at.join(classes.select("cid", "n", "unit", "keys"), "cid").select(
        "pair", "low", "t", "same", "cid", "n", "unit", "keys")
    found = cut(near.repartition("pair").sortWithinPartitions("pair")
                .mapInArrow(_compare(threshold, tables), "cid string, links long, root string"), "links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    per = (classes.select("cid", "n", "first_id").join(links, "cid", "left")
           .join(groups.withColumnRenamed("node", "cid"), "cid", "left")
           .select("cid", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                   "first_id", F.coalesce("comp", "cid").alias("comp")))
    per = cut(per, "class-links")
    ids = per.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    per = per.join(ids, "comp").select("cid", "n_links", "component_id")
    out = rows.select("vec_id", "cid").join(per, "cid", "left")
    comp = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      comp.alias("component_id"), F.col("vec_id").eqNullSafe(comp).alias("kept"))

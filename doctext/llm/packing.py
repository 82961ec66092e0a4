"""Packing along a space-filling curve.

A document becomes a hashed vector of its byte trigrams, projected to a few
dimensions; the Hilbert key of that point orders the corpus, so neighbours on
the curve are alike.  Documents are range-sorted by (key, hash), tokenised and
packed in that order, task by task: sequences of ``LENGTH`` tokens without
padding, and what is left at a task's end in sequences whose lengths are
powers of two, which need none either.

Equal documents have one key; the hash beside it lets the range sort split
them over tasks.

Defined results: a null text is empty, and an empty text is the separator id
alone; documents longer than a sequence go on in the next one; repeated rows
are packed each; a null doc_id stays null; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import default_path, encoder

LENGTH = 1024
DIMS, BITS = 4, 15
#: Buckets of the hashed document vector.
BUCKETS = 1024
#: Bytes hashed at once.
CHUNK = 1 << 20
#: Bytes of text in one range of the sort, on average.
RANGE_BYTES = 64 << 20
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position of every row of ``points`` (unsigned, ``bits`` each) on the
    Hilbert curve, as long.  Works on all rows at once, bit by bit: in every
    octant the low bits of an axis are inverted or swapped with the first."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        bit, low = 1 << b, (1 << b) - 1
        for i in range(n):
            on = (x[i] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] >> b) & 1, (1 << b) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def document_vector(text: str | None) -> np.ndarray:
    """Unit vector of hashed byte trigrams (log counts); zero if there are none."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for lo in range(0, max(0, len(raw) - 2), CHUNK):
        b = raw[lo:lo + CHUNK + 2].astype(np.uint32)
        h = b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA6B) + b[2:] * np.uint32(0xC2B2AE35)
        counts += np.bincount(h >> np.uint32(22), minlength=BUCKETS)
    v = np.log1p(counts)
    norm = np.sqrt(v @ v)
    return v / norm if norm else v


def curve_keys(texts, seed: int = 5) -> np.ndarray:
    project = np.random.default_rng(seed).standard_normal((BUCKETS, DIMS))
    points = np.array([document_vector(t.as_py()) for t in texts]).reshape(-1, BUCKETS) @ project
    scaled = np.clip((points + 4.0) / 8.0, 0, 1 - 2 ** -30) * (1 << BITS)
    return hilbert_keys(scaled.astype(np.int64))


class Packer:
    """Pieces of a stream of documents; keeps the ids of the open sequence only."""

    def __init__(self, first_id: int, length: int, with_ids: bool):
        self.next_id, self.length, self.with_ids = first_id, length, with_ids
        self.open: list[tuple[int, int, int, bytes]] = []  # doc, start, doc_tokens, ids
        self.fill = 0
        self.rows: list[tuple] = []

    def close(self) -> None:
        at = 0
        for doc, start, total, ids in self.open:
            n = len(ids) >> 2
            row = (doc, start, n, zlib.crc32(ids), total, self.next_id, at)
            self.rows.append((*row, ids) if self.with_ids else row)
            at += n
        self.next_id += 1
        self.open, self.fill = [], 0

    def add(self, doc, ids: bytes, start: int = 0, total: int | None = None) -> None:
        n = len(ids) >> 2
        total = n if total is None else total
        at = 0
        while at < n:
            take = min(self.length - self.fill, n - at)
            self.open.append((doc, start + at, total, ids[4 * at:4 * (at + take)]))
            self.fill += take
            at += take
            if self.fill == self.length:
                self.close()

    def finish(self) -> None:
        """The open rest as sequences of falling powers of two."""
        left, parts, full = self.fill, self.open, self.length
        self.open, self.fill = [], 0
        while left:
            self.length = 1 << (left.bit_length() - 1)
            rest, parts_left = [], parts
            for i, (doc, start, total, ids) in enumerate(parts_left):
                room = self.length - self.fill
                self.add(doc, ids[:4 * room], start, total)
                if len(ids) >> 2 >= room:
                    if len(ids) >> 2 > room:
                        rest.append((doc, start + room, total, ids[4 * room:]))
                    rest += parts_left[i + 1:]
                    break
            parts, left = rest, left - self.length
        self.length = full


def pack(documents: DataFrame, length: int = LENGTH, path: str | None = None, separator: int = 0,
         with_ids: bool = False) -> DataFrame:
    """One row per piece of a document: where it starts in the document, its
    tokens, their checksum, and its sequence and offset; the ids themselves
    (little-endian 32-bit, column ``ids``) with ``with_ids``."""
    path = path or default_path()
    names = [p.split()[0] for p in PIECE.split(", ")] + ["ids"] * with_ids

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                c = b.slice(lo, 256)
                yield pa.RecordBatch.from_arrays([*c.columns, pa.array(curve_keys(c.column(1)))],
                                                 ["doc_id", "text", "tie", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, end = encoder(path), np.array([separator], dtype="<u4").tobytes()
        packer = Packer(TaskContext.get().partitionId() << 40, length, with_ids)

        def out() -> pa.RecordBatch:
            cols = list(zip(*packer.rows)) if packer.rows else [[] for _ in names]
            packer.rows = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary() if n == "ids" else pa.int64()) for c, n in zip(cols, names)], names)
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                packer.add(doc, tok.encode(text.as_py() or "") + end)
                if len(packer.rows) > 4096:
                    yield out()
        packer.finish()
        yield out()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("doc_id", "text"))
    keyed = rows.mapInArrow(key, "doc_id long, text string, tie long, key long")
    # Ranges by the bytes of all texts: a task's share does not grow with the table.
    held = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), held // RANGE_BYTES + 1)
    return (keyed.repartitionByRange(ranges, "key", "tie").sortWithinPartitions("key", "tie")
            .select("doc_id", "text").mapInArrow(run, PIECE + (", ids binary" if with_ids else "")))

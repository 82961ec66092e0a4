"""Postings of a task packed by package and bucket, on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Postings that are packed together; a task holds so many at a time.
ROWS = 1 << 20


def _pack(held: list[pa.RecordBatch], names: list[str]) -> pa.RecordBatch:
    package, bucket, term, tf = (pa.concat_arrays([b.column(i) for b in held]) for i in range(4))
    number = pc.dictionary_encode(package, null_encoding="encode").indices.to_numpy()
    buckets = bucket.to_numpy()
    order = np.lexsort((buckets, number))
    own = (np.diff(number[order]) != 0) | (np.diff(buckets[order]) != 0)
    at = np.flatnonzero(np.concatenate(([True], own)))
    ends = pa.array(np.append(at, len(order)).astype(np.int32))
    first = pa.array(order[at])
    return pa.RecordBatch.from_arrays(
        [package.take(first), bucket.take(first), pc.binary_join(pa.ListArray.from_arrays(ends, term.take(pa.array(order))), " "),
         pa.ListArray.from_arrays(ends, tf.take(pa.array(order)))], names)


def packs_udf(names: list[str], rows: int = ROWS) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``(package_id, bucket, terms, tfs)`` from ``(package_id, bucket, term,
    tf)``: terms side by side with a space between (they hold none).  A package
    and bucket may come more than once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n >= rows:
                yield _pack(held, names)
                held, n = [], 0
        if held:
            yield _pack(held, names)
    return run

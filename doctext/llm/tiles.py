"""Streaming over sorted groups inside a task, and links inside a group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def sorted_groups(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[pa.Table]:
    """Whole groups of equal keys from batches sorted by column ``key`` (long).
    Only the rows of the group that is still open are kept."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
        if held and held[-1].column(key)[0].as_py() != k[0]:
            yield pa.Table.from_batches(held)
            held = []
        last = 0
        for c in cuts:
            held.append(batch.slice(last, c - last))
            yield pa.Table.from_batches(held)
            held, last = [], c
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Union-find over local positions; keeps one edge per merge."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def link(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        out = []
        for x, y in zip(a.tolist(), b.tolist()):
            rx, ry = self.root(x), self.root(y)
            if rx != ry:
                self.up[max(rx, ry)] = min(rx, ry)
                out.append((x, y))
        return out

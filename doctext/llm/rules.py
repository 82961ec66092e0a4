"""Rule bitmask ledger: every rule is evaluated once per document; failures
are bits of one long, measurements stand beside them; policies are masks over
those bits and ablations are bitwise aggregates, so neither reads a text.

Defined results: a null or empty text has no words and fails ``few_words``;
very long texts are measured whole; repeated rows are measured each; extra
columns are ignored; an empty table gives an empty ledger, and its ablation
counts are 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")

#: One bit per rule, in this order: a document fails where the SQL holds.
#: Bits are never reused, so ledgers written earlier keep their meaning.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbol_words": "4 * n_symbols > n_words",
    "repeated_lines": "n_lines >= 4 and 2 * n_dup_lines > n_lines",
    "upper_case": "2 * n_upper > word_chars",
    "long_words": "word_chars > 25 * n_words",
}


@dataclass(frozen=True)
class Policy:
    """A versioned set of rules that reject."""
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << i for i, name in enumerate(RULES) if name in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_windows"))
STRICT = Policy("strict-1", tuple(RULES))


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside a window whose word sequence occurs at least twice."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.uint64, count=len(words))
    if len(number) == len(words):
        return 0
    # Equal windows have equal sums, so no equal sums means no repeat.
    mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(window):
        total = total * np.uint64(0xD6E8FEB86659FD93) + mixed[j:j + n]
    order = np.sort(total)
    if not (order[1:] == order[:-1]).any():
        return 0
    # Exact: number the sequences of 2, 4 and 8 words (window is a power of two).
    step, code = 1, ids.astype(np.int64)
    while step < window:
        pair = code[:-step] * np.int64(len(words) + 1) + code[step:]
        code = np.unique(pair, return_inverse=True)[1]
        step *= 2
    twice = np.bincount(code)[code] > 1
    marks = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(marks, at, 1)
    np.add.at(marks, at + window, -1)
    return int((np.cumsum(marks[:-1]) > 0).sum())


def measure_text(text: str) -> tuple[int, ...]:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    seen: set[bytes] = set()
    dup = 0
    lines = raw.split(b"\n")
    for line in lines:
        if line in seen:
            dup += 1
        elif line.strip():
            seen.add(line)
    return (len(words), len(text) - sum(text.count(c) for c in SPACES),
            len(raw) - len(raw.translate(None, SYMBOLS)), len(lines), dup, repeat_words(words),
            len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")))


def ledger(documents: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """``doc_id``, the measurements and ``failed`` (bit i: rule i fails)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = np.array([measure_text(t.as_py() or "") for t in b.column(1)], dtype=np.int64)
            got = got.reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(got[:, i]) for i in range(len(MEASURES))]],
                                             ["doc_id", *MEASURES])
    rows = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)))
    bits = " + ".join(f"if({sql}, {1 << i}L, 0L)" for i, sql in enumerate(rules.values()))
    return rows.withColumn("failed", F.expr(bits))


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``kept`` and the policy's version."""
    return rows.withColumn("kept", F.expr(f"failed & {policy.mask}L") == 0).withColumn("policy", F.lit(policy.version))


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents it fails, those only it fails, and
    documents kept without it.  The ledger is first counted by its bits (at
    most 2^rules rows), so the rest is a few rows of bitwise arithmetic."""
    by = rows.groupBy(F.expr(f"failed & {policy.mask}L").alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    names = [(name, 1 << i) for i, name in enumerate(RULES) if name in policy.rules]
    sums = []
    for name, bit in names:
        sums.append(F.struct(
            F.lit(name).alias("rule"),
            F.sum(F.when(F.expr(f"bits & {bit}L") != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == bit, F.col("n")).otherwise(0)).alias("n_only"),
            F.sum(F.when(F.expr(f"bits & {policy.mask & ~bit}L") == 0, F.col("n")).otherwise(0)).alias("n_kept_without")))
    one = by.agg(F.array(*sums).alias("a"))
    return one.select(F.explode("a").alias("r")).select(
        "r.rule", *[F.coalesce(f"r.{c}", F.lit(0)).alias(c) for c in ("n_failed", "n_only", "n_kept_without")])

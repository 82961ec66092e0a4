"""Line-level quality classifier: a linear-chain conditional random field.

Each line of a document is labelled good or bad.  Features describe the line
and its two neighbours; transitions tie neighbouring labels.  Training lines
take the label of their document.  Forward-backward marginals of "good",
weighted by line length, average into the document's raw quality, which a
logistic calibration (slope kept positive) turns into the score.

The field is fitted on a bounded sample (``FIT_DOCS`` labelled documents with
at most ``FIT_LINES`` lines each, chosen by a hash of the id); scoring covers
every whole text.

Defined results: a null or empty text is one empty line; if no usable label
exists every score is 0.5, and with one class only the scores go that way
alike; an id with several labels counts as good if any says so; repeated rows
score alike; extra columns are ignored by ``score`` and kept by
``keep_good``; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, hide, show

#: Bounds of the fitting sample (documents, lines of one document).
FIT_DOCS, FIT_LINES = 4000, 256
#: Label rows of this remainder of crc32(doc_id) mod 4 are never learnt from.
FOLDS = 4
THRESHOLD = 0.7

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGIT = b"0123456789"
_MARKS = b".,;:?'\"-()"
_SYMBOL = b"#*$%&<>@^~=+_\\/{}[]"
_HIGH = bytes(range(128, 256))
#: Own features of a line; those of the neighbours follow (the first
#: ``N_NEAR`` of them, of the line before and the line after).
N_OWN, N_NEAR = 13, 8
N_FEATURES = N_OWN + 2 * N_NEAR + 3


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows and weights (bytes plus one) of the lines of a text."""
    lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
    own = np.zeros((len(lines), N_OWN), dtype=np.float64)
    size = np.empty(len(lines))
    seen: set[bytes] = set()
    for i, line in enumerate(lines):
        n = len(line)
        size[i] = n + 1
        words = line.split()
        m = len(words)
        if not m:
            continue
        again = line in seen
        seen.add(line)
        share = lambda chars: (n - len(line.translate(None, chars))) / n
        same = sum(map(bytes.__eq__, words, words[1:]))
        own[i] = (share(_UPPER), share(_SYMBOL), line.count(b"|") / m, line.count(b"!") / m, same / m,
                  1.0 - len(set(words)) / m, again, share(_DIGIT),
                  share(_MARKS), share(_HIGH), np.log1p(m), np.log1p(n / m), m < 3)
    out = np.zeros((len(lines), N_FEATURES))
    out[:, :N_OWN] = own
    out[1:, N_OWN:N_OWN + N_NEAR] = own[:-1, :N_NEAR]
    out[:-1, N_OWN + N_NEAR:N_OWN + 2 * N_NEAR] = own[1:, :N_NEAR]
    out[0, -3] = 1.0   # no line before
    out[-1, -2] = 1.0  # no line after
    out[:, -1] = 1.0   # bias
    return out, size


class Chains:
    """Forward-backward over many chains of two labels at once; position t of
    all chains that long is one numpy step."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))[self.order]
        sorted_len = lengths[self.order]
        self.steps = [starts[:np.searchsorted(-sorted_len, -t, side="left")] + t
                      for t in range(int(lengths.max(initial=0)))]

    def marginals(self, unary: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """P(good) of each line, expected transition counts, and log Z.
        ``unary`` is the log-odds of good; ``trans[i, j]`` the score of i, j."""
        pot = np.stack([np.zeros_like(unary), unary], axis=1)
        alpha, beta = np.empty_like(pot), np.zeros_like(pot)
        for t, at in enumerate(self.steps):
            alpha[at] = pot[at] if not t else pot[at] + np.logaddexp(
                alpha[at - 1, 0, None] + trans[0], alpha[at - 1, 1, None] + trans[1])
        pairs = np.zeros((2, 2))
        for at in self.steps[:0:-1]:
            after = pot[at] + beta[at]
            beta[at - 1] = np.logaddexp(trans[:, 0] + after[:, :1], trans[:, 1] + after[:, 1:])
        total = alpha + beta
        z = np.logaddexp(total[:, 0], total[:, 1])
        p = np.exp(total[:, 1] - z)
        for at in self.steps[1:]:
            s = alpha[at - 1][:, :, None] + trans[None] + (pot[at] + beta[at])[:, None, :] - z[at][:, None, None]
            pairs += np.exp(s).sum(axis=0)
        last = z[self.steps[0]].sum() if self.steps else 0.0
        return p, pairs, float(last)


class Field:
    """Weights, transitions and calibration; small enough to ship by value."""

    def __init__(self):
        self.mean, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)
        self.weights, self.trans = np.zeros(N_FEATURES), np.zeros((2, 2))
        self.slope, self.shift = 1.0, 0.0

    def raw(self, features: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Length-weighted mean marginal of each document, as log-odds."""
        if not len(lengths):
            return np.zeros(0)
        p, _, _ = Chains(lengths).marginals((features - self.mean) / self.scale @ self.weights, self.trans)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        p = np.add.reduceat(p * sizes, starts) / np.add.reduceat(sizes, starts)
        p = np.clip(p, 1e-6, 1 - 1e-6)
        return np.log(p / (1 - p))

    def score(self, features: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        z = np.clip(self.slope * self.raw(features, sizes, lengths) + self.shift, -30, 30)
        return 1 / (1 + np.exp(-z))

    def fit(self, features: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, labels: np.ndarray,
            rounds: int = 200, ridge: float = 1e-3, rate: float = 0.1) -> "Field":
        """Adam on the penalised likelihood, every document weighing the same
        per line of its own (long documents do not drown short ones)."""
        if not len(lengths):
            return self
        self.mean = features.mean(axis=0)
        self.scale = np.maximum(features.std(axis=0), 1e-3)
        self.mean[-1], self.scale[-1] = 0.0, 1.0
        x, y = (features - self.mean) / self.scale, np.repeat(labels, lengths).astype(float)
        chains, n = Chains(lengths), len(y)
        inner = np.ones(n, dtype=bool)
        inner[np.concatenate(([0], np.cumsum(lengths)[:-1]))] = False
        seen = np.zeros((2, 2))
        for k in (0, 1):
            seen[k, k] = (inner & (y == k)).sum()
        theta = np.zeros(N_FEATURES + 4)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for i in range(1, rounds + 1):
            p, pairs, _ = chains.marginals(x @ theta[:-4], theta[-4:].reshape(2, 2))
            grad = np.concatenate([x.T @ (y - p), (seen - pairs).ravel()]) / n - ridge * theta
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
            theta += rate * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.999 ** i)) + 1e-8)
        self.weights, self.trans = theta[:-4], theta[-4:].reshape(2, 2)
        # Logistic calibration on the documents, with a prior of one row a class.
        z, t = self.raw(features, sizes, lengths), labels.astype(float)
        t = np.where(t == 1, (t.sum() + 1) / (t.sum() + 2), 1 / (len(t) - t.sum() + 2))
        a, b = 1.0, 0.0
        for _ in range(50):
            q = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            w = q * (1 - q) + 1e-9
            g = np.array([((t - q) * z).sum() - 1e-2 * (a - 1), (t - q).sum()])
            h = np.array([[(w * z * z).sum() + 1e-2, (w * z).sum()], [(w * z).sum(), w.sum()]])
            d = np.linalg.solve(h, g)
            d *= min(1.0, 2.0 / max(np.abs(d).max(), 1e-12))
            a, b = max(a + d[0], 1e-3), b + d[1]
        self.slope, self.shift = float(a), float(b)
        return self


def training_labels(labels: DataFrame, docs: int = FIT_DOCS, folds: int = FOLDS) -> DataFrame:
    """At most ``docs`` rows ``(doc_id, quality)`` that may be learnt from."""
    usable = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id"), folds))
    return (usable.groupBy("doc_id").agg(F.max("quality").alias("quality"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(docs))


def fit(documents: DataFrame, labels: DataFrame, docs: int = FIT_DOCS, lines: int = FIT_LINES) -> Field:
    """The field fitted on the bounded sample.  At most ``docs`` rows of at
    most ``lines`` lines reach the driver, as float32 features."""
    chosen = training_labels(labels, docs)
    sample = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
              .join(F.broadcast(chosen), "doc_id")
              .where(F.size(F.split(F.coalesce("text", F.lit("")), "\n")) <= lines))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [line_features(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([f.astype("<f4").tobytes() for f, _ in got], pa.binary()),
                 pa.array([s.astype("<f4").tobytes() for _, s in got], pa.binary())],
                ["doc_id", "quality", "features", "sizes"])
    # Repeated rows of one id count once: the sample is at most `docs` rows.
    rows = (sample.select("doc_id", "text", F.col("quality").cast("int").alias("quality"))
            .mapInArrow(run, "doc_id long, quality int, features binary, sizes binary")
            .dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id"))
    if not rows.num_rows:
        return Field()
    features = [np.frombuffer(x, "<f4").reshape(-1, N_FEATURES) for x in rows["features"].to_pylist()]
    sizes = [np.frombuffer(x, "<f4") for x in rows["sizes"].to_pylist()]
    lengths = np.array([len(f) for f in features])
    quality = (rows["quality"].to_numpy() > 0).astype(int)
    return Field().fit(np.concatenate(features).astype(float), np.concatenate(sizes).astype(float), lengths, quality)


def score(documents: DataFrame, field: Field, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``score`` and the long columns ``keep`` for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.empty(b.num_rows)
            for lo in range(0, b.num_rows, 128):
                got = [line_features(t.as_py()) for t in b.column(1).slice(lo, 128)]
                lengths = np.array([len(s) for _, s in got])
                out[lo:lo + len(got)] = field.score(np.concatenate([f for f, _ in got]),
                                                    np.concatenate([s for _, s in got]), lengths)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out), *b.columns[2:]], ["doc_id", "score", *keep])
    return (documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *keep)
            .mapInArrow(run, ", ".join(["doc_id long", "score double", *[f"{c} long" for c in keep]])))


def keep_good(documents: DataFrame, field: Field, threshold: float = THRESHOLD) -> DataFrame:
    """The documents the classifier accepts, with all their columns: one pass,
    no join (the score is computed beside the row)."""
    hidden = hide(documents, "text")
    at = hidden.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = np.empty(b.num_rows, dtype=bool)
            for lo in range(0, b.num_rows, 128):
                got = [line_features(t.as_py()) for t in b.column(at).slice(lo, 128)]
                lengths = np.array([len(s) for _, s in got])
                ok[lo:lo + len(got)] = field.score(np.concatenate([f for f, _ in got]),
                                                   np.concatenate([s for _, s in got]), lengths) >= threshold
            yield b.filter(pa.array(ok))
    return show(hidden.mapInArrow(run, hidden.schema), documents, "text")


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    rows = score(documents, fit(documents, labels))
    return rows.select("doc_id", held_out(F.col("doc_id"), FOLDS).alias("held_out"), "score",
                       F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))

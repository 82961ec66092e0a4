"""Cross-tokenizer alignment: where two tokenizers cut the same bytes.

A text's tokens are placed by the byte offset where each ends.  The offsets of
both tokenizers are dictionaries from end to index; their common keys, sorted,
slice both id lists into groups, and within a slice every pair of tokens whose
byte ranges overlap is a link.  Links are counted by id pair over the corpus.

A space that no space precedes and no white space follows starts a new token
in both vocabularies, so a text is aligned chunk by chunk and chunks met before
are looked up.  Documents travel as packed pair counts in blocks of bounded
bytes; each block asks once for the corpus count of every pair it holds.

Defined results: a null or empty text, and one whose tokens do not spell its
bytes in either vocabulary, has no tokens: zeros and an empty digest.  Very
long texts are aligned whole; repeated rows, equal and null ids give a row
each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Text bytes of one block of documents, but for a block's last document.
BLOCK_BYTES = 8 << 20
#: Chunks remembered by a worker, and the longest that is worth it.
MAX_CHUNKS, MAX_CHUNK = 400_000, 64
#: Characters of texts aligned at a time, but for the last text of a slice,
#: and new chunks placed at a time.
SLICE, PLACED = 1 << 19, 20_000
#: Distinct pairs of one batch of requests.
PAIR_ROWS = 50_000

#: Marks that may end a word; neither vocabulary joins them to a letter.
TAIL = ".,;:!?"

_START = re.compile(r"(?<! )(?= \S)")
_UNEVEN = re.compile(r" (?:\s|\Z)")

FACTS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
TOKENS = f"row long, doc_id long, block long, {FACTS}, pairs binary, counts binary"
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")


def byte_level() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable
    Latin-1 bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def end_index(ends: np.ndarray) -> dict[int, int]:
    """Token index by the byte offset where the token ends."""
    return dict(zip(ends.tolist(), count()))


def cuts(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The common ends in order, and how many tokens of each kind have ended
    there: between two of them lies a group."""
    at_a, at_b = end_index(a_ends), end_index(b_ends)
    common = sorted(at_a.keys() & at_b.keys())
    n = len(common)
    return (np.array(common, dtype=np.int64), np.fromiter(map(at_a.__getitem__, common), np.int64, n) + 1,
            np.fromiter(map(at_b.__getitem__, common), np.int64, n) + 1)


def links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs whose byte ranges overlap, slice by slice: a slice with m and
    n tokens has m + n - 1 of them, one for each stretch between the ends of
    either kind.  Returns the ends of the stretches and the index pairs."""
    ends = np.union1d(a_ends, b_ends)
    return ends, np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)


class Aligner:
    """Both tokenizers, and the alignment of chunks met before."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        vocab, special = self.a.get_vocab(with_added_tokens=True), {t.content for t in self.a.get_added_tokens_decoder().values()}
        to_byte = byte_level()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            self.a_bytes[i] = bytes(to_byte.get(c, 0) for c in piece)
        # The same vocabulary as ranks: ids of short chunks, without the
        # other library's bookkeeping.
        self.ranks = tiktoken.Encoding("chunks", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
            self.a_bytes[i]: i for piece, i in vocab.items() if piece not in special})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.b_size = self.b.vocab_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.b_size)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_len, self.b_len = np.array(list(map(len, self.a_bytes))), np.array(list(map(len, self.b_bytes)))
        #: Whether no piece joins a space to what stands before it.
        self.cuts = not any(re.search("[^▁]▁", p) for p in pieces)
        #: Whether no piece joins a mark of ``TAIL`` to a letter before it.
        self.tails = not any(x.isalpha() and y in TAIL for p in pieces for x, y in zip(p, p[1:]))
        self.known: dict[str, tuple | None] = {}
        self.known_tails: dict[str, tuple | None] = {}

    def _learn(self, bodies: set[str]) -> None:
        """Put the alignments of these chunks among the known ones; when there
        are too many, the older half goes, but for chunks in use."""
        new = [w for w in bodies if w not in self.known]
        if len(self.known) + len(new) > MAX_CHUNKS:
            self.known = {w: x for n, (w, x) in enumerate(self.known.items()) if 2 * n > MAX_CHUNKS or w in bodies}
        known, marked, whole = self.known, [], set()
        for w in new:
            core = w.rstrip(TAIL)
            if self.tails and len(core) < len(w) and core.isalpha():
                marked.append((w, core, w[len(core):]))
                if core not in known:
                    whole.add(core)
            else:
                whole.add(w)
        whole = list(whole)
        for i in range(0, len(whole), PLACED):
            part = whole[i:i + PLACED]
            known.update(zip(part, self._place(part)))
        for w, core, tail in marked:
            x, y = known[core], self._tail(tail)
            known[w] = x and (x[0] + y[0], f"{x[1]};{y[1]}", x[2] + y[2])

    def _tail(self, tail: str) -> tuple:
        """Marks after a letter: both vocabularies cut between the two."""
        if tail not in self.known_tails:
            if len(self.known_tails) >= MAX_CHUNKS:
                self.known_tails.clear()
            (n1, g1, k1), (n2, g2, k2) = self._place(["a", "a" + tail])
            self.known_tails[tail] = n2 - n1, g2[len(g1) + 1:], k2[len(k1):]
        return self.known_tails[tail]

    def _place(self, bodies: list[str]) -> list[tuple | None]:
        """``(n_a, text of the groups, pair keys)`` of a space followed by each
        body, all laid behind one another (a chunk's end is an end of both
        kinds); None where tokens do not spell it."""
        a_ids = [self.ranks.encode_ordinary(" " + w) if len(w) <= MAX_CHUNK
                 else self.a.encode(" " + w, add_special_tokens=False).ids for w in bodies]
        b_ids = self.b.encode(bodies, num_threads=1)
        raws = [(" " + w).encode("utf-8", "surrogatepass") for w in bodies]
        good = [n for n, raw in enumerate(raws)
                if b"".join(map(self.b_bytes.__getitem__, b_ids[n])) == raw
                and b"".join(map(self.a_bytes.__getitem__, a_ids[n])) == raw]
        out: list[tuple | None] = [None] * len(bodies)
        if not good:
            return out
        flat = lambda ids: np.fromiter(chain.from_iterable(ids[n] for n in good), np.int64)
        a, b = flat(a_ids), flat(b_ids)
        a_ends, b_ends = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        common, a_to, b_to = cuts(a_ends, b_ends)
        ends, p, q = links(a_ends, b_ends)
        keys = (a[p] * self.b_size + b[q]).astype("<u4")
        a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
        groups, i, j = [], 0, 0
        for i2, j2 in zip(a_to.tolist(), b_to.tolist()):
            if i2 - i == 1 and j2 - j == 1:
                groups.append(f"{a_text[i]}|{b_text[j]}")
            else:
                groups.append(f"{','.join(a_text[i:i2])}|{','.join(b_text[j:j2])}")
            i, j = i2, j2
        last = np.cumsum([len(raws[n]) for n in good])
        g_to, k_to = np.searchsorted(common, last) + 1, np.searchsorted(ends, last) + 1
        g = k = 0
        for n, g2, k2 in zip(good, g_to.tolist(), k_to.tolist()):
            out[n] = len(a_ids[n]), ";".join(groups[g:g2]), keys[k:k2].tobytes()
            g, k = g2, k2
        return out

    def bodies(self, text: str) -> list[str]:
        """The chunks of a space and ``text``, without the space before each."""
        if not self.cuts:
            return [text]
        if not _UNEVEN.search(" " + text):
            return text.split(" ")
        return [c[1:] for c in _START.split(" " + text) if c]

    def align(self, texts: list[str | None]) -> list[tuple]:
        """``(n_a, n_b, n_groups, n_links, digest, pair keys, their counts)``
        of every text."""
        chunks = [self.bodies(t) if t else None for t in texts]
        self._learn({c for c in set().union(*[one for one in chunks if one]) if len(c) <= MAX_CHUNK})
        return [self._sum(c) for c in chunks]

    def _sum(self, bodies: list[str] | None) -> tuple:
        try:
            parts = [None] if bodies is None else list(map(self.known.__getitem__, bodies))
        except KeyError:   # a long chunk, which is not remembered
            parts = [self.known[c] if len(c) <= MAX_CHUNK else self._place([c])[0] for c in bodies]
        if None in parts:
            return 0, 0, 0, 0, "", b"", b""
        n_a, groups, keys = zip(*parts)
        text = ";".join(groups)
        k, n = np.unique(np.frombuffer(b"".join(keys), "<u4"), return_counts=True)
        n_a, n_groups, n_links = sum(n_a), text.count("|"), int(n.sum())
        # A group of m and n tokens has m + n - 1 links.
        return (n_a, n_links + n_groups - n_a, n_groups, n_links, hashlib.sha256(text.encode()).hexdigest(),
                k.tobytes(), n.astype("<u4").tobytes())


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner for each worker process and pair of files."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
        assert len(_aligners[path_a, path_b].a_bytes) * _aligners[path_a, path_b].b_size < 1 << 32
    return _aligners[path_a, path_b]


def tokenise(documents: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: its own facts and its distinct pairs, packed.
    ``block`` numbers runs of documents of ``block_bytes`` within a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        block = TaskContext.get().partitionId() << 32
        row, size = block, 0
        for b in batches:
            out: list[tuple] = []
            texts: list[str | None] = []
            places: list[tuple] = []
            held = 0
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                if size > block_bytes:
                    block, size = block + 1, 0
                texts.append(text.as_py())
                places.append((row, doc_id, block))
                size += len(texts[-1] or "")
                held += len(texts[-1] or "")
                row += 1
                if held > SLICE:
                    out += [(*p, *x) for p, x in zip(places, both.align(texts))]
                    texts, places, held = [], [], 0
            out += [(*p, *x) for p, x in zip(places, both.align(texts))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=kind) for c, kind in zip(zip(*out) if out else [[]] * 10, _TOKEN_TYPES)], _TOKEN_NAMES)
    return (documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, TOKENS))


_TOKEN_NAMES = [c.split()[0] for c in TOKENS.split(", ")]
_TOKEN_TYPES = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]] for c in TOKENS.split(", ")]


def asked(tokens: DataFrame) -> DataFrame:
    """``(block, pair, n)``: the links of every pair within a block, in one row
    for each read of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, size, keys, counts = None, 0, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            if keys:
                k, place = np.unique(np.concatenate(keys), return_inverse=True)
                n = np.bincount(place, np.concatenate(counts)).astype("i8")
                for i in range(0, len(k), PAIR_ROWS):
                    part = k[i:i + PAIR_ROWS].astype("i8")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), at)), pa.array(part), pa.array(n[i:i + PAIR_ROWS])],
                        ["block", "pair", "n"])

        for b in batches:
            for block, k, n in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                if block != at or size > 8 * BLOCK_BYTES:
                    yield from flush()
                    at, size, keys, counts = block, 0, [], []
                keys.append(np.frombuffer(k.as_buffer() or b"", "<u4"))
                counts.append(np.frombuffer(n.as_buffer() or b"", "<u4"))
                size += 8 * len(keys[-1])
        yield from flush()
    return (tokens.where("n_links > 0").select("block", "pairs", "counts")
            .mapInArrow(run, "block long, pair long, n long"))


def pair_counts(requests: DataFrame, b_size: int) -> DataFrame:
    """``(pair, n, best)``: the corpus count of every linked id pair, and
    whether it is the highest of its B id.  A B id has as many pairs as the
    other vocabulary at most."""
    total = requests.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair") % b_size)
    top = total.groupBy("b").agg(F.max("n").alias("top"))
    return total.join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def answer(tokens: DataFrame, replies: DataFrame) -> DataFrame:
    """The documents of each block with the counts of their pairs."""
    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        pair = known.column("pair").to_numpy()
        order = np.argsort(pair)
        pair, n = pair[order], known.column("n").to_numpy()[order]
        best = known.column("best").to_numpy(zero_copy_only=False)[order]
        n_best, count_sum = [], []
        for k, c in zip(docs.column("pairs"), docs.column("counts")):
            at = np.searchsorted(pair, np.frombuffer(k.as_buffer() or b"", "<u4"))
            times = np.frombuffer(c.as_buffer() or b"", "<u4").astype("i8")
            n_best.append(int(times[best[at]].sum()))
            count_sum.append(int((times * n[at]).sum()))
        names = [c.split()[0] for c in RESULT.split(", ")]
        cols = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        return pa.table([cols[c] if c in cols else docs.column(c) for c in names], names=names)
    return tokens.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, RESULT)


def align_documents(documents: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per document: tokens of both kinds, groups, links, links whose
    pair is the most frequent of its B id, and the counts summed over links."""
    import public_tokenizers
    path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
    path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    import sentencepiece
    b_size = sentencepiece.SentencePieceProcessor(model_file=path_b).vocab_size()
    tokens = cut(tokenise(documents, path_a, path_b), "aligned")
    requests = cut(asked(tokens), "pairs")
    replies = requests.select("block", "pair").distinct().join(pair_counts(requests, b_size), "pair")
    return answer(tokens, replies)

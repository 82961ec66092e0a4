import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from doctext.llm import alignment
from doctext.llm.queries import QUERIES

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def byte_chars():
    keep = [b for b in range(256) if chr(b).isprintable() and chr(b) != " " and b != 173]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in keep)}


CHARS = byte_chars()


def plain(text):
    """(A ids, B ids, groups, links) of a whole text, by comparing all ranges."""
    if not text:
        return [], [], [], []
    raw = (" " + text).encode()
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    pa = [bytes(CHARS[c] for c in A.id_to_token(i)) for i in a]
    pb = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(pa) != raw or b"".join(pb) != raw:
        return [], [], [], []
    ends = lambda p: [sum(map(len, p[:i + 1])) for i in range(len(p))]
    ea, eb = ends(pa), ends(pb)
    links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b))
             if max(ea[i] - len(pa[i]), eb[j] - len(pb[j])) < min(ea[i], eb[j])]
    groups, low = [], 0
    for e in sorted(set(ea) & set(eb)):
        ids = lambda x, xe: ",".join(str(t) for t, at in zip(x, xe) if low < at <= e)  # noqa: B023, E731
        groups.append(ids(a, ea) + "|" + ids(b, eb))
        low = e
    return a, b, groups, links


def brute(texts):
    got = [plain(t) for t in texts]
    total = Counter(x for g in got for x in g[3])
    top = {}
    for (_, b), n in total.items():
        top[b] = max(n, top.get(b, 0))
    return [(len(a), len(b), len(g), len(k), sum(total[x] == top[x[1]] for x in k), sum(total[x] for x in k),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for a, b, g, k in got]


TEXTS = [None, "", " ", "one", "one two", "one two", "  two  spaces ", "a\nb\n c \t d\r\n", "é ü ß 日本語 😀 e\u0301", "<s> </s><|endoftext|> x",
         "▁ under", "a▁b", "\x00\x01", "it's 1234567 don't", "x" * 5000, "ab" * 3000, "word " * 3000, "\u00a0nbsp\u2003em", "ﬁ½",
         " lead", "trail ", "\u3000 x", "a \u3000b", "...!!!\n\n\n", "日本語" * 500, "\x1c x \x85 y",
         "end. next, é! été?! Straße... word;: 日本. ². 2. a_. x'. \"q\".", "end end. end.. .end ..", "ª. ǅ, ʰ! x\u0301. _,"]


def frame(spark, texts):
    rows = [(None if i == 3 else i // 2, t, 5, 1, "p") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n int, block int, pair string")


def keyed(rows):
    return sorted(rows, key=repr)


def test_nasty_texts_against_brute_force(spark, monkeypatch):
    got = alignment.align_documents(frame(spark, TEXTS)).collect()
    ids = [None if i == 3 else i // 2 for i in range(len(TEXTS))]
    want = keyed((i, *r) for i, r in zip(ids, brute(TEXTS)))
    assert keyed((r["doc_id"], *[r[c] for c in COLUMNS]) for r in got) == want
    small = alignment.tokenise(frame(spark, TEXTS), public_tokenizers.path("byte_bpe_50k.json"),
                               public_tokenizers.path("piece_bpe_32k.model"), block_bytes=10)
    assert small.select("block").distinct().count() > 5


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").where("n_chars < 3000").select("doc_id", "text").collect()]
    sub = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.align_documents(sub).collect()}
    assert got == {d: r for (d, _), r in zip(docs, brute([t for _, t in docs]))}
    whole = QUERIES["op13_alignment"](spark, sf)
    assert whole.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_empty_table(spark):
    assert alignment.align_documents(frame(spark, TEXTS).limit(0)).count() == 0


def test_cuts_and_links():
    a, b = np.array([2, 3, 7, 9]), np.array([3, 5, 9])
    assert [x.tolist() for x in alignment.cuts(a, b)] == [[3, 9], [2, 4], [1, 3]]
    ends, p, q = alignment.links(a, b)
    assert list(zip(p.tolist(), q.tolist())) == [(0, 0), (1, 0), (2, 1), (2, 2), (3, 2)]
    assert np.unique(list(alignment.byte_level().values())).tolist() == list(range(256))


def test_known_chunks_stay_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "MAX_CHUNKS", 40)
    both = alignment.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    texts = [f"w{i} common x{i * 7} words" for i in range(200)]
    got = [both.align([t])[0] for t in texts]
    assert len(both.known) <= 60
    assert [g[:5] for g in got] == [(len(a), len(b), len(g), len(k), hashlib.sha256(";".join(g).encode()).hexdigest())
                                    for a, b, g, k in map(plain, texts)]

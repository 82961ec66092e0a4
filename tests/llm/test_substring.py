import hashlib
import random

from doctext.llm import substring


def brute(rows, window):
    """doc rows -> (doc, n, removed, sha) by the rule, window by window."""
    big = 1 << 63
    words = [((big if i is None else i), (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            first[g] = min(first.get(g, big), i)
    out = []
    for i, w in words:
        gone = {k + j for k in range(len(w) - window + 1) if first[tuple(w[k:k + window])] < i for j in range(window)}
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((None if i == big else i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def make(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 3000)}"
    shared = [[word() for _ in range(rng.randint(20, 90))] for _ in range(4)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(rng.randint(0, 4)):
            text += rng.choice([[word() for _ in range(rng.randint(0, 70))], rng.choice(shared), rng.choice(shared)[5:]])
        rows.append((i, " ".join(text)))
    rows += [(i + 100, rows[rng.randint(0, 59)][1]) for i in range(15)]
    rows += [(200, rows[0][1]), (200, rows[1][1]), (200, rows[1][1]), (None, rows[2][1]), (None, None), (201, None), (202, "")]
    rows += [(300, "x y " * 400), (301, "x y " * 400 + "z"), (302, "\n".join(shared[0]) + "\t" + " ".join(shared[1]))]
    return rows


def test_windows_against_brute_force(docs):
    for seed in (1, 2):
        rows = make(seed)
        got = [tuple(r) for r in substring.digests(docs([(i, t, "a") for i, t in rows])).collect()]
        assert sorted(got, key=str) == brute(rows, 50)


def test_an_overfull_sketch_loses_nothing(docs, monkeypatch):
    monkeypatch.setattr(substring, "ROOM", 0.001)
    monkeypatch.setattr(substring.np, "log2", lambda x: 1.0)
    rows = make(3)
    got = [tuple(r) for r in substring.digests(docs([(i, t, "a") for i, t in rows])).collect()]
    assert sorted(got, key=str) == brute(rows, 50)


def test_documents_keep_their_columns(nasty, empty, docs):
    assert substring.digests(empty).count() == 0
    out = substring.deduplicate(nasty)
    assert out.schema == nasty.schema and out.count() == nasty.count()
    text = " ".join(f"w{i}" for i in range(60))
    got = {r["doc_id"]: r for r in substring.deduplicate(docs([(1, text, "a"), (2, "Start here\n" + text + "  end", "a")])).collect()}
    assert got[1]["text"] == text and got[2]["text"] == "Start here end" and got[2]["n_chars"] == 14


def test_only_texts_that_may_lose_words_are_shuffled(spark, tmp_path):
    """The others go from the scan to the result, whatever the size of the bitmap."""
    rows = make(4)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    out = substring._marked(spark.read.parquet(str(tmp_path / "d")))
    lines = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert lines[0].startswith("Union")
    some, rest = [out._jdf.queryExecution().optimizedPlan().children().apply(i).toString() for i in (0, 1)]
    assert "LeftOuter" in some and "__gone" in some
    assert "strategy=broadcast" in rest and rest.count("Join ") == 1, rest


def test_a_full_bitmap_loses_nothing(docs, monkeypatch):
    rows = make(5)
    for bits in (0, 26):
        monkeypatch.setattr(substring, "MOST_BITS", bits)
        got = [tuple(r) for r in substring.digests(docs([(i, t, "a") for i, t in rows])).collect()]
        assert sorted(got, key=str) == brute(rows, 50)

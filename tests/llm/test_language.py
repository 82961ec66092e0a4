import math
import zlib
from collections import Counter

import numpy as np

from doctext.llm import language


def test_base_score_and_counts(nasty, empty):
    got = language.language_scores(nasty).toPandas()
    rows = nasty.collect()
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    toks = [(r["text"] or "").encode().lower().split() + [b"\n"] for r in rows]
    count = Counter()
    for r, t in zip(rows, toks):
        if not out(r["doc_id"]):
            count.update(t)
    n, v = sum(count.values()), len(count)
    want = sorted((out(r["doc_id"]), len(t), sum(count[w] > 0 for w in t), n,
                   round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), 6)) for r, t in zip(rows, toks))
    have = sorted(zip(got.held_out, got.n_tokens, got.n_known, got.train_tokens, got.base_score.round(6)))
    assert have == want and np.isfinite(got.score).all() and (got.score <= 0).all()
    assert language.language_scores(empty).count() == 0


def test_model_beats_the_base_on_held_out_texts(spark):
    rng = np.random.default_rng(4)
    vocab = {"en": [f"e{i}" for i in range(300)], "de": [f"d{i}" for i in range(300)]}
    p = 1 / np.arange(1, 301)
    rows = []
    for i in range(300):
        lang = "en" if i % 2 else "de"
        words = rng.choice(vocab[lang], size=60, p=p / p.sum())
        rows.append((i, " ".join(["the" if lang == "en" else "der", *words])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    scores = language.language_scores(df)
    per = {r["held_out"]: r for r in language.perplexity(scores).collect()}
    assert per[True]["perplexity"] < 0.9 * per[True]["base_perplexity"]


def test_predictives_sum_to_one():
    """Over all words met and the unknown one, in every context."""
    rng = np.random.default_rng(0)
    words, k = 40, 3
    pairs = [(w, c) for w in range(1, words + 1) for c in range(k)]
    entries = np.zeros(len(pairs) + k, dtype=language.ENTRY)
    for i, (w, c) in enumerate(pairs):
        entries[i] = (w, c, rng.integers(0, 30) if (w + c) % 2 else 0)
    entries["n"][::k] += 1  # every word is met somewhere
    for c in range(k):
        entries[len(pairs) + c] = (10 ** 6, c, 0)
    seen = entries["n"] > 0
    customers = np.bincount(entries["ctx"], weights=entries["n"], minlength=k)
    tables = np.bincount(entries["ctx"][seen], minlength=k).astype(float)
    totals = language.Totals(customers, tables, float(words), float(words))
    for r in range(30):
        before = totals
        got, root = language.sample(entries, before, np.random.default_rng(r), 1, 3)
        totals = language.Totals(customers, np.bincount(entries["ctx"], weights=got, minlength=k), root.sum(), float(words))
    p = language.predictive(entries, got, root, totals)
    assert (p > 0).all()
    for c in range(k):
        assert abs(p[entries["ctx"] == c].sum() - 1) < 1e-9


def test_seating_follows_the_restaurant():
    """Mean tables of a lone restaurant with base mass 1: known growth."""
    rng = np.random.default_rng(1)
    c = np.full(20000, 50)
    t = language.seat(c, np.full(len(c), 1.0), 0.0, rng)  # concentration 1: harmonic number
    assert abs(t.mean() - sum(1 / i for i in range(1, 51))) < 0.05
    big = language.seat(np.full(500, 100_000), np.full(500, 1.0), 0.0, rng)
    assert abs(big.mean() - sum(1 / i for i in range(1, 100_001))) < 0.4


def test_the_word_before_counts(spark):
    """A successor chain: shuffled words score far worse, and its order is learnt."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(120):
        at = int(rng.integers(0, 50))
        rows.append((i, [f"w{(at + j) % 50}" for j in range(50)]))
    shuffled = [(1000 + i, list(rng.permutation(w))) for i, w in rows if zlib.crc32(str(1000 + i).encode()) % 7 == 2]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows + shuffled], "doc_id long, text string")
    got = [r for r in language.language_scores(df).collect() if r["held_out"]]
    per = lambda rows: 10 ** (-sum(r["score"] for r in rows) / sum(r["n_tokens"] for r in rows))
    kept, mixed = [r for r in got if r["doc_id"] < 1000], [r for r in got if r["doc_id"] >= 1000]
    assert kept and mixed and per(kept) < 4 and per(mixed) > 5 * per(kept)


def test_seating_of_many_customers_is_exact():
    """No step size shows in the mean, with and without a discount."""
    rng = np.random.default_rng(5)
    t = language.seat(np.full(20000, 100_000), np.full(20000, 1.0), 0.0, rng)
    assert abs(t.mean() - sum(1 / i for i in range(1, 100_001))) < 0.12
    plain_ = np.ones(20000)
    for j in range(1, 300):
        plain_ += rng.random(20000) * (5.0 + j - 0.8 * plain_) < 5.0
    t = language.seat(np.full(20000, 300), np.full(20000, 5.0), 0.8, rng)  # standard errors 0.06 and 0.04
    assert abs(t.mean() - plain_.mean()) < 0.25 and abs(t.std() - plain_.std()) < 0.2


def test_predictives_are_averaged_over_sweeps(monkeypatch):
    """Once for every kept sweep in every bucket, each with its own totals."""
    entries = np.zeros(3, dtype=language.ENTRY)
    entries["w"], entries["ctx"], entries["n"] = [1, 1, 2], [0, 1, 0], [40, 30, 5]
    before = language.Totals(np.array([45.0, 30.0]), np.array([2.0, 1.0]), 2.0, 2.0)
    kept = list(language.sweeps(entries, before, np.random.default_rng(1), 1, 3))
    mean, root = language.sample(entries, before, np.random.default_rng(1), 1, 3)
    assert len(kept) == 3 and np.allclose(mean, sum(t for t, _ in kept) / 3) and np.allclose(root, sum(r for _, r in kept) / 3)
    import pyarrow as pa
    contexts = np.array([7, 9], dtype=np.int64)
    after = [(float(t.sum()), float(r.sum())) for t, r in kept]
    sums = np.stack([before.customers, *[np.bincount(entries["ctx"], weights=t, minlength=2) for t, _ in kept]], axis=1)
    asked = np.zeros(3, dtype=language.ASKED)
    asked["entry"] = [0, 1, 2]
    words = pa.table({"bucket": [1], "entries": [entries.tobytes()], "contexts": [contexts.tobytes()], "asked": [asked.tobytes()]})
    both = np.stack([before.customers, before.tables], axis=1)
    back = pa.table({"bucket": [1, 1], "contexts": [contexts.tobytes()] * 2, "v": [both.tobytes(), sums.tobytes()],
                     "last": [False, True]})
    monkeypatch.setattr(language, "BURN", 1)
    rng = np.random.default_rng
    monkeypatch.setattr(language.np.random, "default_rng", lambda seed: rng(1))
    got = language._answers((before.root_customers, 2.0, 2.0), after, 17)(words, back)
    rows = np.frombuffer(got["pairs"][0].as_py(), dtype=language.ANSWER)
    want = sum(language.predictive(entries, t, r, language.Totals(before.customers, sums[:, 1 + i], after[i][1], 2.0, after[i][0]))
               for i, (t, r) in enumerate(kept)) / 3
    key = language.pair_key(np.ascontiguousarray(entries["w"]), contexts[entries["ctx"]])
    assert np.allclose([dict(zip(rows["key"].tolist(), rows["p"]))[k] for k in key.tolist()], np.log10(want), atol=1e-5)


def test_blocks_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    """Long texts that lie together do not make a large block."""
    rows = [(i, "a b " * 5) for i in range(2000)] + [(i, "long " * 4000) for i in range(2000, 2040)] + [(3000, None)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    monkeypatch.setattr(language, "BLOCK_BYTES", 100_000)
    df = spark.read.parquet(str(tmp_path / "d"))
    blocks = language._blocks(df, language._starts(df))
    got = blocks.selectExpr("block", "coalesce(octet_length(text), 0) as n").groupBy("block").sum("n").collect()
    assert len(got) > 5 and max(r[1] for r in got) < 100_000 + 20_000
    assert sorted(r[0] for r in blocks.select("doc_id").collect()) == [r[0] for r in rows]
    assert language.language_scores(df).count() == len(rows)


def test_packed_numbers_come_back():
    """Any width, and sorted hashes as steps."""
    rng = np.random.default_rng(2)
    h = np.sort(rng.integers(-2 ** 63, 2 ** 63 - 1, 1000))
    arrays = [np.arange(300), np.zeros(0, dtype=np.int64), np.array([2 ** 40, 1]), np.ones(5, dtype=np.int64)]
    blob = language.pack(language.steps(h), *arrays)
    steps, *got = language.unpack(blob)
    assert (np.cumsum(steps.view(np.uint64)).view(np.int64) == h).all()
    assert all((x == y).all() and len(x) == len(y) for x, y in zip(got, arrays))


def test_entries_do_not_move_after_they_are_stored(spark, tmp_path):
    """Joins on the bucket shuffle the totals only, never the stored entries."""
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % 97}" for j in range(60))) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    plan = language.language_scores(spark.read.parquet(str(tmp_path / "d")))._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    scans = [i for i, x in enumerate(lines) if "Scan parquet spark_catalog.default.words_" in x]
    assert scans
    for i in scans:
        above = lines[i - 3:i]
        assert not any("Exchange" in x for x in above), "\n".join(lines)


def test_words_of_many_texts_at_once(monkeypatch):
    """As each text split by itself, whatever its white space and the cut."""
    import pyarrow as pa
    import xxhash
    rng = np.random.default_rng(6)
    signs = list("aAbZé ß\t\n\x0b\x0c\r\x1c\x85\u00a0\u2028İ😀@[`{")
    texts = ["".join(rng.choice(signs, rng.integers(0, 40))) for _ in range(300)] + ["", None, " ", None, "a ", " B", "x" * 500]
    want = [[*(t or "").encode().lower().split(), b""] for t in texts]
    monkeypatch.setattr(language, "AT_ONCE", 100)
    column = pa.array(texts)
    cuts = list(language.lots(column))
    assert len(cuts) > 20 and [lo for lo, _ in cuts[1:]] == [hi for _, hi in cuts[:-1]] and cuts[-1][1] == len(texts)
    w, hashes, sizes = language.tokens([language.spelled(column.slice(lo, hi - lo)) for lo, hi in cuts])
    assert sizes.tolist() == list(map(len, want))
    hashed = [xxhash.xxh3_64_intdigest(x) if x else language.END for t in want for x in t]
    assert hashes.view(np.uint64)[w].tolist() == hashed and len(hashes) == len(set(hashed))
    words, own = language._bytes(column)
    assert words == [len(b" ".join(x)) - 1 if len(x) > 1 else 0 for x in ([*t[:-1], b" "] for t in want)]
    assert own == [len((t or "").encode()) for t in texts]
    assert list(language.lots(pa.array([], pa.string()))) == []


def test_the_last_sweeps_are_drawn_once(monkeypatch):
    """The answers take the seats that the last round kept, the same as drawn again."""
    import pyarrow as pa
    import pyarrow.compute  # noqa: F401
    rng = np.random.default_rng(7)
    k = 30
    words, ctx, n = np.sort(rng.integers(-2 ** 62, 2 ** 62, 20)), np.tile(np.arange(k), 20), rng.integers(0, 40, 20 * k)
    contexts = np.sort(rng.integers(-2 ** 62, 2 ** 62, k))
    row = pa.table({"bucket": [3], "entries": [language.pack(language.steps(words), np.full(20, k), ctx, n)],
                    "contexts": [language.pack(language.steps(contexts))],
                    "asked": [language.pack(np.array([0]), np.array([len(n)]), np.diff(np.arange(len(n)), prepend=0))]})
    sent = list(language._first(4)(iter(row.select(["bucket", "entries", "contexts"]).to_batches())))
    places = [next(language._register(iter([x]))) for b in sent for x in (b.slice(i, 1) for i in range(b.num_rows))]
    totals = pa.Table.from_batches(places).select(["bucket", "shard", "totals"]).rename_columns(["bucket", "shard", "v"])
    root = (float((n > 0).sum()), 20.0, 20.0)
    out = language._sweep(root, 5, 3, 4, True)(row, totals)
    mask = lambda c: pa.compute.is_valid(out[c])
    back = out.filter(mask("shard")).select(["bucket", "shard", "v"])
    first = pa.Table.from_batches(places)
    back = pa.concat_tables([language._sum_up(first.slice(i, 1), back.filter(pa.compute.equal(back["shard"], first["shard"][i])))
                             for i in range(len(first))])
    after = [tuple(x) for x in out.filter(mask("i"))["x"].to_numpy().reshape(-1, 2)]
    seats = out.filter(pa.compute.invert(pa.compute.or_(mask("shard"), mask("i"))))
    both = pa.concat_tables([t.select(["bucket", "shard", "v"]).append_column("last", pa.array([x] * len(t), pa.bool_()))
                             for t, x in ((totals, False), (back, True), (seats, None))])
    answers = language._answers(root, after, 5)
    want = language._packed(lambda words, back, seats: answers(words, back), 4)(row, both)
    monkeypatch.setattr(language, "sweeps", None)
    assert language._packed(answers, 4)(row, both).equals(want) and len(want) == 1

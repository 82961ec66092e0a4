import random

import numpy as np
import pytest
import xxhash

from doctext.llm import simhash


def plain(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, ids, radius):
    """Smallest id reachable over links, by label spreading."""
    f = np.array(fps, dtype=np.uint64)
    near = np.bitwise_count(f[:, None] ^ f[None]) <= radius
    label = np.array([(1 << 63) - 1 if i is None else i for i in ids])
    while True:
        new = np.where(near, label[None], (1 << 63) - 1).min(axis=1)
        if (new == label).all():
            return [None if x == (1 << 63) - 1 else int(x) for x in label]
        label = new


def test_fingerprints_and_groups(nasty, empty):
    rows = nasty.collect()
    got = sorted(map(tuple, simhash.simhash_groups(nasty).select("doc_id", "fingerprint", "component_id").collect()), key=str)
    fps = [plain(r["text"]) for r in rows]
    want = zip([r["doc_id"] for r in rows], [f"{x:016x}" for x in fps], groups(fps, [r["doc_id"] for r in rows], 2))
    assert got == sorted(want, key=str)
    assert simhash.simhash_groups(empty).count() == 0


@pytest.mark.parametrize("tile", [4096, 3])
def test_links_of_random_fingerprints(spark, tile):
    rng = random.Random(tile)
    seeds = [rng.getrandbits(64) for _ in range(15)]
    fps = set()
    for _ in range(400):
        x = rng.choice(seeds)
        for _ in range(rng.randint(0, 4)):
            x ^= 1 << rng.randint(0, 63)
        fps.add(x)
    fps = sorted(fps | {0, 1, (1 << 64) - 1})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"), 2, tile)
    comp = {r["node"]: r["comp"] for r in simhash.components(links).collect()}
    want = groups(fps, signed, 2)
    assert [comp.get(x, x) for x in signed] == want


def test_one_document_of_each_group_stays(nasty, docs):
    kept = simhash.keep_first(nasty)
    assert kept.schema == nasty.schema
    groups_ = simhash.simhash_groups(nasty)
    assert kept.count() == groups_.select("component_id").distinct().count()
    same = docs([(3, "a b c d e", "x"), (3, "a b c d e", "x"), (9, "A b c d e", "x"), (None, "q r s", "x"), (None, "q r s", "x")])
    assert sorted(map(str, [r["doc_id"] for r in simhash.keep_first(same).collect()])) == ["3", "None"]


def test_groups_are_classes_and_not_ids(docs):
    """Classes that share their smallest doc_id stay apart; a class without ids is one group."""
    far = docs([(5, "a b c d e", "x"), (7, "a b c d e", "x"), (5, "q r s t u v", "x"), (9, "q r s t u v", "x")])
    assert sorted((r["doc_id"], r["text"]) for r in simhash.keep_first(far).collect()) == [(5, "a b c d e"), (5, "q r s t u v")]
    words = [f"w{i}" for i in range(4000)]
    one = simhash.fingerprint(" ".join(words))
    near = next(t for t in (" ".join([*words[:-1 - i], "x"]) for i in range(100))
                if 1 <= (one ^ simhash.fingerprint(t)).bit_count() <= 2)
    assert simhash.keep_first(docs([(None, " ".join(words), "x"), (None, near, "x")])).count() == 1

import numpy as np
import pytest

from doctext.llm import embeddings


def brute(rows, threshold=0.98):
    """(vec_id, links, component) by comparing everything."""
    unit = []
    for _, v, label in rows:
        x = np.array([np.nan if e is None else e for e in v], dtype=float) if v else np.zeros(0)
        ok = label is not None and len(x) and np.isfinite(x).all() and np.abs(x).max() > 0
        unit.append(x / np.linalg.norm(x) if ok else None)
    n = len(rows)
    link = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2]
             and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(n)]
    label = [r[0] for r in rows]
    for _ in range(n):
        label = [min([label[i], *[label[j] for j in link[i]]]) for i in range(n)]
    return sorted((rows[i][0], len(link[i]), label[i], rows[i][0] == label[i]) for i in range(n))


def test_small_table_against_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 16))
    rows = [(i, (base[i % 12] + rng.normal(size=16) * 0.05 * (i % 4)).tolist(), int(i % 2)) for i in range(120)]
    rows += [(200 + i, rows[i][1], rows[i][2]) for i in range(20)]                      # copies
    rows += [(300 + i, [2 * x for x in rows[i][1]], rows[i][2]) for i in range(10)]     # same direction
    rows += [(400, None, 0), (401, [], 0), (402, [0.0] * 16, 0), (403, [float("nan")] * 16, 0), (404, rows[0][1], None),
             (405, [None] + [1.0] * 15, 1), (406, [float("inf")] * 16, 1), (407, [1.0, 0.0], 0), (408, [1.0, 0.001], 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, cid string")
    for tile in (2048, 4):
        got = sorted(map(tuple, embeddings.embedding_groups(df, tile=tile).collect()))
        assert got == brute(rows)


def test_recall_near_the_threshold(spark):
    """Pairs at cosine 0.98 to 0.985, the hardest ones."""
    rng = np.random.default_rng(2)
    rows, n = [], 400
    for i in range(n):
        a = rng.normal(size=64)
        a /= np.linalg.norm(a)
        b = rng.normal(size=64)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        c = rng.uniform(0.9801, 0.985)
        rows += [(2 * i, a.tolist(), 0), (2 * i + 1, (c * a + np.sqrt(1 - c * c) * b).tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = embeddings.embedding_groups(df).where("n_links > 0").count() / 2
    assert found / n >= 0.99


@pytest.mark.parametrize("kind", ["array<float>", "array<double>"])
def test_empty_table(spark, kind):
    df = spark.createDataFrame([], f"vec_id long, embedding {kind}, label int")
    assert embeddings.embedding_groups(df).count() == 0

import numpy as np
from pyspark.sql import functions as F

from doctext.llm import quality

GOOD = "Plain words form a short sentence here.\nAnother calm line follows the first one."
BAD = "BUY!! NOW!! $$$ ### BUY!! NOW!!\nBUY!! NOW!! $$$ ### BUY!! NOW!!"


def labelled(spark, n=80):
    rows = [(i, f"{GOOD} {i}" if i % 2 else f"{BAD} {i}") for i in range(n)]
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame([(i, i % 2) for i in range(n)], "doc_id long, quality int"))


def test_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 1, 4])
    unary, trans = rng.normal(size=8), rng.normal(size=(2, 2))
    p, pairs, z = quality.Chains(lengths).marginals(unary, trans)
    want, want_pairs, want_z, at = [], np.zeros((2, 2)), 0.0, 0
    for n in lengths:
        u, total, good = unary[at:at + n], 0.0, np.zeros(n)
        edges = np.zeros((2, 2))
        for code in range(2 ** n):
            y = [(code >> i) & 1 for i in range(n)]
            w = np.exp(sum(u[i] for i in range(n) if y[i]) + sum(trans[a, b] for a, b in zip(y, y[1:])))
            total += w
            good += w * np.array(y)
            for a, b in zip(y, y[1:]):
                edges[a, b] += w
        want.append(good / total)
        want_pairs += edges / total
        want_z += np.log(total)
        at += n
    assert np.allclose(p, np.concatenate(want)) and np.allclose(pairs, want_pairs) and np.isclose(z, want_z)


def test_held_out_rows_are_separated_and_never_learnt(spark):
    docs, labels = labelled(spark)
    out = quality.quality_scores(docs, labels).toPandas().set_index("doc_id")
    y = labels.toPandas().set_index("doc_id").quality
    assert out.held_out.any() and (out.predicted == y).all()
    # Turning every held-out label around changes nothing.
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id"), 4), 1 - F.col("quality"))
                               .otherwise(F.col("quality")))
    again = quality.quality_scores(docs, turned).toPandas().set_index("doc_id")
    assert np.allclose(out.score, again.score.loc[out.index])


def test_nasty_rows_and_empty_tables(spark, nasty, empty):
    docs, labels = labelled(spark)
    field = quality.fit(docs, labels)
    out = quality.score(nasty, field).toPandas()
    assert len(out) == nasty.count() and out.score.between(0, 1).all()
    assert out[out.doc_id == 5].score.nunique() == 1
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert (quality.quality_scores(nasty, none).toPandas().score == 0.5).all()
    assert quality.quality_scores(empty, labels).count() == 0
    kept = quality.keep_good(nasty, quality.Field(), threshold=0.5)
    assert kept.columns == nasty.columns and kept.count() == nasty.count()
    odd = spark.createDataFrame([(1, None), (None, 1), (5, 1), (5, 0)], "doc_id long, quality int")
    assert quality.quality_scores(nasty, odd).count() == nasty.count()

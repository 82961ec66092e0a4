"""Helpers shared by the operators: scratch tables, word rules, row fan-out."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship, written

#: White space of every word rule here: space, tab, LF, VT, FF, CR.  Python's
#: ``bytes.split()`` separates on exactly these six bytes.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

#: Rows in one Arrow batch.  Documents are kilobytes on average and sometimes
#: megabytes, so the engine's 10,000 rows would be too much for one worker.
ARROW_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """Make the package importable on the workers and keep Arrow batches
    small.  Safe to call any number of times."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    ship(spark)
    return spark


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage
    ends there, and a lost executor costs a file read instead of a recompute.
    The folder's retention rule removes the tables, as it does checkpoints."""
    return written(df, name)


def stored(df: DataFrame, name: str, key: str, parts: int) -> DataFrame:
    """``cut`` laid out by ``key``: joins and groups on it alone read their
    part where it lies and shuffle the other side only."""
    name = f"{name}_{uuid.uuid4().hex}"
    (df.write.format("parquet").option("path", scratch_path(df.sparkSession, name))
     .bucketBy(parts, key).saveAsTable(name))
    return df.sparkSession.table(name)


def hide(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with every column but ``names`` renamed by its place, so that
    helper columns cannot clash with it; ``show`` undoes it."""
    return df.select(*[F.col(f"`{c}`").alias(c if c in names else f"u{i}") for i, c in enumerate(df.columns)])


def show(df: DataFrame, like: DataFrame, *names: str) -> DataFrame:
    return df.select(*[F.col(c if c in names else f"u{i}").alias(c) for i, c in enumerate(like.columns)])


def word_count(text: Column) -> Column:
    """Number of words of ``text`` (0 for null)."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, GAP))).cast("long")


def held_out(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``, is 2.  A null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == 2, F.lit(False))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: one row ``(node, comp)`` per
    node that has an edge, ``comp`` the smallest node it reaches.

    Each round hooks every node to its smallest neighbour, follows the hooks
    twice and contracts the edges; every minimum is a map-side combined
    aggregate, so a hub costs one row per task.  Rounds end when no edge is
    left (about the logarithm of the longest path); nothing is collected.
    """
    e = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .where("a < b").distinct(), "edges")
    hops: list[DataFrame] = []
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = cut(both.groupBy("a").agg(F.min("b").alias("m"))
                 .select("a", F.least("a", "m").alias("p")), "hooks")
        for _ in range(2):
            nxt = up.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            up = up.join(nxt, "p").select("a", F.col("pp").alias("p"))
        up = cut(up, "roots")
        hops.append(up)
        ua = up.select("a", F.col("p").alias("pa"))
        ub = up.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        e = cut(e.join(ua, "a").join(ub, "b")
                .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
                .where("a < b").distinct(), "edges")
    if not hops:
        return e.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    out = hops[0].select(F.col("a").alias("node"), F.col("p").alias("comp"))
    for h in hops[1:]:
        out = (out.join(h, out.comp == h.a, "left")
               .select("node", F.coalesce("p", "comp").alias("comp")))
    return out

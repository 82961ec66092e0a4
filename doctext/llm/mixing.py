"""Mixing sources to target weights by entropy balancing (DataFrame only).

A document's rate is ``min(3, exp(lambda_s * x))`` with ``x`` its size over the
mean size of its source: the exponential tilt closest in entropy to "every
document once" whose expected words meet the source's token target.  The dual
variable of every source is found by safeguarded Newton steps; each step is
one distributed aggregate over the (source, size) histogram, and the table of
duals stays a table (sources are never collected).

Rates become whole copies per (source, size) cell: cells are folded from the
largest size down, each taking the nearest whole number of copies and handing
its remainder on, so what a source takes ends within about half its smallest
document of the target (unless bounds forbid it).  The copies of a cell go to
its documents in the order of a seeded hash, ranked in buckets so that a cell
with a third of all rows is spread over many tasks.

Defined results: a null text has size 0; a document of size 0 takes 0; a null
source is a source of its own, after all others; repeated rows are separate
documents; a corpus without words has targets 0; an empty table gives an
empty result.  Extra columns are ignored by ``mix`` and kept by ``apply``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, hide, show, word_count

#: Weights by the source's place in code point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: No document is taken more often than this.
MAX_COPIES = 3
#: A source's dual is settled when its words are this near the target.
NEAR = 1e-9
#: Documents of one cell that are ranked in one task, on average.
RANK_ROWS = 100_000


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS,
            cap: float = MAX_COPIES) -> DataFrame:
    """``(source, source_size, n_docs, target)`` from ``(source, size)`` rows.

    The total is shared by weight; a source above ``cap`` times its size stays
    there and the excess is reshared by weight among the rest until none is
    above.  Only sources below their cap take part, so sorting by the share
    at which each source would reach its cap turns the loop into one prefix
    scan: with the first k sources capped, the rest share
    ``(total - caps) / weights left`` each per unit of weight.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.count(F.lit(1)).alias("n_docs"))
    # One row per source: the order and the prefix sums run over source rows only.
    order = W.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("cap", F.col("source_size") * float(cap))
    fill = W.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing).orderBy(
        (F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    per = (per.withColumn("total", F.sum("source_size").over(every))
           .withColumn("w_left", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
           .withColumn("t_left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("level", F.col("t_left") / F.col("w_left"))
           .withColumn("full", F.col("level") * F.col("w") >= F.col("cap")))
    # The first source that is not full fixes the level of all after it.
    per = per.withColumn("open", F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(every))
    return per.select("source", "source_size", "n_docs",
                      F.least("cap", F.coalesce(F.col("open") * F.col("w"), F.col("cap"))).alias("target"))


def _rate(lam, x, cap: float):
    """exp(lambda x) up to the cap, without overflow."""
    return F.least(F.lit(float(cap)), F.exp(F.least(lam * x, F.lit(20.0))))


def solve(hist: DataFrame, goals: DataFrame, cap: float = MAX_COPIES) -> DataFrame:
    """Dual variable per source: ``(sid, mean, lam)``.

    ``hist(sid, size, n)`` counts documents; ``goals(sid, source_size,
    n_docs, target)``.  The bracket always holds the root: a document's ``x``
    is at least one word over the mean, so at the low end the source gives less
    than the target, at the high end its smallest document is at the cap.  A
    Newton step is taken while it stays inside and the gap halves; any other
    step bisects (from a wide side it goes no further than doubles ``lam``).
    So steps end, and they go on until every source is within ``NEAR`` of its
    target or its bracket has no number left inside.
    """
    mean = F.col("source_size") / F.col("n_docs")
    tiny = F.greatest(F.col("target"), F.lit(1e-12))
    lam = cut(goals.where("source_size > 0").select(
        "sid", "target", "n_docs", mean.alias("mean"), F.lit(0.0).alias("lam"),
        (-(F.log(F.greatest(F.col("source_size") / tiny, F.lit(1.0))) + 1.0) * mean).alias("lo"),
        (F.lit(1.2) * F.log(F.lit(float(cap))) * mean + 1.0).alias("hi"), F.lit(float("inf")).alias("last"))
        # At the cap every document is at the cap: the bracket's end is the root.
        .withColumn("lam", F.when(F.col("target") >= cap * F.col("mean") * (1 - 1e-12) * F.col("n_docs"),
                                  F.col("hi")).otherwise(F.col("lam"))).drop("n_docs"), "dual")
    cells = hist.where("size > 0")
    while True:
        x = F.col("size") / F.col("mean")
        r = _rate(F.col("lam"), x, cap)
        sums = (cells.join(lam, "sid").groupBy("sid")
                .agg(F.sum(F.col("n") * F.col("size") * r).alias("got"),
                     F.sum(F.when(r < float(cap), F.col("n") * F.col("size") * x * r).otherwise(0.0)).alias("slope")))
        gap = F.col("got") - F.col("target")
        j = (lam.join(sums, "sid").withColumn("lo", F.when(gap <= 0, F.col("lam")).otherwise(F.col("lo")))
             .withColumn("hi", F.when(gap >= 0, F.col("lam")).otherwise(F.col("hi"))))
        step = F.col("lam") - gap / F.when(F.col("slope") > 0, F.col("slope"))
        reach = F.abs("lam") + 4.0
        mid = F.greatest(F.least((F.col("lo") + F.col("hi")) / 2, F.col("lam") + reach), F.col("lam") - reach)
        good = (step > F.col("lo")) & (step < F.col("hi")) & (F.abs(gap) <= F.col("last") / 2)
        done = ((F.abs(gap) <= NEAR * F.col("target"))
                | (F.col("hi") - F.col("lo") <= 1e-15 * (F.abs("lo") + F.abs("hi"))))
        lam = cut(j.select("sid", "target", "mean", F.when(done, F.col("lam")).when(good, step).otherwise(mid).alias("lam"),
                           "lo", "hi", F.abs(gap).alias("last"), done.alias("done")), "dual")
        if lam.where("not done").isEmpty():
            return lam.select("sid", "mean", "lam")
        lam = lam.drop("done")


def copies_of_cells(hist: DataFrame, lam: DataFrame, cap: int = MAX_COPIES) -> DataFrame:
    """Whole copies of every (sid, size) cell: ``(sid, size, n, copies)``.

    One fold per source over its distinct sizes, whose number is bounded by
    the longest document's words and not by the number of documents.
    """
    cells = (hist.where("size > 0").join(lam, "sid")
             .withColumn("r", _rate(F.col("lam"), F.col("size") / F.col("mean"), cap))
             .groupBy("sid").agg(F.sort_array(F.collect_list(F.struct("size", "n", "r")), asc=False).alias("c")))
    # Folded 256 cells at a time, so that the growing list is copied rarely.
    k = (f"greatest(cast(0 as bigint), least({int(cap)} * x.n, "
         "cast(round(x.n * x.r + s.carry / x.size) as bigint)))")
    fold = f"""
      aggregate(sequence(0, (size(c) - 1) div 256),
        named_struct('carry', cast(0.0 as double), 'k', cast(array() as array<bigint>)),
        (o, i) -> aggregate(slice(c, 256 * i + 1, 256),
          named_struct('carry', o.carry, 'k', cast(array() as array<bigint>)),
          (s, x) -> named_struct('carry', s.carry + (x.n * x.r - {k}) * x.size,
                                 'k', concat(s.k, array({k}))),
          s -> named_struct('carry', s.carry, 'k', concat(o.k, s.k))),
        o -> o.k)"""
    return (cells.select("sid", F.explode(F.arrays_zip("c", F.expr(fold).alias("k"))).alias("z"))
            .select("sid", F.col("z.c.size").alias("size"), F.col("z.c.n").alias("n"), F.col("z.k").alias("copies")))


def mix_rows(rows: DataFrame, seed: int = 7, weights: tuple[float, ...] = WEIGHTS,
             cap: int = MAX_COPIES) -> DataFrame:
    """``rows(rid, source, size)`` plus ``source_size``, ``target`` and ``copies``.

    ``rid`` is any value that tells rows apart (equal ones are interchangeable).
    """
    goals = cut(targets(rows, weights, cap)
                .withColumn("sid", F.xxhash64(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))), "goals")
    rows = rows.withColumn("sid", F.xxhash64(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))))
    hist = cut(rows.groupBy("sid", "size").agg(F.count(F.lit(1)).alias("n")), "hist")
    cells = copies_of_cells(hist, solve(hist, goals, cap), cap)
    # Rank inside buckets of a cell; bucket offsets make the ranks one order.
    total = goals.agg(F.sum("n_docs")).first()[0] or 0
    parts = int(max(64, total // RANK_ROWS))
    rows = (rows.withColumn("h", F.xxhash64("rid", F.lit(seed)))
            .withColumn("bucket", F.pmod("h", F.lit(parts)).cast("int")))
    upto = W.partitionBy("sid", "size").orderBy("bucket")
    buckets = (rows.groupBy("sid", "size", "bucket").agg(F.count(F.lit(1)).alias("m"))
               .withColumn("end", F.sum("m").over(upto)))
    # Of the cell's `copies`, bucket b gets what a fair running split gives it.
    share = F.expr("cast(floor(cast(copies as decimal(20,0)) * end / n) as bigint)"
                   " - cast(floor(cast(copies as decimal(20,0)) * (end - m) / n) as bigint)")
    buckets = buckets.join(cells, ["sid", "size"]).select("sid", "size", "bucket", "m", share.alias("k"))
    rank = F.row_number().over(W.partitionBy("sid", "size", "bucket").orderBy("h", "rid")) - 1
    out = rows.withColumn("rank", rank).join(buckets, ["sid", "size", "bucket"], "left")
    copies = F.expr("k div m") + F.when(F.col("rank") < F.col("k") % F.col("m"), 1).otherwise(0)
    return (out.withColumn("copies", F.coalesce(copies, F.lit(0)).cast("int"))
            .join(F.broadcast(goals.select("sid", "source_size", "target")) if _small(goals)
                  else goals.select("sid", "source_size", "target"), "sid")
            .select("rid", "source", "size", "source_size", "target", "copies"))


def _small(goals: DataFrame) -> bool:
    """At most 10,000 sources (about 300 kB): safe to broadcast."""
    return goals.limit(10_001).count() <= 10_000


def mix(documents: DataFrame, seed: int = 7) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (and copies)."""
    rows = cut(documents.select(F.struct("doc_id", F.xxhash64("text").alias("t")).alias("rid"), "source",
                                word_count(F.col("text")).alias("size")), "sizes")
    m = mix_rows(rows, seed)
    return m.select(F.col("rid.doc_id").alias("doc_id"), "size", "source_size", "target",
                    (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies", "source")


def apply(documents: DataFrame, seed: int = 7) -> DataFrame:
    """The mixed corpus: every document as many times as it is taken, with
    all its columns.  Rows equal in doc_id, source and text share their
    copies evenly, the first ones taking what is left over."""
    rid = F.struct("doc_id", F.xxhash64("text").alias("t"))
    m = mix_rows(cut(documents.select(rid.alias("rid"), "source", word_count(F.col("text")).alias("size")), "sizes"), seed)
    # The hash tells equal ids apart, so the join key is unique up to equal rows.
    key = F.xxhash64(F.col("rid.doc_id"), F.col("rid.t"), F.col("source"))
    got = m.groupBy(key.alias("__k")).agg(F.sum("copies").alias("__c"), F.count(F.lit(1)).alias("__n"))
    d = hide(documents, "doc_id", "text", "source").withColumn("__k", F.xxhash64("doc_id", F.xxhash64("text"), "source"))
    rank = F.row_number().over(W.partitionBy("__k").orderBy("__c")) - 1
    d = (d.join(got, "__k").withColumn("__i", rank)
         .withColumn("__t", F.expr("__c div __n") + F.when(F.expr("__i < __c % __n"), 1).otherwise(0)))
    d = d.where("__t > 0").withColumn("__r", F.explode(F.sequence(F.lit(1), F.col("__t").cast("int"))))
    return show(d, documents, "doc_id", "text", "source")

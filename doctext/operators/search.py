"""Term search (Q2-Q7): terms and postings of a text, filter queries, order,
paging and facets.  Matching and scores come from the stored index
(``index.py``).

There is no query language: a search is a list of terms plus filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import FACET_LIMIT
from ..session import written

TOKEN_RE = r"[^\p{L}\p{Nd}]+"


def terms_of(c) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(F.lower(x), TOKEN_RE), lambda t: t != "")


def postings(texts: DataFrame, key: str = "package_id", text: str = "text") -> DataFrame:
    """Q2: (term, key, tf).  The aggregate pre-combines per task, so a term
    present everywhere is counted locally before its rows move."""
    return (texts.select(key, F.explode(terms_of(text)).alias("term"))
                 .groupBy("term", key).agg(F.count("*").alias("tf")))


def filtered(matches: DataFrame, packages: DataFrame, condition: Column | None) -> DataFrame:
    """Q4: filter queries on package fields."""
    p = packages if condition is None else packages.filter(condition)
    return matches.join(p.select("package_id"), "package_id", "left_semi")


def ranked(scored: DataFrame, packages: DataFrame) -> DataFrame:
    """Q5, the default sort: relevance, then newest first, then id.  A reader
    with an order of its own (``page``, a join) drops this one from its plan."""
    return scored.join(packages.select("package_id", "metadata_modified"), "package_id").orderBy(*order_cols())


def order_cols():
    return [F.col("score").desc(), F.col("metadata_modified").desc(), F.col("package_id")]


def everything(packages: DataFrame) -> DataFrame:
    """Q3 without terms: every package matches, none scores."""
    return packages.select("package_id", "metadata_modified", F.lit(0).cast("long").alias("matched_terms"),
                           F.lit(0.0).alias("score"))


def page(ranked_df: DataFrame, start: int, rows: int, sort: list[Column] | None = None) -> DataFrame:
    """Q6: one page of the ranked list, in the default order or by ``sort``.
    ``orderBy().limit(start+rows)`` is a top-k (per-task heaps, one small
    merge), never a full sort; the rank is then numbered over at most
    start+rows rows.  For pages far down see ``page_at`` and ``page_after``."""
    order = sort or order_cols()
    top = ranked_df.orderBy(*order).limit(start + rows)
    w = Window.orderBy(*order)
    return top.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") > start)


#: Rows of one range of ``page_at``.
RANGE_ROWS = 100_000


def page_at(df: DataFrame, start: int, rows: int, sort: list[Column], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Q6 for any ``start``: the list is laid out in ranges of its order,
    written once; the ranges' row counts say which of them hold the page, and
    only those are read and sorted.  ``sort`` must order all rows (end with
    an id), and ``df`` should hold little beside its columns."""
    n = max(1, -(-df.count() // range_rows))
    laid = written(df.repartitionByRange(n, *sort).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = {r["_range"]: r["count"] for r in laid.groupBy("_range").count().collect()}   # one row a range
    hit, before, seen = [], None, 0
    for k in sorted(counts):
        if seen < start + rows and seen + counts[k] > start:
            hit.append(k)
            before = seen if before is None else before
        seen += counts[k]
    near = laid.where(F.col("_range").isin(hit)) if hit else laid.limit(0)
    rank = F.row_number().over(Window.orderBy(*sort)) + F.lit(before or 0)
    return (near.withColumn("rank", rank.cast("long")).where((F.col("rank") > start) & (F.col("rank") <= start + rows))
            .drop("_range"))


def page_after(df: DataFrame, order: list[tuple[str, bool]], last: tuple | None, rows: int) -> DataFrame:
    """Q6 by a cursor: the next ``rows`` rows after the row whose order values
    are ``last`` (None: from the start), a top-k however far down.  ``order``
    lists (column, descending) and ends with an id; its columns hold no nulls."""
    if last is not None:
        beyond, same = F.lit(False), F.lit(True)
        for (name, down), value in zip(order, last):
            beyond |= same & ((F.col(name) < F.lit(value)) if down else (F.col(name) > F.lit(value)))
            same &= F.col(name) == F.lit(value)
        df = df.where(beyond)
    return df.orderBy(*[F.col(c).desc() if down else F.col(c) for c, down in order]).limit(rows)


def count(matches: DataFrame) -> DataFrame:
    """Q6: total number of matches (before paging)."""
    return matches.agg(F.count("*").alias("count"))


def facets(matches: DataFrame, fields: DataFrame, mincount: int = 1,
           limit: int = FACET_LIMIT) -> DataFrame:
    """Q7: value counts per facet field over the whole match set.

    ``fields`` holds distinct (package_id, field, value) rows (several fields
    stacked, multi-valued fields exploded), so every field is counted by one
    aggregate.  ``limit`` < 0 means no limit; ties are broken by value."""
    f = fields.join(matches.select("package_id"), "package_id", "left_semi")
    counts = f.groupBy("field", "value").agg(F.count("*").alias("count")).filter(F.col("count") >= mincount)
    if limit is None or limit < 0:
        return counts
    w = Window.partitionBy("field").orderBy(F.col("count").desc(), F.col("value"))
    return counts.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= limit).drop("_r")

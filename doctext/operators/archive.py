"""Archive members and archive text.

Archives are given as a member table ``(archive_id, parent_id, seq, path,
text)``: ``parent_id`` names the archive an archive is nested in.  The tree
is resolved over the archive edge list, not the member rows; members are then
joined to their root once.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalise, strip_ws
from ..session import written
from .keys import near_keys
from .select import has_blacklisted_suffix


def archive_tree(members: DataFrame) -> DataFrame:
    """(archive_id, root_id, depth, place) for every archive reachable from a
    root.  ``place`` orders the archives of one root and depth by the ids on
    their paths from the root, so breadth-first order is (depth, place).

    Pointer doubling on numbers.  Down: every open archive knows its ancestor
    2^k above; a round takes that ancestor's ancestor, or its root and depth
    where those are known.  Each round closes some archives as long as one
    that has a root is open, so a round that closes none leaves only archives
    on or below a cycle; they go, like those whose parent is missing.  Back:
    after round k a place orders the last 2^k ids of a path; the next orders
    the pairs (place of the ancestor 2^k above, own place), within root and
    depth, where all paths are equally long.  Of several parents the smallest
    counts.
    """
    e = members.groupBy("archive_id").agg(F.min("parent_id").alias("p")).withColumnRenamed("archive_id", "a")
    closed = written(e.where("p is null").select("a", F.col("a").alias("root"), F.lit(0).alias("depth")), "tree")
    open_ = written(e.where("p is not null").select("a", "p", F.lit(1).alias("depth")), "tree")
    jumps, n = [], open_.count()
    while n:
        jumps.append(open_)
        ends = near_keys(closed, open_.select(F.col("p").alias("a")), "a").select(
            F.col("a").alias("p"), F.lit(None).cast("long").alias("pp"), "root", F.col("depth").alias("more"))
        on = open_.select(F.col("a").alias("p"), F.col("p").alias("pp"), F.lit(None).cast("long").alias("root"),
                          F.col("depth").alias("more"))
        step = written(open_.join(ends.unionByName(on), "p").select(
            "a", F.col("pp").alias("p"), "root", (F.col("depth") + F.col("more")).alias("depth")), "tree")
        closed = closed.unionByName(step.where("p is null").drop("p"))
        open_ = step.where("p is not null").drop("root")
        left = open_.count()
        if left == n:
            break
        n = left
    tree = closed.select(F.col("a").alias("archive_id"), F.col("root").alias("root_id"), "depth", F.col("a").alias("place"))
    deepest = tree.agg(F.max("depth")).first()[0] or 0
    for k, jump in enumerate(jumps):
        if 1 << k > deepest:
            break
        tree = written(tree, "tree")
        high = jump.select(F.col("a").alias("archive_id"), F.col("p").alias("high"))
        over = tree.select(F.col("archive_id").alias("high"), F.col("place").alias("front"))
        w = Window.partitionBy("root_id", "depth").orderBy(F.col("front").asc_nulls_first(), "place")
        tree = tree.join(high.join(over, "high"), "archive_id", "left").select(
            "archive_id", "root_id", "depth", F.rank().over(w).cast("long").alias("place"))
    return tree


def archive_members(members: DataFrame, blacklist: Iterable[str] = (), roots: DataFrame | None = None) -> DataFrame:
    """Every file of a root archive and of the archives nested in it,
    breadth first; files whose name ends with a blacklisted suffix and
    directory entries are left out.  With ``roots(root_id)`` only theirs."""
    tree = archive_tree(members)
    m = members.filter(~F.col("path").endswith("/")) \
               .filter(~has_blacklisted_suffix("path", blacklist))
    if roots is not None:
        tree = written(tree.join(roots, "root_id", "left_semi"), "tree")
        m = near_keys(m, tree, "archive_id")
    return m.join(tree, "archive_id").select("root_id", "depth", "place", "archive_id", "seq",
                                             "path", "text")


def member_text(c, path) -> F.Column:
    """Text of one member as the extractor returns it: stripped, then
    normalised (a ``.csv`` member by the CSV rule)."""
    t = strip_ws(c)
    return F.when(F.lower(path).endswith(".csv"), normalise(t, is_csv=True)).otherwise(normalise(t))


def archive_text(members: DataFrame, blacklist: Iterable[str] = (), roots: DataFrame | None = None) -> DataFrame:
    """Per root archive, the member paths each followed by a newline,
    then the member texts joined by newlines; members with empty text are
    left out.

    Two-level aggregation: each nested archive first folds its own members
    into a (paths, texts) pair, then the root joins the pairs in breadth
    first order, so a root with very many members is pre-aggregated per
    nested archive before its final group.
    """
    m = archive_members(members, blacklist, roots).withColumn("t", member_text("text", "path")) \
                                          .filter(F.length("t") > 0)
    per_archive = m.groupBy("root_id", "archive_id", "depth", "place").agg(
        F.array_sort(F.collect_list(F.struct("seq", "path", "t"))).alias("ms"))
    per_archive = per_archive.select(
        "root_id", "depth", "place",
        F.array_join(F.transform("ms", lambda x: F.concat(x["path"], F.lit("\n"))), "").alias("paths"),
        F.array_join(F.transform("ms", lambda x: x["t"]), "\n").alias("texts"))
    roots = per_archive.groupBy("root_id").agg(
        F.array_sort(F.collect_list(F.struct("depth", "place", "paths", "texts"))).alias("parts"))
    return roots.select(
        F.col("root_id").alias("archive_id"),
        F.concat(F.array_join(F.transform("parts", lambda p: p["paths"]), ""),
                 F.array_join(F.transform("parts", lambda p: p["texts"]), "\n")).alias("text"))


def archive_member(members: DataFrame, requests: DataFrame) -> DataFrame:
    """One named member per request ``(archive_id, path)``; ``found``
    is false (the reference raises) when the archive has no such file."""
    m = members.select("archive_id", "path", "text", F.lit(True).alias("found"))
    return requests.join(m, ["archive_id", "path"], "left") \
                   .select("archive_id", "path", "text",
                           F.coalesce("found", F.lit(False)).alias("found"))

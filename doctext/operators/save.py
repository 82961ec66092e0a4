"""Q12: create or update packages that carry texts inside their resources.

What comes in is nested: a package with its resources, some with a text.  Texts
are lifted out by position, the package is stored without them, and the texts
are merged into the text table; the answer is the stored package, with the
texts put back for readers with rights and without hidden fields for others.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .state import merge_actions, FT_COLS
from .texttable import TextTable
from .visibility import hide_extras_list, hide_main


def lift(sent: DataFrame) -> DataFrame:
    """``(package_id, position, resource_id, text)`` of every resource sent,
    '' where it has no text."""
    return sent.select("package_id", F.posexplode("resources").alias("position", "r")).select(
        "package_id", F.col("position").cast("long").alias("position"), F.col("r.id").alias("resource_id"),
        F.coalesce("r.fulltext", F.lit("")).alias("text"))


def without_texts(sent: DataFrame) -> DataFrame:
    """The packages as they are stored."""
    return sent.withColumn("resources", F.transform("resources", lambda r: r.dropFields("fulltext")))


@dataclass
class Saved:
    packages: DataFrame      # stored, without texts
    rows: DataFrame          # text rows written for them, with position
    table: TextTable         # all texts


def save_packages(sent: DataFrame, table: TextTable, path: str) -> Saved:
    """Both tables written: the packages under ``path``, their texts into the
    touched buckets of ``table``.  ``sent`` holds whole packages (package_id,
    state, resources, ...): resources that are not listed lose their text."""
    spark, sent = sent.sparkSession, written(sent, "sent")
    without_texts(sent).write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    lifted = lift(sent)
    # A package without resources still empties its rows.
    buckets = table.touched(stored)
    old = table.read(buckets)
    none = stored.where("size(resources) = 0").select("package_id", F.lit(None).cast("string").alias("resource_id"),
                                                      F.lit(None).cast("string").alias("text"))
    acts = written(merge_actions(old, lifted.select("package_id", "resource_id", "text").unionByName(none), stored)
                   .where("resource_id is not null"), "saved")
    table.replace(acts.where("action in ('keep', 'update', 'insert')").select(*FT_COLS), buckets, apart=True)
    # Dealt once for the distinct rows and for their positions.
    rows = (acts.where("action in ('update', 'insert')").select("package_id", "resource_id", "text")
            .repartition("package_id", "resource_id").distinct())
    return Saved(stored, rows.join(lifted.select("package_id", "resource_id", "position"), ["package_id", "resource_id"]), table)


def answer_full(saved: Saved) -> DataFrame:
    """The stored packages with the new texts in their resources, by position."""
    texts = saved.rows.groupBy("package_id").agg(F.map_from_entries(F.collect_list(F.struct("position", "text"))).alias("by"))
    put = F.transform("resources", lambda r, i: r.withField("fulltext", F.try_element_at(F.col("by"), i.cast("long"))))
    return saved.packages.join(texts, "package_id", "left").withColumn(
        "resources", F.when(F.col("by").isNotNull(), put).otherwise(
            F.transform("resources", lambda r: r.withField("fulltext", F.lit(None).cast("string"))))).drop("by")


def answer_reduced(saved: Saved, hidden_extras: Iterable[str], hidden_main: Iterable[str]) -> DataFrame:
    """The stored packages without hidden extras and main fields, no texts."""
    p = saved.packages
    if "extras" in p.columns:
        p = p.withColumn("extras", hide_extras_list("extras", hidden_extras))
    return hide_main(p, hidden_main)

"""Incremental ingest (B6, B7) with Structured Streaming.

The re-run-every-ten-minutes loop becomes a file-source stream: new text
files land in a folder, each micro-batch collapses duplicate arrivals of a
resource (B7), decides the outcome (W6) of every resource that arrived and of
those still unprocessed, and writes what it decided to a folder of its own,
named by the batch.  A repeated batch overwrites its folder with the same rows.

The table is the initial rows with the last decision on every resource, found
by one aggregate on read.  A batch says nothing about resources it does not
hold, so a package may be split over any number of files and triggers; rows go
only by an explicit mark, which is ``deleted`` on a resource, or ``complete``
packages given at the end of a delivery.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import split_by_keys
from ..operators.state import FT_COLS, empty_to_unavailable, new_row_id
from ..operators.texttable import TextTable
from ..schema import UNPROCESSED
from ..session import written

DECIDED = "package_id string, resource_id string, text string, text_clear string, deleted boolean, batch long"
#: ``decide(arrivals)``: rows (package_id, resource_id, text) to the same rows
#: with the text to be stored, and text_clear.
Decide = Callable[[DataFrame], DataFrame]


def latest_per_resource(batch: DataFrame, order: str = "version") -> DataFrame:
    """One row per resource in a batch, the latest arrival wins (ties
    broken by text so a replay picks the same row).  The winner is a partial
    aggregate, so a resource with very many arrivals is no hot group."""
    rest = [c for c in batch.columns if c not in ("resource_id", order, "text")]
    best = F.max(F.struct(F.col(order), F.col("text"), *rest)).alias("_b")
    return batch.groupBy("resource_id").agg(best).select(
        *[F.col("resource_id") if c == "resource_id" else F.col(f"_b.{c}").alias(c) for c in batch.columns])


def saved_as_sent(arrivals: DataFrame) -> DataFrame:
    """The plain decision: the text that arrived (W2 for a blank one)."""
    return arrivals.select("package_id", "resource_id", empty_to_unavailable("text").alias("text"),
                           F.lit(None).cast("string").alias("text_clear"))


def decisions(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """The last decision on every resource, of batches below ``before``."""
    try:
        rows = spark.read.schema(DECIDED).parquet(f"{root.rstrip('/')}/decided")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], DECIDED)
    if before is not None:
        rows = rows.where(F.col("batch") < before)
    last = rows.groupBy("package_id", "resource_id").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["package_id", "resource_id", "batch"], "left_semi")


def table_after(initial: DataFrame, decided: DataFrame) -> DataFrame:
    """The text table: every row of a decided resource takes its text, one is
    inserted where there is none, and marked ones go.  Rows of other resources
    are not moved."""
    near, away = split_by_keys(initial.select(*FT_COLS), decided, "resource_id")
    d = decided.select("package_id", "resource_id", F.col("text").alias("d_text"), F.col("text_clear").alias("d_clear"),
                       "deleted", F.lit(True).alias("is_decided"))
    j = near.join(d, ["package_id", "resource_id"], "full_outer")
    came = F.coalesce("is_decided", F.lit(False))
    rows = j.where(~(came & F.coalesce("deleted", F.lit(False)))).select(
        F.coalesce("id", new_row_id("resource_id")).alias("id"), "resource_id", "package_id",
        F.when(came, F.col("d_text")).otherwise(F.col("text")).alias("text"),
        F.when(came, F.col("d_clear")).otherwise(F.col("text_clear")).alias("text_clear"))
    return rows.unionByName(away)


def marked(rows: DataFrame) -> DataFrame:
    """Rows whose text only says whether they are unprocessed."""
    return rows.withColumn("text", F.when(F.col("text") == UNPROCESSED, F.lit(UNPROCESSED))) \
               .withColumn("text_clear", F.lit(None).cast("string"))


def batch_writer(spark: SparkSession, root: str, initial: DataFrame, prepare: Callable[[DataFrame], DataFrame],
                 decide: Decide, fetch: DataFrame | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch body.  ``prepare`` gives rows (package_id, resource_id,
    text, version[, deleted]).  With ``fetch(resource_id, raw)`` the resources
    that are unprocessed in the table so far are decided too, from there."""
    def run(batch: DataFrame, batch_id: int) -> None:
        incoming = prepare(batch)
        if "deleted" not in incoming.columns:
            incoming = incoming.withColumn("deleted", F.lit(False))
        new = written(latest_per_resource(incoming.select("package_id", "resource_id", "text", "version", "deleted")), "arrived")
        todo = new.where("not deleted").select("package_id", "resource_id", "text")
        if fetch is not None:
            now = table_after(marked(initial), marked(decisions(spark, root, batch_id)))
            waiting = now.where(F.col("text") == UNPROCESSED).select("package_id", "resource_id").distinct()
            waiting = waiting.join(new.select("resource_id"), "resource_id", "left_anti")
            texts = fetch.select("resource_id", F.col("raw").alias("text"))
            todo = written(todo.unionByName(waiting.join(texts, "resource_id", "left").select(todo.columns)), "todo")
        rows = decide(todo).select("package_id", "resource_id", "text", "text_clear", F.lit(False).alias("deleted"))
        gone = new.where("deleted").select("package_id", "resource_id", F.lit(None).cast("string").alias("text"),
                                           F.lit(None).cast("string").alias("text_clear"), "deleted")
        rows.unionByName(gone).write.mode("overwrite").parquet(f"{root.rstrip('/')}/decided/batch={batch_id}")
    return run


def stream_ingest(spark: SparkSession, source: DataFrame, initial: DataFrame, packages: DataFrame,
                  prepare: Callable[[DataFrame], DataFrame], root: str,
                  complete: DataFrame | None = None, decide: Decide = saved_as_sent,
                  fetch: DataFrame | None = None, trigger: dict | None = None) -> DataFrame:
    """Run the stream and return the table.  By default it takes all that
    is available now and ends; ``trigger={"processingTime": "10 minutes"}``
    goes on until the query is stopped.  ``root`` is a folder that all
    executors share; a later call with the same root goes on where the last
    one ended (also with no new files).

    ``complete(package_id)`` names packages whose delivery is whole: rows of
    theirs that never arrived go, and so do the rows of deleted packages that
    were delivered.  Without it nothing is inferred from absence.
    """
    q = (source.writeStream
               .foreachBatch(batch_writer(spark, root, initial, prepare, decide, fetch))
               .option("checkpointLocation", f"{root.rstrip('/')}/stream")
               .trigger(**(trigger or {"availableNow": True}))
               .start())
    q.awaitTermination()
    decided = decisions(spark, root)
    rows = table_after(initial, decided)
    if complete is not None:
        gone = packages.where(F.col("state") == "deleted").select("package_id").distinct()
        whole = complete.select("package_id").distinct()
        kept = rows.join(whole, "package_id", "left_anti")
        listed = (rows.join(decided, ["package_id", "resource_id"], "left_semi")
                  .join(whole, "package_id", "left_semi").join(gone, "package_id", "left_anti"))
        rows = kept.unionByName(listed.select(kept.columns))
    return rows.select(*FT_COLS)


def fold(table: TextTable, root: str) -> list[int]:
    """All decisions so far put into the stored table, its touched buckets
    only.  Decisions that are folded in twice change nothing."""
    decided = decisions(table.spark, root)
    buckets = table.touched(decided)
    table.replace(table_after(table.read(buckets), decided), buckets)
    return buckets

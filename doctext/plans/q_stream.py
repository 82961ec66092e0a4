"""Registered queries: streaming ingest (B6) and latest arrival.

The stream's file source is the documents table itself; the incoming
texts are derived inside each micro-batch exactly as the batch view does,
so the final table must equal the batch merge (same oracle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.index import text_bytes
from ..schema import INPUT_SCHEMAS
from ..session import scratch_path
from ..sources.views import VIEW_SQL
from ..streaming.ingest import fold, latest_per_resource, stream_ingest
from . import pipeline as pl
from .params import SETTINGS as S
from .q_pipeline import _outcome_sql, stored_table
from .q_state import MERGE_SQL
from .registry import query


def _source(c):
    return (c.spark.readStream.schema(INPUT_SCHEMAS["documents"])
                 .option("basePath", c.sf_dir)
                 .parquet(f"{c.sf_dir}/documents[.]parquet"))


def _incoming(batch):
    inc = batch.sparkSession.sql(VIEW_SQL["incoming"], documents=batch)
    return inc.withColumn("version", F.lit(1))


STREAM_SQL = f"""
WITH m AS ({MERGE_SQL})
SELECT id, resource_id, package_id, text, text_clear FROM m WHERE action IN ('keep', 'update', 'insert')"""


@query("stream_ingest", STREAM_SQL)
def stream_ingest_q(c):
    return stream_ingest(c.spark, _source(c), c.fulltext, c.package, _incoming,
                         scratch_path(c.spark, "ingest"), c.incoming.select("package_id"))


#: Text bytes of one file of a delivery, which one task writes.
FILE_BYTES = 64 << 20


def _files(c):
    """The documents in four deliveries that split every package, one a batch,
    each of as many files as its texts take."""
    files = scratch_path(c.spark, "ingest-files")
    d = c.raw("documents").withColumn("part", F.col("doc_id") % 4)
    n = max(1, -(-text_bytes(d) // (4 * FILE_BYTES)))
    for part in range(4):
        rows = d.where(F.col("part").eqNullSafe(part) | (F.col("part").isNull() if part == 0 else F.lit(False)))
        rows.repartition(n).write.mode("append").partitionBy("part").parquet(files)
    return (c.spark.readStream.schema(INPUT_SCHEMAS["documents"]).option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", n).parquet(files))


@query("stream_ingest_split", STREAM_SQL)
def stream_ingest_split(c):
    """The same delivery in files that split every package: the four
    resources of a package lie in four deliveries, read one a batch."""
    return stream_ingest(c.spark, _files(c), c.fulltext, c.package, _incoming,
                         scratch_path(c.spark, "ingest"), c.incoming.select("package_id"))


INC_TEXT = r"CASE WHEN regexp_matches(coalesce(i.text, ''), '^\s*$') THEN 'NOT_AVAILABLE' ELSE i.text END"

# Outcomes of what arrived (incoming texts) and of what was unprocessed
# (fetched texts); every row of such a resource takes it.
OUTCOME_SQL = _outcome_sql("SELECT package_id FROM package").replace(
    "SELECT concat('r', doc_id) AS resource_id, text FROM documents WHERE true", """
SELECT concat('r', x.doc_id) AS resource_id, CASE WHEN i.resource_id IS NOT NULL THEN i.text ELSE x.text END AS text
FROM documents x LEFT JOIN incoming i ON i.resource_id = concat('r', x.doc_id)""") + """,
decided AS (
  SELECT * FROM outcome WHERE resource_id IN (SELECT resource_id FROM incoming)
     OR resource_id IN (SELECT resource_id FROM fulltext WHERE text = 'UNPROCESSED_FULLTEXT'))
SELECT f.id, f.resource_id, f.package_id, CASE WHEN d.resource_id IS NOT NULL THEN d.text ELSE f.text END AS text,
  CASE WHEN d.resource_id IS NOT NULL THEN NULL ELSE f.text_clear END AS text_clear
FROM fulltext f LEFT JOIN decided d ON d.resource_id = f.resource_id
UNION ALL
SELECT concat(resource_id, '-new'), resource_id, package_id, text, NULL FROM decided
WHERE resource_id NOT IN (SELECT resource_id FROM fulltext)"""


@query("stream_outcomes", OUTCOME_SQL)
def stream_outcomes(c):
    """B6 with W6: each trigger decides what arrived and what is still
    unprocessed, joined to the catalogue as it stands."""
    def decide(todo):
        res = c.resource.join(todo.select("resource_id"), "resource_id", "left_semi")
        return pl.outcome(res, c.package, c.harvest, todo.select("resource_id", F.col("text").alias("raw")), c.members, S)

    return stream_ingest(c.spark, _files(c), c.fulltext, c.package, _incoming, scratch_path(c.spark, "ingest"),
                         decide=decide, fetch=pl.fetched_texts(c.raw("documents")))


@query("stream_folded", f"""
SELECT f.id, f.resource_id, f.package_id, CASE WHEN i.resource_id IS NOT NULL THEN {INC_TEXT} ELSE f.text END AS text,
  CASE WHEN i.resource_id IS NOT NULL THEN NULL ELSE f.text_clear END AS text_clear
FROM fulltext f LEFT JOIN incoming i ON i.resource_id = f.resource_id
UNION ALL
SELECT concat(i.resource_id, '-new'), i.resource_id, i.package_id, {INC_TEXT}, NULL FROM incoming i
WHERE i.resource_id NOT IN (SELECT resource_id FROM fulltext)""")
def stream_folded(c):
    """B6 folded into the stored table (nothing goes without a mark)."""
    root = scratch_path(c.spark, "ingest")
    stream_ingest(c.spark, _source(c), c.fulltext, c.package, _incoming, root)
    table = stored_table(c)
    fold(table, root)
    return table.read()


@query("stream_latest", """
SELECT concat('r', doc_id) AS resource_id, CASE WHEN doc_id % 9 = 0 THEN concat(text, ' v2') ELSE text END AS text,
  CASE WHEN doc_id % 9 = 0 THEN 2 ELSE 1 END AS version
FROM documents""")
def stream_latest(c):
    """A second arrival (version 2) of every ninth document in the same
    micro-batch replaces the first."""
    src = _source(c)
    first = src.select(F.concat(F.lit("r"), "doc_id").alias("resource_id"), "text", F.lit(1).alias("version"))
    again = src.filter(F.col("doc_id") % 9 == 0).select(
        F.concat(F.lit("r"), "doc_id").alias("resource_id"),
        F.concat("text", F.lit(" v2")).alias("text"), F.lit(2).alias("version"))
    out = scratch_path(c.spark, "arrivals")

    def run(batch, batch_id):
        latest_per_resource(batch).write.mode("overwrite").parquet(f"{out}/b{batch_id:08d}")

    q = (first.unionByName(again).writeStream.foreachBatch(run)
              .option("checkpointLocation", scratch_path(c.spark, "arrivals-stream"))
              .trigger(availableNow=True).start())
    q.awaitTermination()
    return (c.spark.read.schema("resource_id string, text string, version int")
                 .option("recursiveFileLookup", "true").parquet(out))

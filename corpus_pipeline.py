"""The corpus pipeline: documents to packed training sequences.

``STAGES`` lists the stages in order; each takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes to the shared folder and reads back
for the next one.  All but the last return the columns of ``documents``:

1. quality: documents that the line field rejects go (nulls in other columns
   and repeated rows stay as they are; empty texts are scored like any other);
2. simhash: one document of each near-duplicate group stays;
3. substring: words of 50-word windows that an earlier document has go;
4. mixing: sources are brought to their target weights by repeating or
   leaving out whole documents;
5. packing: one row per piece of a sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from doctext.llm import mixing, packing, quality, simhash, substring
from doctext.llm.common import cut, prepare


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    field = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, field)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.keep_first(docs, shingle=3, radius=2)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return substring.deduplicate(docs, window=50)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.apply(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(docs, length=1024)


STAGES = [
    ("quality", quality_stage),
    ("simhash", simhash_stage),
    ("substring", substring_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: A fitted classifier and a tokeniser are in it, so no SQL can express it;
#: tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

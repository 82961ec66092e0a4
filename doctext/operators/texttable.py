"""The stored text table, written where a run changed it.

Rows lie in Parquet partitions by a bucket of their package.  A run reads the
buckets of the packages it processed, and dynamic partition overwrite replaces
those partitions; the files of all others stay as they are.  What replaces them
is written to the shared folder first, so a run that dies before or during the
replacement is repeated with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written
from .state import FT_COLS, apply_outcome

STORED = "id string, resource_id string, package_id string, text string, text_clear string, bucket int"


class TextTable:
    """``buckets`` should leave some hundred megabytes to a bucket; it is a
    property of the table, given at every use."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("package_id"), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame) -> None:
        # Ranges split a package with very many rows over several files.
        (rows.repartitionByRange("bucket", "package_id", "resource_id").sortWithinPartitions("bucket", "package_id", "resource_id")
         .write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket").parquet(self.path))

    def create(self, rows: DataFrame) -> None:
        self._write(rows.select(*FT_COLS, self.bucket().alias("bucket")))

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        df = self.spark.read.schema(STORED).parquet(self.path).where("id is not null")
        return (df if buckets is None else df.where(F.col("bucket").isin(buckets))).select(*FT_COLS)

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of ``rows``: at most as many as the table has."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def replace(self, rows: DataFrame, buckets: list[int], apart: bool = False) -> None:
        """``rows`` become the whole contents of ``buckets``.  A row of nulls
        stands in every bucket, so one that is left empty is written too.
        ``apart``: the rows are read from a written frame, not from the table."""
        if not buckets:
            return
        marks = self.spark.range(1).select(
            *[F.lit(None).cast("string").alias(c) for c in FT_COLS], F.explode(F.array(*map(F.lit, buckets))).alias("bucket"))
        rows = rows.select(*FT_COLS, self.bucket().alias("bucket")).unionByName(marks)
        self._write(rows if apart else written(rows, "replaced", "zstd"))

    def after(self, outcome: DataFrame, buckets: list[int]) -> DataFrame:
        """What ``buckets`` will hold with the outcome of a run written back
        (``state.apply_outcome``), written apart; the table is as it was."""
        return written(apply_outcome(self.read(buckets), outcome), "replaced", "zstd")

    def apply(self, outcome: DataFrame) -> list[int]:
        """The outcome of a run written back; the buckets that were replaced."""
        buckets = self.touched(outcome)
        self.replace(self.after(outcome, buckets), buckets, apart=True)
        return buckets

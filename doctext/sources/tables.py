"""Reading the driver tables and building the catalogue views."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import INPUT_SCHEMAS, FULLTEXT_SCHEMA
from .views import VIEW_INPUTS, VIEW_SQL


class Catalog:
    """Lazy DataFrames over one data folder.

    Nothing is read until an action runs; each property is a plan that
    Catalyst prunes to the columns and rows the final query needs.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    # -- driver tables -----------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in INPUT_SCHEMAS:
            reader = reader.schema(INPUT_SCHEMAS[name])
        return reader.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        frames = {t: self.raw(t) for t in VIEW_INPUTS[name]}
        return self.spark.sql(VIEW_SQL[name], **frames)

    # -- views -------------------------------------------------------------
    @cached_property
    def package(self) -> DataFrame:
        return self.view("package")

    @cached_property
    def resource(self) -> DataFrame:
        return self.view("resource")

    @cached_property
    def fulltext(self) -> DataFrame:
        df = self.view("fulltext")
        return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in FULLTEXT_SCHEMA])

    @cached_property
    def incoming(self) -> DataFrame:
        return self.view("incoming")

    @cached_property
    def harvest(self) -> DataFrame:
        return self.view("harvest")

    @cached_property
    def members(self) -> DataFrame:
        return self.view("members")

    @cached_property
    def attempts(self) -> DataFrame:
        return self.view("attempts")

    def spread(self, df: DataFrame, key: str) -> DataFrame:
        """A text table of fewer files than there are cores, hash-spread over
        them; one with many files is read as it lies."""
        cores = self.spark.sparkContext.defaultParallelism
        return df if len(df.inputFiles()) >= cores else df.repartition(cores, key)

    @cached_property
    def documents(self) -> DataFrame:
        return self.spread(self.raw("documents"), "doc_id")

    @cached_property
    def pages(self) -> DataFrame:
        return self.spread(self.raw("pages"), "page_id")

"""Registry of named queries: a Spark builder and, where one exists, the
equivalent DuckDB SQL used as the correctness oracle."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import Catalog
from ..sources.views import with_views


@dataclass
class Entry:
    name: str
    build: Callable[[Catalog], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, oracle: str | None = None, extra_ctes: dict[str, str] | None = None):
    """Register ``fn(catalog) -> DataFrame`` under ``name``."""
    def deco(fn):
        sql = with_views(oracle, extra_ctes) if oracle is not None else None
        REGISTRY[name] = Entry(name, fn, sql)
        return fn
    return deco


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    entry = REGISTRY[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return entry.build(Catalog(spark, sf_dir))
    run.__name__ = name
    return run

"""Joins and nested assembly: texts onto resources (J1-J3), harvest
lookups (J4, J5) and the cleaning eligibility (J10, W10)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import truncate
from .select import in_list
from .state import dedupe_resource


def attach_fulltext(resources: DataFrame, ft: DataFrame,
                    format_blacklist: Iterable[str] = (), limit: int = 0,
                    package_blacklist: Iterable[str] = ()) -> DataFrame:
    """The text of every resource, one row per resource.

    Resources of blacklisted packages get no row.  A resource whose format
    (lower-cased, exact) is blacklisted, or which has no text row, gets
    ``('', '')``.  With ``limit > 0`` both texts are cut to ``limit``
    characters before they leave the scan side of the join.  Duplicate text
    rows of a resource are reduced first (W4) so the join is one-to-one.
    """
    fmts = [f.lower() for f in format_blacklist]
    res = resources.filter(~in_list("package_id", package_blacklist))
    texts = dedupe_resource(ft).select(
        "resource_id", "package_id", F.lit(True).alias("_row"),
        truncate("text", limit).alias("t"), truncate("text_clear", limit).alias("tc"))
    j = res.join(texts, ["package_id", "resource_id"], "left")
    empty = in_list(F.lower(F.col("format")), fmts) | F.col("_row").isNull()
    return j.select(
        "package_id", "resource_id", "position",
        F.when(empty, F.lit("")).otherwise(F.col("t")).alias("text"),
        F.when(empty, F.lit("")).otherwise(F.col("tc")).alias("text_clear"))


def nest_resources(packages: DataFrame, resources: DataFrame,
                   texts: DataFrame | None = None) -> DataFrame:
    """Packages with their resources as an array of structs in position
    order; with ``texts`` (J1 output) each resource carries fulltext and
    fulltext_clear.  The grouping key is the package: a package's resource
    list is one value of the output row."""
    r = resources
    fields = [F.col("position"), F.col("resource_id").alias("id"), F.col("url"),
              F.col("name"), F.col("format"), F.col("file_size")]
    if texts is not None:
        r = r.join(texts.select("resource_id", F.col("text").alias("fulltext"),
                                F.col("text_clear").alias("fulltext_clear")),
                   "resource_id", "left")
        fields += [F.col("fulltext"), F.col("fulltext_clear")]
    nested = (r.groupBy("package_id")
                .agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("resources")))
    return packages.join(nested, "package_id", "left")


def strip_fulltext(packages: DataFrame) -> DataFrame:
    """Drop the text fields from every nested resource."""
    return packages.withColumn(
        "resources",
        F.transform("resources", lambda r: r.dropFields("fulltext", "fulltext_clear")))


def explode_resources(packages: DataFrame, keep: Iterable[str] = ("package_id",)) -> DataFrame:
    """Flat view of a nested package frame: one row per resource."""
    return packages.select(*keep, F.explode("resources").alias("r")).select(*keep, "r.*")


def harvest_guid(harvest: DataFrame) -> DataFrame:
    """The guid of a package's harvest object when exactly one is
    current and COMPLETE, else NULL."""
    ok = harvest.filter(F.col("current") & (F.col("state") == "COMPLETE"))
    g = ok.groupBy("package_id").agg(F.count("*").alias("n"), F.min("guid").alias("g"))
    return g.select("package_id", F.when(F.col("n") == 1, F.col("g")).alias("guid"))


def harvest_source(harvest: DataFrame) -> DataFrame:
    """The source title of the first current harvest object (ordered by
    guid, then title, so the choice is deterministic)."""
    cur = harvest.filter(F.col("current"))
    return cur.groupBy("package_id").agg(
        F.min_by("source_title", F.struct("guid", "source_title")).alias("source_title"))


def clean_eligible(resources: DataFrame, harvest: DataFrame,
                   clean_sources: Iterable[str]) -> DataFrame:
    """J10 + W10: a resource is cleaned when its package's harvest source is
    listed and its URL ends with rar, zip or pdf."""
    src = harvest_source(harvest)
    r = resources.join(src, "package_id", "left")
    url = F.lower(F.col("url"))
    by_url = url.endswith("rar") | url.endswith("zip") | url.endswith("pdf")
    by_source = F.coalesce(in_list("source_title", clean_sources), F.lit(False))
    return r.select("package_id", "resource_id", by_source.alias("source_listed"),
                    by_url.alias("url_cleanable"), (by_source & by_url).alias("clean"))

"""Selections, predicates and counts over the text state table."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ERROR_PHRASES, UNAVAILABLE, UNPROCESSED
from ..functions.text import _col


def all_package_ids(ft: DataFrame) -> DataFrame:
    """Distinct package ids of the table."""
    return ft.select("package_id").distinct()


def packages_with_text(ft: DataFrame, text: str) -> DataFrame:
    """Packages having a row whose text equals ``text`` (no trim)."""
    return ft.filter(F.col("text") == text).select("package_id").distinct()


def packages_with_any_text(ft: DataFrame, texts: Iterable[str]) -> DataFrame:
    """Packages having a row whose space-trimmed text is in ``texts``."""
    return ft.filter(F.trim("text").isin(list(texts))).select("package_id").distinct()


def packages_with_error(ft: DataFrame) -> DataFrame:
    """Packages in error (any of the error phrases, UNPROCESSED included)."""
    return packages_with_any_text(ft, ERROR_PHRASES)


def packages_min_size(ft: DataFrame, n: int) -> DataFrame:
    """P5: packages with a text strictly longer than ``n`` characters."""
    return ft.filter(F.length("text") > n).select("package_id").distinct()


def first_fulltext(ft: DataFrame) -> DataFrame:
    """One row per resource, the one with the smallest id.

    ``min_by`` is an ordinary aggregate, so each task pre-aggregates before
    the shuffle and a resource with many rows never lands whole in one task.
    """
    cols = [c for c in ft.columns if c != "resource_id"]
    row = F.min_by(F.struct(*cols), F.col("id"))
    return (ft.groupBy("resource_id").agg(row.alias("r"))
              .select("resource_id", *[F.col(f"r.{c}").alias(c) for c in cols]))


def fulltexts_of_resource(ft: DataFrame, resource_id: str) -> DataFrame:
    """All rows of one resource (pushed down to the scan)."""
    return ft.filter(F.col("resource_id") == resource_id)


def _count_packages(ft: DataFrame, texts: Iterable[str]) -> DataFrame:
    return (ft.filter(F.col("text").isin(list(texts)))
              .agg(F.count_distinct("package_id").alias("n")))


def error_count(ft: DataFrame) -> DataFrame:
    """Number of packages in error, exact (untrimmed) comparison."""
    return _count_packages(ft, ERROR_PHRASES)


def unprocessed_count(ft: DataFrame) -> DataFrame:
    """P9."""
    return _count_packages(ft, [UNPROCESSED])


def unavailable_count(ft: DataFrame) -> DataFrame:
    """P10."""
    return _count_packages(ft, [UNAVAILABLE])


def packages_modified_since(packages: DataFrame, min_date: str | None = None) -> DataFrame:
    """All package ids, or those modified strictly after ``min_date``."""
    df = packages
    if min_date is not None:
        df = df.filter(F.col("metadata_modified") > F.lit(min_date).cast("timestamp_ntz"))
    return df.select("package_id")


def work_selection(ft: DataFrame, force_all: bool = False, retry: bool = True,
                   max_size: int | None = None, dedupe: bool = False) -> DataFrame:
    """The packages to (re)process.

    force_all -> every package; retry -> packages in error; otherwise the
    unprocessed ones.  With ``max_size`` the packages holding a longer text
    are appended (UNION ALL: a package may appear twice unless ``dedupe``).
    """
    if force_all:
        ids = all_package_ids(ft)
    elif retry:
        ids = packages_with_error(ft)
    else:
        ids = packages_with_text(ft, UNPROCESSED)
    if max_size:
        ids = ids.unionAll(packages_min_size(ft, max_size))
    return ids.distinct() if dedupe else ids


def work_selection_capped(ft: DataFrame, max_chars: int = 0, force_all: bool = False,
                          retry: bool = True, package_id: str | None = None) -> DataFrame:
    """Run-mode choice: one id, or the selection with the length cap
    ``max(max_chars, len('UNPROCESSED_FULLTEXT'))``."""
    if package_id is not None:
        return all_package_ids(ft.where(F.col("package_id") == package_id))
    cap = max(max_chars, len(UNPROCESSED))
    return work_selection(ft, force_all=force_all, retry=retry, max_size=cap)


def clean_all_ids(ft: DataFrame) -> DataFrame:
    """P14."""
    return ft.select("resource_id")


def clean_pending_ids(ft: DataFrame) -> DataFrame:
    """Resources whose cleaned text is still missing."""
    return ft.filter(F.col("text_clear").isNull()).select("resource_id")


def clean_one(ft: DataFrame, resource_id: str) -> DataFrame:
    """P16."""
    return ft.filter(F.col("resource_id") == resource_id).select("resource_id")


def is_archive_url(c) -> F.Column:
    """The URL mentions .zip or .rar (any case)."""
    x = F.lower(_col(c))
    return x.contains(".zip") | x.contains(".rar")


def is_archive_name(c) -> F.Column:
    """The name ends with zip or rar (no dot needed, any case)."""
    x = F.lower(_col(c))
    return x.endswith("zip") | x.endswith("rar")


def has_blacklisted_suffix(c, suffixes: Iterable[str]) -> F.Column:
    """The lower-cased URL ends with one of the suffixes."""
    sfx = list(suffixes)
    if not sfx:
        return F.lit(False)
    arr = F.array(*[F.lit(s) for s in sfx])
    x = F.lower(_col(c))
    return F.exists(arr, lambda s: x.endswith(s))


def in_list(c, values: Iterable[str]) -> F.Column:
    """P20: membership in a short fixed list (a package blacklist)."""
    vals = list(values)
    return _col(c).isin(vals) if vals else F.lit(False)


def is_oversize(size, max_size: int) -> F.Column:
    """Size larger than the maximum; an unreadable size is not."""
    x = F.col(size) if isinstance(size, str) else size
    return F.coalesce(x.try_cast("bigint") > max_size, F.lit(False))

"""Visibility projection (V2-V7): what a reader without rights may see."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import _col


def _arr(values: Iterable[str]) -> Column:
    vals = list(values)
    return F.array(*[F.lit(v) for v in vals]) if vals else F.array().cast("array<string>")


def hide_extras_map(m, hidden: Iterable[str], named: str | None = None) -> Column:
    """V2: drop hidden keys from map-form extras.  With ``named`` present in
    the map, only that key is dropped."""
    h = _arr(hidden)
    all_hidden = F.map_filter(_col(m), lambda k, v: ~F.array_contains(h, k))
    if named is None:
        return all_hidden
    return F.when(F.map_contains_key(_col(m), F.lit(named)),
                  F.map_filter(_col(m), lambda k, v: k != F.lit(named))).otherwise(all_hidden)


def hide_extras_list(lst, hidden: Iterable[str], named: str | None = None) -> Column:
    """V3: drop hidden keys from list-form extras ``array<struct<key,value>>``.
    With ``named``, only its first occurrence goes (when there is one)."""
    h = _arr(hidden)
    x = _col(lst)
    all_hidden = F.filter(x, lambda e: ~F.array_contains(h, e["key"]))
    if named is None:
        return all_hidden
    idx = F.array_position(F.transform(x, lambda e: e["key"]), F.lit(named))
    first_only = F.filter(x, lambda e, i: i + 1 != idx)
    return F.when(idx > 0, first_only).otherwise(all_hidden)


def hide_main(df: DataFrame, hidden: Iterable[str]) -> DataFrame:
    """V4: drop hidden top-level fields."""
    return df.drop(*[c for c in hidden if c in df.columns])


def extra_value(lst, key: str) -> Column:
    """V5: value of ``key`` in list-form extras, NULL when absent."""
    hit = F.filter(_col(lst), lambda e: e["key"] == F.lit(key))
    return F.try_element_at(hit, F.lit(1))["value"]


def extras_to_list(m, complex_fields: dict[str, Column] | None = None) -> Column:
    """V6: map-form extras to list form; non-scalar values (given as
    columns) are JSON-encoded, non-ASCII kept as is."""
    base = F.transform(F.map_entries(_col(m)),
                       lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    extra = [F.struct(F.lit(k).alias("key"), F.to_json(v).alias("value"))
             for k, v in (complex_fields or {}).items()]
    return F.concat(base, F.array(*extra)) if extra else base


def names_to_structs(c) -> Column:
    """V7: tag / group names to ``{name}`` structs."""
    return F.transform(_col(c), lambda x: F.struct(x.alias("name")))

"""Filtering a wide table by a set of keys without moving the table.

The keys are hashed into a bitmap of a fixed number of bits, kept as rows of
(word number, 64 bits).  Its size is bounded by the number of bits, whatever
the number of keys, so it may be broadcast; rows whose bit is not set are
certainly outside the set and stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2^23 bits are at most 131,072 rows of 16 bytes.
BITS = 23


def _place(key: str | Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << bits))


def key_bits(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """The bitmap of ``keys[key]``: (word, mask), bounded by ``bits``."""
    h = keys.select(_place(key, bits).alias("h"))
    return (h.groupBy(F.shiftright("h", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63L as int))")).alias("mask")))


def split_by_keys(df: DataFrame, keys: DataFrame, key: str, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """``(near, away)``: rows that may have one of the keys, and rows that
    certainly have none.  Neither is shuffled."""
    return split_by_bits(df, key_bits(keys, key, bits), key, bits)


def split_by_bits(df: DataFrame, bitmap: DataFrame, key: str, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """``split_by_keys`` by a bitmap that is there already (``key_bits``)."""
    words = F.broadcast(bitmap).select(F.col("word").alias("_word"), F.col("mask").alias("_mask"))
    h = _place(key, bits)
    marked = (df.withColumn("_h", h).join(words, F.expr("shiftright(_h, 6) = _word"), "left")
              .withColumn("_near", F.expr("coalesce(_mask & shiftleft(1L, cast(_h & 63L as int)), 0L) <> 0")))
    return (marked.where("_near").select(*df.columns), marked.where("not _near").select(*df.columns))


def near_keys(df: DataFrame, keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """The rows of ``df`` that may have one of the keys; to be joined with
    them exactly afterwards."""
    return split_by_keys(df, keys, key, bits)[0]

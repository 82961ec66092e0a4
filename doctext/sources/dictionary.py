"""S3: word lists for the repair."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip_ws


def load_word_files(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """One or more line files (one word per line), stripped of all white space
    at both ends, lower-cased,
    merged and de-duplicated."""
    lines = spark.read.text(list(paths))
    w = F.lower(strip_ws("value"))
    return lines.select(w.alias("word")).filter(F.col("word") != "").distinct()


def words_from_texts(texts: DataFrame, col: str = "text") -> DataFrame:
    """A word list made of the letters-only words (two or more letters) of
    a text column."""
    w = F.explode(F.split(F.lower(F.col(col)), r"[^\p{L}]+")).alias("word")
    return texts.select(w).filter(F.length("word") >= 2).distinct()


def dictionary_from_words(spark: SparkSession, words: Iterable[str]) -> DataFrame:
    """A word list from an explicit Python list (tests, small lists)."""
    rows = sorted({w.strip().lower() for w in words if w and w.strip()})
    return spark.createDataFrame([(w,) for w in rows], "word string")

"""Stored inverted index (Q2) with signed maintenance.

Three Parquet tables under one folder, each partitioned by the batch that
wrote it:

* ``postings`` (term, package_id, tf), further partitioned by a bucket of the
  term and sorted by term, so a search reads only its terms' buckets and, in
  them, only row groups that hold its terms;
* ``lengths`` (package_id, dl): tokens of a package;
* ``stats`` (n_docs, n_terms, buckets): one row a batch.

Batch 0 is the build.  A later batch holds differences: minus the terms of the
old text of every resource that changed, plus those of the new.  Readers add
the rows of a key up, so appending a batch is all that maintenance does, and a
repeated batch overwrites itself.  ``compact`` folds the batches into one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.packs import packs_udf
from ..session import ship, written
from .keys import key_bits, near_keys, split_by_bits, split_by_keys
from .search import postings, terms_of
from .state import FT_COLS, dedupe_winners, is_sentinel, merge_rows

POSTINGS = "term string, package_id string, tf long, batch int, bucket int"
LENGTHS = "package_id string, dl long, batch int"
STATS = "n_docs long, n_terms long, buckets int, batch int"
#: Text bytes of one term bucket, and the bounds of the number of buckets.
BUCKET_BYTES, FEWEST, MOST = 256 << 20, 8, 4096
#: Text bytes and postings of one task: both fit its memory without a spill.
TASK_BYTES, TASK_POSTINGS = 16 << 20, 2 << 20
#: Tokens whose postings one task adds up.
TASK_TERMS = 2 << 20


def term_bucket(term: str | Column, buckets: int) -> Column:
    return (F.crc32(F.col(term).cast("binary") if isinstance(term, str) else term.cast("binary")) % buckets).cast("int")


def buckets_of(terms: Iterable[str], buckets: int) -> list[int]:
    """The buckets of a search's terms, known before the plan is made."""
    return sorted({zlib.crc32(t.encode()) % buckets for t in terms})


class SearchIndex:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        s = self._read("stats", STATS).agg(F.sum("n_docs"), F.sum("n_terms"), F.max("buckets"), F.max("batch")).first()
        self.n_docs, self.n_terms, self.buckets, self.last = s

    def _read(self, table: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")

    # -- writing -------------------------------------------------------------
    @classmethod
    def build(cls, texts: DataFrame, root: str, buckets: int | None = None, size: int | None = None) -> SearchIndex:
        """Batch 0, from ``texts(package_id, text)``; ``size``: about how many
        bytes they have, where that is known."""
        spark, root = texts.sparkSession, root.rstrip("/")
        size = text_bytes(texts) if size is None else size
        if buckets is None:
            buckets = min(MOST, max(FEWEST, size // BUCKET_BYTES))
        _write_postings(postings(texts), root, 0, buckets, _parts(size, buckets))
        post = spark.read.schema(POSTINGS).parquet(f"{root}/postings").where("batch = 0")
        lengths = post.groupBy("package_id").agg(F.sum("tf").alias("dl"))
        _write(lengths, f"{root}/lengths/batch=0")
        stats = spark.read.schema("package_id string, dl long").parquet(f"{root}/lengths/batch=0").agg(
            F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum("dl"), F.lit(0)).cast("long").alias("n_terms"))
        _write(stats.withColumn("buckets", F.lit(int(buckets))), f"{root}/stats/batch=0")
        return cls(spark, root)

    def apply(self, changes: DataFrame, batch: int) -> SearchIndex:
        """Batch ``batch`` > 0 from ``changes(package_id, old_text, new_text)``
        (null: no text).  Batches are applied in order; applying the last one
        again gives the same index."""
        sides = F.explode(F.array(F.struct(F.col("old_text").alias("text"), F.lit(-1).alias("n")),
                                  F.struct(F.col("new_text").alias("text"), F.lit(1).alias("n"))))
        return self.add(changes.select("package_id", sides.alias("x")).select("package_id", "x.text", "x.n"), batch)

    def add(self, texts: DataFrame, batch: int, size: int | None = None) -> SearchIndex:
        """Batch ``batch`` > 0 from ``texts(package_id, text, n)``: the terms of
        a text count ``n`` times, below 0 they are taken off.  Texts that are
        dealt by package stay there, and what cancels out goes no further.
        ``size``: about how many bytes they have, where that is known."""
        assert batch > 0
        terms = texts.select("package_id", "n", F.explode(terms_of(F.coalesce("text", F.lit("")))).alias("term"))
        delta = terms.groupBy("term", "package_id").agg(F.sum("n").alias("tf")).where("tf <> 0")
        _write_postings(delta, self.root, batch, self.buckets, None if size is None else _parts(size, self.buckets))
        post = self._read("postings", POSTINGS).where(F.col("batch") == batch)
        moved = written(post.groupBy("package_id").agg(F.sum("tf").alias("by")), "lengths")
        before = (self._read("lengths", LENGTHS).where(F.col("batch") < batch)
                  .join(moved.select("package_id"), "package_id", "left_semi").groupBy("package_id").agg(F.sum("dl").alias("dl")))
        both = moved.join(before, "package_id", "left").select(F.col("by"), F.coalesce("dl", F.lit(0)).alias("dl"))
        stats = both.agg(
            F.coalesce(F.sum((F.col("dl") + F.col("by") > 0).cast("long") - (F.col("dl") > 0).cast("long")), F.lit(0))
            .cast("long").alias("n_docs"), F.coalesce(F.sum("by"), F.lit(0)).cast("long").alias("n_terms"))
        _write(stats.withColumn("buckets", F.lit(int(self.buckets))), f"{self.root}/stats/batch={batch}")
        _write(moved.select("package_id", F.col("by").alias("dl")), f"{self.root}/lengths/batch={batch}")
        return SearchIndex(self.spark, self.root)

    def compact(self, root: str) -> SearchIndex:
        """The same index as one batch in a new folder."""
        _write_postings(self.postings(), root.rstrip("/"), 0, self.buckets, dealt=False)
        _write(self.lengths(), f"{root}/lengths/batch=0")
        _write(self.spark.range(1).select(F.lit(self.n_docs).cast("long").alias("n_docs"), F.lit(self.n_terms).cast("long").alias("n_terms"),
                                          F.lit(int(self.buckets)).alias("buckets")), f"{root}/stats/batch=0")
        return SearchIndex(self.spark, root)

    # -- reading -------------------------------------------------------------
    def rows(self, terms: Iterable[str] | None = None) -> DataFrame:
        """Signed postings, of some terms only: their buckets are partitions
        and the terms are pushed into the scan."""
        df = self._read("postings", POSTINGS)
        if terms is None:
            return df
        ts = sorted(set(terms))
        return df.where(F.col("bucket").isin(buckets_of(ts, self.buckets)) & F.col("term").isin(ts))

    def postings(self, terms: Iterable[str] | None = None) -> DataFrame:
        """Q2: (term, package_id, tf).  The build has one row a key; rows of
        packages that no later batch has touched are answers as they are."""
        rows = self.rows(terms).select("term", "package_id", "tf", "bucket", "batch")
        first = rows.where("batch = 0 and tf > 0")
        if not self.last:
            return first.select("term", "package_id", "tf")
        touched = self._read("lengths", LENGTHS).where("batch > 0").select("package_id")
        near, away = split_by_keys(first, touched, "package_id")
        packs = packed(near.unionByName(rows.where("batch > 0")))
        tasks = max(self.spark.sparkContext.defaultParallelism, (self.n_terms or 0) // TASK_TERMS)
        added = (unpacked(packs.repartition(tasks, "package_id")).groupBy("term", "package_id")
                 .agg(F.sum("tf").cast("long").alias("tf")).where("tf > 0"))
        return away.select("term", "package_id", "tf").unionByName(added)

    def lengths(self) -> DataFrame:
        return (self._read("lengths", LENGTHS).groupBy("package_id").agg(F.sum("dl").cast("long").alias("dl")).where("dl > 0"))

    def _counted(self, terms: Iterable[str], min_match: int | None) -> tuple[DataFrame, list[Column]]:
        """Packages that match, with a count column for every term."""
        ts = sorted({t.lower() for t in terms})
        need = len(ts) if min_match is None else min_match
        per = self.rows(ts).groupBy("package_id").agg(*[
            F.sum(F.when(F.col("term") == t, F.col("tf")).otherwise(0)).alias(f"tf_{i}") for i, t in enumerate(ts)])
        tfs = [F.col(f"tf_{i}") for i in range(len(ts))]
        matched = sum(((c > 0).cast("long") for c in tfs), F.lit(0).cast("long"))
        return per.withColumn("matched_terms", matched).where(F.col("matched_terms") >= max(need, 1)), tfs

    def match(self, terms: Iterable[str], min_match: int | None = None) -> DataFrame:
        """Q3: packages matching all terms, or at least ``min_match``."""
        per, tfs = self._counted(terms, min_match)
        return per.select("package_id", "matched_terms", sum(tfs, F.lit(0)).cast("long").alias("tf"))

    def bm25(self, terms: Iterable[str], min_match: int | None = None, k1: float = 1.2, b: float = 0.75) -> DataFrame:
        """Q3 + Q5: matches with their unrounded BM25 score.  The collection
        statistics are the stored row; document frequencies are one row over
        the terms' postings."""
        per, tfs = self._counted(terms, 1)
        need = len(tfs) if min_match is None else min_match
        df_row = per.agg(*[F.sum((c > 0).cast("long")).alias(f"df_{i}") for i, c in enumerate(tfs)])
        m = (per.where(F.col("matched_terms") >= need).join(self.lengths(), "package_id")
             .join(F.broadcast(df_row), how="cross"))     # one row
        avgdl = (self.n_terms or 0) / max(self.n_docs or 0, 1)
        score = F.lit(0.0)
        for i, c in enumerate(tfs):
            df = F.col(f"df_{i}")
            idf = F.log(1 + (self.n_docs - df + 0.5) / (df + 0.5))
            part = idf * c * (k1 + 1) / (c + k1 * (1 - b + b * F.col("dl") / avgdl))
            score = score + F.when(c > 0, part).otherwise(F.lit(0.0))
        return m.select("package_id", "matched_terms", sum(tfs, F.lit(0)).cast("long").alias("tf"), score.alias("score"))


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def text_bytes(texts: DataFrame) -> int:
    return texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def tasks_of(spark: SparkSession, size: int) -> int:
    """In how many tasks so many bytes of text are dealt."""
    return max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))


def _parts(size: int, buckets: int) -> int:
    return max(1, -(-size // (buckets * TASK_BYTES)))


def packed(post: DataFrame) -> DataFrame:
    """Postings (with their bucket) for a shuffle: those of a package in a
    bucket as one row, where they lie.  By themselves each would travel with a
    package id and fields of fixed width."""
    ship(post.sparkSession)
    return post.select("package_id", "bucket", "term", F.col("tf").cast("long").alias("tf")).mapInArrow(
        packs_udf(["package_id", "bucket", "terms", "tfs"]), "package_id string, bucket int, terms string, tfs array<long>")


def gathered(post: DataFrame) -> DataFrame:
    """``packed`` for postings that are dealt by package: those of a package
    and bucket are gathered where they lie."""
    rows = post.groupBy("package_id", "bucket").agg(F.collect_list(F.struct("term", F.col("tf").cast("long").alias("tf"))).alias("l"))
    return rows.select("package_id", "bucket", F.array_join(F.col("l.term"), " ").alias("terms"), F.col("l.tf").alias("tfs"))


def unpacked(pack: DataFrame) -> DataFrame:
    both = F.arrays_zip(F.split("terms", " ").alias("term"), F.col("tfs").alias("tf"))
    return pack.select("package_id", "bucket", F.explode(both).alias("x")).select("x.term", "package_id", "x.tf", "bucket")


def _write_postings(post: DataFrame, root: str, batch: int, buckets: int, parts: int | None = None, dealt: bool = True) -> None:
    """Sorted by bucket and term, a bucket in ``parts`` tasks and files by
    package, so that a term that very many packages hold is split.  If the
    number is not known, the rows are written packed as they are made and
    counted.  ``dealt``: the rows are dealt by package."""
    pack = (gathered if dealt else packed)(post.withColumn("bucket", term_bucket("term", buckets)))
    if parts is None:
        pack = written(pack, "postings", "zstd")
        n = pack.agg(F.sum(F.size("tfs"))).first()[0] or 0
        parts = max(1, -(-n // (buckets * TASK_POSTINGS)))
    place = F.col("bucket") * parts + F.pmod(F.xxhash64("package_id"), F.lit(parts)).cast("int")
    rows = unpacked(pack.repartitionById(buckets * parts, place))
    (rows.sortWithinPartitions("bucket", "term", "package_id")
     .write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(f"{root}/postings/batch={batch}"))


def listed_texts(ft: DataFrame, resources: DataFrame, size: int) -> DataFrame:
    """``(package_id, text)``: the kept row (W4) of every listed resource (as
    often as it is listed), dealt by package.

    Which rows those are is decided on narrow columns; their keys and the
    texts then meet in one exchange by package, in as many tasks as ``size``
    bytes of text take, and what is grouped by package next stays there."""
    kept = dedupe_winners(ft).withColumnRenamed("id", "kept_id").where("kept_id is not null")
    keys = resources.groupBy("package_id", "resource_id").agg(F.count(F.lit(1)).alias("times")).where(
        "package_id is not null").join(kept, "resource_id").select(
        "package_id", "resource_id", F.col("kept_id").alias("id"), F.lit(None).cast("string").alias("text"), "times")
    both = ft.select("package_id", "resource_id", "id", "text", F.lit(None).cast("long").alias("times")).unionByName(keys)
    own = Window.partitionBy("package_id", "resource_id", "id")
    return (both.repartition(tasks_of(ft.sparkSession, size), "package_id")
            .withColumn("listed", F.max("times").over(own)).where("listed is not null and times is null")
            .select("package_id", "text", F.explode(F.expr("array_repeat(true, cast(listed as int))")).alias("_one"))
            .drop("_one"))


def shown_keys(ft: DataFrame, resources: DataFrame) -> DataFrame:
    """``(package_id, resource_id, id)`` of the rows a search may find: the kept
    row (W4) of every listed resource; a resource without one has no text."""
    kept = dedupe_winners(ft).where("resource_id is not null and id is not null")
    listed = resources.select("package_id", "resource_id").where("package_id is not null").distinct()
    return listed.join(kept, "resource_id").select("package_id", "resource_id", "id")


def text_differences(old: DataFrame, old_keys: DataFrame, new: DataFrame, new_keys: DataFrame, size: int) -> DataFrame:
    """``(package_id, text, n)``, dealt by package: what two states of the text
    table differ by, for ``SearchIndex.add``.

    The rows that the keys name (``shown_keys`` of each state) count: an old
    text is taken off for every new row of its resource, a new one added for
    every old row, once if there is none.  Equal texts are dropped before they
    are tokenised.  Keys and texts meet in one exchange by package."""
    def side(n: int, texts: DataFrame, keys: DataFrame) -> DataFrame:
        rows = texts.select("package_id", "resource_id", "id", "text", F.lit(n).alias("side"), F.lit(None).cast("boolean").alias("mark"))
        return rows.unionByName(keys.select("package_id", "resource_id", "id", F.lit(None).cast("string").alias("text"),
                                            F.lit(n).alias("side"), F.lit(True).alias("mark")))

    both = side(-1, old, old_keys).unionByName(side(1, new, new_keys))
    row = Window.partitionBy("package_id", "resource_id", "side", "id")
    resource = Window.partitionBy("package_id", "resource_id")
    count = lambda n: F.sum((F.col("side") == n).cast("int")).over(resource)
    rows = (both.repartition(tasks_of(old.sparkSession, size), "package_id")
            .withColumn("named", F.max("mark").over(row)).where("named and mark is null")
            .select("package_id", "text", "side", count(-1).alias("olds"), count(1).alias("news"),
                    F.count("text").over(resource).alias("texts"), F.min("text").over(resource).alias("least"), F.max("text").over(resource).alias("most")))
    same = (F.col("olds") > 0) & (F.col("news") > 0) & (F.col("texts") == F.col("olds") + F.col("news")) & (F.col("least") == F.col("most"))
    other = F.when(F.col("side") < 0, F.col("news")).otherwise(F.col("olds"))
    return rows.where(~F.coalesce(same, F.lit(False))).select(
        "package_id", "text", (F.col("side") * F.greatest(other, F.lit(1))).alias("n"))


def merge_and_index(index: SearchIndex, table: DataFrame, incoming: DataFrame, packages: DataFrame,
                    listed: DataFrame, batch: int) -> tuple[DataFrame, SearchIndex]:
    """W3 with Q1: a batch merged into the text table and its differences
    appended to the index.  What the batch does is decided once and written
    (the rows it updates or inserts); the rows of other packages stay where
    they are, and an old text moves only to be taken off the index.
    ``listed`` are the resources that searches may find."""
    spark = table.sparkSession
    ids = written(incoming.select("package_id").distinct(), "ids")
    bits = written(key_bits(ids, "package_id"), "bits")
    near, away = split_by_bits(table.select(*FT_COLS), bits, "package_id")
    rows = written(merge_rows(near.select("id", "resource_id", "package_id"), incoming, packages,
                              tasks_of(spark, text_bytes(incoming))), "merged", "zstd")
    # Rows whose hash meets a package of the batch by chance.
    others = near.select("package_id").where("package_id is not null").distinct().join(ids, "package_id", "left_anti")
    met = near_keys(near, others, "package_id").join(others, "package_id", "left_semi").select(*FT_COLS)
    met = written(met.unionByName(near.where("package_id is null")), "met", "zstd")

    mine = listed.select("package_id", "resource_id").join(ids, "package_id", "left_semi")
    # Which row is kept asks for the sentinels among the old texts only.
    brief = F.when(F.col("text").isNull() | is_sentinel("text"), F.col("text")).otherwise("").alias("text")
    before = near.select("resource_id", "id", "package_id", brief).join(ids, "package_id", "left_semi")
    new = rows.where("package_id is not null")
    size = text_bytes(near) + text_bytes(new)
    index = index.add(text_differences(near, shown_keys(before, mine), new, shown_keys(new, mine), size), batch, size)
    return away.unionByName(met).unionByName(rows), index

"""Uniform shuffle into shards by a hypergeometric communication matrix
(DataFrame only).

Rows fall into blocks by a hash.  The number of rows every block sends to
every shard is drawn exactly (sequential multivariate hypergeometric draws
whose margins are the block counts and the shard sizes), each block permutes
its rows and deals them out by those counts, and each shard permutes what it
received.  The result is a uniform random assignment with exact shard sizes.

Defined results: a null text has size 1 (no bytes, plus 1) and the checksum of
no bytes; repeated rows are separate rows; an empty table gives an empty
result; extra columns are ignored by the query and may be kept by callers who
join on the row key.  Reruns with one seed agree, because the blocks and both
permutations depend on row contents and the seed only (equal rows are
interchangeable).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

#: Rows of one block (first permutation) and of one slot range (second one),
#: up to so many blocks; beyond that blocks grow, which the driver's matrix does not.
BLOCK_ROWS, MAX_BLOCKS = 4096, 1 << 16


def shard_sizes(total: int, shards: int) -> np.ndarray:
    """Sizes at most one apart."""
    return np.array([total // shards + (s < total % shards) for s in range(shards)], dtype=np.int64)


def communication_matrix(counts: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """Exact rows-to-shard counts per block: row sums ``counts``, column sums
    ``sizes``, distributed as in a uniform shuffle."""
    rng = np.random.default_rng(seed)
    left, out = sizes.copy(), np.zeros((len(counts), len(sizes)), dtype=np.int64)
    for i, n in enumerate(counts):
        out[i] = rng.multivariate_hypergeometric(left, n, method="marginals")
        left -= out[i]
    return out


def uniform_shards(rows: DataFrame, shards: int = 8, seed: int = 11,
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` plus ``shard`` (0 to shards-1) and ``slot`` (gapless from 0).

    ``rows`` is read three times, so hand in a narrow written table.  The
    driver holds one count per block and shard, for 65,536 blocks at most.
    """
    spark, cols = rows.sparkSession, rows.columns
    total = rows.count()
    blocks = min(MAX_BLOCKS, max(1, -(-total // block_rows)))
    keyed = rows.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("r"))
    # Equal rows are numbered, or one hash would send them all the same way.
    same = F.row_number().over(W.partitionBy("h0").orderBy("r"))
    keyed = (keyed.select("r", F.xxhash64("r", F.lit(seed)).alias("h0"))
             .select("r", F.xxhash64("h0", same).alias("h")))
    keyed = keyed.withColumn("b", F.pmod(F.xxhash64("h", F.lit("block")), F.lit(blocks)).cast("int"))
    counts = np.zeros(blocks, dtype=np.int64)
    for b, n in keyed.groupBy("b").agg(F.count(F.lit(1))).collect():
        counts[b] = n
    matrix = communication_matrix(counts, shard_sizes(total, shards), seed)
    ends = np.cumsum(matrix, axis=1)
    plan = spark.createDataFrame([(b, [int(x) for x in ends[b]]) for b in range(blocks) if counts[b]] or [],
                                 "b int, ends array<bigint>")
    # First permutation, inside the block; the first ends[0] rows go to shard 0 and so on.
    rank = F.row_number().over(W.partitionBy("b").orderBy(F.xxhash64("h", F.lit("deal")), "h"))
    dealt = (keyed.withColumn("rank", rank).join(plan, "b")
             .withColumn("shard", F.size(F.filter("ends", lambda e: e < F.col("rank"))).cast("int")))
    dealt = cut(dealt.select("r", "h", "b", "shard"), "dealt")
    # Second permutation, inside the shard: a random slot range, then a random order in it.
    ranges = min(MAX_BLOCKS, max(1, -(-total // (shards * block_rows))))
    dealt = dealt.withColumn("o", F.xxhash64("h", "b", F.lit("slot")))
    dealt = dealt.withColumn("q", F.pmod(F.xxhash64("o", F.lit(seed)), F.lit(ranges)).cast("int"))
    # `shards * ranges` rows: eight bytes for every few thousand rows of input.
    sums = W.partitionBy("shard").orderBy("q").rowsBetween(W.unboundedPreceding, -1)
    starts = (dealt.groupBy("shard", "q").agg(F.count(F.lit(1)).alias("n"))
              .select("shard", "q", F.coalesce(F.sum("n").over(sums), F.lit(0)).alias("start")))
    place = F.row_number().over(W.partitionBy("shard", "q").orderBy("o", "h")) - 1
    return (dealt.withColumn("place", place).join(starts, ["shard", "q"])
            .select("r.*", "shard", (F.col("start") + F.col("place")).cast("long").alias("slot")))


def shard_documents(documents: DataFrame, shards: int = 8, seed: int = 11) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = cut(documents.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                                F.crc32(text.cast("binary")).cast("long").alias("text_crc32")), "rows")
    return (uniform_shards(rows, shards, seed)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))

"""Operator 2: shards by jump consistent hashing.

The shard follows from the document id and the number of shards alone, with no
table of a ring: a linear congruential sequence seeded with the key names the
next shard count at which the key jumps, and the last jump below the count is
its shard.  When a shard is appended, a key stays or moves into the new shard.

Slots number the rows of a shard without gaps.  They are dealt in two steps, so
that no task holds a whole shard: rows are numbered within ``buckets`` buckets
of a shard, and each bucket starts where the counts of those before it end.

Defined results: a null text has size 1 (its end mark) and checksum 0; a null
id counts as key 0 and comes first; rows with one id share a shard and have
slots of their own, by checksum; an empty table gives no rows; further columns
of the input are not carried.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

MULTIPLIER = 2862933555777941757   # fixed value of the published generator
SHARDS = 16
BUCKETS = 64


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key, all keys at once."""
    if shards < 1:
        raise ValueError("shards must be positive")
    key = keys.astype(np.int64).view(np.uint64).copy()
    at = np.zeros(len(key), np.int64)
    jumps = np.zeros(len(key), np.int64)
    open_ = np.arange(len(key))
    while len(open_):
        at[open_] = jumps[open_]
        key[open_] = key[open_] * np.uint64(MULTIPLIER) + np.uint64(1)
        step = 2.0 ** 31 / ((key[open_] >> np.uint64(33)).astype(np.float64) + 1.0)
        jumps[open_] = ((at[open_] + 1) * step).astype(np.int64)
        open_ = open_[jumps[open_] < shards]
    return at


def jump_shard(key: str | Column, shards: int) -> Column:
    """Shard number of a long column as a Spark column."""

    @pandas_udf("int")
    def of(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.fillna(0).to_numpy(np.int64), shards).astype(np.int32))

    return of(F.coalesce(F.col(key) if isinstance(key, str) else key, F.lit(0)).cast("long"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, buckets: int = BUCKETS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row."""
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    rows = rows.select(
        "*", jump_shard("doc_id", shards).alias("shard"), jump_shard("doc_id", shards + 1).alias("grown_shard"),
        F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0)), "text_crc32"), F.lit(buckets)).cast("int").alias("bucket"))
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("shard").alias("s"), F.col("bucket").alias("b"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    # shards x buckets rows at most: a proven bound for the broadcast
    return (rows.withColumn("r", F.row_number().over(within) - 1)
            .join(F.broadcast(starts), (F.col("shard") == F.col("s")) & (F.col("bucket") == F.col("b")))
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("first") + F.col("r")).cast("long").alias("slot"), "grown_shard"))

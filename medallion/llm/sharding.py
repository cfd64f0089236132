"""Sharding by jump consistent hash.

A row's key (any type, as text; null counts as the empty text) is hashed with SHA-256
and the first 8 bytes walk the jump sequence: no ring table, and one more shard takes
rows only into itself, 1/(n+1) of them. A key always goes to one shard, so repeated
rows share a shard (that is the law, not skew that could be spread). Places inside a
shard are numbered without ever sorting a whole shard in one task: a shard is divided
into 4,096 buckets by the key's hash and the row's checksum, equal rows are counted
first, and the bucket sizes (at most 4,096 rows a shard) give each bucket's first place. Equal rows
are written out again in runs of at most 65,536 places, dealt over all tasks, so that no array
or task holds the copies of one row.

Empty tables give empty results; null texts have size 1 (0 bytes plus 1) and checksum 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm.common import col, read_table, stage

BUCKETS = 4096
RUN = 65_536


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key, for ``shards`` shards."""
    k = keys.astype(np.uint64)
    last = np.zeros(len(k), np.int64)
    following = np.zeros(len(k), np.float64)
    todo = np.arange(len(k))
    while todo.size:
        last[todo] = following[todo].astype(np.int64)
        k[todo] = k[todo] * np.uint64(2862933555777941757) + np.uint64(1)
        following[todo] = np.floor((last[todo] + 1) * (2.0**31 / ((k[todo] >> np.uint64(33)).astype(np.float64) + 1)))
        todo = todo[following[todo] < shards]
    return last


def key_digest(key: Column) -> Column:
    """First 8 bytes of the SHA-256 of the key's text, as 16 hex digits."""
    return F.substring(F.sha2(F.coalesce(key.cast("string"), F.lit("")).cast("binary"), 256), 1, 16)


def shard_of(key: Column, shards: int) -> Column:
    """Expression for the shard (0 to shards - 1) of a key column."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf("int")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            raw = np.frombuffer(b"".join(bytes(x) for x in s), ">u8") if len(s) else np.zeros(0, np.uint64)
            yield pd.Series(jump(raw, shards).astype(np.int32))

    return place(F.unhex(key_digest(key)))


def assign_shards(df: DataFrame, key: str, shards: int, out: str = "shard") -> DataFrame:
    """``df`` and the shard of each row; no shuffle."""
    return df.withColumn(out, shard_of(col(key), shards))


def number_places(df: DataFrame, shard: str, key: str, checksum: str, out: str = "slot") -> DataFrame:
    """Gapless places from 0 in each shard. Equal rows are interchangeable.

    Rows are ordered by bucket, then key hash, then all columns. ``checksum`` is an
    unsigned 32-bit column; its top bits divide the rows of one hot key.
    """
    names = df.columns
    counted = stage(
        df.groupBy(*[col(c) for c in names])
        .agg(F.count(F.lit(1)).alias("_m"))
        .withColumn("_h", key_digest(col(key)))
        .withColumn("_b", (F.conv(F.substring("_h", 1, 2), 16, 10).cast("int") * 16 + F.shiftright(col(checksum), 28)).cast("int")),
        "places",
    )
    sizes = counted.groupBy(col(shard), "_b").agg(F.sum("_m").alias("_n"))
    before = Window.partitionBy(col(shard)).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(col(shard).alias("_s"), F.col("_b").alias("_sb"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy(col(shard), "_b").orderBy("_h", *[col(c) for c in names]).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        counted.withColumn("_done", F.coalesce(F.sum("_m").over(inside), F.lit(0)))
        .join(firsts, (F.col("_s") == col(shard)) & (F.col("_sb") == F.col("_b")))
        .withColumn("_from", F.col("_first") + F.col("_done"))
        .withColumn("_upto", F.col("_from") + F.col("_m") - 1)
    )
    # a number of partitions that is asked for isn't coalesced by size: a run is one small row here, but many later
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = placed.withColumn("_at", F.explode(F.sequence("_from", "_upto", F.lit(RUN)))).repartition(tasks, col(shard), "_at")
    return runs.select(*[col(c) for c in names], F.explode(F.sequence(F.col("_at"), F.least(F.col("_at") + (RUN - 1), F.col("_upto")))).alias(out))


def op5_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    rows = assign_shards(assign_shards(rows, "doc_id", 16, "shard"), "doc_id", 17, "grown_shard")
    placed = number_places(rows, "shard", "doc_id", "text_crc32")
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")

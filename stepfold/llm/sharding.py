"""Sharding by extendible hashing, as DataFrame operations only.

A row's hash is 60 bits of the MD5 of its key. The directory starts with one
bucket; a bucket over the byte limit splits on its next hash bit, and only that
bucket, until every shard fits. Sizes of all prefixes of a round of bits come from
one aggregate; a prefix's bucket is the shortest one that fits. If some prefixes
still don't fit after a round, only their rows go on to the next bits.

Rows that share a whole hash (repeated keys) can't be told apart by it: such a
bucket is cut into pages in row order, from sizes summed by input partition, so no
task holds it whole. A row over the limit makes a shard of its own or
one that only such equal keys share. A null key hashes like an empty one, a null text has no
bytes. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stepfold.llm.common import checkpointed

HASH_BITS = 60
LEAST_BITS, MOST_BITS = 8, 20  # bits of a round: its directory has 2^20 rows at most


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the MD5 of a key as a long."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(depth) -> Column:
    return F.expr(f"shiftright(hash, {HASH_BITS} - {depth})")


def _directory(sizes: DataFrame, done: int, bits: int, limit: int) -> DataFrame:
    """(cell, depth) of every prefix of ``done + bits`` bits whose bucket fits at some depth over ``done``."""
    upto = done + bits
    least = 0 if not done else done + 1
    levels = (sizes.withColumn("depth", F.explode(F.sequence(F.lit(least), F.lit(upto))))
              .withColumn("prefix", F.expr(f"shiftright(cell, {upto} - depth)")))
    fits = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("total")).where(F.col("total") <= limit)
    return levels.join(fits, ["depth", "prefix"], "left_semi").groupBy("cell").agg(F.min("depth").alias("depth"))


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Cut buckets of rows with one hash into pages within the limit."""
    rows = checkpointed(rows.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()))
    before = W.partitionBy("hash").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = (rows.groupBy("hash", "_part").agg(F.sum("bytes").alias("s"))
             .select("hash", "_part", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("base")))
    largest = rows.groupBy("hash").agg(F.max("bytes").alias("largest"))
    running = F.sum("bytes").over(W.partitionBy("hash", "_part").orderBy("_row").rowsBetween(W.unboundedPreceding, -1))
    room = F.greatest(F.lit(1), F.lit(limit) - F.col("largest"))
    return (rows.withColumn("own", F.coalesce(running, F.lit(0))).join(parts, ["hash", "_part"]).join(largest, "hash")
            .withColumn("page", F.floor((F.col("base") + F.col("own")) / room).cast("long")).drop("_part", "_row", "own", "base", "largest"))


def shard(df: DataFrame, key_col: str, size: Column, limit: int) -> DataFrame:
    """``df`` with bytes, depth, prefix and page of each row's shard; the three name the shard."""
    rows = df.withColumns({"bytes": F.coalesce(size.cast("long"), F.lit(0).cast("long")), "hash": hash_bits(df[key_col])})
    narrow, done, parts = rows.select("hash", "bytes"), 0, []
    total = narrow.agg(F.sum("bytes")).first()[0]
    if total is None:
        total = 0
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, total) / limit + 1)) + 4))
    while done < HASH_BITS:
        bits = min(bits, HASH_BITS - done)
        sizes = checkpointed(rows.select(_prefix(done + bits).alias("cell"), "bytes").groupBy("cell").agg(F.sum("bytes").alias("bytes")))
        found = checkpointed(_directory(sizes, done, bits, limit))
        joined = rows.withColumn("cell", _prefix(done + bits)).join(F.broadcast(found) if not done else found, "cell", "left").drop("cell")
        parts.append(joined.where("depth is not null"))
        if not sizes.join(found, "cell", "left_anti").limit(1).count():
            break
        rows, done = joined.where("depth is null").drop("depth"), done + bits
    else:
        parts.append(_pages(rows, limit).withColumn("depth", F.lit(HASH_BITS)))
    out = None
    for part in parts:
        part = part.withColumns({"depth": F.col("depth").cast("int"), "prefix": F.expr(f"shiftright(hash, {HASH_BITS} - depth)"),
                                 "page": F.col("page") if "page" in part.columns else F.lit(0).cast("long")}).drop("hash")
        out = part if out is None else out.unionByName(part)
    return out


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard."""
    (sharded.repartition("depth", "prefix", "page").write.partitionBy("depth", "prefix", "page").mode("errorifexists").parquet(path))

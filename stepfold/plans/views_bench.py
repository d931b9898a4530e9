"""Test views for the collective/kernel benchmark jobs, from ``lineitem``/``part``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stepfold.plans.tables import table

LINEITEM_ORDER = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
WORLD = 8


def v_rank_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(op, bytes, dtype, repeat, rank, iter, latency_ms): per-rank, per-iteration latencies."""
    li = table(spark, sf_dir, "lineitem")
    op = (F.when(F.col("l_returnflag") == "A", F.lit("allreduce"))
          .when(F.col("l_returnflag") == "N", F.lit("allgather"))
          .otherwise(F.lit("reduce_scatter")))
    base = li.select(
        *LINEITEM_ORDER,
        op.alias("op"),
        (F.lit(1048576) * (1 + F.col("l_suppkey") % 3)).cast("long").alias("bytes"),
        F.lit("bfloat16").alias("dtype"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(2).cast("int").alias("repeat"),
        (F.col("l_partkey") % WORLD).cast("int").alias("rank"),
        (F.col("l_extendedprice") / 1000).alias("latency_ms"))
    w = Window.partitionBy("op", "bytes", "repeat", "rank").orderBy(*LINEITEM_ORDER)
    return base.select("op", "bytes", "dtype", "repeat", "rank",
                       (F.row_number().over(w) - 1).cast("int").alias("iter"), "latency_ms")


def v_hosts(spark: SparkSession) -> DataFrame:
    """rank -> host for ranks 0..6 (rank 7 unknown on purpose)."""
    return spark.range(7).select(F.col("id").cast("int").alias("rank"),
                                 F.concat(F.lit("node"), (F.col("id") / 4).cast("int").cast("string")).alias("host"))


def v_collective_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Communication-library trace lines, one for each lineitem row."""
    li = table(spark, sf_dir, "lineitem")
    opn = (F.when(F.col("l_returnflag") == "A", F.lit("AllReduce"))
           .when(F.col("l_returnflag") == "N", F.lit("AllGather")).otherwise(F.lit("ReduceScatter")))
    line = F.format_string(
        "node%d:%d:%d [%d] NCCL INFO %s: opCount %s sendbuff 0x7f7a78400000 recvbuff 0x7f8429000000 "
        "acc (nil) count %d datatype %d op %d root %d comm 0x5581 [nranks=8] stream 0x5582",
        F.col("l_suppkey") % 4, 80000 + F.col("l_partkey"), 86000 + F.col("l_linenumber"),
        (F.col("l_partkey") % 8).cast("int"), opn, F.lower(F.hex(F.col("l_orderkey"))),
        (F.col("l_quantity") * 4096).cast("long"), (F.col("l_linenumber") % 3 + 7).cast("int"),
        (F.col("l_suppkey") % 5).cast("int"), F.lit(0))
    return li.select(line.alias("line"))

"""Memory and throughput formulas over step/rank tables (PRJ12, PRJ13, PRJ24, AGG23, WIN3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GIB = float(1 << 30)


def memory_stats(df: DataFrame, used: str = "used", total: str = "total", free: str | None = None) -> DataFrame:
    """PRJ12: used = total - free when only free is known; GiB and usage ratio."""
    u = F.col(used) if free is None else F.col(total) - F.col(free)
    return df.withColumn("used_gib", u / GIB) \
        .withColumn("free_gib", (F.col(total) - u) / GIB) \
        .withColumn("total_gib", F.col(total) / GIB) \
        .withColumn("usage_pct", F.try_divide(u * 100.0, F.col(total)))


def token_throughput(seq_len: Column, batch: Column, elapsed_ms: Column, world: Column) -> Column:
    """PRJ13: tokens/s per GPU = seq_len * batch / max(elapsed_s, 1e-6) / world;
    NULL when a factor is missing."""
    return seq_len * batch / F.greatest(elapsed_ms / 1000.0, F.lit(1e-6)) / world


def throughput_metrics(steps: DataFrame, flops_per_token: float, peak_flops: float, global_batch: int,
                       local_batch: int, dp_degree: int, tps: str = "tps", step: str = "step") -> DataFrame:
    """PRJ24: TFLOP/s and MFU % from tokens/s, consumed samples = step x global
    batch (global batch < 0 -> local batch x data-parallel degree)."""
    gbs = global_batch if global_batch >= 0 else local_batch * dp_degree
    return steps.select(
        "*",
        (F.lit(flops_per_token) * F.col(tps) / 1e12).alias("tflops_calc"),
        (F.lit(100.0 * flops_per_token) * F.col(tps) / F.lit(peak_flops)).alias("mfu_pct"),
        (F.col(step) * F.lit(gbs)).cast("long").alias("consumed_samples"))


def peak_memory_rank(df: DataFrame, key=("run", "iter"), used: str = "used", rank: str = "rank") -> DataFrame:
    """AGG23: max used memory over ranks and the first (lowest) rank holding it."""
    return df.groupBy(*key).agg(
        F.max(used).alias("max_used"),
        F.max_by(F.col(rank), F.struct(F.col(used), -F.col(rank))).alias("max_rank"))

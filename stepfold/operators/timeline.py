"""Pipeline timeline analytics (AGG19, AGG20) over the exploded dump table
``(task, iter, pp_rank, series, ord, start_ms, end_ms, total, memory)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pipeline_bubble(events: DataFrame, vp_size: int, num_mbs: int) -> DataFrame:
    """AGG19: per (task, iter): iteration time = max rank total; per rank the
    F/B/W time over the first vp*mb events of each series, their shares and
    bubble % = (iter - F - B - W) / iter (NULL for a zero iteration time)."""
    n = vp_size * num_mbs
    first = events.filter(F.col("ord") < n)
    dur = F.col("end_ms") - F.col("start_ms")
    per_rank = first.groupBy("task", "iter", "pp_rank").agg(
        F.sum(F.when(F.col("series") == "fwd", dur)).alias("f_ms"),
        F.sum(F.when(F.col("series") == "bwd", dur)).alias("b_ms"),
        F.coalesce(F.sum(F.when(F.col("series") == "wgrad", dur)), F.lit(0.0)).alias("w_ms"))
    totals = events.groupBy("task", "iter", "pp_rank").agg(F.max("total").alias("total"))
    it = totals.groupBy("task", "iter").agg(F.max("total").alias("iter_ms"))
    out = per_rank.join(it, ["task", "iter"])
    t = F.col("iter_ms")
    fbw = F.coalesce(F.col("f_ms"), F.lit(0.0)) + F.coalesce(F.col("b_ms"), F.lit(0.0)) + F.col("w_ms")

    def share(c):
        return F.when(t > 0, F.coalesce(F.col(c), F.lit(0.0)) / t * 100).otherwise(F.lit(0.0))
    return out.select("task", "iter", "pp_rank", "iter_ms", "f_ms", "b_ms", "w_ms",
                      share("f_ms").alias("f_pct"), share("b_ms").alias("b_pct"), share("w_ms").alias("w_pct"),
                      F.try_divide((t - fbw) * 100, t).alias("bubble_pct"))


def pipeline_summary(ranks: DataFrame, key=("task", "iter")) -> DataFrame:
    """AGG20: step time = max rank total, critical rank (first on ties), max memory."""
    per_rank = ranks.groupBy(*key, "pp_rank").agg(F.max("total").alias("total"), F.max("memory").alias("memory"))
    return per_rank.groupBy(*key).agg(
        F.max("total").alias("step_time_ms"),
        F.max_by(F.col("pp_rank"), F.struct(F.col("total"), -F.col("pp_rank"))).alias("critical_rank"),
        F.max("memory").alias("max_memory"),
        F.count(F.lit(1)).alias("pp_size"))

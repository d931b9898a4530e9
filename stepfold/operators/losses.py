"""Loss series jobs: reproducibility check, evaluation loss, interval loss."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def loss_reproducibility(run: DataFrame, reference: DataFrame, key: str = "run") -> DataFrame:
    """JN5: two loss series compared as strings, position by position
    (ordinal full outer join on (key, pos)). Extra or missing positions on
    either side count as unequal (the reference ignores extra reference rows)."""
    j = run.alias("a").join(reference.alias("b"), [key, "pos"], "full_outer")
    same = F.col("a.loss").eqNullSafe(F.col("b.loss"))
    return j.groupBy(key).agg(
        F.bool_and(same).alias("equal"),
        F.count("a.loss").alias("n_run"), F.count("b.loss").alias("n_ref"),
        F.min(F.when(~same, F.col("pos"))).alias("first_diff"))


def eval_loss(parts: DataFrame, group=("run", "key")) -> DataFrame:
    """AGG21: ratio of sums per loss key; a scalar entry (no denominator)
    counts 1; denominator 0 gives 0.0."""
    den = F.coalesce(F.col("den"), F.lit(1.0))
    return parts.groupBy(*group).agg(F.sum("num").alias("_n"), F.sum(den).alias("_d")).select(
        *group, F.when(F.col("_d") > 0, F.col("_n") / F.col("_d")).otherwise(F.lit(0.0)).alias("loss"))


def interval_loss(parts: DataFrame, log_interval: int, run: str = "run") -> DataFrame:
    """AGG22: between log points (iterations (k-1)*L+1 .. k*L): per key the
    summed loss of advanced iterations / max(1, advanced); shown only if > 0;
    skipped iterations counted; NaN/Inf looked for in skipped iterations only.

    Per iteration the value of a key is sum(num / den) (scalar entries den 1);
    an iteration is skipped when any of its rows is.
    """
    den = F.coalesce(F.col("den"), F.lit(1.0))
    per_iter = parts.groupBy(run, "iter").agg(
        F.bool_or("skipped").alias("skipped"),
        F.bool_or(F.isnan("num") | (F.abs("num") == float("inf"))).alias("bad"))
    per_key = parts.groupBy(run, "iter", "key").agg(F.sum(F.col("num") / den).alias("value"))
    interval = F.floor((F.col("iter") - 1) / log_interval).cast("long")
    counts = per_iter.groupBy(run, interval.alias("interval")).agg(
        F.count_if(~F.col("skipped")).alias("advanced"),
        F.count_if(F.col("skipped")).alias("skipped_iters"),
        F.count_if(F.col("skipped") & F.col("bad")).alias("nan_iters"))
    sums = (per_key.join(per_iter, [run, "iter"])
            .groupBy(run, interval.alias("interval"), "key")
            .agg(F.sum(F.when(~F.col("skipped"), F.col("value"))).alias("_s")))
    out = sums.join(counts, [run, "interval"])
    avg = F.coalesce(F.col("_s"), F.lit(0.0)) / F.greatest(F.lit(1), F.col("advanced"))
    return out.select(run, "interval", "key", F.when(avg > 0, avg).alias("avg_loss"),
                      "advanced", "skipped_iters", "nan_iters")

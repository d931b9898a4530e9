"""Running statistics over step series (WIN1-WIN3).

The reference keeps a list per metric inside the training process: skip the
first S iterations, clear the list when iteration S+1 appears (a restart) or
when it already holds R values, append, print the mean. That is a tumbling
block of R rows inside a segment that starts at every iteration S+1 — a
windowed mean with ``rows unbounded preceding`` over (file, segment, block), at
most R rows. ``order`` must be unique within a file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepfold.operators.common import few, global_last, range_buckets, written


def _segments(df: DataFrame, key: Sequence[str], order: Sequence[str], iter_col: str, skip: int,
              reset: int) -> DataFrame:
    """Adds the segment and the block of each row. Rows and starts are counted range by range and shifted by those of the
    ranges before, so one long run is spread over tasks."""
    start = F.coalesce(F.col(iter_col) == skip + 1, F.lit(False))
    w = Window.partitionBy(*key, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = range_buckets(df.withColumn("_start", start), [*key, *order], "_bucket")
    rows = rows.withColumns({"_row": F.count(F.lit(1)).over(w) - 1, "_starts": F.count_if("_start").over(w)})
    rows = written(rows.withColumn("_last", F.max(F.when(F.col("_start"), F.col("_row"))).over(w)))
    ranges = rows.groupBy(*key, "_bucket").agg((F.max("_row") + 1).alias("_n"), F.max("_starts").alias("_s"), F.max("_last").alias("_l"))
    before = Window.partitionBy(*key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumns({"_rows0": F.coalesce(F.sum("_n").over(before), F.lit(0)), "_starts0": F.coalesce(F.sum("_s").over(before), F.lit(0))})
    ranges = written(ranges.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], F.col("_bucket").alias("_b"), "_rows0", "_starts0",
                                   F.last(F.col("_rows0") + F.col("_l"), ignorenulls=True).over(before).alias("_last0")))
    same = F.col("_bucket") == F.col("_b")
    for i, k in enumerate(key):  # null keys are keys too
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    at = F.col("_rows0") + F.col("_row") - F.coalesce(F.col("_rows0") + F.col("_last"), F.col("_last0"), F.lit(0))
    return rows.join(few(ranges), same).withColumns({"_seg": F.col("_starts0") + F.col("_starts"), "_block": F.floor(at / reset)}).drop(
        "_start", "_bucket", "_row", "_starts", "_last", "_b", "_rows0", "_starts0", "_last0", *[f"_k{i}" for i in range(len(key))])


def running_averages(steps: DataFrame, metrics: Sequence[str], key: Sequence[str] = ("path",),
                     order: Sequence[str] = ("line_no",), iter_col: str = "iter",
                     skip: int = 2, reset: int = 10, legacy: bool = False) -> DataFrame:
    """WIN1 (``legacy=False``): rows with iteration <= skip are not averaged
    (their ``*_avg`` is NULL). WIN2 (``legacy=True``): warm-up rows are
    averaged too, until iteration skip+1 starts the first real segment.

    Defaults of the reference config: skip 2, reset 10.
    """
    steps = written(steps.select(*key, *[c for c in order if c not in key], iter_col, *metrics))
    base = steps if legacy else steps.filter(F.col(iter_col) > skip)
    seg = _segments(base, key, order, iter_col, skip, reset)
    w = Window.partitionBy(*key, "_seg", "_block").orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, 0)
    out = seg.select(*key, *[c for c in order if c not in key], iter_col,
                     *[F.col(m) for m in metrics],
                     *[F.avg(m).over(w).alias(f"{m}_avg") for m in metrics])
    if legacy:
        return out
    warm = steps.filter(F.col(iter_col) <= skip).select(
        *key, *[c for c in order if c not in key], iter_col, *[F.col(m) for m in metrics],
        *[F.lit(None).cast("double").alias(f"{m}_avg") for m in metrics])
    return out.unionByName(warm)


def carry_forward(df: DataFrame, value: str, sampled: str, key: Sequence[str], order: Sequence[str],
                  out: str | None = None) -> DataFrame:
    """WIN3: value only on sampled rows, the others reuse the last sampled
    value; NULL before the first sample."""
    last = F.when(F.col(sampled), F.col(value))
    return global_last(df, order, key, last, out or f"{value}_carried")

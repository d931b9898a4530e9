"""Small building blocks shared by the jobs."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepfold.session import ensure_checkpoint_dir


def first_k(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], k: int,
            rank_col: str = "rn") -> DataFrame:
    """Rows ranked 1..k per group (``row_number``), ties broken by ``order``.

    ``row_number() <= k`` is planned with a partial WindowGroupLimit before the
    shuffle, so every map task forwards at most k rows per group: a hot group
    never reaches one task whole.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def exclusive_prefix_sum(counts: DataFrame, group: Sequence[str], order: Sequence[str],
                         value: str, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` over a *small* table (one row per
    partition/shard/bucket), used to turn local positions into global ones."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long"))


def range_partitions(df: DataFrame) -> int:
    """Number of range partitions for global orders: the session's shuffle
    partition count (sized for the data on a cluster)."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def written(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder; for narrow
    derived rows that several passes read (never for texts)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


SAMPLED_KEYS = 64  # keys sampled per bucket to find the bucket ends


def range_buckets(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Adds the number of the range of ``keys`` that a row falls in.

    The ends of the ranges are literals, picked once from a bounded sample of
    the keys (the same rows at every run), so the bucket is a pure function of
    the key: every branch of a plan, and every re-run task, agrees on it.
    A two-level search compares a key with about 2 sqrt(buckets) ends.
    """
    parts = range_partitions(df)
    sample = (df.select(*keys).orderBy(F.xxhash64(*keys), *keys).limit(SAMPLED_KEYS * parts)
              .orderBy(*keys).collect())
    picked = sorted({i * len(sample) // parts for i in range(1, parts)}) if sample else []
    types = [df.schema[k].dataType for k in keys]
    ends = [F.struct(*[F.lit(v).cast(t).alias(k) for k, v, t in zip(keys, sample[i], types)]) for i in picked]
    if not ends:
        return df.withColumn(out, F.lit(0))
    step = max(1, round(len(ends) ** 0.5))
    key = F.struct(*[F.col(k).alias(k) for k in keys])
    fine = F.array(*[F.array(*ends[i:i + step]) for i in range(0, len(ends), step)])
    df = df.withColumn("_coarse", F.size(F.filter(F.array(*ends[::step]), lambda e: e <= key)))
    within = F.size(F.filter(F.element_at(fine, F.col("_coarse")), lambda e: e <= key))
    return df.withColumn(out, F.when(F.col("_coarse") > 0, (F.col("_coarse") - 1) * step + within)
                         .otherwise(0)).drop("_coarse")


def global_running(df: DataFrame, order: Sequence[str], group: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Exclusive running value of each aggregate in ``order`` (within ``group``): its
    value over the row's own range up to the row plus the totals of the group's earlier ranges."""
    bucketed = range_buckets(df, [*group, *order], "_bucket")
    base = bucketed.groupBy(*group, "_bucket").agg(*[agg.alias(f"_t{i}") for i, agg in enumerate(sums.values())])
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = base.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_bucket").alias("_b"),
                       *[F.coalesce(F.sum(f"_t{i}").over(before), F.lit(0)).alias(f"_base{i}") for i in range(len(sums))])
    same = F.col("_bucket") == F.col("_b")
    for i, g in enumerate(group):  # null groups are groups too
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    w = Window.partitionBy(*group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = bucketed.withColumns({f"_local{i}": F.coalesce(agg.over(w), F.lit(0)) for i, agg in enumerate(sums.values())})
    helpers = ["_bucket", "_b", *[f"_g{i}" for i in range(len(group))],
               *[f"{c}{i}" for i in range(len(sums)) for c in ("_base", "_local")]]
    return local.join(base, same).withColumns(
        {out: (F.col(f"_base{i}") + F.col(f"_local{i}")).cast("long") for i, out in enumerate(sums)}).drop(*helpers)


def global_index(df: DataFrame, order: Sequence[str], out: str = "idx",
                 group: Sequence[str] = ()) -> DataFrame:
    """Dense 0-based position of every row in ``order`` (within ``group``),
    without pulling a group into one task: ranges of (group, order) are
    numbered on their own and shifted by the counts of the ranges before.
    ``order`` must be unique within a group."""
    return global_running(df, order, group, {out: F.count(F.lit(1))})


def global_prefix_sum(df: DataFrame, order: Sequence[str], value: str, out: str,
                      group: Sequence[str] = ()) -> DataFrame:
    """Exclusive running sum of ``value`` in ``order`` (within ``group``) over
    the whole table, range by range as in ``global_index``."""
    return global_running(df, order, group, {out: F.sum(value)})


def global_last(df: DataFrame, order: Sequence[str], group: Sequence[str], value: Column, out: str) -> DataFrame:
    """The last value of ``value`` that isn't null up to and with the row, in
    ``order`` within ``group``; a row without one in its own range takes the last of the earlier ranges."""
    bucketed = range_buckets(df, [*group, *order], "_bucket").withColumn("_value", value)
    place = F.struct(*order)
    base = bucketed.groupBy(*group, "_bucket").agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), place)).alias("_end"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = base.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_bucket").alias("_b"),
                       F.last("_end", ignorenulls=True).over(before).alias("_base"))
    same = F.col("_bucket") == F.col("_b")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    w = Window.partitionBy(*group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = bucketed.withColumn("_local", F.last("_value", ignorenulls=True).over(w))
    return local.join(base, same).withColumn(out, F.coalesce("_local", "_base")).drop(
        "_bucket", "_value", "_b", "_base", "_local", *[f"_g{i}" for i in range(len(group))])


VALUE_BINS = 1024  # ranges of values that ranks are first sought in
FEW_ROWS = 100_000  # measured tables up to this number of rows are broadcast


def few(df: DataFrame) -> DataFrame:
    """``df`` (cheap to read twice) to be broadcast in a join if it has at most FEW_ROWS rows, else as it is."""
    return F.broadcast(df) if df.limit(FEW_ROWS + 1).count() <= FEW_ROWS else df


def _value_bins(df: DataFrame, value: str, out: str) -> DataFrame:
    """Adds the number of the range of values that a row falls in, rising with the value (null for null, NaN last). The ends are
    literals near the value's quantiles over all rows, so a range of several values holds about 1 / VALUE_BINS of the rows."""
    near = F.percentile_approx(F.col(value).cast("double"), [i / VALUE_BINS for i in range(1, VALUE_BINS)], 10 * VALUE_BINS)
    ends = df.agg(near).first()[0] or []
    ends = sorted({e + 0.0 for e in ends if math.isfinite(e)})
    bins = Bucketizer(splits=[-math.inf, *(ends or [0.0]), math.inf], inputCol="_value", outputCol=out, handleInvalid="keep")
    return bins.transform(df.withColumn("_value", F.col(value).cast("double") + F.lit(0.0))).drop("_value")


def values_at(df: DataFrame, group: Sequence[str], value: str, places: dict[str, Column]) -> DataFrame:
    """Per group (group, _total, least, largest, places): how many values aren't null, the least and largest, and the values at the
    given 0-based places of the group's sorted values; ``places`` are columns over ``_total``.

    All rows are counted by (group, range of values) before the shuffle, and only rows of the ranges that hold a
    place are looked at again, so no group is sorted whole. ``df`` is read three times: give dear rows written."""
    rows = _value_bins(df.select(*group, value), value, "_bin")
    inside = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    keys = [F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]
    counted = rows.groupBy(*group, "_bin").agg(F.count(value).alias("_n"), F.min(value).alias("_min"), F.max(value).alias("_max"))
    one = Window.partitionBy(*group)
    before = one.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    counted = written(counted.withColumns({"_total": F.sum("_n").over(one), "_before": F.coalesce(F.sum("_n").over(before), F.lit(0))}))

    def here(place: Column) -> Column:
        return (F.col("_before") <= place) & (place < F.col("_before") + F.col("_n"))

    wanted = F.lit(False)
    for place in places.values():
        wanted = wanted | here(place)
    several = counted.where(wanted & (F.col("_min") != F.col("_max"))).select(
        *keys, F.col("_bin").alias("_b"), F.col("_before").alias("_base"), "_total")
    same = F.col("_bin") == F.col("_b")
    for x in inside:
        same = same & x
    looked = rows.join(few(several), same).groupBy(*group, "_bin", "_base", "_total", value).agg(F.count(value).alias("_n"))
    order = Window.partitionBy(*group, "_bin").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    looked = looked.select(*group, "_total", (F.col("_base") + F.coalesce(F.sum("_n").over(order), F.lit(0))).alias("_before"), "_n",
                           F.col(value).alias("_value"), F.col(value).alias("_min"), F.col(value).alias("_max"))
    known = counted.select(*group, "_total", "_before", "_n", F.when(F.col("_min") == F.col("_max"), F.col("_min")).alias("_value"), "_min", "_max")
    picks = [F.max(F.when(here(place), F.col("_value"))).alias(name) for name, place in places.items()]
    return known.unionByName(looked).groupBy(*group).agg(
        F.max("_total").alias("_total"), F.min("_min").alias("least"), F.max("_max").alias("largest"), *picks)


def exact_percentiles(df: DataFrame, group: Sequence[str], value: str, shares: Sequence[float], out: str = "q") -> DataFrame:
    """``percentile`` of each share (linear between the two nearest ranks) with the
    least and largest value, per group, as (group, out array, least, largest).

    Ranks are sought by ``values_at``, so a hot group is spread over tasks; a group without values has nulls."""
    place = [(F.col("_total") - 1) * F.lit(float(share)) for share in shares]
    found = values_at(df, group, value, {f"_{end}{i}": f(p) for i, p in enumerate(place) for end, f in (("lo", F.floor), ("hi", F.ceil))})
    q = [F.when(F.col(f"_lo{i}") == F.col(f"_hi{i}"), F.col(f"_lo{i}")).otherwise(
        (F.ceil(p) - p) * F.col(f"_lo{i}") + (p - F.floor(p)) * F.col(f"_hi{i}")) for i, p in enumerate(place)]
    return found.select(*group, F.array(*q).alias(out), "least", "largest")

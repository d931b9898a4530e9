"""Collective-benchmark statistics (AGG9-13, WIN7, PRJ16, PRJ21, PRJ23, JN1, PIV1).

Input is the long latency table ``(op, bytes, dtype, repeat, rank, iter, latency_ms)``
that each rank produces; everything rank 0 computed alone in the reference is a
distributed aggregation here. Percentiles are exact with linear interpolation
(``percentile``), as in the reference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepfold.operators.common import exact_percentiles, first_k, written

CASE = ["op", "bytes", "dtype", "repeat"]


# Spellings of collective names (the CLI offers the
# underscore form, the statistics code the joined one).
OP_ALIASES = {"all_reduce": "allreduce", "allreduce": "allreduce", "all_gather": "allgather",
              "allgather": "allgather", "reduce_scatter": "reduce_scatter", "reducescatter": "reduce_scatter",
              "all_to_all": "alltoall", "alltoall": "alltoall", "broadcast": "broadcast"}


def normalize_op(c: Column) -> Column:
    """'all_reduce' and 'allreduce' name the same operation."""
    low = F.lower(c)
    return (F.when(low.isin("all_reduce", "allreduce"), F.lit("allreduce"))
            .when(low.isin("all_gather", "allgather"), F.lit("allgather"))
            .when(low.isin("reduce_scatter", "reducescatter"), F.lit("reduce_scatter"))
            .when(low.isin("all_to_all", "alltoall"), F.lit("alltoall"))
            .otherwise(low))


def bytes_factor(op: Column, world: Column | int) -> Column:
    """PRJ16: per-rank effective bytes factor; unknown op is an error."""
    p = F.lit(world) if isinstance(world, int) else world
    o = normalize_op(op)
    return (F.when(o == "allreduce", 2.0 * (p - 1) / p)
            .when(o.isin("allgather", "reduce_scatter", "broadcast", "alltoall"), (p - 1) / p.cast("double"))
            .otherwise(F.raise_error(F.concat(F.lit("Unknown op: "), op)).cast("double")))


def critical_path(times: DataFrame) -> DataFrame:
    """AGG9: per (case, iter) the max latency over ranks; iterations beyond the
    shortest rank's series are dropped."""
    per_rank = times.groupBy(*CASE, "rank").agg(F.count(F.lit(1)).alias("n"))
    shortest = per_rank.groupBy(*CASE).agg(F.min("n").alias("n_iters"))
    return (times.join(shortest, CASE)
            .filter(F.col("iter") < F.col("n_iters"))
            .groupBy(*CASE, "iter").agg(F.max("latency_ms").alias("latency_ms")))


def latency_percentiles(times: DataFrame, world: int) -> DataFrame:
    """AGG10: p50/p95/min/max of the critical path, effective GB/s from p50."""
    cp = written(critical_path(times))
    out = exact_percentiles(cp, CASE, "latency_ms", (0.5, 0.95)).withColumnsRenamed({"least": "tmin", "largest": "tmax"})
    p50 = F.col("q")[0]
    return out.select(*CASE, p50.alias("p50"), F.col("q")[1].alias("p95"), "tmin", "tmax",
                      (F.col("bytes") * bytes_factor(F.col("op"), world) / (p50 / 1000.0) / 1e9).alias("eff_gbps"))


def rank_percentiles(times: DataFrame) -> DataFrame:
    """Per (case, rank): p50/p95/min/max of the rank's own series."""
    q = exact_percentiles(times, [*CASE, "rank"], "latency_ms", (0.5, 0.95))
    return q.select(*CASE, "rank", F.col("q")[0].alias("p50"), F.col("q")[1].alias("p95"),
                    F.col("least").alias("rmin"), F.col("largest").alias("rmax"))


def rank_report(times: DataFrame, world: int, hosts: DataFrame | None = None) -> DataFrame:
    """AGG11 + JN1: per-rank rows with p95 relative to the global p50 and the host
    (unknown rank -> empty host)."""
    rp = rank_percentiles(times)
    g = latency_percentiles(times, world).select(*CASE, F.col("p50").alias("global_p50"))
    out = rp.join(g, CASE).withColumn(
        "rel_p95", F.when(F.col("global_p50") > 0, F.col("p95") / F.col("global_p50")))
    return attach_host(out, hosts).drop("global_p50")


def attach_host(df: DataFrame, hosts: DataFrame | None) -> DataFrame:
    """JN1: rank -> hostname; the host table has one row per rank (bounded by
    the world size), so it is broadcast; an unknown rank gets ''."""
    if hosts is None:
        return df.withColumn("host", F.lit(""))
    return (df.join(hosts.select("rank", "host"), "rank", "left")
            .withColumn("host", F.coalesce(F.col("host"), F.lit(""))))


def straggler_summary(times: DataFrame, hosts: DataFrame | None = None) -> DataFrame:
    """AGG12: slowest rank by p95 (lowest rank on ties) as ``r{rank}@{host}``;
    spread = max p95 - median p95."""
    rp = attach_host(rank_percentiles(times), hosts)
    return rp.groupBy(*CASE).agg(
        F.max_by(F.struct("rank", "host"), F.struct(F.col("p95"), -F.col("rank"))).alias("s"),
        (F.max("p95") - F.percentile(F.col("p95"), F.lit(0.5))).alias("spread_ms"),
    ).select(*CASE, F.format_string("r%d@%s", "s.rank", "s.host").alias("slowest"), "spread_ms")


def repeat_rows(times: DataFrame, world: int, hosts: DataFrame | None = None) -> DataFrame:
    """Per-repeat summary rows: AGG10 joined with AGG12."""
    return latency_percentiles(times, world).join(straggler_summary(times, hosts), CASE)


def repeat_summary(times: DataFrame, world: int, hosts: DataFrame | None = None) -> DataFrame:
    """AGG13: per-repeat rows plus one ``avg`` row per (op, bytes, dtype):
    means of p50/p95/eff/spread, min of min, max of max, slowest label of the
    repeat with the highest p95 (first repeat on ties)."""
    rows = repeat_rows(times, world, hosts).withColumn("repeat", F.col("repeat").cast("string"))
    key = ["op", "bytes", "dtype"]
    agg = rows.groupBy(*key).agg(
        F.avg("p50").alias("p50"), F.avg("p95").alias("p95"), F.min("tmin").alias("tmin"),
        F.max("tmax").alias("tmax"), F.avg("eff_gbps").alias("eff_gbps"), F.avg("spread_ms").alias("spread_ms"),
        F.max_by("slowest", F.struct(F.col("p95"), -F.col("repeat").cast("int"))).alias("slowest"),
    ).withColumn("repeat", F.lit("avg"))
    return rows.unionByName(agg)


def topk_slowest(times: DataFrame, k: int) -> DataFrame:
    """WIN7: k slowest ranks by p95 per case (none for k <= 0); lower rank first on ties."""
    if k <= 0:
        return rank_percentiles(times).limit(0).withColumn("rn", F.lit(0))
    return first_k(rank_percentiles(times), CASE, [F.col("p95").desc(), F.col("rank")], k)


def trace_filter(times: DataFrame, ops: Sequence[str] = (), sizes: Sequence[int] = (), limit: int = 0,
                 repeat: int | None = None) -> DataFrame:
    """PRJ21: rows of the chosen ops and sizes, first ``limit`` iterations
    (an empty list means all; limit <= 0 means all). Plain filters, pushed to
    the scan by Catalyst."""
    df = times
    if ops:
        df = df.filter(normalize_op(F.col("op")).isin([OP_ALIASES.get(o.lower(), o.lower()) for o in ops]))
    if sizes:
        df = df.filter(F.col("bytes").isin(list(sizes)))
    if repeat is not None:
        df = df.filter(F.col("repeat") == repeat)
    if limit > 0:
        df = df.filter(F.col("iter") < limit)
    return df


def every_nth_rank(df: DataFrame, n: int, local_size: int) -> DataFrame:
    """PRJ22: one representative rank per group of n; node id = rank div local size."""
    return df.filter(F.col("rank") % n == 0).withColumn("node", (F.col("rank") / local_size).cast("int"))


def size_matrix(results: DataFrame, sizes_mb: Sequence[int], value: str, index: Sequence[str]) -> DataFrame:
    """PIV1: index rows x message-size columns in numeric size order. The
    column list is explicit, so the pivot needs no distinct pass."""
    labels = [f"{s}MB" for s in sorted(sizes_mb)]
    p = results.groupBy(*index).pivot("size_label", labels).agg(F.first(value))
    return p.select(*index, *[F.col(l).alias(f"{value}_{l}") for l in labels])


# Fixed pattern of a communication-library trace line.
TRACE = (r"INFO (\w+): opCount ([0-9a-fA-F]+) .*?count (\d+) datatype (\d+) op (\d+) root (\d+)")


def parse_collective_trace(lines: DataFrame) -> DataFrame:
    """PRJ23: trace lines -> (op, op_count, count, datatype, red_op, root)."""
    l = F.col("line")
    return lines.filter(l.rlike(TRACE)).select(
        F.regexp_extract(l, TRACE, 1).alias("op"),
        F.conv(F.regexp_extract(l, TRACE, 2), 16, 10).cast("long").alias("op_count"),
        F.regexp_extract(l, TRACE, 3).cast("long").alias("count"),
        F.regexp_extract(l, TRACE, 4).cast("int").alias("datatype"),
        F.regexp_extract(l, TRACE, 5).cast("int").alias("red_op"),
        F.regexp_extract(l, TRACE, 6).cast("int").alias("root"))


def collective_trace_counts(parsed: DataFrame) -> DataFrame:
    """PRJ23 summary: calls and elements per (op, datatype)."""
    return parsed.groupBy("op", "datatype").agg(F.count(F.lit(1)).alias("calls"),
                                                F.sum("count").alias("elements"))


def bandwidth_table(percentiles: DataFrame, world: int, nodes: int = 1) -> DataFrame:
    """PRJ16: algorithm and bus bandwidth of each case (GB/s and GiB/s), ring
    variant over size x nodes, and point-to-point bandwidth (size / time)."""
    t = F.col("p50") / 1000.0
    factor = bytes_factor(F.col("op"), world)
    return percentiles.select(
        *CASE, factor.alias("bytes_factor"),
        (F.col("bytes") / t / 1e9).alias("algo_gbps"),
        (F.col("bytes") * factor / t / 1e9).alias("bus_gbps"),
        (F.col("bytes") * factor / t / float(1 << 30)).alias("bus_gibps"),
        (F.col("bytes") * nodes / t / 1e9).alias("ring_gbps"),
        (F.col("bytes") / t / 1e9).alias("p2p_gbps"))

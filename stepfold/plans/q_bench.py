"""Registered queries and oracles of the benchmark statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepfold.operators import collectives as C
from stepfold.plans import views_bench as V
from stepfold.plans.finalize import rounded

QUERIES = {}
ORACLE = {}
WORLD = V.WORLD


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


LI_ORDER = ", ".join(V.LINEITEM_ORDER)
TIMES = f"""rt_base AS (
  SELECT *, CASE l_returnflag WHEN 'A' THEN 'allreduce' WHEN 'N' THEN 'allgather' ELSE 'reduce_scatter' END AS op,
         CAST(1048576*(1 + l_suppkey % 3) AS BIGINT) AS bytes, 'bfloat16' AS dtype,
         CAST(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS INTEGER) AS repeat,
         CAST(l_partkey % 8 AS INTEGER) AS rank, l_extendedprice / 1000 AS latency_ms
  FROM lineitem),
v_rank_times AS (
  SELECT op, bytes, dtype, repeat, rank,
         CAST(row_number() OVER (PARTITION BY op, bytes, repeat, rank ORDER BY {LI_ORDER}) - 1 AS INTEGER) AS iter,
         latency_ms
  FROM rt_base),
hosts AS (SELECT CAST(r AS INTEGER) AS rank, 'node' || CAST(r // 4 AS VARCHAR) AS host FROM range(7) t(r)),
cp AS (
  SELECT t.op, t.bytes, t.dtype, t.repeat, t.iter, max(t.latency_ms) AS latency_ms
  FROM v_rank_times t JOIN (
    SELECT op, bytes, repeat, min(n) AS n_iters
    FROM (SELECT op, bytes, repeat, rank, count(*) AS n FROM v_rank_times GROUP BY ALL) GROUP BY ALL) s
  USING (op, bytes, repeat)
  WHERE t.iter < s.n_iters GROUP BY ALL),
lp AS (
  SELECT op, bytes, dtype, repeat, quantile_cont(latency_ms, 0.5) AS p50, quantile_cont(latency_ms, 0.95) AS p95,
         min(latency_ms) AS tmin, max(latency_ms) AS tmax
  FROM cp GROUP BY ALL),
lpe AS (
  SELECT *, bytes * (CASE WHEN op = 'allreduce' THEN 2.0 * 7 / 8 ELSE 7.0 / 8 END) / (p50 / 1000.0) / 1e9 AS eff_gbps
  FROM lp),
rp AS (
  SELECT op, bytes, dtype, repeat, rank, quantile_cont(latency_ms, 0.5) AS p50,
         quantile_cont(latency_ms, 0.95) AS p95, min(latency_ms) AS rmin, max(latency_ms) AS rmax
  FROM v_rank_times GROUP BY ALL),
strag AS (
  SELECT op, bytes, dtype, repeat,
         printf('r%d@%s', arg_max(rank, p95 * 1000 - rank / 1000.0), arg_max(coalesce(h.host, ''), p95 * 1000 - rank / 1000.0)) AS slowest,
         max(p95) - quantile_cont(p95, 0.5) AS spread_ms
  FROM rp LEFT JOIN hosts h USING (rank) GROUP BY ALL)"""


def _times(spark, sf_dir):
    return V.v_rank_times(spark, sf_dir)


@register("critical_path", f"""WITH {TIMES}
SELECT op, bytes, dtype, repeat, iter, latency_ms FROM cp""")
def q_critical_path(spark, sf_dir):
    return C.critical_path(_times(spark, sf_dir))


@register("latency_percentiles", f"""WITH {TIMES}
SELECT op, bytes, dtype, repeat, round(p50, 8) AS p50, round(p95, 8) AS p95, tmin, tmax,
       round(eff_gbps, 8) AS eff_gbps FROM lpe""")
def q_latency_percentiles(spark, sf_dir):
    return C.latency_percentiles(_times(spark, sf_dir), WORLD)


@register("rank_percentiles", f"""WITH {TIMES}
SELECT op, bytes, dtype, repeat, rank, round(rp.p50, 8) AS p50, round(rp.p95, 8) AS p95, rmin, rmax,
       round(CASE WHEN lpe.p50 > 0 THEN rp.p95 / lpe.p50 END, 8) AS rel_p95, coalesce(h.host, '') AS host
FROM rp JOIN lpe USING (op, bytes, dtype, repeat) LEFT JOIN hosts h USING (rank)""")
def q_rank_percentiles(spark, sf_dir):
    return C.rank_report(_times(spark, sf_dir), WORLD, V.v_hosts(spark))


@register("rank_host", f"""WITH {TIMES}
SELECT DISTINCT rank, coalesce(h.host, '') AS host FROM v_rank_times LEFT JOIN hosts h USING (rank)""")
def q_rank_host(spark, sf_dir):
    ranks = _times(spark, sf_dir).select("rank").distinct()
    return C.attach_host(ranks, V.v_hosts(spark))


@register("straggler_summary", f"""WITH {TIMES}
SELECT op, bytes, dtype, repeat, slowest, round(spread_ms, 8) AS spread_ms FROM strag""")
def q_straggler_summary(spark, sf_dir):
    return C.straggler_summary(_times(spark, sf_dir), V.v_hosts(spark))


@register("repeat_summary", f"""WITH {TIMES}, rows AS (
  SELECT op, bytes, dtype, CAST(repeat AS VARCHAR) AS repeat, p50, p95, tmin, tmax, eff_gbps, slowest, spread_ms
  FROM lpe JOIN strag USING (op, bytes, dtype, repeat))
SELECT op, bytes, dtype, repeat, round(p50, 8) AS p50, round(p95, 8) AS p95, tmin, tmax,
       round(eff_gbps, 8) AS eff_gbps, slowest, round(spread_ms, 8) AS spread_ms FROM rows
UNION ALL
SELECT op, bytes, dtype, 'avg', round(avg(p50), 8), round(avg(p95), 8), min(tmin), max(tmax),
       round(avg(eff_gbps), 8), arg_max(slowest, p95 * 10 - CAST(repeat AS INTEGER) / 100.0),
       round(avg(spread_ms), 8)
FROM rows GROUP BY op, bytes, dtype""")
def q_repeat_summary(spark, sf_dir):
    return C.repeat_summary(_times(spark, sf_dir), WORLD, V.v_hosts(spark))


@register("topk_slowest", f"""WITH {TIMES}
SELECT op, bytes, dtype, repeat, rank, round(p50, 8) AS p50, round(p95, 8) AS p95, rmin, rmax, rn FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY op, bytes, dtype, repeat ORDER BY p95 DESC, rank) AS INTEGER) AS rn
  FROM rp) WHERE rn <= 3""")
def q_topk_slowest(spark, sf_dir):
    return C.topk_slowest(_times(spark, sf_dir), 3)


@register("trace_filter", f"""WITH {TIMES}
SELECT op, bytes, dtype, repeat, rank, iter, latency_ms FROM v_rank_times
WHERE op = 'allreduce' AND bytes IN (1048576, 3145728) AND iter < 10""")
def q_trace_filter(spark, sf_dir):
    return C.trace_filter(_times(spark, sf_dir), ops=["all_reduce"], sizes=[1048576, 3145728], limit=10)


@register("collective_bandwidth", f"""WITH {TIMES}
SELECT op, bytes, dtype, repeat,
       CASE WHEN op = 'allreduce' THEN 1.75 ELSE 0.875 END AS bytes_factor,
       round(bytes / (p50 / 1000.0) / 1e9, 8) AS algo_gbps,
       round(bytes * (CASE WHEN op = 'allreduce' THEN 1.75 ELSE 0.875 END) / (p50 / 1000.0) / 1e9, 8) AS bus_gbps,
       round(bytes * (CASE WHEN op = 'allreduce' THEN 1.75 ELSE 0.875 END) / (p50 / 1000.0) / 1073741824.0, 8) AS bus_gibps,
       round(bytes * 2 / (p50 / 1000.0) / 1e9, 8) AS ring_gbps,
       round(bytes / (p50 / 1000.0) / 1e9, 8) AS p2p_gbps
FROM lp""")
def q_collective_bandwidth(spark, sf_dir):
    return C.bandwidth_table(C.latency_percentiles(_times(spark, sf_dir), WORLD), WORLD, nodes=2)


@register("size_matrix", f"""WITH {TIMES}, r AS (
  SELECT rank, bytes // 1048576 AS mb, avg(latency_ms) AS lat FROM v_rank_times WHERE rank % 2 = 0 GROUP BY ALL)
SELECT rank, CAST(rank // 4 AS INTEGER) AS node,
       round(max(CASE WHEN mb = 1 THEN lat END), 8) AS latency_ms_1MB,
       round(max(CASE WHEN mb = 2 THEN lat END), 8) AS latency_ms_2MB,
       round(max(CASE WHEN mb = 3 THEN lat END), 8) AS latency_ms_3MB
FROM r GROUP BY rank""")
def q_size_matrix(spark, sf_dir):
    t = C.every_nth_rank(_times(spark, sf_dir), 2, 4)
    res = t.groupBy("rank", "node", F.concat((F.col("bytes") / 1048576).cast("long").cast("string"),
                                             F.lit("MB")).alias("size_label")) \
        .agg(F.avg("latency_ms").alias("latency_ms"))
    return C.size_matrix(res, [1, 2, 3], "latency_ms", ["rank", "node"])


@register("collective_trace", """
SELECT CASE l_returnflag WHEN 'A' THEN 'AllReduce' WHEN 'N' THEN 'AllGather' ELSE 'ReduceScatter' END AS op,
       CAST(l_linenumber % 3 + 7 AS INTEGER) AS datatype, count(*) AS calls,
       CAST(sum(CAST(l_quantity * 4096 AS BIGINT)) AS BIGINT) AS elements, max(l_orderkey) AS max_op_count
FROM lineitem GROUP BY ALL""")
def q_collective_trace(spark, sf_dir):
    parsed = C.parse_collective_trace(V.v_collective_trace(spark, sf_dir))
    return parsed.groupBy("op", "datatype").agg(F.count(F.lit(1)).alias("calls"),
                                                F.sum("count").cast("long").alias("elements"),
                                                F.max("op_count").alias("max_op_count"))

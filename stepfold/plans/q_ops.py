"""Registered queries and oracles: checkpoints, losses, memory, fleet, pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepfold.operators import checkpoint as CK
from stepfold.operators import fleet as FL
from stepfold.operators import losses as LS
from stepfold.operators import memory as MM
from stepfold.operators import timeline as TL
from stepfold.operators import trainlog as T
from stepfold.operators import windows as W
from stepfold.plans import views_logs as VL
from stepfold.plans import views_ops as V
from stepfold.plans.finalize import rounded
from stepfold.plans.q_logs import MPATH, STEPS, TITAN, TPATH
from stepfold.plans.tables import table
from stepfold.plans.views_bench import LINEITEM_ORDER

QUERIES = {}
ORACLE = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ checkpoints
CKPT = """ck_base AS (SELECT CAST(o_custkey % 20 AS INTEGER) AS run, o_orderkey AS k, o_orderdate AS ts0 FROM orders),
ck AS (
  SELECT run, k*4 AS line_no, ts0 AS ts, 0 AS kind FROM ck_base
  UNION ALL SELECT run, k*4+1, ts0 + to_seconds(k % 30), 1 FROM ck_base WHERE run IN (7, 13)
  UNION ALL SELECT run, k*4+2, ts0 + to_seconds(k % 600 + 1), 2 FROM ck_base WHERE NOT (run = 19 AND k % 7 = 0)
  UNION ALL SELECT run, k*4+3, ts0 + to_seconds(2), 3 FROM ck_base WHERE run = 13 AND k % 50 = 0)"""


def _ckpt_events(spark, sf_dir):
    lines = V.v_ckpt_log(spark, sf_dir).withColumn(
        "run", F.regexp_extract("path", r"run_(\d+)/", 1).cast("int"))
    return CK.read_rank_logs(lines)


@register("pair_events", f"""WITH {CKPT},
s AS (SELECT run, row_number() OVER (PARTITION BY run ORDER BY ts, line_no) AS n, ts FROM ck WHERE kind = 0),
e AS (SELECT run, row_number() OVER (PARTITION BY run ORDER BY ts, line_no) AS n, ts FROM ck WHERE kind = 2)
SELECT coalesce(s.run, e.run) AS run, CAST(coalesce(s.n, e.n) AS INTEGER) AS n,
       strftime(s.ts, '%Y-%m-%d %H:%M:%S') AS start_ts, strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS end_ts,
       CAST(date_diff('second', s.ts, e.ts) AS BIGINT) AS seconds,
       (s.ts IS NOT NULL AND e.ts IS NOT NULL) AS paired
FROM s FULL OUTER JOIN e ON s.run = e.run AND s.n = e.n""")
def q_pair_events(spark, sf_dir):
    p = CK.pair_events(_ckpt_events(spark, sf_dir), CK.SAVE_START, CK.SAVE_END)
    return p.select("run", "n", F.date_format("start_ts", "yyyy-MM-dd HH:mm:ss").alias("start_ts"),
                    F.date_format("end_ts", "yyyy-MM-dd HH:mm:ss").alias("end_ts"), "seconds", "paired")


@register("checkpoint_report", f"""WITH {CKPT},
st AS (
  SELECT run, count(*) FILTER (WHERE kind = 0) AS num_saved, count(*) FILTER (WHERE kind = 2) AS n_end,
         count(*) FILTER (WHERE kind = 1) AS n_async,
         max(ts) FILTER (WHERE kind = 0) AS s0, max(ts) FILTER (WHERE kind = 2) AS s1,
         max(ts) FILTER (WHERE kind = 1) AS a1, bool_or(kind = 3) AS overlap
  FROM ck GROUP BY run),
fl AS (
  SELECT run, k, CAST(trunc(o_totalprice * 100) AS BIGINT) AS b FROM ck_base JOIN orders ON o_orderkey = k
  UNION ALL SELECT run, k, CAST(trunc(l_extendedprice * 100) AS BIGINT) FROM ck_base JOIN lineitem ON l_orderkey = k),
sz AS (
  SELECT run, count(*) AS folders, arg_max(b, k) AS newest FROM (
    SELECT run, k, sum(b) AS b FROM fl WHERE NOT (run = 11 AND k % 5 = 0) GROUP BY ALL) GROUP BY run),
r AS (
  SELECT st.run, num_saved,
         CASE WHEN num_saved > 0 AND num_saved = n_end THEN CAST(date_diff('second', s0, s1) AS BIGINT) END AS save_total_s,
         CASE WHEN st.run NOT IN (7, 13) THEN
                CASE WHEN num_saved > 0 AND num_saved = n_end THEN CAST(date_diff('second', s0, s1) AS BIGINT) END
              WHEN n_async = num_saved THEN CAST(date_diff('second', s0, a1) AS BIGINT) END AS save_block_s,
         NOT (st.run IN (7, 13) AND coalesce(overlap, false)) AS accurate,
         CAST(st.run * 3 + 5 AS BIGINT) AS load_s,
         CASE WHEN folders = num_saved THEN newest END AS iter_folder_size
  FROM st LEFT JOIN sz USING (run))
SELECT run, num_saved, save_total_s, save_block_s, accurate, load_s, iter_folder_size,
       round(CASE WHEN save_total_s <> 0 THEN iter_folder_size / 1048576.0 / save_total_s END, 8) AS save_mbps,
       round(CASE WHEN load_s <> 0 THEN iter_folder_size / 1048576.0 / load_s END, 8) AS load_mbps
FROM r""")
def q_checkpoint_report(spark, sf_dir):
    sizes = CK.checkpoint_sizes(V.v_ckpt_files(spark, sf_dir))
    return CK.checkpoint_report(_ckpt_events(spark, sf_dir), sizes)


# ------------------------------------------------------------------ losses
LOSS_PARTS = """lp AS (
  SELECT CAST(l_suppkey % 10 AS INTEGER) AS run, CAST(l_orderkey % 300 + 1 AS INTEGER) AS iter,
         CASE WHEN l_linenumber % 2 = 1 THEN 'lm loss' ELSE 'mtp loss' END AS key,
         CASE WHEN l_returnflag = 'R' AND l_suppkey % 97 = 0 THEN 'NaN'::DOUBLE ELSE l_extendedprice / 1000 END AS num,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS den, l_returnflag = 'R' AS skipped
  FROM lineitem)"""


@register("loss_reproducibility", f"""WITH {STEPS}
SELECT run, NOT (run IN (3, 5)) AS equal, count(*) AS n_run,
       count(*) - CASE WHEN run = 5 THEN 3 ELSE 0 END AS n_ref,
       CASE WHEN run = 3 THEN 5 WHEN run = 5 THEN CAST(count(*) - 2 AS INTEGER) END AS first_diff
FROM v_steps GROUP BY run""")
def q_loss_reproducibility(spark, sf_dir):
    run, ref = V.v_losses(spark, sf_dir)
    return LS.loss_reproducibility(run, ref)


@register("eval_loss", f"""WITH {LOSS_PARTS}, e AS (
  SELECT run, key, CASE WHEN sum(coalesce(den, 1.0)) > 0 THEN sum(num) / sum(coalesce(den, 1.0)) ELSE 0.0 END AS loss FROM lp GROUP BY run, key)
SELECT run, key, isnan(loss) AS is_nan, round(CASE WHEN NOT isnan(loss) THEN loss END, 8) AS loss FROM e""")
def q_eval_loss(spark, sf_dir):
    """All micro-batches; a sum with a NaN part is reported as such."""
    e = LS.eval_loss(V.v_loss_parts(spark, sf_dir))
    return e.select("run", "key", F.isnan("loss").alias("is_nan"), F.when(~F.isnan("loss"), F.col("loss")).alias("loss"))


@register("interval_loss", f"""WITH {LOSS_PARTS},
pi AS (SELECT run, iter, bool_or(skipped) AS skipped, bool_or(isnan(num) OR isinf(num)) AS bad FROM lp GROUP BY ALL),
pk AS (SELECT run, iter, key, sum(num / coalesce(den, 1.0)) AS value FROM lp GROUP BY ALL),
cnt AS (SELECT run, CAST((iter - 1) // 10 AS BIGINT) AS interval, count(*) FILTER (WHERE NOT skipped) AS advanced,
               count(*) FILTER (WHERE skipped) AS skipped_iters, count(*) FILTER (WHERE skipped AND bad) AS nan_iters
        FROM pi GROUP BY ALL),
sm AS (SELECT run, CAST((iter - 1) // 10 AS BIGINT) AS interval, key,
              sum(CASE WHEN NOT pi.skipped THEN value END) AS s
       FROM pk JOIN pi USING (run, iter) GROUP BY ALL)
SELECT run, interval, key,
       round(CASE WHEN coalesce(s, 0) / greatest(1, advanced) > 0 THEN coalesce(s, 0) / greatest(1, advanced) END, 8) AS avg_loss,
       advanced, skipped_iters, nan_iters
FROM sm JOIN cnt USING (run, interval)""")
def q_interval_loss(spark, sf_dir):
    return LS.interval_loss(V.v_loss_parts(spark, sf_dir), 10)


# ------------------------------------------------------------------ memory
RANK_MEM = """rm AS (
  SELECT CAST(l_suppkey % 5 AS INTEGER) AS run, CAST(l_orderkey % 50 AS INTEGER) AS iter,
         CAST(l_linenumber - 1 AS INTEGER) AS rank, max(CAST(trunc(l_extendedprice * 1e6) AS BIGINT)) AS used,
         CAST(192 AS BIGINT) * 1073741824 AS total
  FROM lineitem GROUP BY ALL)"""


@register("memory_stats", f"""WITH {RANK_MEM}
SELECT run, iter, rank, used, total, (iter % 5 = 0) AS sampled,
       round(used / 1073741824.0, 8) AS used_gib, round((total - used) / 1073741824.0, 8) AS free_gib,
       192.0 AS total_gib, round(used * 100.0 / total, 8) AS usage_pct
FROM rm""")
def q_memory_stats(spark, sf_dir):
    return MM.memory_stats(V.v_rank_memory(spark, sf_dir))


@register("peak_memory_rank", f"""WITH {RANK_MEM}
SELECT run, iter, used AS max_used, rank AS max_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY run, iter ORDER BY used DESC, rank) AS rn FROM rm) WHERE rn = 1""")
def q_peak_memory_rank(spark, sf_dir):
    return MM.peak_memory_rank(V.v_rank_memory(spark, sf_dir))


@register("carry_forward_memory", f"""WITH {RANK_MEM}
SELECT run, iter, rank, used, (iter % 5 = 0) AS sampled,
       last_value(CASE WHEN iter % 5 = 0 THEN used END IGNORE NULLS) OVER (
         PARTITION BY run, rank ORDER BY iter ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used_carried
FROM rm""")
def q_carry_forward_memory(spark, sf_dir):
    rm = V.v_rank_memory(spark, sf_dir).select("run", "iter", "rank", "used", "sampled")
    return W.carry_forward(rm, "used", "sampled", ["run", "rank"], ["iter"])


@register("token_throughput", f"""WITH {STEPS}
SELECT {MPATH} AS path, CAST(iter * 2 AS BIGINT) AS line_no,
       round(4096.0 * gbs / greatest(elapsed_ms / 1000.0, 1e-6) / 8, 8) AS tokens_per_gpu
FROM v_steps""")
def q_token_throughput(spark, sf_dir):
    s = T.parse_megatron_steps(VL.v_train_log(spark, sf_dir))
    return s.select("path", "line_no",
                    MM.token_throughput(F.lit(4096), F.col("gbs"), F.col("elapsed_ms"), F.lit(8)).alias("tokens_per_gpu"))


@register("throughput_metrics", f"""WITH {TITAN}
SELECT {TPATH} AS path, line_no, CAST(iter AS BIGINT) AS step, tps,
       round(4.8e10 * tps / 1e12, 8) AS tflops_calc, round(100.0 * 4.8e10 * tps / 1.3e15, 8) AS mfu_pct,
       CAST(iter * 32 AS BIGINT) AS consumed_samples
FROM v_titan""")
def q_throughput_metrics(spark, sf_dir):
    s = T.parse_titan_steps(VL.v_titan_log(spark, sf_dir)).select("path", "line_no", "step", "tps")
    return MM.throughput_metrics(s, 4.8e10, 1.3e15, global_batch=-1, local_batch=8, dp_degree=4)


# ------------------------------------------------------------------ fleet
FINDINGS = """fd AS (
  SELECT 'node' || CAST(user_id % 16 AS VARCHAR) AS host, CAST(user_id % 128 AS INTEGER) AS rank,
         CAST(row_number() OVER (PARTITION BY user_id % 128 ORDER BY ts, event_id) - 1 AS INTEGER) AS pos,
         CASE event_type WHEN 'error' THEN 'fail' WHEN 'signup' THEN 'warn' ELSE 'info' END AS level,
         event_type AS message, props AS details
  FROM events)"""


@register("fleet_status", f"""WITH {FINDINGS}, g AS (
  SELECT host, rank, count(*) FILTER (WHERE level = 'info') AS n_info, count(*) FILTER (WHERE level = 'warn') AS n_warn,
         count(*) FILTER (WHERE level = 'fail') AS n_fail, GROUPING(host, rank) AS gid
  FROM fd GROUP BY ROLLUP (host, rank))
SELECT CASE gid WHEN 3 THEN 'fleet' WHEN 1 THEN 'host' ELSE 'rank' END AS scope, host, rank, n_info, n_warn, n_fail,
       CASE WHEN n_fail > 0 THEN 'FAIL' WHEN n_warn > 0 THEN 'WARN' ELSE 'OK' END AS status,
       CASE WHEN n_fail > 0 THEN 2 ELSE 0 END AS exit_code
FROM g""")
def q_fleet_status(spark, sf_dir):
    return FL.fleet_status(V.v_findings(spark, sf_dir))


HOST_MESSAGES = ["signup", "purchase", "error"]


@register("host_summary", f"""WITH {FINDINGS}
SELECT host, array_to_string(list_sort(list_distinct(list(rank))), ',') AS ranks,
       arg_min(details, CAST(rank AS BIGINT) * 100000000 + pos) FILTER (WHERE message = 'signup' AND details <> '' AND details <> '{{}}') AS details_signup,
       arg_min(details, CAST(rank AS BIGINT) * 100000000 + pos) FILTER (WHERE message = 'purchase' AND details <> '' AND details <> '{{}}') AS details_purchase,
       arg_min(details, CAST(rank AS BIGINT) * 100000000 + pos) FILTER (WHERE message = 'error' AND details <> '' AND details <> '{{}}') AS details_error,
       CASE WHEN count(*) FILTER (WHERE level = 'fail') > 0 THEN 'FAIL'
            WHEN count(*) FILTER (WHERE level = 'warn') > 0 THEN 'WARN' ELSE 'OK' END AS status
FROM fd GROUP BY host""")
def q_host_summary(spark, sf_dir):
    return FL.host_summary(V.v_findings(spark, sf_dir), HOST_MESSAGES)


@register("gpu_host_summary", f"""WITH {FINDINGS}, m AS (SELECT *, CAST(json_extract(details, '$.k') AS DOUBLE) AS metric FROM fd)
SELECT host, min(metric) AS metric_min, max(metric) AS metric_max, round(avg(metric), 8) AS metric_avg,
       bool_or(metric > 90) AS occupied,
       coalesce(array_to_string(list_sort(list_distinct(list(message) FILTER (WHERE level = 'warn'))), '; '), '') AS warnings,
       CASE WHEN count(*) FILTER (WHERE level = 'fail') > 0 THEN 'FAIL'
            WHEN count(*) FILTER (WHERE level = 'warn') > 0 THEN 'WARN' ELSE 'OK' END AS status
FROM m GROUP BY host""")
def q_gpu_host_summary(spark, sf_dir):
    return FL.gpu_host_summary(V.v_findings(spark, sf_dir))


@register("consistency_check", f"""WITH {FINDINGS}, a AS (
  SELECT host, CASE WHEN rank % 37 = 0 THEN 'v2' ELSE 'v1' END AS fw_version FROM fd)
SELECT host, 'warn' AS level, 'fw_version differs' AS message, count(DISTINCT fw_version) AS n_values,
       array_to_string(list_sort(list_distinct(list(fw_version))), ',') AS "values"
FROM a GROUP BY host HAVING count(DISTINCT fw_version) > 1""")
def q_consistency_check(spark, sf_dir):
    f = V.v_findings(spark, sf_dir).withColumn(
        "fw_version", F.when(F.col("rank") % 37 == 0, "v2").otherwise("v1"))
    return FL.consistency_check(f, ["host"], "fw_version")


@register("below_threshold", """SELECT 'node' || CAST(c_custkey % 16 AS VARCHAR) AS host, c_custkey // 16 AS rank, round(abs(c_acctbal), 8) AS bandwidth, 'warn' AS level
FROM customer WHERE abs(c_acctbal) < 500""")
def q_below_threshold(spark, sf_dir):
    c = table(spark, sf_dir, "customer").selectExpr("concat('node', c_custkey % 16) as host", "c_custkey div 16 as rank", "abs(c_acctbal) as bandwidth")
    return FL.below_threshold(c, "bandwidth", 500.0, ["host", "rank"])


NET = """ne AS (
  SELECT 'node' || CAST(c_custkey % 64 AS VARCHAR) AS host, CAST(c_custkey % 8 AS INTEGER) AS rank,
         [['lo','eth0','ib0'], ['lo','docker0','eth0'], ['lo','veth12ab'], ['lo','eth0','eth1','ib0']][c_custkey % 4 + 1] AS nics,
         ['eth0','docker0','','ib0','veth12ab'][c_custkey % 5 + 1] AS ifname,
         ['eth0','docker0','','ib0','veth12ab'][(c_custkey // 3) % 5 + 1] AS gloo,
         CASE WHEN c_custkey % 6 = 0 THEN 'eth1' ELSE 'eth0' END AS route_dev,
         CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'mlx5_0' END AS hca,
         CASE WHEN c_custkey % 11 = 0 THEN '2' WHEN c_custkey % 2 = 0 THEN '0' ELSE '1' END AS ib_disable,
         c_custkey % 5 <> 0 AS has_ib, c_custkey
  FROM customer),
nx AS (
  SELECT *, (hca <> '' OR starts_with(ifname, 'ib') OR len(list_filter(nics, lambda x: starts_with(x, 'ib'))) > 0) AS expected_ib,
         (ifname IN ('lo', 'docker0') OR starts_with(ifname, 'veth') OR gloo IN ('lo', 'docker0') OR starts_with(gloo, 'veth')) AS suspect
  FROM ne)"""


@register("network_checks", f"""WITH {NET}
SELECT host, rank, 'warn' AS level, 'NCCL_SOCKET_IFNAME does not match any visible NIC' AS message FROM nx WHERE ifname <> '' AND NOT list_contains(nics, ifname)
UNION ALL SELECT host, rank, 'warn', 'GLOO_SOCKET_IFNAME does not match any visible NIC' FROM nx WHERE gloo <> '' AND NOT list_contains(nics, gloo)
UNION ALL SELECT host, rank, 'warn', 'IFNAME looks suspect (lo/docker0/veth)' FROM nx WHERE suspect
UNION ALL SELECT host, rank, 'warn', 'Socket IFNAME does not match route-to-master interface (may hang init_process_group)' FROM nx
  WHERE (ifname <> '' AND ifname <> route_dev) OR (gloo <> '' AND gloo <> route_dev)
UNION ALL SELECT host, rank, 'warn', 'NCCL_IB_DISABLE has an unexpected value' FROM nx WHERE ib_disable NOT IN ('0', '1')
UNION ALL SELECT host, rank, 'warn', 'IB expected but not enabled/available' FROM nx WHERE expected_ib AND (ib_disable = '1' OR NOT has_ib)
UNION ALL SELECT host, rank, 'warn', 'NCCL_IB_HCA not set (may fall back to socket)' FROM nx WHERE expected_ib AND hca = ''
UNION ALL SELECT host, rank, 'info', unnest(['NIC and network path', 'InfiniBand / RDMA', 'RCCL/NCCL snapshot']) FROM nx""")
def q_network_checks(spark, sf_dir):
    return FL.network_checks(V.v_network_env(spark, sf_dir))


@register("network_findings", f"""WITH {NET}, x AS (
  SELECT nx.*, '10.0.' || CAST(c_custkey % 64 AS VARCHAR) || '.' || CAST(c_custkey % 8 AS VARCHAR) AS ip,
         CASE WHEN c_custkey % 3 = 0 THEN 'PHB' END AS gdr, CASE WHEN c_custkey % 4 = 1 THEN 'INFO' END AS debug,
         CASE WHEN has_ib THEN ['mlx5_0', 'mlx5_1'] ELSE [] END AS devices,
         CASE WHEN ib_disable = '1' THEN 'disabled' WHEN NOT has_ib THEN 'absent' ELSE 'enabled' END AS ib_status,
         ifname <> '' AND NOT list_contains(nics, ifname) AS nccl_bad, gloo <> '' AND NOT list_contains(nics, gloo) AS gloo_bad
  FROM nx),
y AS (SELECT *, json_object('ib', json_object('NCCL_IB_DISABLE', ib_disable, 'expected_ib', expected_ib, 'has_ib', has_ib, 'ib_devices', devices, 'ib_status', ib_status)) AS fabric,
         json_object('GLOO_SOCKET_IFNAME', gloo, 'NCCL_SOCKET_IFNAME', ifname) AS names FROM x)
SELECT host, rank, 'warn' AS level, 'NCCL_SOCKET_IFNAME does not match any visible NIC' AS message,
       json_object('available_nics', nics, 'ifname', ifname)::VARCHAR AS details FROM y WHERE nccl_bad
UNION ALL SELECT host, rank, 'warn', 'GLOO_SOCKET_IFNAME does not match any visible NIC', json_object('available_nics', nics, 'ifname', gloo)::VARCHAR FROM y WHERE gloo_bad
UNION ALL SELECT host, rank, 'warn', 'IFNAME looks suspect (lo/docker0/veth)', names::VARCHAR FROM y WHERE suspect
UNION ALL SELECT host, rank, 'info', 'NIC and network path', json_object('nics', json_object('GLOO_SOCKET_IFNAME', gloo, 'NCCL_SOCKET_IFNAME', ifname,
  'available_nics', nics, 'ifname_suspect', suspect, 'ifname_valid', NOT nccl_bad AND NOT gloo_bad, 'route_to_master_dev', route_dev,
  'route_to_master_ok', true, 'route_to_master_src_ip', ip))::VARCHAR FROM y
UNION ALL SELECT host, rank, 'warn', 'Socket IFNAME does not match route-to-master interface (may hang init_process_group)',
  json_object('GLOO_SOCKET_IFNAME', gloo, 'NCCL_SOCKET_IFNAME', ifname, 'suggested_dev', route_dev)::VARCHAR FROM y
  WHERE (ifname <> '' AND ifname <> route_dev) OR (gloo <> '' AND gloo <> route_dev)
UNION ALL SELECT host, rank, 'warn', 'NCCL_IB_DISABLE has an unexpected value', json_object('NCCL_IB_DISABLE', ib_disable)::VARCHAR FROM y WHERE ib_disable NOT IN ('0', '1')
UNION ALL SELECT host, rank, 'info', 'InfiniBand / RDMA', fabric::VARCHAR FROM y
UNION ALL SELECT host, rank, 'warn', 'IB expected but not enabled/available', fabric::VARCHAR FROM y WHERE expected_ib AND ib_status <> 'enabled'
UNION ALL SELECT host, rank, 'info', 'RCCL/NCCL snapshot', json_object('rccl', json_object('NCCL_DEBUG', debug, 'NCCL_IB_HCA', hca, 'NCCL_NET_GDR_LEVEL', gdr,
  'NCCL_SOCKET_IFNAME', ifname))::VARCHAR FROM y
UNION ALL SELECT host, rank, 'warn', 'NCCL_IB_HCA not set (may fall back to socket)', json_object('NCCL_IB_HCA', '')::VARCHAR FROM y WHERE expected_ib AND hca = ''""")
def q_network_findings(spark, sf_dir):
    return FL.network_findings(V.v_network_env(spark, sf_dir)).withColumn("details", F.to_json("details"))


@register("gpu_host_report", """WITH g AS (
  SELECT 'node' || CAST(c_custkey % 16 AS VARCHAR) AS host, CAST(c_custkey // 16 AS INTEGER) AS rank, c_custkey AS k, abs(c_acctbal) AS a FROM customer),
h AS (
  SELECT host, array_to_string(list_sort(list(rank)), ',') AS ranks,
    arg_min(CASE WHEN k % 4 = 0 THEN 'MI300X' ELSE (CASE WHEN k % 10 = 0 THEN '' ELSE 'MI300X' END) || '/gfx942' END, rank)
      FILTER (WHERE k % 9 <> 0 AND NOT (k % 10 = 0 AND k % 4 = 0)) AS gpu_type_arch,
    coalesce(arg_min(CASE WHEN k % 5 <> 0 AND k % 7 <> 0 THEN 8 ELSE 2 END, rank) FILTER (WHERE (k % 5 <> 0 AND k % 7 <> 0) OR k % 9 <> 0), 0) AS gpu_count,
    min(190.5 + k % 3) FILTER (WHERE k % 9 <> 0) AS total_memory_gb_min,
    CASE WHEN count(*) FILTER (WHERE k % 9 <> 0) > 0 THEN 256.0 END AS total_memory_gb_max,
    min(a / 64) FILTER (WHERE k % 9 <> 0) AS min_free_gb, coalesce(bool_or(k % 90 = 0), false) AS occupied,
    arg_min('6.' || CAST(k % 4 AS VARCHAR), rank) FILTER (WHERE k % 5 <> 0 AND k % 3 <> 0) AS amdgpu_version,
    arg_min('7.0.' || CAST(k % 2 AS VARCHAR), rank) FILTER (WHERE k % 5 <> 0) AS rocm_version,
    arg_min(k % 6 = 1, rank) FILTER (WHERE k % 4 <> 0) AS numa_imbalance,
    CASE WHEN bool_or(k % 32 = 1) THEN true END AS topo_pcie_hint,
    arg_max(k % 48 = 2, rank) FILTER (WHERE k % 16 < 4) AS nccl_ib_hca_set,
    list_sort(list_distinct(flatten(list(list_filter([
      CASE WHEN k % 90 = 0 THEN 'GPU occupied by other processes (amd-smi)' END,
      CASE WHEN k % 32 = 1 THEN 'Topology indicates PCIe paths; XGMI may be absent' END,
      CASE WHEN k % 16 < 4 THEN 'NCCL_IB_HCA not set (may fall back to socket)' END], lambda x: x IS NOT NULL))))) AS w,
    bool_or(k % 160 = 5) AS fail, count(*) FILTER (WHERE k % 13 <> 0 AND k % 2 <> 0) > 0 AS shaped,
    min(a / 8) FILTER (WHERE k % 13 <> 0) AS tflops_min, max(a / 8) FILTER (WHERE k % 13 <> 0) AS tflops_max, avg(a / 8) FILTER (WHERE k % 13 <> 0) AS tflops_avg,
    min(a / 1024) FILTER (WHERE k % 13 <> 0) AS ms_min, max(a / 1024) FILTER (WHERE k % 13 <> 0) AS ms_max, avg(a / 1024) FILTER (WHERE k % 13 <> 0) AS ms_avg,
    arg_max(k * 1024, rank)::BIGINT AS alloc_bytes
  FROM g GROUP BY host)
SELECT host, ranks, CASE WHEN fail THEN 'FAIL' WHEN len(w) > 0 THEN 'WARN' ELSE 'OK' END AS status, gpu_type_arch, gpu_count,
  round(total_memory_gb_min, 8) AS total_memory_gb_min, round(total_memory_gb_max, 8) AS total_memory_gb_max, round(min_free_gb, 8) AS min_free_gb,
  occupied, amdgpu_version, rocm_version, numa_imbalance, topo_pcie_hint, nccl_ib_hca_set, coalesce(array_to_string(w, '; '), '') AS warnings,
  CASE WHEN shaped THEN 4096 END AS m, CASE WHEN shaped THEN 4096 END AS n, CASE WHEN shaped THEN 8192 END AS k,
  round(tflops_min, 8) AS tflops_min, round(tflops_max, 8) AS tflops_max, round(tflops_avg, 8) AS tflops_avg,
  round(ms_min, 8) AS ms_min, round(ms_max, 8) AS ms_max, round(ms_avg, 8) AS ms_avg, alloc_bytes
FROM h""")
def q_gpu_host_report(spark, sf_dir):
    return FL.gpu_host_report(V.v_gpu_findings(spark, sf_dir))


@register("gather_records", f"""WITH {FINDINGS}
SELECT host, rank, message, details, NULL::VARCHAR AS warning, NULL::VARCHAR AS info_details, 128 AS world FROM fd WHERE level = 'fail'
UNION ALL SELECT host, rank, NULL, NULL, message, NULL, 128 FROM fd WHERE level = 'warn'
UNION ALL SELECT host, rank, NULL, NULL, NULL, details, 128 FROM fd WHERE level = 'info' AND details IS NOT NULL""")
def q_gather_records(spark, sf_dir):
    f = V.v_findings(spark, sf_dir)
    fail = f.filter(F.col("level") == "fail").select("host", "rank", "message", "details")
    warn = f.filter(F.col("level") == "warn").select("host", "rank", F.col("message").alias("warning"))
    info = f.filter(F.col("level") == "info").select("host", "rank", F.col("details").alias("info_details"))
    return FL.gather_records([fail, warn, info], world=128) \
        .select("host", "rank", "message", "details", "warning", "info_details", "world")


# ------------------------------------------------------------------ pipeline
LI_ORDER = ", ".join(LINEITEM_ORDER)
PIPE = f"""pb AS (
  SELECT *, l_returnflag AS task, CAST(l_suppkey % 5 AS INTEGER) AS it, CAST(l_linenumber - 1 AS INTEGER) AS pp_rank,
         ['fwd', 'bwd', 'wgrad'][l_partkey % 3 + 1] AS series, CAST(l_orderkey % 1000 AS DOUBLE) AS start_ms,
         CAST(l_orderkey % 1000 AS DOUBLE) + l_quantity AS end_ms
  FROM lineitem),
pe AS (
  SELECT task, it AS iter, pp_rank, series, start_ms, end_ms,
         row_number() OVER (PARTITION BY task, it, pp_rank, series ORDER BY {LI_ORDER}) - 1 AS ord,
         max(end_ms) OVER (PARTITION BY task, it, pp_rank) AS total, CAST(pp_rank * 1.5 + it AS DOUBLE) AS memory
  FROM pb)"""


@register("pipeline_bubble", f"""WITH {PIPE},
pr AS (SELECT task, iter, pp_rank, sum(end_ms - start_ms) FILTER (WHERE series = 'fwd') AS f_ms,
              sum(end_ms - start_ms) FILTER (WHERE series = 'bwd') AS b_ms,
              coalesce(sum(end_ms - start_ms) FILTER (WHERE series = 'wgrad'), 0.0) AS w_ms
       FROM pe WHERE ord < 4 GROUP BY ALL),
it AS (SELECT task, iter, max(total) AS iter_ms FROM pe GROUP BY ALL)
SELECT task, iter, pp_rank, iter_ms, f_ms, b_ms, w_ms,
       round(CASE WHEN iter_ms > 0 THEN coalesce(f_ms, 0) / iter_ms * 100 ELSE 0.0 END, 8) AS f_pct,
       round(CASE WHEN iter_ms > 0 THEN coalesce(b_ms, 0) / iter_ms * 100 ELSE 0.0 END, 8) AS b_pct,
       round(CASE WHEN iter_ms > 0 THEN w_ms / iter_ms * 100 ELSE 0.0 END, 8) AS w_pct,
       round(CASE WHEN iter_ms <> 0 THEN (iter_ms - coalesce(f_ms, 0) - coalesce(b_ms, 0) - w_ms) * 100 / iter_ms END, 8) AS bubble_pct
FROM pr JOIN it USING (task, iter)""")
def q_pipeline_bubble(spark, sf_dir):
    return TL.pipeline_bubble(V.v_pipeline(spark, sf_dir), vp_size=1, num_mbs=4)


@register("pipeline_summary", f"""WITH {PIPE},
r AS (SELECT task, iter, pp_rank, max(total) AS total, max(memory) AS memory FROM pe GROUP BY ALL)
SELECT task, iter, max(total) AS step_time_ms, arg_max(pp_rank, total * 1000 - pp_rank) AS critical_rank,
       max(memory) AS max_memory, count(*) AS pp_size
FROM r GROUP BY task, iter""")
def q_pipeline_summary(spark, sf_dir):
    return TL.pipeline_summary(V.v_pipeline(spark, sf_dir))

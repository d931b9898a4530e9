"""Registered queries and DuckDB oracles of the training-log jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepfold.operators import trainlog as T
from stepfold.operators import windows as W
from stepfold.plans import views_logs as V
from stepfold.plans.finalize import rounded
from stepfold.plans.tables import table

QUERIES = {}
ORACLE = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ oracle views (typed)
STEPS = """v_steps AS (
  SELECT user_id AS run,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS iter,
         round(value*10+50, 1) AS elapsed_ms, round(value, 1) AS tflops, round(value*20, 1) AS tokens,
         CAST(64*(1+user_id%4) AS INTEGER) AS gbs, event_id, event_type, ts, value
  FROM events)"""
MPATH = "'logs/megatron/run_' || CAST(run AS VARCHAR) || '.log'"
IPATH = "'logs/megatron_avg/run_' || CAST(run AS VARCHAR) || '.log'"
TPATH = "'logs/torchtitan/run_' || CAST(run AS VARCHAR) || '.log'"
XPATH = "'logs/maxtext/run_' || CAST(run AS VARCHAR) || '.log'"
INST = STEPS + """, v_inst AS (
  SELECT *, round(value*10+45, 0) AS elapsed_avg, round(value*2, 1) AS tflops_avg,
         round(value*40, 1) AS tokens_avg, round(value/5+10, 2) AS mem_used
  FROM v_steps)"""
TITAN = STEPS + """, titan_base AS (
  SELECT run, iter, event_id, event_type, 0 AS rank, CAST(iter*10 AS BIGINT) AS line_no,
         round(value/5+10, 2) AS memory, round(value*20, 0) AS tps, tflops, round(value/5, 2) AS mfu
  FROM v_steps),
v_titan AS (
  SELECT * FROM titan_base
  UNION ALL SELECT run, iter, event_id, event_type, rank, line_no+1, memory+1, tps+1, tflops+1, mfu+1
    FROM titan_base WHERE event_type = 'view'
  UNION ALL SELECT run, iter, event_id, event_type, 1, line_no+2, memory+2, tps+2, tflops+2, mfu+2
    FROM titan_base WHERE event_id % 4 = 0)"""
MAXTEXT = STEPS + """, mx_base AS (
  SELECT run, iter, event_id, event_type, CAST(iter*10 AS BIGINT) AS line_no,
         round(value/10, 3) AS seconds, tflops, tokens, round(value/10 + 2, 3) AS loss
  FROM v_steps),
v_maxtext AS (
  SELECT * FROM mx_base
  UNION ALL SELECT run, iter, event_id, event_type, line_no+1, round(seconds+1, 3), tflops+1, tokens+1, loss
    FROM mx_base WHERE event_type = 'view')"""


def _mlines(spark, sf_dir):
    return V.v_train_log(spark, sf_dir)


@register("megatron_steps", f"""WITH {STEPS}
SELECT {MPATH} AS path, CAST(iter*2 AS BIGINT) AS line_no, CAST(iter AS BIGINT) AS iter,
       elapsed_ms, tflops AS tflops_gpu, tokens AS tokens_gpu, CAST(gbs AS BIGINT) AS gbs
FROM v_steps""")
def q_megatron_steps(spark, sf_dir):
    return T.parse_megatron_steps(_mlines(spark, sf_dir))


MEGATRON_AVG_SQL = f"""WITH {STEPS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY iter) AS rn FROM v_steps)
SELECT {MPATH} AS path, CAST(count(*) AS BIGINT) AS n_steps,
       round(avg(elapsed_ms), 8) AS elapsed_ms, round(avg(tflops), 8) AS tflops_gpu,
       round(avg(tokens), 8) AS tokens_gpu, CAST(arg_min(gbs, rn) AS BIGINT) AS gbs
FROM ranked WHERE rn > 2 GROUP BY run"""


@register("megatron_averages", MEGATRON_AVG_SQL)
def q_megatron_averages(spark, sf_dir):
    return T.megatron_averages(T.parse_megatron_steps(_mlines(spark, sf_dir)))


@register("strip_ansi", f"""WITH {STEPS}
SELECT {MPATH} AS path,
       CAST(count(*) + count(*) FILTER (WHERE event_id % 10 = 0) + CASE WHEN run % 5 <> 0 THEN 2 ELSE 1 END AS BIGINT) AS n_lines,
       CAST(sum(CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_cleaned,
       CAST(sum(CASE WHEN event_id % 7 = 0 THEN 9 ELSE 0 END) AS BIGINT) AS chars_removed,
       CAST(sum(length(printf('[%s][user/team][trainer][ip-10-0-0-1][rank-7/8][INFO]', strftime(ts, '%Y%m%d %H:%M:%S')))) AS BIGINT) AS header_chars
FROM v_steps GROUP BY run""")
def q_strip_ansi(spark, sf_dir):
    """Per file: all lines, lines that carried escape codes, characters removed, and header
    characters left after stripping (a step line's header ends at ``[INFO]``)."""
    lines = _mlines(spark, sf_dir).withColumn("_raw", F.col("line"))
    header = F.instr("line", "[INFO]")
    return T.strip_ansi_lines(lines).groupBy("path").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count(F.when(F.col("_raw") != F.col("line"), 1)).alias("n_cleaned"),
        F.sum(F.length("_raw") - F.length("line")).cast("long").alias("chars_removed"),
        F.sum(F.when(header > 0, header + 5).otherwise(0)).cast("long").alias("header_chars"))


@register("enrich_train_log", f"""WITH {STEPS}, a AS (
  SELECT *, avg(elapsed_ms) OVER w + 1e-6 AS ea, avg(tflops) OVER w + 1e-6 AS ta, avg(tokens) OVER w + 1e-6 AS ka FROM v_steps
  WINDOW w AS (PARTITION BY run, iter > 2, (iter - 3) // 10 ORDER BY iter ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT {MPATH} AS path, CAST(iter*2 AS BIGINT) AS line_no,
  printf('[%s][user/team][trainer][ip-10-0-0-1][rank-7/8][INFO] iteration %8d/%8d', strftime(ts, '%Y%m%d %H:%M:%S'), iter, 100000)
  || printf(' | consumed samples: %12d', iter * gbs)
  || CASE WHEN iter > 2 THEN printf(' | elapsed time per iteration (ms): %.1f/%.1f | throughput per GPU (TFLOP/s/GPU): %.1f/%.1f'
       || ' | tokens per GPU (tokens/s/GPU): %.1f/%.1f', elapsed_ms, ea, tflops, ta, tokens, ka)
     ELSE printf(' | elapsed time per iteration (ms): %.1f | throughput per GPU (TFLOP/s/GPU): %.1f', elapsed_ms, tflops) END
  || ' | tokens per GPU (tokens/s/GPU): ' || CASE WHEN event_id % 3 = 0 THEN format('{{:,.1f}}', tokens) ELSE printf('%.1f', tokens) END
  || printf(' | learning rate: 1.000000E-04 | global batch size: %5d | ', gbs) || printf('lm loss: %.6E', value / 10 + 1)
  || ' | loss scale: 1.0 | number of skipped iterations:   0 | number of nan iterations:   0' AS line
FROM a""")
def q_enrich_train_log(spark, sf_dir):
    """Every step line rewritten with its running averages (a tiny offset keeps means off rounding ties)."""
    lines = T.strip_ansi_lines(_mlines(spark, sf_dir))
    avg = W.running_averages(T.parse_megatron_steps(lines), ["elapsed_ms", "tflops_gpu", "tokens_gpu"])
    avg = avg.select("path", "line_no", (F.col("elapsed_ms_avg") + 1e-6).alias("elapsed_avg"),
                     (F.col("tflops_gpu_avg") + 1e-6).alias("tflops_avg"), F.col("tokens_gpu").alias("tokens_inst"),
                     (F.col("tokens_gpu_avg") + 1e-6).alias("tokens_avg"))
    return T.enrich_train_log(T.parse_train_log(lines), avg)


@register("parse_train_log", f"""WITH {STEPS}
SELECT {MPATH} AS path, CAST(iter*2 AS BIGINT) AS line_no, CAST(iter AS BIGINT) AS iteration,
       CAST(100000 AS BIGINT) AS train_iters, CAST(iter*gbs AS BIGINT) AS consumed_samples,
       elapsed_ms, tflops AS throughput_tflops, CAST(gbs AS BIGINT) AS global_batch_size,
       CAST(CASE WHEN event_id % 11 = 0 THEN 3 ELSE 2 END AS INTEGER) AS elapsed_index,
       CAST(CASE WHEN event_id % 11 = 0 THEN 4 ELSE 3 END AS INTEGER) AS throughput_index,
       CAST(CASE WHEN event_id % 11 = 0 THEN 13 ELSE 12 END AS INTEGER) AS n_segments
FROM v_steps""")
def q_parse_train_log(spark, sf_dir):
    p = T.parse_train_log(_mlines(spark, sf_dir))
    return p.select("path", "line_no", "iteration", "train_iters", "consumed_samples", "elapsed_ms",
                    "throughput_tflops", "global_batch_size", "elapsed_index", "throughput_index",
                    F.size("segments").alias("n_segments"))


@register("inst_avg_steps", f"""WITH {INST}
SELECT {IPATH} AS path, CAST(iter*2 AS BIGINT) AS line_no, CAST(iter AS BIGINT) AS iter,
       elapsed_ms, elapsed_avg AS elapsed_ms_avg, tflops, tflops_avg, tokens, tokens_avg,
       mem_used AS mem_used_gb,
       CASE WHEN run % 3 = 0 THEN NULL ELSE round(192 - mem_used, 2) END AS mem_free_gb,
       CASE WHEN run % 3 = 0 THEN NULL ELSE 192.0 END AS mem_total_gb,
       CASE WHEN run % 3 = 0 THEN NULL ELSE round(mem_used/192*100, 2) END AS mem_ratio_pct
FROM v_inst""")
def q_inst_avg_steps(spark, sf_dir):
    return T.parse_inst_avg_steps(V.v_inst_log(spark, sf_dir))


@register("last_step_metrics", f"""WITH {INST}
SELECT {IPATH} AS path, arg_max(tflops_avg, iter) AS tflops_gpu,
       round(arg_max(elapsed_avg, iter) / 1000.0, 8) AS step_time_s,
       arg_max(tokens_avg, iter) AS tokens_gpu, arg_max(mem_used, iter) AS mem_usage
FROM v_inst GROUP BY run""")
def q_last_step_metrics(spark, sf_dir):
    return T.last_step_metrics(T.parse_inst_avg_steps(V.v_inst_log(spark, sf_dir)))


@register("last_step_blend", f"""WITH {INST}
SELECT {IPATH} AS path, greatest(arg_max(tflops, iter), arg_max(tflops_avg, iter)) AS tflops_gpu,
       round((arg_max(elapsed_ms, iter) + arg_max(elapsed_avg, iter)) / 2000.0, 8) AS step_time_s,
       round((arg_max(tokens, iter) + arg_max(tokens_avg, iter)) / 2, 8) AS tokens_gpu,
       arg_max(mem_used, iter) AS mem_usage
FROM v_inst GROUP BY run""")
def q_last_step_blend(spark, sf_dir):
    return T.last_step_blend(T.parse_inst_avg_steps(V.v_inst_log(spark, sf_dir)))


@register("titan_steps", f"""WITH {TITAN}
SELECT {TPATH} AS path, line_no, CAST(iter AS BIGINT) AS step, memory AS memory_gib, tps, tflops, mfu,
       CAST(1 + run % 8 AS BIGINT) AS local_batch_size, CAST(1024*(1 + run % 4) AS BIGINT) AS seq_len
FROM v_titan""")
def q_titan_steps(spark, sf_dir):
    return T.parse_titan_steps(V.v_titan_log(spark, sf_dir))


@register("titan_averages", f"""WITH {TITAN}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY iter, line_no) AS rn FROM v_titan)
SELECT {TPATH} AS path, CAST(count(*) AS BIGINT) AS n_steps, round(avg(memory), 8) AS memory_gib,
       round(avg(tps), 8) AS tps, round(avg(tflops), 8) AS tflops, round(avg(mfu), 8) AS mfu,
       CAST(1 + run % 8 AS BIGINT) AS local_batch_size, CAST(1024*(1 + run % 4) AS BIGINT) AS seq_len
FROM ranked WHERE rn > 2 GROUP BY run""")
def q_titan_averages(spark, sf_dir):
    return T.titan_averages(T.parse_titan_steps(V.v_titan_log(spark, sf_dir)))


@register("maxtext_steps", f"""WITH {MAXTEXT}
SELECT {XPATH} AS path, line_no, CAST(iter AS BIGINT) AS step, seconds, tflops, tokens, loss
FROM v_maxtext""")
def q_maxtext_steps(spark, sf_dir):
    return T.parse_maxtext_steps(V.v_maxtext_log(spark, sf_dir))


@register("all_step_means", f"""WITH {TITAN}
SELECT {TPATH} AS path, round(avg(tflops), 8) AS tflops_gpu, round(avg(tps), 8) AS tokens_gpu,
       round(avg(memory), 8) AS mem_usage, CAST(count(*) AS BIGINT) AS n_steps
FROM v_titan WHERE rank = 0 GROUP BY run""")
def q_all_step_means(spark, sf_dir):
    return T.all_step_means(T.parse_titan_daily_steps(V.v_titan_log(spark, sf_dir)))


DEDUP_SQL = f"""WITH {MAXTEXT}, last AS (
  SELECT run, iter, arg_max(seconds, line_no) AS seconds, arg_max(tflops, line_no) AS tflops,
         arg_max(tokens, line_no) AS tokens FROM v_maxtext GROUP BY run, iter)"""


@register("dedup_step_means", DEDUP_SQL + f"""
SELECT {XPATH} AS path, round(avg(tflops), 8) AS tflops_gpu, round(avg(tokens), 8) AS tokens_gpu,
       round(avg(seconds), 8) AS step_time_s, CAST(count(*) AS BIGINT) AS n_steps
FROM last GROUP BY run""")
def q_dedup_step_means(spark, sf_dir):
    return T.dedup_step_means(T.parse_maxtext_steps(V.v_maxtext_log(spark, sf_dir)))


@register("daily_report", f"""WITH {INST}, {TITAN[len(STEPS) + 2:]}, {MAXTEXT[len(STEPS) + 2:]},
last AS (
  SELECT run, iter, arg_max(seconds, line_no) AS seconds, arg_max(tflops, line_no) AS tflops,
         arg_max(tokens, line_no) AS tokens FROM v_maxtext GROUP BY run, iter)
SELECT {IPATH} AS path, 'megatron' AS framework, arg_max(tflops_avg, iter) AS tflops_gpu,
       round(arg_max(elapsed_avg, iter) / 1000.0, 8) AS step_time_s,
       arg_max(tokens_avg, iter) AS tokens_gpu, arg_max(mem_used, iter) AS mem_usage
FROM v_inst GROUP BY run
UNION ALL
SELECT {TPATH}, 'torchtitan', round(avg(tflops), 8), NULL, round(avg(tps), 8), round(avg(memory), 8)
FROM v_titan WHERE rank = 0 GROUP BY run
UNION ALL
SELECT {XPATH}, 'maxtext', round(avg(tflops), 8), round(avg(seconds), 8), round(avg(tokens), 8), NULL
FROM last GROUP BY run""")
def q_daily_report(spark, sf_dir):
    return T.daily_report(V.v_inst_log(spark, sf_dir), V.v_titan_log(spark, sf_dir),
                          V.v_maxtext_log(spark, sf_dir)) \
        .select("path", "framework", "tflops_gpu", "step_time_s", "tokens_gpu", "mem_usage")


@register("run_completion", f"""WITH {STEPS}
SELECT DISTINCT {MPATH} AS path FROM v_steps WHERE run % 5 = 0""")
def q_run_completion(spark, sf_dir):
    return T.run_completion(_mlines(spark, sf_dir))


ARGS = STEPS + """, runs AS (SELECT DISTINCT run FROM v_steps)"""


@register("parse_arguments", f"""WITH {ARGS}
SELECT 'logs/args/run_' || CAST(run AS VARCHAR) || '.log' AS path, k AS key, v AS value
FROM runs, LATERAL (VALUES
  ('data_parallel_size', CAST(CAST(pow(2, run % 4) AS BIGINT) AS VARCHAR)),
  ('tensor_model_parallel_size', CAST(1 + run % 2 AS VARCHAR)),
  ('pipeline_model_parallel_size', CAST(1 + run % 3 AS VARCHAR)),
  ('expert_model_parallel_size', CAST(CAST(pow(2, run % 3) AS BIGINT) AS VARCHAR)),
  ('expert_tensor_parallel_size', '1'),
  ('use_torch_fsdp2', CASE WHEN run % 5 = 0 THEN 'True' ELSE 'False' END),
  ('recompute_granularity', CASE WHEN run % 2 = 0 THEN 'full' ELSE 'selective' END),
  ('recompute_method', CASE WHEN run % 2 = 0 THEN 'block' ELSE 'None' END),
  ('recompute_num_layers', CAST(run % 4 AS VARCHAR)),
  ('seq_length', CAST(1024 * (1 + run % 4) AS VARCHAR)),
  ('micro_batch_size', CAST(2 + run % 3 AS VARCHAR)),
  ('global_batch_size', CAST(64 * (1 + run % 4) AS VARCHAR))) AS t(k, v)""")
def q_parse_arguments(spark, sf_dir):
    return T.parse_arguments(V.v_args(spark, sf_dir))


@register("run_dimensions", f"""WITH {ARGS}
SELECT 'logs/args/run_' || CAST(run AS VARCHAR) || '.log' AS path,
  CAST(CAST(pow(2, run % 4) AS BIGINT) AS VARCHAR) AS dp, CAST(1 + run % 2 AS VARCHAR) AS tp,
  CAST(1 + run % 3 AS VARCHAR) AS pp, CAST(CAST(pow(2, run % 3) AS BIGINT) AS VARCHAR) AS ep,
  '1' AS etp, CASE WHEN run % 5 = 0 THEN 'True' ELSE 'False' END AS fsdp,
  CASE WHEN run % 2 = 0 THEN 'full/block/' ELSE 'selective/None/' END || CAST(run % 4 AS VARCHAR) AS recompute
FROM runs""")
def q_run_dimensions(spark, sf_dir):
    return T.run_dimensions(T.parse_arguments(V.v_args(spark, sf_dir)))


@register("running_averages", f"""WITH {STEPS}
SELECT {MPATH} AS path, CAST(iter*2 AS BIGINT) AS line_no, CAST(iter AS BIGINT) AS iter,
  elapsed_ms, tflops AS tflops_gpu, tokens AS tokens_gpu,
  CASE WHEN iter > 2 THEN round(avg(elapsed_ms) OVER w, 8) END AS elapsed_ms_avg,
  CASE WHEN iter > 2 THEN round(avg(tflops) OVER w, 8) END AS tflops_gpu_avg,
  CASE WHEN iter > 2 THEN round(avg(tokens) OVER w, 8) END AS tokens_gpu_avg
FROM v_steps
WINDOW w AS (PARTITION BY run, iter > 2, (iter - 3) // 10 ORDER BY iter
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_running_averages(spark, sf_dir):
    steps = T.parse_megatron_steps(_mlines(spark, sf_dir))
    return W.running_averages(steps, ["elapsed_ms", "tflops_gpu", "tokens_gpu"])


@register("running_averages_legacy", f"""WITH {STEPS}
SELECT {MPATH} AS path, CAST(iter*2 AS BIGINT) AS line_no, CAST(iter AS BIGINT) AS iter,
  elapsed_ms, tflops AS tflops_gpu, tokens AS tokens_gpu,
  round(avg(elapsed_ms) OVER w, 8) AS elapsed_ms_avg,
  round(avg(tflops) OVER w, 8) AS tflops_gpu_avg,
  round(avg(tokens) OVER w, 8) AS tokens_gpu_avg
FROM v_steps
WINDOW w AS (PARTITION BY run, iter > 2,
             CASE WHEN iter > 2 THEN (iter - 3) // 10 ELSE (iter - 1) // 10 END ORDER BY iter
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_running_averages_legacy(spark, sf_dir):
    steps = T.parse_megatron_steps(_mlines(spark, sf_dir))
    return W.running_averages(steps, ["elapsed_ms", "tflops_gpu", "tokens_gpu"], legacy=True)


# A line with metrics in the layout of each framework, and one without.
STEP_LINES = {
    "megatron": " iteration        3/      50 | consumed samples:          384 | elapsed time per iteration (ms): 6046.6 | throughput per GPU (TFLOP/s/GPU): 1255.4 | "
                "tokens per GPU (tokens/s/GPU): 1234.5 | learning rate: 1.000000E-04 | global batch size:   128 | lm loss: 1.100000E+00 | loss scale: 1.0 | "
                "number of skipped iterations:   0 | number of nan iterations:   0 |",
    "torchtitan": "[2024-01-01 00:00:00][user/team][trainer][ip-10-0-0-1][rank-0/8][INFO] step: 3  loss: 1.2345  grad_norm: 0.5000  memory: 10.00GiB(5.00%)  tps: 1,234  tflops: 100.00  mfu: 10.00%",
    "maxtext": "[2024-01-01 00:00:00][INFO] completed step: 3, seconds: 1.234, TFLOP/s/device: 100.000, Tokens/s/device: 1234.000, total_weights: 1024, loss: 1.234"}
FOLDERS = [*STEP_LINES, "jaxrun"]


@register("daily_report_errors", f"""WITH f AS (SELECT s_suppkey AS k, {FOLDERS}[s_suppkey % 4 + 1] AS framework FROM supplier)
SELECT concat('logs/', framework, '/job_', k, '.log') AS path,
  CASE WHEN framework = 'jaxrun' THEN 'unknown framework' ELSE 'no valid iteration metrics' END AS error
FROM f WHERE framework = 'jaxrun' OR k % 3 = 0""")
def q_daily_report_errors(spark, sf_dir):
    """A log for each supplier: a note, and a step line in two of three; every fourth is of a framework that isn't known."""
    k = F.col("s_suppkey")
    framework = F.element_at(F.array(*map(F.lit, FOLDERS)), (k % 4 + 1).cast("int"))
    step = F.create_map(*[F.lit(x) for name, line in [*STEP_LINES.items(), ("jaxrun", STEP_LINES["maxtext"])] for x in (name, line)])[framework]
    notes = F.array(F.lit("iteration of a plan, step by step"), F.when(k % 3 != 0, step).otherwise("stopped"))
    lines = table(spark, sf_dir, "supplier").select(F.concat(F.lit("logs/"), framework, F.lit("/job_"), k.cast("string"), F.lit(".log")).alias("path"),
                                                    F.posexplode(notes).alias("line_no", "line"))
    return T.daily_report_errors(lines)

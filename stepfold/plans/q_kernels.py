"""Registered queries and oracles of the kernel benchmark jobs (from ``lineitem``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepfold.operators import kernels as KB
from stepfold.plans.finalize import rounded
from stepfold.plans.tables import table

QUERIES = {}
ORACLE = {}
MODELS = list(KB.MODEL_CONFIGS)
MBS = [1, 2]


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _arr(xs):
    return F.array(*[F.lit(x) for x in xs])


def v_kernel_results(spark, sf_dir):
    """(host, rank, model, shape, phase, mbs, dtype, ms); the model name is
    written in varying case (the lookup is case-insensitive)."""
    li = table(spark, sf_dir, "lineitem")
    model = F.element_at(_arr(MODELS), (F.col("l_partkey") % len(MODELS) + 1).cast("int"))
    model = F.when(F.col("l_orderkey") % 5 == 0, F.upper(model)).otherwise(model)
    # the last shape, 'vocab', is never measured
    shape = F.element_at(_arr(KB.SHAPES), (F.col("l_linenumber") % 4 + 1).cast("int"))
    return li.select(
        F.format_string("node%d", (F.col("l_suppkey") % 4).cast("int")).alias("host"),
        (F.col("l_suppkey") % 8).cast("int").alias("rank"), model.alias("model"), shape.alias("shape"),
        F.element_at(_arr(KB.PHASES), (F.col("l_orderkey") % 3 + 1).cast("int")).alias("phase"),
        (F.col("l_orderkey") % 2 + 1).cast("int").alias("mbs"),
        F.lit("bf16").alias("dtype"), (F.col("l_extendedprice") / 1000).alias("ms"))


def _measured(spark, sf_dir):
    measured, missing = KB.benchmark_coverage(v_kernel_results(spark, sf_dir), KB.model_catalog_df(spark), MBS)
    return measured, missing


CAT = "cat(model, seqlen, hidden, inter, heads, kv, hd, vocab) AS (VALUES " + ", ".join(
    f"('{k}', " + ", ".join(f"{x}::BIGINT" for x in v) + ")" for k, v in KB.MODEL_CONFIGS.items()) + ")"
SQL_BASE = f"""{CAT},
sh AS (
  SELECT model, 'attn_qkv' AS shape, seqlen AS s0, (heads + 2 * kv) * hd AS n, hidden AS k FROM cat
  UNION ALL SELECT model, 'attn_out', seqlen, hidden, hidden FROM cat
  UNION ALL SELECT model, 'mlp_up', seqlen, 2 * inter, hidden FROM cat
  UNION ALL SELECT model, 'mlp_down', seqlen, hidden, inter FROM cat
  UNION ALL SELECT model, 'vocab', seqlen, vocab, hidden FROM cat),
ex AS (SELECT sh.*, p.phase, b.mbs, b.mbs * s0 AS m FROM sh, (VALUES ('fwd'), ('wgrad'), ('dgrad')) p(phase),
       (VALUES (1), (2)) b(mbs)),
kr AS (
  SELECT 'node' || CAST(l_suppkey % 4 AS VARCHAR) AS host, CAST(l_suppkey % 8 AS INTEGER) AS rank,
         {str(MODELS).replace('"', "'")}[l_partkey % {len(MODELS)} + 1] AS model,
         {str(KB.SHAPES).replace('"', "'")}[l_linenumber % 4 + 1] AS shape,
         ['fwd', 'wgrad', 'dgrad'][l_orderkey % 3 + 1] AS phase, CAST(l_orderkey % 2 + 1 AS INTEGER) AS mbs,
         l_extendedprice / 1000 AS ms
  FROM lineitem),
ms AS (SELECT kr.*, ex.n, ex.k, ex.m FROM kr JOIN ex USING (model, shape, phase, mbs))"""


@register("gemm_roofline", f"""WITH {SQL_BASE},
g AS (SELECT model, shape, phase, mbs, m, n, k, avg(ms) AS ms FROM ms GROUP BY ALL)
SELECT model, shape, phase, mbs, CAST(m AS BIGINT) AS m, CAST(n AS BIGINT) AS n, CAST(k AS BIGINT) AS k,
       round(ms, 8) AS ms, round(2.0 * m * n * k / (ms / 1000.0) / 1e12, 8) AS tflops,
       round((m * k + k * n + m * n) * 2.0 / (ms / 1000.0) / 1e9, 8) AS gbps,
       round(2.0 * m * n * k / ((m * k + k * n + m * n) * 2.0), 8) AS arith_intensity
FROM g""")
def q_gemm_roofline(spark, sf_dir):
    measured, _ = _measured(spark, sf_dir)
    g = measured.groupBy("model", "shape", "phase", "mbs", "m", "n", "k").agg(F.avg("ms").alias("ms"))
    return KB.gemm_roofline(g)


@register("benchmark_coverage", f"""WITH {SQL_BASE}
SELECT model, shape, phase, mbs, CAST(n AS BIGINT) AS n, CAST(k AS BIGINT) AS k, CAST(m AS BIGINT) AS m FROM ex
WHERE (model, shape, phase, mbs) NOT IN (SELECT model, shape, phase, mbs FROM kr)""")
def q_benchmark_coverage(spark, sf_dir):
    _, missing = _measured(spark, sf_dir)
    return missing.select("model", "shape", "phase", F.col("mbs").cast("int").alias("mbs"), "n", "k",
                          F.col("m").cast("long").alias("m"))


@register("attention_flops", f"""WITH {CAT}, t AS (
  SELECT {str(MODELS).replace('"', "'")}[l_partkey % {len(MODELS)} + 1] AS model, l_linenumber AS batch, avg(l_extendedprice) / 1e6 AS fwd_s,
         avg(l_extendedprice + 1000 * l_quantity) / 1e6 AS all_s FROM lineitem GROUP BY ALL),
a AS (SELECT model, batch, fwd_s, 2.0 * batch * seqlen * seqlen * heads * (hd + hd) / 1e12 * 0.5 AS tflop_fwd,
  greatest(all_s - fwd_s, 1e-12) AS bwd_s FROM t JOIN cat USING (model))
SELECT model, CAST(batch AS BIGINT) AS batch, round(tflop_fwd, 8) AS tflop_fwd, round(tflop_fwd * 2.5, 8) AS tflop_bwd,
       round(tflop_fwd / fwd_s, 8) AS fwd_tflops, round(bwd_s, 8) AS bwd_s, round(tflop_fwd * 2.5 / bwd_s, 8) AS bwd_tflops
FROM a""")
def q_attention_flops(spark, sf_dir):
    """Attention cases measured per model and batch size; times from lineitem."""
    li = table(spark, sf_dir, "lineitem")
    times = li.groupBy(F.element_at(_arr(MODELS), (F.col("l_partkey") % len(MODELS) + 1).cast("int")).alias("model"),
                       F.col("l_linenumber").alias("batch")).agg(
        (F.avg("l_extendedprice") / 1e6).alias("fwd_s"),
        (F.avg(F.col("l_extendedprice") + 1000 * F.col("l_quantity")) / 1e6).alias("fwd_bwd_s"))
    cases = times.join(KB.model_catalog_df(spark).select(
        "model", "seqlen", F.col("num_attention_heads").alias("heads"),
        F.col("head_dim").alias("head_dim_qk"), F.col("head_dim").alias("head_dim_v")), "model")
    out = KB.attention_flops(cases, causal=True)
    return out.select("model", F.col("batch").cast("long").alias("batch"), "tflop_fwd", "tflop_bwd", "fwd_tflops",
                      "bwd_s", "bwd_tflops")


@register("regression_check", f"""WITH {SQL_BASE},
r AS (SELECT host, rank, model, shape, phase, mbs, 2.0 * m * n * k / (ms / 1000.0) / 1e12 AS tflops FROM ms),
t(phase, min_value) AS (VALUES ('fwd', 12.0), ('wgrad', 11.0), ('dgrad', 11.0))
SELECT host, rank, model, shape, phase, mbs, round(tflops, 8) AS tflops, min_value FROM r JOIN t USING (phase)
WHERE tflops < min_value""")
def q_regression_check(spark, sf_dir):
    measured, _ = _measured(spark, sf_dir)
    rl = KB.gemm_roofline(measured)
    th = spark.createDataFrame([("fwd", 12.0), ("wgrad", 11.0), ("dgrad", 11.0)], "phase string, min_value double")
    return KB.regression_check(rl, th, ["phase"]).select("host", "rank", "model", "shape", "phase", "mbs",
                                                         "tflops", "min_value")


@register("relative_to_baseline", f"""WITH {SQL_BASE},
g AS (SELECT model, shape, phase, mbs, avg(ms) AS ms FROM ms GROUP BY ALL),
b AS (SELECT model, shape, phase, ms AS base_ms FROM g WHERE mbs = 1)
SELECT model, shape, phase, mbs, round(ms, 8) AS ms, round(base_ms / ms, 8) AS speedup
FROM g JOIN b USING (model, shape, phase)""")
def q_relative_to_baseline(spark, sf_dir):
    measured, _ = _measured(spark, sf_dir)
    g = measured.groupBy("model", "shape", "phase", "mbs").agg(F.avg("ms").alias("ms"))
    out = KB.relative_to_baseline(g, ["model", "shape", "phase"], F.col("mbs") == 1)
    return out.filter(F.col("speedup").isNotNull()).select("model", "shape", "phase", "mbs", "ms", "speedup")


@register("projection_error", f"""WITH {SQL_BASE},
g AS (SELECT model, shape, phase, mbs, avg(ms) AS ms FROM ms GROUP BY ALL),
p AS (SELECT *, mbs * max(CASE WHEN mbs = 1 THEN ms END) OVER (PARTITION BY model, shape, phase) AS projected_ms FROM g)
SELECT model, shape, phase, mbs, round(ms, 8) AS ms, round(projected_ms, 8) AS projected_ms, round((projected_ms - ms) / ms * 100, 8) AS error_pct
FROM p WHERE projected_ms IS NOT NULL""")
def q_projection_error(spark, sf_dir):
    """Times projected linearly from a batch of 1 against those measured."""
    measured, _ = _measured(spark, sf_dir)
    g = measured.groupBy("model", "shape", "phase", "mbs").agg(F.avg("ms").alias("ms"))
    base = g.where("mbs = 1").select("model", "shape", "phase", F.col("ms").alias("_one"))
    projected = g.join(base, ["model", "shape", "phase"]).withColumn("projected_ms", F.col("mbs") * F.col("_one"))
    return KB.projection_error(projected, "projected_ms", "ms").select("model", "shape", "phase", "mbs", "ms", "projected_ms", "error_pct")


MOE_SHAPES = ["attn_q", "attn_q_down", "attn_q_up", "attn_kv_down", "attn_kv_up", "attn_out", "router", "shared_gateup", "shared_down", "moe_gateup", "moe_down"]
MOE_CAT = f"c(model, {', '.join(KB.MOE_FIELDS)}) AS (VALUES " + ", ".join(
    f"('{k}', " + ", ".join("NULL::BIGINT" if x is None else f"{x}::BIGINT" for x in v) + ")" for k, v in KB.MOE_CONFIGS.items()) + ")"


def v_moe_results(spark, sf_dir):
    """(model, shape, phase, mbs, ms) for each lineitem row; 'vocab' is never measured, some models don't have the shape."""
    model = F.element_at(_arr(list(KB.MOE_CONFIGS)), (F.col("l_partkey") % 3 + 1).cast("int"))
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 5 == 0, F.lower(model)).otherwise(model).alias("model"),
        F.element_at(_arr(MOE_SHAPES), (F.col("l_suppkey") % len(MOE_SHAPES) + 1).cast("int")).alias("shape"),
        F.element_at(_arr(KB.PHASES), (F.col("l_linenumber") % 3 + 1).cast("int")).alias("phase"),
        (F.col("l_orderkey") % 2 + 1).cast("int").alias("mbs"), (F.col("l_extendedprice") / 1000).alias("ms"))


@register("moe_benchmark_coverage", f"""WITH {MOE_CAT},
sh AS (
  SELECT model, 'attn_q' AS shape, seqlen AS s0, num_attention_heads * (qk_nope_head_dim + qk_rope_head_dim) AS n, hidden_size AS k FROM c WHERE q_lora_rank IS NULL
  UNION ALL SELECT model, 'attn_q_down', seqlen, q_lora_rank, hidden_size FROM c WHERE q_lora_rank IS NOT NULL
  UNION ALL SELECT model, 'attn_q_up', seqlen, num_attention_heads * (qk_nope_head_dim + qk_rope_head_dim), q_lora_rank FROM c WHERE q_lora_rank IS NOT NULL
  UNION ALL SELECT model, 'attn_kv_down', seqlen, kv_lora_rank + qk_rope_head_dim, hidden_size FROM c
  UNION ALL SELECT model, 'attn_kv_up', seqlen, num_attention_heads * (qk_nope_head_dim + v_head_dim), kv_lora_rank FROM c
  UNION ALL SELECT model, 'attn_out', seqlen, hidden_size, num_attention_heads * v_head_dim FROM c
  UNION ALL SELECT model, 'router', seqlen, n_routed_experts, hidden_size FROM c
  UNION ALL SELECT model, 'shared_gateup', seqlen, intermediate_size * 2, hidden_size FROM c WHERE n_shared_experts > 0
  UNION ALL SELECT model, 'shared_down', seqlen, hidden_size, intermediate_size FROM c WHERE n_shared_experts > 0
  UNION ALL SELECT model, 'moe_gateup', seqlen * num_experts_per_tok // n_routed_experts, moe_intermediate_size * 2, hidden_size FROM c
  UNION ALL SELECT model, 'moe_down', seqlen * num_experts_per_tok // n_routed_experts, hidden_size, moe_intermediate_size FROM c
  UNION ALL SELECT model, 'vocab', seqlen, vocab_size, hidden_size FROM c),
ex AS (SELECT model, shape, phase, mbs::INTEGER AS mbs, mbs * s0 AS m, n, k FROM sh, (VALUES ('fwd'), ('wgrad'), ('dgrad')) p(phase), (VALUES (1), (2)) b(mbs)),
r AS (SELECT {list(KB.MOE_CONFIGS)}[l_partkey % 3 + 1] AS model, {MOE_SHAPES}[l_suppkey % {len(MOE_SHAPES)} + 1] AS shape, ['fwd', 'wgrad', 'dgrad'][l_linenumber % 3 + 1] AS phase,
  CAST(l_orderkey % 2 + 1 AS INTEGER) AS mbs, l_extendedprice / 1000 AS ms FROM lineitem),
g AS (SELECT model, shape, phase, mbs, count(*) AS runs, avg(ms) AS ms FROM r GROUP BY ALL)
SELECT coalesce(g.model, ex.model) AS model, coalesce(g.shape, ex.shape) AS shape, coalesce(g.phase, ex.phase) AS phase, coalesce(g.mbs, ex.mbs) AS mbs,
  m::BIGINT AS m, n, k, coalesce(runs, 0) AS runs, round(ms, 8) AS ms
FROM g FULL JOIN ex ON g.model = ex.model AND g.shape = ex.shape AND g.phase = ex.phase AND g.mbs = ex.mbs""")
def q_moe_benchmark_coverage(spark, sf_dir):
    measured, missing = KB.benchmark_coverage(v_moe_results(spark, sf_dir), KB.moe_catalog_df(spark), MBS, KB.moe_shapes)
    case = ["model", "shape", "phase", "mbs", "m", "n", "k"]
    runs = measured.groupBy(*case).agg(F.count("*").alias("runs"), F.avg("ms").alias("ms"))
    return runs.unionByName(missing.select(*case, F.lit(0).cast("long").alias("runs"), F.lit(None).cast("double").alias("ms")))

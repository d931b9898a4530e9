"""Kernel benchmark analytics (PRJ14, PRJ15, JN2, JN3, JN6, JN7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values that must equal the reference: dense model shapes.
# name: (seqlen, hidden_size, intermediate_size, num_attention_heads, num_key_value_heads, head_dim, vocab_size)
MODEL_CONFIGS = {
    "Llama2_7B": (4096, 4096, 11008, 32, 32, 128, 32000),
    "Llama2_70B": (4096, 8192, 28672, 64, 8, 128, 32000),
    "Llama3.1_8B": (8192, 4096, 14336, 32, 8, 128, 128256),
    "Llama3.1_70B": (8192, 8192, 28672, 64, 8, 128, 128256),
    "Llama3.1_405B": (8192, 16384, 53248, 128, 8, 128, 128256),
    "Mistral_8x7B": (4096, 4096, 14336, 32, 8, 128, 32000),
    "Mistral_8x22B": (4096, 6144, 16384, 48, 8, 128, 32000),
}
# Fixed values that must equal the reference: latent-attention models with routed experts.
# name: (seqlen, hidden_size, intermediate_size, kv_lora_rank, moe_intermediate_size, num_attention_heads, num_experts_per_tok, n_routed_experts,
#        n_shared_experts, q_lora_rank, qk_nope_head_dim, qk_rope_head_dim, v_head_dim, vocab_size)
MOE_CONFIGS = {
    "Deepseek_V2_Lite": (4096, 2048, 10944, 512, 1408, 16, 6, 64, 2, None, 128, 64, 128, 102400),
    "Deepseek_V2": (4096, 5120, 12288, 512, 1536, 128, 6, 160, 2, 1536, 128, 64, 128, 102400),
    "Deepseek_V3": (4096, 7168, 18432, 512, 2048, 128, 8, 256, 1, 1536, 128, 64, 128, 129280),
}
MOE_FIELDS = ("seqlen hidden_size intermediate_size kv_lora_rank moe_intermediate_size num_attention_heads num_experts_per_tok n_routed_experts "
              "n_shared_experts q_lora_rank qk_nope_head_dim qk_rope_head_dim v_head_dim vocab_size").split()
SHAPES = ["attn_qkv", "attn_out", "mlp_up", "mlp_down", "vocab"]
PHASES = ["fwd", "wgrad", "dgrad"]


def model_catalog_df(spark: SparkSession) -> DataFrame:
    """The model shape catalog as a small DataFrame (one row per model)."""
    rows = [(k, *v) for k, v in MODEL_CONFIGS.items()]
    return spark.createDataFrame(rows, "model string, seqlen long, hidden_size long, intermediate_size long, "
                                       "num_attention_heads long, num_key_value_heads long, head_dim long, "
                                       "vocab_size long")


def dense_shapes(catalog: DataFrame) -> DataFrame:
    """The five dense GEMM shapes (shape, s0, n, k) per model, generated with
    ``inline`` from each catalog row (no join)."""
    c = F.col

    def shape(name, n, k):
        return F.struct(F.lit(name).alias("shape"), c("seqlen").alias("s0"), n.cast("long").alias("n"),
                        k.cast("long").alias("k"))
    shapes = F.array(
        shape("attn_qkv", (c("num_attention_heads") + 2 * c("num_key_value_heads")) * c("head_dim"),
              c("hidden_size")),
        shape("attn_out", c("hidden_size"), c("hidden_size")),
        shape("mlp_up", 2 * c("intermediate_size"), c("hidden_size")),
        shape("mlp_down", c("hidden_size"), c("intermediate_size")),
        shape("vocab", c("vocab_size"), c("hidden_size")))
    return catalog.select("model", F.inline(shapes))


def moe_catalog_df(spark: SparkSession) -> DataFrame:
    """The catalog of latent-attention models (one row per model)."""
    return spark.createDataFrame([(k, *v) for k, v in MOE_CONFIGS.items()], "model string, " + ", ".join(f"{f} long" for f in MOE_FIELDS))


def moe_shapes(catalog: DataFrame) -> DataFrame:
    """The GEMM shapes (shape, s0, n, k) of latent attention and routed experts per model: the query projection in one
    step or, with a query rank, in two; shared experts only where there are any; routed experts at a balanced share of the tokens."""
    c = F.col

    def shape(name, n, k, s0=None, when=None):
        row = F.struct(F.lit(name).alias("shape"), (c("seqlen") if s0 is None else s0).cast("long").alias("s0"), n.cast("long").alias("n"), k.cast("long").alias("k"))
        return row if when is None else F.when(when, row)
    heads, hidden, low = c("num_attention_heads"), c("hidden_size"), c("q_lora_rank")
    query, routed = heads * (c("qk_nope_head_dim") + c("qk_rope_head_dim")), c("moe_intermediate_size")
    share, shared = F.floor(c("seqlen") * c("num_experts_per_tok") / c("n_routed_experts")), c("n_shared_experts") > 0
    shapes = F.array(
        shape("attn_q", query, hidden, when=low.isNull()),
        shape("attn_q_down", low, hidden, when=low.isNotNull()),
        shape("attn_q_up", query, low, when=low.isNotNull()),
        shape("attn_kv_down", c("kv_lora_rank") + c("qk_rope_head_dim"), hidden),
        shape("attn_kv_up", heads * (c("qk_nope_head_dim") + c("v_head_dim")), c("kv_lora_rank")),
        shape("attn_out", hidden, heads * c("v_head_dim")),
        shape("router", c("n_routed_experts"), hidden),
        shape("shared_gateup", 2 * c("intermediate_size"), hidden, when=shared),
        shape("shared_down", hidden, c("intermediate_size"), when=shared),
        shape("moe_gateup", 2 * routed, hidden, s0=share),
        shape("moe_down", hidden, routed, s0=share),
        shape("vocab", c("vocab_size"), hidden))
    return catalog.select("model", F.inline(F.filter(shapes, lambda x: x.isNotNull())))


def expected_cases(catalog: DataFrame, mbs_list, shapes=dense_shapes) -> DataFrame:
    """JN2 grid: models x shapes x phases x micro-batch sizes, m = mbs * s0.
    The fixed phase and mbs lists are exploded per shape row."""
    sh = shapes(catalog)
    return (sh.select("*", F.explode(F.array(*[F.lit(p) for p in PHASES])).alias("phase"))
            .select("*", F.explode(F.array(*[F.lit(int(b)) for b in mbs_list])).alias("mbs"))
            .withColumn("m", F.col("mbs") * F.col("s0")).drop("s0"))


def lookup_models(results: DataFrame, catalog: DataFrame) -> DataFrame:
    """JN3: case-insensitive model lookup; an unknown model is an error."""
    cat = catalog.select(F.lower("model").alias("_lm"), F.col("model").alias("_model"))
    j = results.withColumn("_lm", F.lower("model")).join(F.broadcast(cat), "_lm", "left")
    return j.withColumn("model", F.when(F.col("_model").isNull(),
                                        F.raise_error(F.concat(F.lit("unknown model: "), F.col("model"))))
                        .otherwise(F.col("_model"))).drop("_lm", "_model")


def benchmark_coverage(results: DataFrame, catalog: DataFrame, mbs_list, shapes=dense_shapes) -> tuple[DataFrame, DataFrame]:
    """JN2: measured rows with their shape (left join onto the expected grid)
    and the expected cases never measured (left anti join). The grid's size follows
    the catalog, so how it is joined is left to its measured size."""
    exp = expected_cases(catalog, mbs_list, shapes)
    key = ["model", "shape", "phase", "mbs"]
    res = lookup_models(results, catalog)
    measured = res.join(exp, key, "left")
    missing = exp.join(res.select(*key).distinct(), key, "left_anti")
    return measured, missing


def gemm_roofline(df: DataFrame, elem_bytes: int = 2) -> DataFrame:
    """PRJ14: FLOPs 2mnk, TFLOP/s, bytes (mk+kn+mn)*elem, GB/s, FLOPs/byte."""
    m, n, k, t = F.col("m"), F.col("n"), F.col("k"), F.col("ms") / 1000.0
    flops = 2.0 * m * n * k
    byts = (m * k + k * n + m * n) * float(elem_bytes)
    return df.withColumn("tflops", flops / t / 1e12).withColumn("gbps", byts / t / 1e9) \
        .withColumn("arith_intensity", flops / byts)


def attention_flops(df: DataFrame, causal: bool = True) -> DataFrame:
    """PRJ15: forward TFLOP = 2*B*S^2*H*(dqk+dv)/1e12 (halved if causal),
    backward = 2.5 x forward; backward time = total - forward, floored at 1e-12 s."""
    fwd = 2.0 * F.col("batch") * F.col("seqlen") * F.col("seqlen") * F.col("heads") * \
        (F.col("head_dim_qk") + F.col("head_dim_v")) / 1e12
    if causal:
        fwd = fwd * 0.5
    bwd_t = F.greatest(F.col("fwd_bwd_s") - F.col("fwd_s"), F.lit(1e-12))
    return df.withColumn("tflop_fwd", fwd).withColumn("tflop_bwd", fwd * 2.5) \
        .withColumn("fwd_tflops", fwd / F.greatest(F.col("fwd_s"), F.lit(1e-12))) \
        .withColumn("bwd_s", bwd_t).withColumn("bwd_tflops", fwd * 2.5 / bwd_t)


def regression_check(measured: DataFrame, thresholds: DataFrame, key, value: str = "tflops",
                     roofline: str | None = None) -> DataFrame:
    """JN6: rows below the minimum of their (key) threshold, with the ratio to
    the roofline when given."""
    j = measured.join(thresholds, key)
    out = j.filter(F.col(value) < F.col("min_value"))
    if roofline:
        out = out.withColumn("roofline_ratio", F.col(value) / F.col(roofline))
    return out


def relative_to_baseline(df: DataFrame, group, is_baseline, time: str = "ms", memory: str | None = None) -> DataFrame:
    """JN7: speed-up (baseline time / time) and memory overhead relative to the
    baseline row of each group (a per-group aggregate joined back)."""
    aggs = [F.max_by(F.col(time), F.when(is_baseline, F.lit(1))).alias("_base_t")]
    if memory:
        aggs.append(F.max_by(F.col(memory), F.when(is_baseline, F.lit(1))).alias("_base_m"))
    base = df.groupBy(*group).agg(*aggs)
    out = df.join(base, list(group)).withColumn("speedup", F.col("_base_t") / F.col(time))
    if memory:
        out = out.withColumn("memory_overhead", F.col(memory) / F.col("_base_m") - 1)
    return out.drop("_base_t", "_base_m")


def projection_error(df: DataFrame, projected: str, measured: str) -> DataFrame:
    """JN7: percentage error of a projection against the measurement."""
    return df.withColumn("error_pct", (F.col(projected) - F.col(measured)) / F.col(measured) * 100)

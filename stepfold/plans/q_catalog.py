"""Registered queries and oracles: run names, model catalogs, GEMM dumps (from ``part``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepfold.operators import catalog as K
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


STEMS = ["llama3_8B", "deepseek_v2_lite", "qwen2_7B", "mixtral_8x7B", "moe_proxy_2T", "grok1", "gpt_oss_20B",
         "bert_large", "moe_1T", "LLaMA_cased"]
FRAMEWORKS = ["megatron", "torchtitan", "maxtext"]
TYPES = {"ECONOMY": "bf16_r", "STANDARD": "f16_r", "PROMO": "f32_r", "LARGE": "f8_r", "MEDIUM": "bf16_r",
         "SMALL": "f16_r"}


def _arr(xs):
    return F.array(*[F.lit(x) for x in xs])


def _sql_list(xs):
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


def v_run_names(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    stem = F.element_at(_arr(STEMS), (k % 10 + 1).cast("int"))
    fw = F.element_at(_arr(FRAMEWORKS), (k % 3 + 1).cast("int"))
    return p.select(
        "p_partkey", "p_size", stem.alias("stem"), fw.alias("framework"),
        F.format_string("logs/2024%02d01/GPU%d/%s/%s_%d.log", (k % 9 + 1).cast("int"), (k % 8).cast("int"), fw, stem,
                        "p_size").alias("path"),
        F.when(k % 11 == 0, F.format_string("notes_%d.log", k))
        .otherwise(F.format_string("%s_%d_%s_MI%dX_%s.log", stem, "p_size",
                                   F.element_at(_arr(["megatron", "megatorn", "torchtitan"]), (k % 3 + 1).cast("int")),
                                   (300 + 25 * (F.col("p_size") % 3)).cast("int"),
                                   F.element_at(_arr(["BF16", "fp8", "run"]), (F.col("p_size") % 3 + 1).cast("int"))))
        .alias("name"),
        F.format_string("models/%s/%s", fw, F.when(k % 97 == 0, F.lit("shared_model.yaml")).otherwise(
            F.concat(stem, F.lit("_"), F.col("p_size").cast("string"),
                     F.element_at(_arr(["_base", "-fp8", "", "", ""]), (F.col("p_size") % 5 + 1).cast("int")),
                     F.lit(".yaml")))).alias("config_path"))


DENIED = ["shared_model.yaml"]

RUN = f"""rn AS (
  SELECT p_partkey AS k, p_size, {_sql_list(STEMS)}[p_partkey % 10 + 1] AS stem,
         {_sql_list(FRAMEWORKS)}[p_partkey % 3 + 1] AS framework,
         ['megatron', 'megatorn', 'torchtitan'][p_partkey % 3 + 1] AS fwname,
         ['BF16', 'fp8', 'run'][p_size % 3 + 1] AS prec, ['_base', '-fp8', '', '', ''][p_size % 5 + 1] AS suffix
  FROM part)"""


@register("log_path_dims", f"""WITH {RUN}
SELECT printf('logs/2024%02d01/GPU%d/%s/%s_%d.log', k % 9 + 1, k % 8, framework, stem, p_size) AS path,
       printf('2024%02d01', k % 9 + 1) AS date, 'GPU' || CAST(k % 8 AS VARCHAR) AS gpu, framework,
       stem || '_' || CAST(p_size AS VARCHAR) AS model
FROM rn""")
def q_log_path_dims(spark, sf_dir):
    return K.log_path_dims(v_run_names(spark, sf_dir).select("path"))


@register("log_name_dims", f"""WITH {RUN}
SELECT printf('%s_%d_%s_MI%dX_%s.log', stem, p_size, fwname, 300 + 25 * (p_size % 3), prec) AS name,
       CASE WHEN fwname = 'torchtitan' THEN 'torchtitan' ELSE 'megatron' END AS framework,
       stem || '_' || CAST(p_size AS VARCHAR) AS model, 'MI' || CAST(300 + 25 * (p_size % 3) AS VARCHAR) || 'X' AS device,
       CASE WHEN prec = 'run' THEN '-' ELSE upper(prec) END AS precision
FROM rn WHERE k % 11 <> 0 AND fwname <> 'megatorn'""")
def q_log_name_dims(spark, sf_dir):
    return K.log_name_dims(v_run_names(spark, sf_dir).select("name"))


CATALOG = RUN + """, cat AS (
  SELECT framework, stem || '_' || CAST(p_size AS VARCHAR) AS name FROM rn WHERE k % 97 <> 0 AND suffix = '')"""


@register("model_catalog", f"""WITH {CATALOG} SELECT framework, name FROM cat""")
def q_model_catalog(spark, sf_dir):
    return K.model_catalog(v_run_names(spark, sf_dir).select(F.col("config_path").alias("path")), "models", DENIED)


FAMILY_SQL = "CASE " + " ".join(f"WHEN starts_with(name, '{p}') THEN '{f}'" for p, f in K.FAMILY_RULES) + " END"


@register("model_family", f"""WITH {CATALOG}
SELECT framework, name, {FAMILY_SQL} AS family FROM cat WHERE {FAMILY_SQL} IS NOT NULL""")
def q_model_family(spark, sf_dir):
    return K.model_family(K.model_catalog(v_run_names(spark, sf_dir).select(F.col("config_path").alias("path")),
                                          "models", DENIED))


@register("family_pivot", f"""WITH {CATALOG}, f AS (SELECT framework, {FAMILY_SQL} AS family FROM cat)
SELECT framework, {", ".join(f"count(*) FILTER (WHERE family = '{c}') AS {c}" for c in K.FAMILY_COLUMNS)},
       count(*) FILTER (WHERE family IS NOT NULL) AS Total
FROM f GROUP BY framework HAVING count(*) FILTER (WHERE family IS NOT NULL) > 0""")
def q_family_pivot(spark, sf_dir):
    cat = K.model_catalog(v_run_names(spark, sf_dir).select(F.col("config_path").alias("path")), "models", DENIED)
    return K.family_pivot(K.model_family(cat))


def v_gemm_dump(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    m = (F.col("p_size") * 64).cast("long")
    n = (F.lit(128) * (k % 5 + 1)).cast("long")
    t = F.element_at(F.create_map(*[v for a, b in TYPES.items() for v in (F.lit(a), F.lit(b))]), F.col("p_type"))
    bias = F.when(k % 11 == 0, F.lit(" --bias_vector --bias_source d")).otherwise(F.lit(""))
    tail = F.when(k % 7 == 0, F.lit(" --use_gpu_timer -k 512")).otherwise(F.lit(""))
    cmd = F.concat(
        F.format_string("hipblaslt-bench --api_method c -m %d -n %d -k 256 --lda %d --ldb 256 --ldc %d --ldd %d "
                        "--stride_a 0 --stride_b 0 --stride_c 0 --stride_d 0 --alpha 1 --beta 0 --transA N "
                        "--transB T --batch_count 1 --scaleA 0 --scaleB 0", m, n, m, m, m),
        bias,
        F.format_string(" --a_type %s --b_type %s --c_type %s --d_type %s --scale_type f32_r --bias_type f32_r "
                        "--compute_type f32_r --algo_method index --solution_index 0", t, t, t, t),
        tail)
    cmd = F.when(k % 13 == 0, F.concat(F.lit("   "), cmd, F.lit("  "))).otherwise(cmd)
    line = F.when(k % 50 == 0, F.lit("hipblaslt-bench: error: device busy")).otherwise(cmd)
    return p.select(F.format_string("dump/rank_%d.txt", (k % 8).cast("int")).alias("path"), line.alias("line"))


GEMM = """g AS (
  SELECT p_partkey AS k, CAST(p_size * 64 AS BIGINT) AS m, CAST(128 * (p_partkey % 5 + 1) AS BIGINT) AS n,
         CAST(CASE WHEN p_partkey % 7 = 0 THEN 512 ELSE 256 END AS BIGINT) AS kk,
         CASE p_type WHEN 'ECONOMY' THEN 'bf16_r' WHEN 'STANDARD' THEN 'f16_r' WHEN 'PROMO' THEN 'f32_r'
                     WHEN 'LARGE' THEN 'f8_r' WHEN 'MEDIUM' THEN 'bf16_r' ELSE 'f16_r' END AS t,
         p_partkey % 11 = 0 AS bias, p_partkey % 7 = 0 AS retimed
  FROM part WHERE p_partkey % 50 <> 0),
gd AS (SELECT DISTINCT m, n, kk, t, bias, retimed FROM g)"""


@register("gemm_commands", f"""WITH {GEMM}
SELECT m, n, kk AS k, CAST(1 AS BIGINT) AS batch_count, m AS lda, CAST(256 AS BIGINT) AS ldb, t AS a_type,
       t AS b_type, t AS c_type, 'N' AS trans_a, 'T' AS trans_b, CASE WHEN bias THEN 'd' END AS bias_source
FROM gd""")
def q_gemm_commands(spark, sf_dir):
    parsed = K.parse_gemm_commands(K.read_gemm_dump(v_gemm_dump(spark, sf_dir)))
    return parsed.drop("line", "opts", "lda_", "ldb_")


@register("tuning_worklist", f"""WITH {GEMM}, r AS (
  SELECT m, n, kk, t,
    printf('--api_method c -m %d -n %d -k %d --lda %d --ldb 256 --ldc %d --ldd %d --stride_a 0 --stride_b 0 --stride_c 0 --stride_d 0 --alpha 1 --beta 0 --transA N --transB T --batch_count 1 --scaleA 0 --scaleB 0', m, n, kk, m, m, m)
    || CASE WHEN bias THEN ' --bias_source d' ELSE '' END
    || printf(' --a_type %s --b_type %s --c_type %s --d_type %s --scale_type f32_r --bias_type f32_r --compute_type f32_r', t, t, t, t) AS body
  FROM gd)
SELECT m, n, kk AS k, t AS a_type,
  '/opt/rocm/bin/hipblaslt-bench ' || body || ' --algo_method index --solution_index 0 --rotating 512 --cold_iters 20 --iters 20' AS src_script,
  '/opt/rocm/bin/hipblaslt-bench ' || body || ' --rotating 512 --cold_iters 20 --iters 20 --requested_solution -1 --skip_slow_solution_ratio 0.7 --print_kernel_info' AS tune_script
FROM r""")
def q_tuning_worklist(spark, sf_dir):
    return K.tuning_worklist(K.parse_gemm_commands(K.read_gemm_dump(v_gemm_dump(spark, sf_dir))))


@register("gemm_shape_census", f"""WITH {GEMM}
SELECT m, n, kk AS k, CAST(1 AS BIGINT) AS batch_count, t AS a_type, count(*) AS n_lines FROM g GROUP BY ALL""")
def q_gemm_shape_census(spark, sf_dir):
    return K.gemm_shape_census(v_gemm_dump(spark, sf_dir))


@register("tuning_results", """SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN 1 ELSE 0 END AS returncode, p_retailprice AS gflops,
  round(CASE WHEN p_partkey % 9 = 0 THEN -1.0 ELSE p_retailprice / 1024.0 END, 8) AS tflops FROM part""")
def q_tuning_results(spark, sf_dir):
    """One tuning run for each part; every ninth failed."""
    runs = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 9 == 0, 1).otherwise(0).alias("returncode"),
                                               F.col("p_retailprice").cast("double").alias("gflops"))
    return K.tuning_results(runs)

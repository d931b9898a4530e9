"""Run names, model catalogs and GEMM shape dumps (SRC2, SRC3, SRC8, SRC10,
PRJ10, PRJ11, PRJ20, AGG24, AGG26)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference.
# Model family: first matching name prefix wins.
FAMILY_RULES = [("moe_proxy", "MoE_Proxy"), ("moe_", "MoE_Proxy"), ("mixtral", "Mixtral"), ("llama", "LLaMA"),
                ("deepseek", "DeepSeek"), ("qwen", "Qwen"), ("grok", "Grok"), ("gpt", "GPT")]
FAMILY_COLUMNS = ["LLaMA", "DeepSeek", "Qwen", "Mixtral", "MoE_Proxy", "Grok", "GPT"]
BENCH_BINARY = "hipblaslt-bench"
BENCH_PATH = "/opt/rocm/bin/hipblaslt-bench"
ROTATING_BUFFER, RUN_NUMS, REQUESTED_SOLUTION, SKIP_LOW_SOLUTION = 512, 20, -1, 0.7


def log_path_dims(paths: DataFrame, path: str = "path") -> DataFrame:
    """SRC2: date / GPU / framework / model from the last four path parts."""
    parts = F.split(F.col(path), "/")
    return paths.select(path, F.element_at(parts, -4).alias("date"), F.element_at(parts, -3).alias("gpu"),
                        F.element_at(parts, -2).alias("framework"),
                        F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "").alias("model"))


def log_name_dims(names: DataFrame, name: str = "name") -> DataFrame:
    """SRC3: (framework, model, device, precision) from a log file name. The
    framework test accepts the misspelling 'megatorn' but the dimension
    pattern needs '_megatron_', so such names drop out like any non-match;
    precision defaults to '-'."""
    n = F.col(name)
    low = F.lower(n)
    fw = (F.when(low.contains("megatron") | low.contains("megatorn"), "megatron")
          .when(low.contains("torchtitan"), "torchtitan"))
    mp, tp = r"(?i)(.+?)_megatron_(MI\d+X?)", r"(?i)(.+?)_torchtitan_(MI\d+X?)"
    model = F.when(fw == "megatron", F.regexp_extract(n, mp, 1)).otherwise(F.regexp_extract(n, tp, 1))
    device = F.when(fw == "megatron", F.regexp_extract(n, mp, 2)).otherwise(F.regexp_extract(n, tp, 2))
    prec = F.upper(F.regexp_extract(n, r"(?i)(BF16|FP8)", 1))
    return names.select(name, fw.alias("framework"), model.alias("model"), device.alias("device"),
                        F.when(prec == "", "-").otherwise(prec).alias("precision")) \
        .filter(F.col("framework").isNotNull() & (F.col("model") != ""))


def model_catalog(paths: DataFrame, root: str, exclude: Sequence[str], path: str = "path") -> DataFrame:
    """SRC10: config files below ``root`` (``*.yaml``), minus ``*_base``,
    ``*-fp8`` and the deny list (left anti join); framework = first path part."""
    rel = F.regexp_replace(F.col(path), "^" + root.rstrip("/") + "/", "")
    file = F.element_at(F.split(rel, "/"), -1)
    df = paths.select(F.split(rel, "/")[0].alias("framework"), file.alias("file"))
    df = df.filter(F.col("file").endswith(".yaml") & ~F.col("file").endswith("_base.yaml")
                   & ~F.col("file").endswith("-fp8.yaml"))
    deny = paths.sparkSession.createDataFrame([(e,) for e in exclude], "file string")
    return df.join(F.broadcast(deny), "file", "left_anti") \
        .select("framework", F.regexp_replace("file", r"\.yaml$", "").alias("name"))


def family_of(name: Column) -> Column:
    """PRJ20: first-match prefix rule; NULL when unclassified."""
    expr = None
    for prefix, fam in reversed(FAMILY_RULES):
        cond = name.startswith(prefix)
        expr = F.when(cond, F.lit(fam)) if expr is None else F.when(cond, F.lit(fam)).otherwise(expr)
    return expr


def model_family(catalog: DataFrame) -> DataFrame:
    return catalog.withColumn("family", family_of(F.col("name"))).filter(F.col("family").isNotNull())


def family_pivot(families: DataFrame) -> DataFrame:
    """AGG26: framework x family counts with fixed columns (missing 0) and total."""
    p = families.groupBy("framework").pivot("family", FAMILY_COLUMNS).count().na.fill(0, FAMILY_COLUMNS)
    total = sum((F.col(c) for c in FAMILY_COLUMNS[1:]), F.col(FAMILY_COLUMNS[0]))
    return p.select("framework", *[F.col(c).cast("long").alias(c) for c in FAMILY_COLUMNS],
                    total.cast("long").alias("Total"))


def read_gemm_dump(lines: DataFrame, line: str = "line") -> DataFrame:
    """SRC8: trimmed, distinct command lines."""
    return lines.select(F.trim(F.col(line)).alias("line")).filter(F.col("line") != "").distinct()


def command_options(lines: DataFrame, line: str = "line") -> DataFrame:
    """Long option table (line, pos, key, value) of command lines: an option
    takes the next token as value unless that token is itself an option (such
    a flag is dropped); a repeated option keeps its first position and its
    last value. Dedup is an aggregation, independent of any map-key policy."""
    toks = F.filter(F.split(F.trim(F.col(line)), " "), lambda t: t != "")
    n = F.size(toks)
    pairs = F.transform(F.sequence(F.lit(2), F.greatest(n, F.lit(2))), lambda i: F.struct(
        i.alias("pos"), F.element_at(toks, i).alias("key"),
        F.when(i < n, F.element_at(toks, F.least(i + 1, n))).alias("value")))
    kv = F.filter(pairs, lambda p: p["key"].startswith("-") & p["value"].isNotNull()
                  & ~p["value"].startswith("-"))
    return (lines.select(line, F.inline(kv))
            .groupBy(line, "key").agg(F.min("pos").alias("pos"), F.max_by("value", "pos").alias("value")))


# Fixed option names of the parsed problem columns.
INT_OPTIONS = {"m": "-m", "n": "-n", "k": "-k", "batch_count": "--batch_count", "lda": "--lda", "ldb": "--ldb"}
STR_OPTIONS = {"a_type": "--a_type", "b_type": "--b_type", "c_type": "--c_type", "trans_a": "--transA",
               "trans_b": "--transB", "bias_source": "--bias_source"}


def parse_gemm_commands(lines: DataFrame) -> DataFrame:
    """PRJ10: command lines -> typed problem sizes (conditional aggregation
    over the long option table) plus the ordered option list; non-command
    lines dropped; optional bias part."""
    first = F.element_at(F.split(F.trim("line"), " "), 1)
    cmd = lines.filter(first == BENCH_BINARY)
    opts = command_options(cmd)

    def pick(k):
        return F.max(F.when(F.col("key") == k, F.col("value")))
    return opts.groupBy("line").agg(
        *[pick(k).try_cast("long").alias(c) for c, k in INT_OPTIONS.items()],
        *[pick(k).alias(c) for c, k in STR_OPTIONS.items()],
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "key", "value"))),
                    lambda z: F.struct(z["key"].alias("key"), z["value"].alias("value"))).alias("opts"))


def render(opts: Column) -> Column:
    return F.array_join(F.transform(opts, lambda e: F.concat(e["key"], F.lit(" "), e["value"])), " ")


def _kv(*pairs) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("key"), F.lit(str(v)).alias("value")) for k, v in pairs])


def _with(opts: Column, *pairs) -> Column:
    keys = [k for k, _ in pairs]
    return F.concat(F.filter(opts, lambda p: ~p["key"].isin(*keys)), _kv(*pairs))


def tuning_worklist(parsed: DataFrame) -> DataFrame:
    """PRJ11: per distinct problem the source and tuning scripts: rotating
    buffer and iteration counts added; for tuning the algorithm keys removed,
    solution request and slow-solution ratio added, kernel info printed."""
    src = _with(F.col("opts"), ("--rotating", ROTATING_BUFFER), ("--cold_iters", RUN_NUMS), ("--iters", RUN_NUMS))
    tune = _with(F.filter(src, lambda p: ~p["key"].isin("--algo_method", "--solution_index")),
                 ("--requested_solution", REQUESTED_SOLUTION), ("--skip_slow_solution_ratio", SKIP_LOW_SOLUTION))
    return parsed.select("m", "n", "k", "a_type",
                         F.concat(F.lit(BENCH_PATH + " "), render(src)).alias("src_script"),
                         F.concat(F.lit(BENCH_PATH + " "), render(tune), F.lit(" --print_kernel_info"))
                         .alias("tune_script"))


def gemm_shape_census(lines: DataFrame) -> DataFrame:
    """AGG24: distinct problems with the number of dump lines and dtype.
    Lines are counted first and parsed once per distinct line."""
    counted = lines.select(F.trim("line").alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("_c"))
    parsed = parse_gemm_commands(counted.select("line")).join(counted, "line")
    return parsed.groupBy("m", "n", "k", "batch_count", "a_type").agg(F.sum("_c").alias("n_lines"))


def tuning_results(results: DataFrame) -> DataFrame:
    """AGG24 result rows: Gflop/s -> TFLOP/s (/1024 as the tool does); failed runs -1."""
    return results.withColumn("tflops", F.when(F.col("returncode") == 0, F.col("gflops") / 1024.0)
                              .otherwise(F.lit(-1.0)))

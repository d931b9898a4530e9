"""Test views for the log jobs, derived from the driver's ``events`` table.

Each view renders *text* in the layout of one training framework; the jobs
parse that text back. The oracle side (``oracle_sql``) reads the typed
columns of the same derivation, so both sides are independent.

Line numbers are dense per file and ordered; files are one per run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stepfold.plans.tables import table

ESC = "\u001b"


def v_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed step facts: one run per user, iterations in event-time order."""
    ev = table(spark, sf_dir, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    v = F.col("value")
    return ev.select(
        F.col("user_id").alias("run"),
        F.row_number().over(w).cast("int").alias("iter"),
        F.round(v * 10 + 50, 1).alias("elapsed_ms"),
        F.round(v, 1).alias("tflops"),
        F.round(v * 20, 1).alias("tokens"),
        (F.lit(64) * (1 + F.col("user_id") % 4)).cast("int").alias("gbs"),
        "event_id", "event_type", "ts", "value")


def _header(rank: str = "rank-7/8", level: str = "INFO") -> F.Column:
    return F.format_string("[%s][user/team][trainer][ip-10-0-0-1][%s][%s]",
                           F.date_format("ts", "yyyyMMdd HH:mm:ss"), F.lit(rank), F.lit(level))


def _with_ansi(header: F.Column) -> F.Column:
    return F.when(F.col("event_id") % 7 == 0,
                  F.concat(F.lit(ESC + "[32m"), header, F.lit(ESC + "[0m"))).otherwise(header)


def _tail_lines(s: DataFrame, path_expr: F.Column) -> DataFrame:
    """Completion marker (missing for every fifth run) and exit line per run."""
    runs = s.groupBy("run").agg(F.max("iter").alias("last_iter"), F.max("ts").alias("ts"))
    marker = runs.filter(F.col("run") % 5 != 0).select(
        path_expr.alias("path"), (F.col("last_iter") * 2 + 3).cast("long").alias("line_no"),
        F.concat(F.date_format("ts", "[yyyyMMdd HH:mm:ss]"), F.lit(" Training completed.")).alias("line"))
    exit_line = runs.select(
        path_expr.alias("path"), (F.col("last_iter") * 2 + 4).cast("long").alias("line_no"),
        F.concat(F.date_format("ts", "[yyyyMMdd HH:mm:ss]"), F.lit(" process exited with code 0")).alias("line"))
    return marker.unionByName(exit_line)


def megatron_path(run: F.Column | None = None) -> F.Column:
    return F.concat(F.lit("logs/megatron/run_"), (run if run is not None else F.col("run")).cast("string"),
                    F.lit(".log"))


def v_train_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-framework step lines: commas, ANSI, empty segments, malformed lines."""
    s = v_steps(spark, sf_dir)
    tokens_txt = F.when(F.col("event_id") % 3 == 0, F.format_number("tokens", 1)) \
        .otherwise(F.format_string("%.1f", "tokens"))
    empty = F.when(F.col("event_id") % 11 == 0, F.lit(" |  |")).otherwise(F.lit(" |"))
    body = F.concat(
        F.format_string(" iteration %8d/%8d", "iter", F.lit(100000)),
        F.format_string(" | consumed samples: %12d", (F.col("iter") * F.col("gbs")).cast("long")),
        empty,
        F.format_string(" elapsed time per iteration (ms): %.1f", "elapsed_ms"),
        F.format_string(" | throughput per GPU (TFLOP/s/GPU): %.1f", "tflops"),
        F.lit(" | tokens per GPU (tokens/s/GPU): "), tokens_txt,
        F.lit(" | learning rate: 1.000000E-04"),
        F.format_string(" | global batch size: %5d", "gbs"),
        F.format_string(" | lm loss: %.6E", F.col("value") / 10 + 1),
        F.lit(" | loss scale: 1.0 | number of skipped iterations:   0 | number of nan iterations:   0 |"))
    step = s.select(megatron_path().alias("path"), (F.col("iter") * 2).cast("long").alias("line_no"),
                    F.concat(_with_ansi(_header()), body).alias("line"))
    bad = s.filter(F.col("event_id") % 10 == 0).select(
        megatron_path().alias("path"), (F.col("iter") * 2 + 1).cast("long").alias("line_no"),
        F.concat(_header(level="WARNING"),
                 F.format_string(" iteration %8d/ | elapsed time per iteration (ms): nan | "
                                 "throughput per GPU (TFLOP/s/GPU): --", "iter")).alias("line"))
    return step.unionByName(bad).unionByName(_tail_lines(s, megatron_path()))


def inst_path() -> F.Column:
    return F.concat(F.lit("logs/megatron_avg/run_"), F.col("run").cast("string"), F.lit(".log"))


def v_inst_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed values of the ``inst/avg`` layout (older layout for every third run)."""
    v = F.col("value")
    used = F.round(v / 5 + 10, 2)
    return v_steps(spark, sf_dir).select(
        "*",
        F.round(v * 10 + 45, 0).alias("elapsed_avg"),
        F.round(v * 2, 1).alias("tflops_avg"),
        F.round(v * 40, 1).alias("tokens_avg"),
        used.alias("mem_used"),
        F.round(192 - used, 2).alias("mem_free"),
        F.lit(192.0).alias("mem_total"),
        F.round(used / 192 * 100, 2).alias("mem_ratio"),
        (F.col("run") % 3 == 0).alias("old_layout"),
        F.when(F.col("run") % 2 == 0, F.lit("GB")).otherwise(F.lit("GiB")).alias("unit"))


def v_inst_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = v_inst_steps(spark, sf_dir)
    u = F.col("unit")
    hip = F.format_string(" | hip mem usage/free/total/usage_ratio: %.2f%s/%.2f%s/%.2f%s/%.2f%%",
                          "mem_used", u, "mem_free", u, "mem_total", u, "mem_ratio")
    old_mem = F.format_string(" | mem usages: %.2f", "mem_used")
    old = F.col("old_layout")
    body = F.concat(
        F.format_string(" iteration %8d/%8d", "iter", F.lit(100000)),
        F.format_string(" | consumed samples: %12d", (F.col("iter") * F.col("gbs")).cast("long")),
        F.format_string(" | elapsed time per iteration (ms): %.1f/%.1f", "elapsed_ms", "elapsed_avg"),
        F.when(old, old_mem).otherwise(F.lit("")),
        F.format_string(" | throughput per GPU (TFLOP/s/GPU): %.1f/%.1f", "tflops", "tflops_avg"),
        F.format_string(" | tokens per GPU (tokens/s/GPU): %.1f/%.1f", "tokens", "tokens_avg"),
        F.format_string(" | global batch size: %5d", "gbs"),
        F.when(old, F.lit("")).otherwise(hip),
        F.lit(" |"))
    step = s.select(inst_path().alias("path"), (F.col("iter") * 2).cast("long").alias("line_no"),
                    F.concat(_with_ansi(_header()), body).alias("line"))
    return step.unionByName(_tail_lines(s, inst_path()))


def titan_path() -> F.Column:
    return F.concat(F.lit("logs/torchtitan/run_"), F.col("run").cast("string"), F.lit(".log"))


def v_titan_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows of the second layout; 'view' events log the step twice,
    every fourth event is echoed by rank 1."""
    v = F.col("value")
    base = v_steps(spark, sf_dir).select(
        "run", "iter", "event_id", "event_type", "ts",
        F.lit(0).alias("rank"),
        (F.col("iter") * 10).cast("long").alias("line_no"),
        F.round(v / 5 + 10, 2).alias("memory"),
        F.round(v * 20, 0).alias("tps"),
        F.col("tflops"),
        F.round(v / 5, 2).alias("mfu"),
        F.round(v / 10 + 1, 4).alias("loss"),
        F.round(v / 100, 4).alias("grad_norm"))
    rep = base.filter(F.col("event_type") == "view").select(
        "run", "iter", "event_id", "event_type", "ts", "rank",
        (F.col("line_no") + 1).alias("line_no"),
        (F.col("memory") + 1).alias("memory"), (F.col("tps") + 1).alias("tps"),
        (F.col("tflops") + 1).alias("tflops"), (F.col("mfu") + 1).alias("mfu"),
        "loss", "grad_norm")
    echo = base.filter(F.col("event_id") % 4 == 0).select(
        "run", "iter", "event_id", "event_type", "ts", F.lit(1).alias("rank"),
        (F.col("line_no") + 2).alias("line_no"),
        (F.col("memory") + 2).alias("memory"), (F.col("tps") + 2).alias("tps"),
        (F.col("tflops") + 2).alias("tflops"), (F.col("mfu") + 2).alias("mfu"),
        "loss", "grad_norm")
    return base.unionByName(rep).unionByName(echo)


def v_titan_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = v_titan_steps(spark, sf_dir)
    tps_txt = F.when(F.col("event_id") % 3 == 0, F.format_number("tps", 0)) \
        .otherwise(F.format_string("%d", F.col("tps").cast("long")))
    rank = F.concat(F.lit("rank-"), F.col("rank").cast("string"), F.lit("/8"))
    line = F.concat(
        F.format_string("[%s][user/team][trainer][ip-10-0-0-1][%s][INFO] ",
                        F.date_format("ts", "yyyyMMdd HH:mm:ss"), rank),
        F.format_string("step: %d  loss: %.4f  grad_norm: %.4f  memory: %.2fGiB(%.2f%%)  tps: ",
                        "iter", "loss", "grad_norm", "memory", F.col("memory") / 192 * 100),
        tps_txt,
        F.format_string("  tflops: %.2f  mfu: %.2f%%", "tflops", "mfu"))
    steps = s.select(titan_path().alias("path"), "line_no", line.alias("line"))
    runs = s.select("run").distinct()
    bs = F.format_string("training.local_batch_size ........ %d", (1 + F.col("run") % 8))
    seq = F.format_string("training.seq_len ................. %d", 1024 * (1 + F.col("run") % 4))
    cfg = runs.select(titan_path().alias("path"), F.lit(0).cast("long").alias("line_no"), bs.alias("line")) \
        .unionByName(runs.select(titan_path().alias("path"), F.lit(1).cast("long").alias("line_no"),
                                 seq.alias("line"))) \
        .unionByName(runs.select(titan_path().alias("path"), F.lit(10 ** 9).cast("long").alias("line_no"),
                                 F.lit("training.local_batch_size ........ 999").alias("line")))
    return steps.unionByName(cfg)


def maxtext_path() -> F.Column:
    return F.concat(F.lit("logs/maxtext/run_"), F.col("run").cast("string"), F.lit(".log"))


def v_maxtext_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value")
    base = v_steps(spark, sf_dir).select(
        "run", "iter", "event_id", "event_type", "ts", "gbs",
        (F.col("iter") * 10).cast("long").alias("line_no"),
        F.round(v / 10, 3).alias("seconds"), "tflops", "tokens",
        F.round(v / 10 + 2, 3).alias("loss"))
    rep = base.filter(F.col("event_type") == "view").select(
        "run", "iter", "event_id", "event_type", "ts", "gbs",
        (F.col("line_no") + 1).alias("line_no"),
        F.round(v_col("seconds") + 1, 3).alias("seconds"), (F.col("tflops") + 1).alias("tflops"),
        (F.col("tokens") + 1).alias("tokens"), "loss")
    return base.unionByName(rep)


def v_col(name: str) -> F.Column:
    return F.col(name)


def v_maxtext_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = v_maxtext_steps(spark, sf_dir)
    tok = F.when(F.col("event_id") % 3 == 0, F.format_number("tokens", 3)) \
        .otherwise(F.format_string("%.3f", "tokens"))
    line = F.concat(
        F.format_string("[%s][INFO] completed step: %d, seconds: %.3f, TFLOP/s/device: %.3f, Tokens/s/device: ",
                        F.date_format("ts", "yyyyMMdd HH:mm:ss"), "iter", "seconds", "tflops"),
        tok,
        F.format_string(", total_weights: %d, loss: %.3f", F.col("gbs") * 1024, "loss"))
    line = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit(ESC + "[1m"), line, F.lit(ESC + "[0m"))) \
        .otherwise(line)
    return s.select(maxtext_path().alias("path"), "line_no", line.alias("line"))


# Arguments dump: per run a block of `name ..... value` lines.
ARG_KEYS = ("data_parallel_size tensor_model_parallel_size pipeline_model_parallel_size "
            "expert_model_parallel_size expert_tensor_parallel_size use_torch_fsdp2 "
            "recompute_granularity recompute_method recompute_num_layers seq_length "
            "micro_batch_size global_batch_size").split()


def v_arg_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed (run, pos, key, value): values from the run number modulo small numbers;
    ``micro_batch_size`` is written twice (the second wins)."""
    runs = v_steps(spark, sf_dir).select("run").distinct()
    r = F.col("run")
    vals = [
        F.pow(F.lit(2), r % 4).cast("long").cast("string"),
        (1 + r % 2).cast("string"),
        (1 + r % 3).cast("string"),
        F.pow(F.lit(2), r % 3).cast("long").cast("string"),
        F.lit("1"),
        F.when(r % 5 == 0, F.lit("True")).otherwise(F.lit("False")),
        F.when(r % 2 == 0, F.lit("full")).otherwise(F.lit("selective")),
        F.when(r % 2 == 0, F.lit("block")).otherwise(F.lit("None")),
        (r % 4).cast("string"),
        (F.lit(1024) * (1 + r % 4)).cast("string"),
        (1 + r % 3).cast("string"),
        (F.lit(64) * (1 + r % 4)).cast("string"),
    ]
    entries = [F.struct(F.lit(i).alias("pos"), F.lit(k).alias("key"), val.alias("value"))
               for i, (k, val) in enumerate(zip(ARG_KEYS, vals))]
    entries.append(F.struct(F.lit(len(ARG_KEYS)).alias("pos"), F.lit("micro_batch_size").alias("key"),
                            (2 + r % 3).cast("string").alias("value")))
    return runs.select("run", F.inline(F.array(*entries)))


def args_path() -> F.Column:
    return F.concat(F.lit("logs/args/run_"), F.col("run").cast("string"), F.lit(".log"))


def v_args(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = v_arg_values(spark, sf_dir)
    dots = F.expr("repeat('.', 48 - length(key))")
    line = F.concat(F.lit("[20240101 00:00:00][INFO] [arguments]: "), F.col("key"), F.lit(" "), dots,
                    F.lit(" "),
                    F.when(F.col("key") == "recompute_method",
                           F.concat(F.lit(ESC + "[33m"), F.col("value"), F.lit(ESC + "[0m")))
                    .otherwise(F.col("value")))
    noise = a.select("run").distinct().select(
        args_path().alias("path"), F.lit(100).cast("long").alias("line_no"),
        F.lit("[20240101 00:00:01][INFO] ------------------- end of arguments ---------------------").alias("line"))
    return a.select(args_path().alias("path"), F.col("pos").cast("long").alias("line_no"),
                    line.alias("line")).unionByName(noise)

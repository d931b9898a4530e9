"""Training-log jobs: line tables -> step facts -> per-file summaries.

Input of every parser is a line table ``(path, line_no, line)`` (files, test
views and streams alike). Parsers are pure projections/filters; summaries are
partial+final aggregations, so a hot file never lands in one task whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepfold.functions.text import comma_number, extract, strip_ansi, to_double, to_int, to_long
from stepfold.operators.common import first_k, written

# Fixed patterns that must equal the reference's log layouts.
NUM = r"[\d,]+(?:\.\d+)?"
MEGATRON_STEP = (r"(?i)iteration\s+(\d+)/\s*\d+.*?"
                 r"elapsed time per iteration \(ms\):\s*(" + NUM + r").*?"
                 r"throughput per GPU \(TFLOP/s/GPU\):\s*(" + NUM + r").*?"
                 r"tokens per GPU \(tokens/s/GPU\):\s*(" + NUM + r").*?"
                 r"global batch size:\s*(\d+)")
TITAN_STEP = (r"step:\s*(\d+).*?memory:\s*([\d.]+)GiB.*?tps:\s*(" + NUM + r").*?"
              r"tflops:\s*(" + NUM + r").*?mfu:\s*([\d.]+)%")
TITAN_DAILY_STEP = (r"rank-0(?:/\d+)?.*?step:\s*(\d+)\s+loss:\s*([\d.]+)\s+grad_norm:\s*([\d.]+)\s+"
                    r"memory:\s*([\d.]+)GiB\(([\d.]+)%\)\s+tps:\s*([\d,]+)\s+tflops:\s*([\d.]+)\s+"
                    r"mfu:\s*([\d.]+)%")
TITAN_BATCH = r"training\.local_batch_size\s*\.{2,}\s*(\d+)"
TITAN_SEQ = r"training\.seq_len\s*\.{2,}\s*(\d+)"
MAXTEXT_STEP = (r"(?i)completed\s+step:\s*(\d+).*?seconds:\s*([\d.]+).*?TFLOP/s/device:\s*([\d.]+).*?"
                r"Tokens/s/device:\s*([\d,]+(?:\.\d+)?).*?loss:\s*([\d.]+)")
ARGUMENT = r"\]:\s+([a-zA-Z0-9_]+)\s+\.{3,}\s+(.*)$"
COMPLETION_MARKER = "Training completed."


SEPARATOR = "\u0001"  # does not occur in log text


def _once(lines: DataFrame, **columns: Column) -> DataFrame:
    """(path, line_no) and the given columns, each worked out once a line: no filter or projection after the
    generator repeats its expression, or that which renders the line."""
    return lines.select("path", "line_no", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def _parsed(lines: DataFrame, pattern: str, names_casts: list[tuple[str, str]]) -> DataFrame:
    """(path, line_no, groups) of the lines that match. One search gives all
    groups: the line is replaced by them, and a line without a match stays one part."""
    n = len(names_casts)
    groups = SEPARATOR.join(f"${i}" for i in range(1, n + 1))
    parts = F.split(F.regexp_replace("line", f"^.*?{pattern}.*$", groups), SEPARATOR)
    conv = {"long": to_long, "int": to_int, "double": to_double, "num": comma_number}
    return (_once(lines, _g=parts).filter(F.size("_g") == n)
            .select("path", "line_no", *[conv[kind](F.get("_g", F.lit(i))).alias(name)
                                         for i, (name, kind) in enumerate(names_casts)]))


# ---------------------------------------------------------------- PRJ1

def strip_ansi_lines(lines: DataFrame) -> DataFrame:
    """PRJ1: the same line table with escape codes removed."""
    return lines.withColumn("line", strip_ansi("line"))


# ---------------------------------------------------------------- PRJ4

def parse_megatron_steps(lines: DataFrame) -> DataFrame:
    """PRJ4: (path, line_no, iter, elapsed_ms, tflops_gpu, tokens_gpu, gbs)."""
    return _parsed(lines, MEGATRON_STEP, [("iter", "long"), ("elapsed_ms", "num"), ("tflops_gpu", "num"),
                                          ("tokens_gpu", "num"), ("gbs", "long")])


def _warm_dropped_means(steps: DataFrame, order: list[str], metrics: list[str], first_kept: list[str],
                        drop: int = 2) -> DataFrame:
    """Per path: drop the first ``drop`` rows in ``order``, mean of ``metrics``
    over the rest, ``first_kept`` columns of the first kept row; files with
    ``<= drop`` rows are skipped.

    The place of the last dropped row comes from a top-k with a partial
    window-group limit (one row per file); the means are plain partial
    aggregates over the rows after it, so no file is sorted whole in one task.
    """
    place = F.struct(*order)
    cut = first_k(steps.select("path", *order), ["path"], order, drop).filter(F.col("rn") == drop) \
        .select("path", place.alias("_cut"))
    kept = steps.join(cut, "path").filter(place > F.col("_cut"))
    return kept.groupBy("path").agg(F.count(F.lit(1)).alias("n_steps"), *[F.avg(m).alias(m) for m in metrics],
                                    *[F.min_by(F.col(c), place).alias(c) for c in first_kept])


def megatron_averages(steps: DataFrame) -> DataFrame:
    """AGG1: per file, sort by iteration, drop the first two rows, means."""
    metrics = ["elapsed_ms", "tflops_gpu", "tokens_gpu"]
    return _warm_dropped_means(written(steps.select("path", "line_no", "iter", *metrics, "gbs")), ["iter", "line_no"], metrics, ["gbs"])


# ---------------------------------------------------------------- PRJ2

def parse_train_log(lines: DataFrame) -> DataFrame:
    """PRJ2: segment parser. Split on '|', trim, recognise known segments
    (first match per field), keep all segments in ``segments``.

    The reference's number class ``[0-9.+-eE]`` also spans '+'..'e' (so a
    value such as ``6046.6/6100.0`` fails to convert and stops the parse);
    here the first number of the segment is taken and parsing continues.
    Lines without an ``iteration i/N`` segment are not step lines and dropped.
    """
    segs = F.transform(F.split(F.col("line"), r"\|"), lambda s: F.trim(s))
    idx = F.sequence(F.lit(0), F.size(segs) - 1)

    def first_seg(prefix: str) -> Column:
        # index of the first segment starting with prefix
        hits = F.filter(F.arrays_zip(idx.alias("i"), segs.alias("s")),
                        lambda z: z["s"].startswith(prefix))
        return F.try_element_at(hits, F.lit(1))

    it = F.filter(segs, lambda s: s.rlike(r"iteration\s+\d+\s*/\s*\d+"))
    it0 = F.try_element_at(it, F.lit(1))
    el = first_seg("elapsed time per iteration (ms):")
    th = first_seg("throughput per GPU (TFLOP/s/GPU):")
    cs = F.try_element_at(F.filter(segs, lambda s: s.startswith("consumed samples:")), F.lit(1))
    gb = F.try_element_at(F.filter(segs, lambda s: s.startswith("global batch size:")), F.lit(1))
    num = r"([0-9]+(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?)"
    parsed = lines.select(
        "path", "line_no",
        to_long(F.regexp_extract(it0, r"iteration\s+(\d+)\s*/\s*(\d+)", 1)).alias("iteration"),
        to_long(F.regexp_extract(it0, r"iteration\s+(\d+)\s*/\s*(\d+)", 2)).alias("train_iters"),
        to_long(F.regexp_extract(cs, r"consumed samples:\s*([0-9]+)", 1)).alias("consumed_samples"),
        to_double(F.regexp_extract(el["s"], r"\(ms\):\s*" + num, 1)).alias("elapsed_ms"),
        el["i"].cast("int").alias("elapsed_index"),
        to_double(F.regexp_extract(th["s"], r"\(TFLOP/s/GPU\):\s*" + num, 1)).alias("throughput_tflops"),
        th["i"].cast("int").alias("throughput_index"),
        to_long(F.regexp_extract(gb, r"global batch size:\s*([0-9]+)", 1)).alias("global_batch_size"),
        segs.alias("segments"))
    return parsed.filter(F.col("iteration").isNotNull())


# ---------------------------------------------------------------- PRJ3

def enrich_train_log(parsed: DataFrame, averages: DataFrame, memory_text: DataFrame | None = None) -> DataFrame:
    """PRJ3: rewrite each parsed line with running averages.

    ``averages``: (path, line_no, elapsed_avg, tflops_avg, tokens_inst, tokens_avg) from WIN1;
    elapsed and TFLOP/s segments become ``inst/avg`` (1 decimal) in place, a tokens
    segment is added right after the throughput segment, memory text (WIN3) last;
    empty segments dropped; joined by `` | ``.
    """
    df = parsed.join(averages, ["path", "line_no"], "left")
    if memory_text is not None:
        df = df.join(memory_text, ["path", "line_no"], "left")
    else:
        df = df.withColumn("memory_text", F.lit(None).cast("string"))
    ei, ti = F.col("elapsed_index"), F.col("throughput_index")
    tok = F.when(F.col("tokens_avg").isNotNull(),
                 F.format_string("tokens per GPU (tokens/s/GPU): %.1f/%.1f", "tokens_inst", "tokens_avg"))

    def rewrite(s, i):
        el = F.when((i == ei) & F.col("elapsed_avg").isNotNull(),
                    F.format_string("elapsed time per iteration (ms): %.1f/%.1f", "elapsed_ms", "elapsed_avg"))
        th = F.when((i == ti) & F.col("tflops_avg").isNotNull(),
                    F.format_string("throughput per GPU (TFLOP/s/GPU): %.1f/%.1f",
                                    "throughput_tflops", "tflops_avg"))
        base = F.coalesce(el, th, s)
        # tokens segment goes right after the throughput segment
        return F.when((i == ti) & tok.isNotNull(), F.array(base, tok)).otherwise(F.array(base))

    segs = F.flatten(F.transform("segments", rewrite))
    segs = F.concat(segs, F.array(F.col("memory_text")))
    segs = F.filter(segs, lambda s: s.isNotNull() & (s != ""))
    return df.select("path", "line_no", F.array_join(segs, " | ").alias("line"))


# ---------------------------------------------------------------- PRJ5 / AGG2

def parse_titan_steps(lines: DataFrame) -> DataFrame:
    """PRJ5: (path, line_no, step, memory_gib, tps, tflops, mfu) plus the
    per-file config (first occurrence of local batch size and seq length)."""
    steps = _parsed(lines, TITAN_STEP, [("step", "long"), ("memory_gib", "double"), ("tps", "num"),
                                        ("tflops", "num"), ("mfu", "double")])
    cfg = titan_config(lines)
    return steps.join(cfg, "path", "left")


def titan_config(lines: DataFrame) -> DataFrame:
    """First-seen batch size and sequence length per file (min_by over line_no)."""
    l = F.col("line")
    bs = to_long(F.regexp_extract(l, TITAN_BATCH, 1))
    seq = to_long(F.regexp_extract(l, TITAN_SEQ, 1))
    return (lines.filter(l.contains("training."))
            .select("path", "line_no", bs.alias("bs"), seq.alias("seq"))
            .groupBy("path")
            .agg(F.min_by("bs", F.when(F.col("bs").isNotNull(), F.col("line_no"))).alias("local_batch_size"),
                 F.min_by("seq", F.when(F.col("seq").isNotNull(), F.col("line_no"))).alias("seq_len")))


def titan_averages(steps: DataFrame) -> DataFrame:
    """AGG2: per file, sort by step, drop the first two rows, means; config joined."""
    metrics = ["memory_gib", "tps", "tflops", "mfu"]
    steps = written(steps.select("path", "line_no", "step", *metrics, "local_batch_size", "seq_len"))  # lines are searched once
    out = _warm_dropped_means(steps, ["step", "line_no"], metrics, [])
    cfg = steps.groupBy("path").agg(F.max("local_batch_size").alias("local_batch_size"), F.max("seq_len").alias("seq_len"))
    return out.join(cfg, "path", "left")


# ---------------------------------------------------------------- PRJ6

def parse_maxtext_steps(lines: DataFrame) -> DataFrame:
    """PRJ6: (path, line_no, step, seconds, tflops, tokens, loss) from ANSI-free text."""
    return _parsed(strip_ansi_lines(lines), MAXTEXT_STEP,
                   [("step", "long"), ("seconds", "double"), ("tflops", "double"), ("tokens", "num"), ("loss", "double")])


def parse_titan_daily_steps(lines: DataFrame) -> DataFrame:
    """Daily-report variant of PRJ5: rank-0 lines only, with loss and grad norm."""
    return _parsed(strip_ansi_lines(lines), TITAN_DAILY_STEP,
                   [("step", "long"), ("loss", "double"), ("grad_norm", "double"), ("memory_gib", "double"),
                    ("memory_pct", "double"), ("tps", "num"), ("tflops", "double"), ("mfu", "double")])


# ---------------------------------------------------------------- PRJ7

def parse_inst_avg_steps(lines: DataFrame) -> DataFrame:
    """PRJ7: ``inst/avg`` pairs and memory (GB or GiB), extracted per segment
    (so the segment order of the two layouts does not matter). Line-scoped."""
    pair = r"\):\s*([\d.]+)(?:/([\d.]+))?"

    def seg(pattern: str) -> Column:
        """The text from the first match of ``pattern`` to the end of its segment (or of the line of text)."""
        return F.regexp_extract("line", pattern + r"[^|\n\r\u0085\u2028\u2029]*", 0)

    mem = r":\s*([\d.]+)\s*G(?:i)?B/([\d.]+)\s*G(?:i)?B/([\d.]+)\s*G(?:i)?B/([\d.]+)%"
    kept = (_once(lines, line=strip_ansi("line"))
            .filter(F.col("line").contains("elapsed time per iteration"))  # before any search
            .filter(F.col("line").rlike(r"iteration\s+\d+\s*/\s*\d+") &
                    F.col("line").rlike(r"elapsed time per iteration\s*\(ms\):\s*[\d.]+")))
    parts = _once(kept, it=F.regexp_extract("line", r"iteration\s+(\d+)\s*/", 1), old=F.regexp_extract("line", r"mem usages:\s*([\d.]+)", 1),
                  el=seg(r"elapsed time per iteration\s*\(ms\)"), th=seg(r"throughput per GPU\s*\(TFLOP/s/GPU\)"),
                  tk=seg(r"tokens per GPU\s*\(tokens/s/GPU\)"), hip=seg(r"hip mem usage/free/total/usage_ratio:"))
    texts = _once(parts, it=F.col("it"), old=F.col("old"), **{f"{c}{i}": F.regexp_extract(c, pair, i) for c in ("el", "th", "tk") for i in (1, 2)},
                  **{f"hip{i}": F.regexp_extract("hip", mem, i) for i in (1, 2, 3, 4)})
    return texts.select("path", "line_no", to_long("it").alias("iter"),
                        to_double("el1").alias("elapsed_ms"), to_double("el2").alias("elapsed_ms_avg"),
                        to_double("th1").alias("tflops"), to_double("th2").alias("tflops_avg"),
                        to_double("tk1").alias("tokens"), to_double("tk2").alias("tokens_avg"),
                        F.coalesce(to_double("hip1"), to_double("old")).alias("mem_used_gb"),
                        to_double("hip2").alias("mem_free_gb"), to_double("hip3").alias("mem_total_gb"),
                        to_double("hip4").alias("mem_ratio_pct"))


# ---------------------------------------------------------------- AGG3-AGG7

def last_step_metrics(inst_steps: DataFrame) -> DataFrame:
    """AGG3: last matching line per file; averages of the last step.
    Seconds = avg ms / 1000. (Display rounding 2/3/1/2 is applied by the report sink.)"""
    last = F.max_by(F.struct("tflops_avg", "elapsed_ms_avg", "tokens_avg", "mem_used_gb"), F.col("line_no"))
    return (inst_steps.groupBy("path").agg(last.alias("l"))
            .select("path", F.col("l.tflops_avg").alias("tflops_gpu"),
                    (F.col("l.elapsed_ms_avg") / 1000.0).alias("step_time_s"),
                    F.col("l.tokens_avg").alias("tokens_gpu"),
                    F.col("l.mem_used_gb").alias("mem_usage")))


def last_step_blend(inst_steps: DataFrame) -> DataFrame:
    """AGG4 (older report): step time = mean of inst and avg, TFLOP/s = max, tokens = mean."""
    last = F.max_by(F.struct("elapsed_ms", "elapsed_ms_avg", "tflops", "tflops_avg", "tokens",
                             "tokens_avg", "mem_used_gb"), F.col("line_no"))
    return (inst_steps.groupBy("path").agg(last.alias("l"))
            .select("path",
                    F.greatest("l.tflops", "l.tflops_avg").alias("tflops_gpu"),
                    ((F.col("l.elapsed_ms") + F.col("l.elapsed_ms_avg")) / 2000.0).alias("step_time_s"),
                    ((F.col("l.tokens") + F.col("l.tokens_avg")) / 2).alias("tokens_gpu"),
                    F.col("l.mem_used_gb").alias("mem_usage")))


def all_step_means(titan_daily_steps: DataFrame) -> DataFrame:
    """AGG5: mean over all matched steps of a file (no warm-up drop)."""
    return titan_daily_steps.groupBy("path").agg(
        F.avg("tflops").alias("tflops_gpu"), F.avg("tps").alias("tokens_gpu"),
        F.avg("memory_gib").alias("mem_usage"), F.count(F.lit(1)).alias("n_steps"))


def dedup_step_means(maxtext_steps: DataFrame) -> DataFrame:
    """AGG6: a repeated step keeps its last occurrence, then means per file."""
    last = (maxtext_steps.groupBy("path", "step")
            .agg(F.max_by(F.struct("seconds", "tflops", "tokens"), F.col("line_no")).alias("l")))
    return last.groupBy("path").agg(
        F.avg("l.tflops").alias("tflops_gpu"), F.avg("l.tokens").alias("tokens_gpu"),
        F.avg("l.seconds").alias("step_time_s"), F.count(F.lit(1)).alias("n_steps"))


# Framework names of the daily report.
DAILY_FRAMEWORKS = ("megatron", "torchtitan", "maxtext")


def daily_report(megatron_lines: DataFrame, titan_lines: DataFrame, maxtext_lines: DataFrame) -> DataFrame:
    """AGG7: dispatch by framework onto AGG3/AGG5/AGG6, one schema.
    The framework is the path part before the file (dimension of SRC2)."""
    m = last_step_metrics(parse_inst_avg_steps(megatron_lines)).withColumn("framework", F.lit("megatron"))
    t = all_step_means(parse_titan_daily_steps(titan_lines)).drop("n_steps") \
        .withColumn("framework", F.lit("torchtitan"))
    x = dedup_step_means(parse_maxtext_steps(maxtext_lines)).drop("n_steps") \
        .withColumn("framework", F.lit("maxtext"))
    return m.unionByName(t, allowMissingColumns=True).unionByName(x, allowMissingColumns=True)


def daily_report_errors(lines: DataFrame) -> DataFrame:
    """AGG7 error side: files of a known framework with no parsable step,
    and files of an unknown framework (reported, not fatal)."""
    fw = F.element_at(F.split("path", "/"), -2)
    known = fw.isin(*DAILY_FRAMEWORKS)
    any_step = (F.col("line").rlike(MEGATRON_STEP) | F.col("line").rlike(TITAN_STEP) |
                F.col("line").rlike(MAXTEXT_STEP))
    per_file = lines.groupBy("path").agg(F.bool_or(any_step).alias("has_step"))
    return per_file.select(
        "path",
        F.when(~known, F.lit("unknown framework"))
        .when(~F.col("has_step"), F.lit("no valid iteration metrics")).alias("error")
    ).filter(F.col("error").isNotNull())


# ---------------------------------------------------------------- AGG27

def run_completion(lines: DataFrame, exit_marker: str = "exited with code 0") -> DataFrame:
    """AGG27: files whose process ended normally but lack the completion marker."""
    return (lines.groupBy("path")
            .agg(F.bool_or(F.col("line").contains(COMPLETION_MARKER)).alias("completed"),
                 F.bool_or(F.col("line").contains(exit_marker)).alias("exited_ok"))
            .filter(F.col("exited_ok") & ~F.col("completed"))
            .select("path"))


# ---------------------------------------------------------------- PRJ8/PRJ9

def parse_arguments(lines: DataFrame) -> DataFrame:
    """PRJ8: ``]: name ..... value`` lines -> (path, key, value), last value wins,
    ANSI removed from values. Long form (one row per key) so keys stay dynamic."""
    l = F.col("line")
    kv = (lines.filter(l.rlike(ARGUMENT))
          .select("path", "line_no",
                  F.trim(F.regexp_extract(l, ARGUMENT, 1)).alias("key"),
                  strip_ansi(F.trim(F.regexp_extract(l, ARGUMENT, 2))).alias("value")))
    return kv.groupBy("path", "key").agg(F.max_by("value", "line_no").alias("value"))


def arguments_map(args_long: DataFrame) -> DataFrame:
    """PRJ8 map form: one row per file with MAP<STRING,STRING>."""
    return args_long.groupBy("path").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("arguments"))


# Argument keys of the run-dimension columns.
DIMENSION_KEYS = {
    "dp": "data_parallel_size", "tp": "tensor_model_parallel_size",
    "pp": "pipeline_model_parallel_size", "ep": "expert_model_parallel_size",
    "etp": "expert_tensor_parallel_size", "fsdp": "use_torch_fsdp2",
}
RECOMPUTE_KEYS = ("recompute_granularity", "recompute_method", "recompute_num_layers")


def run_dimensions(args_long: DataFrame) -> DataFrame:
    """PRJ9: parallel layout and recompute info per file; missing -> empty string.
    Conditional aggregation of the long table (a bounded pivot on fixed keys)."""
    def pick(k: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("key") == k, F.col("value"))), F.lit(""))
    return args_long.groupBy("path").agg(
        *[pick(k).alias(name) for name, k in DIMENSION_KEYS.items()],
        F.concat_ws("/", *[pick(k) for k in RECOMPUTE_KEYS]).alias("recompute"))

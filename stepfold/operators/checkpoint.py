"""Checkpoint analytics: rank logs -> paired save/load events -> durations and bandwidth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepfold.functions.text import log_time, strip_ansi
from stepfold.operators.common import global_running, written

# Fixed patterns of the logger header and the checkpoint messages.
HEADER = r"\[(.*?)\].*?\.py:\d+\]:\s*(.*)"
RANK_DIR = r"rank-(\d+)/"
SAVE_START = "saving checkpoint at iteration"
SAVE_END = "successfully saved checkpoint from iteration"
ASYNC_SCHEDULED = "scheduled an async checkpoint save"
LOAD_START = "loading checkpoint from"
LOAD_END = "successfully loaded checkpoint from"
OVERLAP = "Starting a checkpoint save before previous has finished"
ARGUMENT = r"(\S+)\s\.{3,}\s(.+)"


def read_rank_logs(lines: DataFrame, run_col: str = "run") -> DataFrame:
    """SRC4: messages of the first and the last rank of each run, header
    parsed, ANSI removed, duplicate (time, message) pairs removed.

    ``lines`` is (run, path, line_no, line) with ``rank-<r>/`` in the path.
    The paths alone, a row for each file, tell which files are a run's first and last
    rank; only their lines are read on, whatever the number of ranks.
    """
    files = lines.groupBy(run_col, "path").agg(F.first(F.regexp_extract("path", RANK_DIR, 1).cast("int")).alias("rank"))
    last = files.groupBy(run_col).agg(F.max("rank").alias("_last"))
    files = files.join(last, run_col).where((F.col("rank") == 0) | (F.col("rank") == F.col("_last"))).select("path")
    kept = lines.join(files, "path", "left_semi")
    # ANSI codes are removed before the header match (an escape such as
    # ESC[32m before the first bracket would otherwise open the time group).
    clean = kept.select(run_col, "line_no", strip_ansi("line").alias("line"))
    parsed = clean.filter(F.col("line").rlike(HEADER)).select(
        run_col, "line_no",
        F.trim(F.regexp_extract("line", HEADER, 1)).alias("time"),
        F.trim(F.regexp_extract("line", HEADER, 2)).alias("msg"))
    # Keep-first by line_no for each (time, message): dedup as an aggregate.
    return (parsed.groupBy(run_col, "time", "msg").agg(F.min("line_no").alias("line_no"))
            .withColumn("ts", log_time("time")))


def pair_events(events: DataFrame, start: str, end: str, run_col: str = "run") -> DataFrame:
    """JN4: n-th start with n-th end of a run, one row for each n; ``paired`` is
    false where one side is missing. Starts and ends are numbered in one pass,
    range by range, so one long run is spread over tasks."""
    is_start, is_end = F.col("msg").contains(start), F.col("msg").contains(end)
    marked = written(events.filter(is_start | is_end).select(
        run_col, "ts", "line_no", "msg", F.when(is_start, 1).alias("_is_start"), F.when(is_end, 1).alias("_is_end")))
    placed = global_running(marked, ["ts", "line_no", "msg"], [run_col],
                            {"_starts": F.count("_is_start"), "_ends": F.count("_is_end")})
    sides = F.array(F.struct(F.col("_starts").alias("n"), (F.col("_is_start") == 1).alias("there"), F.lit("start").alias("side")),
                    F.struct(F.col("_ends").alias("n"), (F.col("_is_end") == 1).alias("there"), F.lit("end").alias("side")))
    long = placed.select(run_col, "ts", F.inline(F.filter(sides, lambda s: s["there"])))
    return (long.groupBy(run_col, (F.col("n") + 1).cast("int").alias("n"))
            .agg(F.max(F.when(F.col("side") == "start", F.col("ts"))).alias("start_ts"),
                 F.max(F.when(F.col("side") == "end", F.col("ts"))).alias("end_ts"))
            .withColumn("seconds", F.timestamp_diff("SECOND", F.col("start_ts"), F.col("end_ts")))
            .withColumn("paired", F.col("start_ts").isNotNull() & F.col("end_ts").isNotNull()))


def checkpoint_sizes(files: DataFrame, run_col: str = "run") -> DataFrame:
    """SRC9: bytes per ``iter_*`` folder from a (path, length) listing (the
    ``binaryFile`` source with only path and length selected)."""
    it = F.regexp_extract("path", r"iter_(\d+)", 1)
    return (files.filter(it != "")
            .select(F.regexp_extract("path", r"run_(\d+)", 1).cast("int").alias(run_col),
                    it.cast("long").alias("iteration"), "length")
            .groupBy(run_col, "iteration").agg(F.sum("length").alias("folder_bytes")))


def checkpoint_report(events: DataFrame, sizes: DataFrame | None = None, run_col: str = "run",
                      require_folder_match: bool = True) -> DataFrame:
    """AGG8: last save pair (whole seconds), async block time (start -> scheduled),
    ``accurate`` false on the overlap warning, number of saves, load time,
    last folder size and MB/s. Unequal start/end counts give NULL durations
    (the reference stops there). Event order is (time, line_no)."""
    def last(pattern: str) -> F.Column:
        return F.max_by(F.col("ts"), F.when(F.col("msg").contains(pattern), F.struct("ts", "line_no")))

    def count(pattern: str) -> F.Column:
        return F.count_if(F.col("msg").contains(pattern))

    arg_val = F.regexp_extract("msg", ARGUMENT, 2)
    st = events.groupBy(run_col).agg(
        count(SAVE_START).alias("num_saved"), count(SAVE_END).alias("_n_end"),
        count(ASYNC_SCHEDULED).alias("_n_async"),
        count(LOAD_START).alias("_n_ls"), count(LOAD_END).alias("_n_le"),
        last(SAVE_START).alias("_s0"), last(SAVE_END).alias("_s1"), last(ASYNC_SCHEDULED).alias("_a1"),
        last(LOAD_START).alias("_l0"), last(LOAD_END).alias("_l1"),
        F.bool_or(F.col("msg").contains(OVERLAP)).alias("_overlap"),
        F.max_by(arg_val, F.when(F.regexp_extract("msg", ARGUMENT, 1) == "async_save",
                                 F.col("line_no"))).alias("async_save"))
    ok = (F.col("num_saved") > 0) & (F.col("num_saved") == F.col("_n_end"))
    save_total = F.when(ok, F.timestamp_diff("SECOND", F.col("_s0"), F.col("_s1")))
    is_async = F.col("async_save") == "True"
    block = (F.when(~is_async, save_total)
             .when(F.col("_n_async") == F.col("num_saved"), F.timestamp_diff("SECOND", F.col("_s0"), F.col("_a1"))))
    load_ok = (F.col("_n_ls") > 0) & (F.col("_n_ls") == F.col("_n_le"))
    rep = st.select(run_col, "num_saved", save_total.alias("save_total_s"), block.alias("save_block_s"),
                    (~(is_async & F.coalesce(F.col("_overlap"), F.lit(False)))).alias("accurate"),
                    F.when(load_ok, F.timestamp_diff("SECOND", F.col("_l0"), F.col("_l1"))).alias("load_s"))
    if sizes is None:
        return rep
    sz = sizes.groupBy(run_col).agg(F.count(F.lit(1)).alias("_folders"),
                                    F.max_by("folder_bytes", "iteration").alias("_last_bytes"))
    rep = rep.join(sz, run_col, "left")
    match = F.lit(True) if not require_folder_match else (F.col("_folders") == F.col("num_saved"))
    size = F.when(match, F.col("_last_bytes"))
    mb = size / float(1 << 20)
    return rep.select(run_col, "num_saved", "save_total_s", "save_block_s", "accurate", "load_s",
                      size.alias("iter_folder_size"),
                      F.try_divide(mb, F.col("save_total_s")).alias("save_mbps"),
                      F.try_divide(mb, F.col("load_s")).alias("load_mbps"))

"""Structured Streaming versions of the log jobs (STR1-STR5).

The parsers are the batch expressions applied unchanged to a streaming line
table. The stateful jobs keep a few values per key in ``applyInPandasWithState``
state, so a restart resumes from the checkpoint. A key's rows of one micro-batch
are put in order before use (``maxFilesPerTrigger`` bounds a micro-batch).

Late rows are dropped and counted: for averages and carried values those that come in a later micro-batch
than a row behind them, for steps and intervals those whose log time the watermark has passed. With
``late=True`` a job emits its late rows too, told by a last column ``late``; ``write_with_late`` keeps
them out of the result and writes their number for each key and micro-batch.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupStateTimeout

from stepfold.operators import trainlog as T
from stepfold.sources.files import block_lines, number_lines


def stream_lines(spark: SparkSession, folder: str) -> DataFrame:
    """STR1 source: new log files of a folder as (path, line_no, line); each
    file is read whole (rotated logs are bounded)."""
    df = spark.readStream.text(folder, wholetext=True)
    df = df.select(F.col("_metadata.file_path").alias("path"), "value")
    return df.select("path", F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n"))
                     .alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("long"))


def stream_train_log(spark: SparkSession, folder: str) -> DataFrame:
    """STR1: growing log folder -> parsed step rows."""
    return T.parse_megatron_steps(stream_lines(spark, folder))


def train_log_writer(spark: SparkSession, folder: str, out: str, files_a_batch: int = 1000) -> DataStreamWriter:
    """STR1 for logs of any size: the parsed step rows of new files, written to ``out``/batch=<n>.

    Files are read in blocks, a long log by many tasks, and numbered by the batch job's rule, so the rows are
    those of the batch job. A micro-batch that is run again after a failure replaces its own folder."""
    lines = block_lines(spark.readStream.option("maxFilesPerTrigger", str(files_a_batch)).option("lineSep", "\n").text(folder))

    def write(batch: DataFrame, number: int) -> None:
        T.parse_megatron_steps(number_lines(batch)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return lines.writeStream.foreachBatch(write)


def write_with_late(stream: DataFrame, keys: list[str], out: str, late_out: str) -> DataStreamWriter:
    """A stream with column ``late``: rows in time go to ``out``/batch=<n>, the number of late ones by ``keys`` to ``late_out``/batch=<n>."""
    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        batch.where("not late").drop("late").write.mode("overwrite").parquet(f"{out}/batch={number}")
        batch.where("late").groupBy(*keys).agg(F.count("*").alias("n_late")).write.mode("overwrite").parquet(f"{late_out}/batch={number}")
        batch.unpersist()

    return stream.writeStream.foreachBatch(write)


STATE_SCHEMA = "seg_sum double, seg_n long, last_line long"
OUT_SCHEMA = "path string, line_no long, iter long, elapsed_ms double, elapsed_ms_avg double"


def _running(iters: np.ndarray, values: np.ndarray, total: float, n: int, skip: int, reset: int) -> tuple[np.ndarray, float, int]:
    """Averages of ordered rows after a block that has ``n`` values with sum ``total``; the last block's sum and number."""
    import pandas as pd

    avg = np.full(len(iters), np.nan)
    used = np.flatnonzero(iters > skip)
    if not len(used):
        return avg, total, n
    segment = np.cumsum(iters[used] == skip + 1)
    first = np.searchsorted(segment, segment)  # where each row's segment begins
    place = np.arange(len(used)) - first + np.where(segment == 0, n, 0)  # a block that is open goes on
    block = segment * (len(used) + n + 1) + place // reset
    sums = values[used].astype(float)
    if segment[0] == 0 and 0 < n < reset:
        sums[0] += total
    sums = pd.Series(sums).groupby(block, sort=False).cumsum().to_numpy()
    avg[used] = sums / (place % reset + 1)
    return avg, float(sums[-1]), int(place[-1] % reset + 1)


def stream_running_averages(steps: DataFrame, skip: int = 2, reset: int = 10, late: bool = False) -> DataFrame:
    """STR2: WIN1 semantics with state per file: rows of a micro-batch are
    ordered by line number; iteration skip+1 restarts, a block of ``reset``
    values restarts; warm-up rows get no average. A row at or before the last line of an earlier micro-batch is late."""
    def fn(key, pdfs, state):
        import pandas as pd
        total, n, last = state.get if state.exists else (0.0, 0, -1)
        rows = pd.concat(pdfs).sort_values("line_no", kind="stable")
        rows["late"] = rows["line_no"] <= last
        on_time = rows[~rows["late"]].copy()
        if len(on_time):
            on_time["elapsed_ms_avg"], total, n = _running(on_time["iter"].to_numpy(), on_time["elapsed_ms"].to_numpy(), total, n, skip, reset)
            state.update((total, n, int(on_time["line_no"].iloc[-1])))
        out = pd.concat([on_time, rows[rows["late"]].assign(elapsed_ms_avg=np.nan)]) if late else on_time
        yield out.astype({"elapsed_ms_avg": object}).where(out.notna(), None)[names] if len(out) else pd.DataFrame(columns=names)
    names = ["path", "line_no", "iter", "elapsed_ms", "elapsed_ms_avg"] + ["late"] * late
    return steps.select("path", "line_no", "iter", "elapsed_ms").groupBy("path").applyInPandasWithState(
        fn, OUT_SCHEMA + ", late boolean" * late, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)


def stream_carry_forward(rows: DataFrame, value: str, sampled: str, key: str, order: str, late: bool = False) -> DataFrame:
    """STR3: WIN3 with the last sampled value of each key in state. Output
    (key, order, value, carried); NULL before the first sample. A row whose ``order`` (a whole number) isn't behind the last one
    of an earlier micro-batch is late."""
    types = dict(rows.dtypes)

    def fn(group, pdfs, state):
        import pandas as pd
        held, at = state.get if state.exists else (None, None)
        some = pd.concat(pdfs).sort_values(order, kind="stable")
        some["late"] = (some[order] <= at) if at is not None else False
        on_time = some[~some["late"]].copy()
        if len(on_time):
            taken = on_time[value].where(on_time[sampled].fillna(False).astype(bool))
            on_time["carried"] = taken.ffill().fillna(np.nan if held is None else held)
            newest = on_time["carried"].iloc[-1]
            state.update((None if pd.isna(newest) else float(newest), int(on_time[order].iloc[-1])))
        out = pd.concat([on_time, some[some["late"]].assign(carried=np.nan)]) if late else on_time
        out = out.astype({value: object, "carried": object}).where(out.notna(), None) if len(out) else pd.DataFrame(columns=[key, *names])
        yield out.assign(**{key: group[0]})[[key, *names]]
    names = [order, value, "carried"] + ["late"] * late
    schema = f"`{key}` {types[key]}, `{order}` {types[order]}, `{value}` double, carried double" + ", late boolean" * late
    return rows.select(key, order, F.col(value).cast("double").alias(value), sampled).groupBy(key).applyInPandasWithState(
        fn, schema, "last double, at long", "append", GroupStateTimeout.NoTimeout)


def _watermarked(df: DataFrame, time: str, delay: str) -> DataFrame:
    """Each row twice, with its log time in ``_clock``, which carries the watermark, and with none, ``_ms`` being the log time in
    both: Spark drops rows behind the watermark unseen, so the job takes the second ones and judges them itself. Rows
    without a log time are left out."""
    clock = F.explode(F.array(F.col(time).cast("timestamp"), F.lit(None).cast("timestamp")))
    return df.where(F.col(time).isNotNull()).withColumns({"_ms": F.unix_millis(F.col(time).cast("timestamp")), "_clock": clock}).withWatermark("_clock", delay)


def stream_dedup_steps(steps: DataFrame, time: str = "ts", delay: str = "10 minutes",
                       keys: tuple[str, ...] = ("path", "iter"), order: str = "line_no", late: bool = False) -> DataFrame:
    """STR4: a step logged more than once is emitted once, as its last line, when
    the watermark has passed the step's latest log time by ``delay``; state is
    one row per open step. A step logged again after that is emitted again. A row whose log time the
    watermark has passed is late."""
    fields = [f for f in steps.schema.fields if f.name not in keys]
    names = [f.name for f in fields]
    at = names.index(order)
    columns = [*keys, *names] + ["late"] * late

    def plain(row) -> tuple:
        import pandas as pd
        return tuple(None if pd.isna(v) else v.item() if hasattr(v, "item") else v for v in row)

    def fn(group, pdfs, state):
        import pandas as pd
        out = []
        if state.hasTimedOut:
            held = state.get
            state.remove()
            out.append((*group, *held[:-1], False))
        else:
            held, watermark = tuple(state.get) if state.exists else None, state.getCurrentWatermarkMs()
            for pdf in pdfs:
                pdf = pdf[pdf["_clock"].isna()]
                passed = pdf["_ms"] <= watermark
                out += [(*group, *plain(r), True) for r in pdf.loc[passed, names].astype(object).itertuples(index=False)] if late else []
                pdf = pdf[~passed]
                if not len(pdf):
                    continue
                newest, latest = plain(pdf[names].sort_values(order).astype(object).iloc[-1]), int(pdf["_ms"].max())
                if held is None or newest[at] >= held[at]:
                    held = (*newest, max(latest, held[-1] if held else latest))
                else:
                    held = (*held[:-1], max(latest, held[-1]))
            if held is not None:
                state.update(held)
                state.setTimeoutTimestamp(max(held[-1], watermark + 1))
        yield pd.DataFrame([r[:len(columns)] for r in out], columns=columns)
    types = {f.name: f.dataType.simpleString() for f in steps.schema.fields}
    body = ", ".join(f"`{n}` {types[n]}" for n in names)
    out = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", " + body + ", late boolean" * late
    return _watermarked(steps, time, delay).select(*keys, *names, "_ms", "_clock").groupBy(*keys).applyInPandasWithState(
        fn, out, body + ", _latest_ms long", "append", GroupStateTimeout.EventTimeTimeout)


def stream_interval_loss(parts: DataFrame, log_interval: int, time: str = "ts", delay: str = "10 minutes", run: str = "run",
                         late: bool = False) -> DataFrame:
    """STR5: AGG22 over a stream of (run, iter, key, num, den, skipped, time). The
    counters of an interval are emitted once the watermark has passed its latest
    log time by ``delay``, and its state is dropped. State holds a sum per
    (iteration, key) and two flags per iteration: ``log_interval`` iterations at most. A row whose log time the watermark has
    passed is late; it is told by its run, interval and key."""
    run_type = dict(parts.dtypes)[run]

    def rows(group, iters, sums):
        advanced = sum(not skipped for skipped, _ in iters.values())
        skipped = len(iters) - advanced
        bad = sum(s and b for s, b in iters.values())
        for key in sorted({k for _, k in sums}):
            total = sum(v for (i, k), v in sums.items() if k == key and not iters[i][0])
            avg = total / max(1, advanced)
            yield (*group, key, avg if avg > 0 else None, advanced, skipped, bad, False)

    def fn(group, pdfs, state):
        import pandas as pd
        names = [run, "interval", "key", "avg_loss", "advanced", "skipped_iters", "nan_iters"] + ["late"] * late
        iters, sums, latest, passed = {}, {}, 0, []
        if state.exists:
            at, skipped, bad, of, keys, values, latest = state.get
            iters = {i: (s, b) for i, s, b in zip(at, skipped, bad)}
            sums = {(i, k): v for i, k, v in zip(of, keys, values)}
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([r[:len(names)] for r in rows(group, iters, sums)], columns=names)
            return
        watermark = state.getCurrentWatermarkMs()
        for pdf in pdfs:
            pdf = pdf[pdf["_clock"].isna()]
            if late:
                passed += [(*group, k, None, None, None, None, True) for k in pdf.loc[pdf["_ms"] <= watermark, "key"]]
            pdf = pdf[pdf["_ms"] > watermark]
            for i, k, value, skipped, bad, ms in zip(pdf["iter"], pdf["key"], pdf["value"], pdf["skipped"], pdf["bad"], pdf["_ms"]):
                was = iters.get(int(i), (False, False))
                iters[int(i)] = (was[0] or bool(skipped), was[1] or bool(bad))
                sums[int(i), k] = sums.get((int(i), k), 0.0) + float(value)
                latest = max(latest, int(ms))
        if iters:
            state.update(([*iters], [s for s, _ in iters.values()], [b for _, b in iters.values()],
                          [i for i, _ in sums], [k for _, k in sums], [*sums.values()], latest))
            state.setTimeoutTimestamp(max(latest, watermark + 1))
        yield pd.DataFrame(passed, columns=names)
    den = F.coalesce(F.col("den"), F.lit(1.0))
    flat = _watermarked(parts, time, delay).select(
        run, F.floor((F.col("iter") - 1) / log_interval).cast("long").alias("interval"), F.col("iter").cast("long").alias("iter"), "key",
        F.coalesce(F.col("num") / den, F.lit(0.0)).alias("value"), F.coalesce("skipped", F.lit(False)).alias("skipped"),
        F.coalesce(F.isnan("num") | (F.abs("num") == float("inf")), F.lit(False)).alias("bad"), "_ms", "_clock")
    return flat.groupBy(run, "interval").applyInPandasWithState(
        fn, f"`{run}` {run_type}, interval long, key string, avg_loss double, advanced long, skipped_iters long, nan_iters long" + ", late boolean" * late,
        "iters array<long>, skipped array<boolean>, bad array<boolean>, of array<long>, keys array<string>, sums array<double>, latest long",
        "append", GroupStateTimeout.EventTimeTimeout)

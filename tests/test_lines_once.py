"""A line is rendered and searched once; running averages and GPU reports move rows no more often than they need."""

from pyspark.sql import functions as F

from stepfold.operators import fleet, trainlog as T, windows as W


def counted(spark, texts):
    """Lines made by a function that counts its calls."""
    calls = spark.sparkContext.accumulator(0)

    def line(i):
        calls.add(1)
        return texts[i % len(texts)]

    df = spark.range(60).select(F.lit("p").alias("path"), F.col("id").alias("line_no"), F.udf(line, "string")("id").alias("line"))
    return df, calls


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


INST = (" iteration 5/ 10 | elapsed time per iteration (ms): 10.0/11.0 | throughput per GPU (TFLOP/s/GPU): 1.5/2.5"
        " | tokens per GPU (tokens/s/GPU): 3.0/4.0 | hip mem usage/free/total/usage_ratio: 1.00GiB/2.00GiB/3.00GiB/33.00% |")


def test_inst_avg_lines_are_searched_once(spark):
    df, calls = counted(spark, [INST, "other", INST.replace("hip mem usage/free/total/usage_ratio: 1.00GiB/2.00GiB/3.00GiB/33.00%", "mem usages: 7.5")])
    rows = T.parse_inst_avg_steps(df).collect()
    assert len(rows) == 40 and calls.value == 60
    assert {tuple(r)[2:] for r in rows} == {(5, 10.0, 11.0, 1.5, 2.5, 3.0, 4.0, 1.0, 2.0, 3.0, 33.0), (5, 10.0, 11.0, 1.5, 2.5, 3.0, 4.0, 7.5, None, None, None)}


def test_inst_avg_segment_ends_bound_values(spark):
    odd = [" iteration 5/ 10 | elapsed time per iteration (ms): 10.0 | throughput per GPU (TFLOP/s/GPU) | tokens per GPU (tokens/s/GPU): x | a): 9/9",
           " iteration 5/ 10 | throughput per GPU | throughput per GPU (TFLOP/s/GPU): 3/4 | throughput per GPU (TFLOP/s/GPU): 5/6 | elapsed time per iteration (ms): 1/2"]
    df = spark.createDataFrame([("p", i, t) for i, t in enumerate(odd)], "path string, line_no int, line string")
    rows = sorted(T.parse_inst_avg_steps(df).collect(), key=lambda r: r.line_no)
    assert tuple(rows[0])[2:7] == (5, 10.0, None, None, None) and rows[0].tokens is None
    assert tuple(rows[1])[2:7] == (5, 1.0, 2.0, 3.0, 4.0)


def test_titan_lines_are_searched_twice_at_most(spark):
    df, calls = counted(spark, [f"step: {i}  loss: 1.0  memory: 1.50GiB(1%)  tps: 1,000  tflops: 2.00  mfu: 3.00%" for i in range(6)])
    row, = T.titan_averages(T.parse_titan_steps(df)).collect()
    assert (row.n_steps, row.tps, row.tflops) == (58, 1000.0, 2.0)
    assert calls.value <= 120  # steps and configuration


def test_running_averages_move_rows_seldom(spark):
    rows = [("a" if i % 3 else None, i, i % 17, float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "path string, line_no int, iter int, elapsed_ms double")
    out = W.running_averages(df, ["elapsed_ms"], reset=4)
    assert plan(out).count("Exchange hashpartitioning") <= 3
    got = {r.line_no: r.elapsed_ms_avg for r in out.collect()}
    held = {}
    for path, no, it, value in rows:
        if it <= 2:
            assert got[no] is None
            continue
        mine = held.setdefault(path, [])
        if it == 3 or len(mine) == 4:
            mine.clear()
        mine.append(value)
        assert got[no] == sum(mine) / len(mine)


def test_gpu_records_are_dealt_before_they_are_sorted(spark):
    df = spark.createDataFrame([("h", 0, 0, "info", "GPU enumeration", "{}")], "host string, rank int, pos int, level string, message string, details string")
    assert "REPARTITION_BY_COL" in plan(fleet.gpu_host_report(df))

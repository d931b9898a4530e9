"""Late rows are dropped and counted over restarts; logs in blocks equal the batch job; traces keep unlike fields."""

import json
import os
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from stepfold.operators import trainlog as T
from stepfold.operators import windows as W
from stepfold.sinks import reports as R
from stepfold.sources import files as S
from stepfold.streaming import logs as ST
from tests.test_streams import _timed, _utc, _values  # noqa: F401


def run_late(spark, build, schema, batches, keys):
    """Rows in time and the number of late ones by key of the stream over ``batches``, stopped and begun again for each."""
    d = tempfile.mkdtemp(prefix="stepfold-late-")
    src, out, late = (os.path.join(d, x) for x in ("in", "out", "late"))
    os.makedirs(src)
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        q = (ST.write_with_late(build(spark.readStream.schema(schema).parquet(src)), keys, out, late)
             .option("checkpointLocation", os.path.join(d, "ckpt")).trigger(availableNow=True).start())
        assert q.awaitTermination(120)
    counts = {tuple(r[k] for k in keys): r["n"] for r in spark.read.parquet(late).groupBy(*keys).agg(F.sum("n_late").alias("n")).collect()}
    return spark.read.parquet(out).drop("batch"), counts


def test_late_lines_of_running_averages(spark):
    schema = "path string, line_no long, iter long, elapsed_ms double"
    rows = [(p, i, i + 1, 100.0 + 7 * i) for p in ("a", "b") for i in range(20)]
    first, second = [r for r in rows if r[1] < 9], [r for r in rows if r[1] >= 9]
    late = [("a", 3, 4, 999.0), ("a", 8, 9, 999.0), ("b", 0, 1, 999.0)]
    got, counts = run_late(spark, lambda s: ST.stream_running_averages(s, reset=4, late=True), schema, [first, second + late, [("a", 19, 20, 999.0)]], ["path"])
    want = W.running_averages(spark.createDataFrame(rows, schema), ["elapsed_ms"], reset=4)
    names = ("path", "line_no", "iter", "elapsed_ms", "elapsed_ms_avg")
    assert _values(got, *names) == _values(want, *names)
    assert counts == {("a",): 3, ("b",): 1}


def test_late_rows_of_carried_values(spark):
    schema = "run int, iter long, used double, sampled boolean"
    rows = [(r, i, float(10 * r + i) if i % 5 else None, i % 3 == 2) for r in (1, 2) for i in range(20)]
    batches = [[r for r in rows if r[1] < 7], [r for r in rows if r[1] >= 7] + [(1, 2, 5.0, True), (1, 6, 5.0, True)]]
    got, counts = run_late(spark, lambda s: ST.stream_carry_forward(s, "used", "sampled", "run", "iter", late=True), schema, batches, ["run"])
    want = W.carry_forward(spark.createDataFrame(rows, schema), "used", "sampled", ["run"], ["iter"], "carried")
    assert _values(got, "run", "iter", "used", "carried") == _values(want, "run", "iter", "used", "carried")
    assert counts == {(1,): 2}


def test_late_steps(spark):
    schema = "path string, iter long, line_no long, s long, loss double"
    batches = [[("a", 1, 0, 0, 1.0), ("a", 2, 1, 5, 2.0)], [("z", 1, 0, 100_000, 0.0)],
               [("a", 1, 3, 20, 4.0), ("a", 9, 9, 30, 4.0), ("b", 1, 0, 99_000, 4.0), ("b", 2, 0, 99_900, 5.0)], [("z", 2, 1, 200_000, 0.0)], [("z", 3, 1, 200_001, 0.0)]]
    got, counts = run_late(spark, lambda s: ST.stream_dedup_steps(_timed(s), late=True), schema, batches, ["path"])
    assert _values(got.where("path <> 'z'"), "path", "iter", "line_no", "loss") == sorted([("a", 1, 0, 1.0), ("a", 2, 1, 2.0), ("b", 2, 0, 5.0)], key=repr)
    assert counts == {("a",): 2, ("b",): 1}


def test_late_interval_parts(spark):
    schema = "run int, iter long, key string, num double, den double, skipped boolean, s long"
    on_time = [(1, i, "a", 3.0 * i, 2.0, False, i) for i in range(1, 6)]
    later = [(1, 3, "a", 1.0, 1.0, False, 3), (2, 3, "a", 1.0, 1.0, False, 4), (2, 3, "b", 1.0, 1.0, False, 4)]
    far = [(9, 1, "a", 1.0, 1.0, False, 10 ** 6)]
    got, counts = run_late(spark, lambda s: ST.stream_interval_loss(_timed(s), 10, late=True), schema, [on_time, far, later, [(9, 2, "a", 1.0, 1.0, False, 10 ** 6)]], ["run"])
    rows = got.where("run < 9").collect()
    assert [(r["run"], r["interval"], r["advanced"], round(r["avg_loss"], 9)) for r in rows] == [(1, 0, 5, round(sum(1.5 * i for i in range(1, 6)) / 5, 9))]
    assert counts == {(1,): 1, (2,): 2}


def test_averages_without_a_row_loop_equal_the_plain_rule():
    rng = random.Random(4)
    for _ in range(300):
        skip, reset = rng.randint(0, 3), rng.randint(1, 6)
        iters = []
        while len(iters) < rng.randint(1, 60):
            iters += range(rng.randint(1, 4), rng.randint(4, 15))
        values = [rng.uniform(1, 9) for _ in iters]
        want, s, n = [], 0.0, 0
        for it, v in zip(iters, values):
            if it > skip:
                if it == skip + 1 or n >= reset:
                    s, n = 0.0, 0
                s, n = s + v, n + 1
            want.append(s / n if it > skip else np.nan)
        got, total, held = [], 0.0, 0
        cut = rng.randint(0, len(iters))
        for part in (slice(0, cut), slice(cut, None)):
            avg, total, held = ST._running(np.array(iters[part], int), np.array(values[part]), total, held, skip, reset)
            got += avg.tolist()
        assert np.allclose(got, want, rtol=1e-12, equal_nan=True)


def test_a_log_over_several_splits(spark):
    d = tempfile.mkdtemp(prefix="stepfold-blocks-")
    src = os.path.join(d, "logs")
    os.makedirs(src)
    line = (" iteration {0:8d}/     500 | consumed samples: {0:12d} | elapsed time per iteration (ms): {1:.1f} | throughput per GPU (TFLOP/s/GPU): 100.0 | "
            "tokens per GPU (tokens/s/GPU): 10.0 | learning rate: 1.000000E-04 | global batch size:   128 | lm loss: 1.000000E+00 | loss scale: 1.0 | "
            "number of skipped iterations:   0 | number of nan iterations:   0 |")

    def write(name, n):
        with open(os.path.join(src, name), "w") as f:
            for i in range(1, n):
                f.write(("a note\n" if i % 7 == 0 else "") + line.format(i, 100 + i) + "\n")

    def run():
        q = ST.train_log_writer(spark, src, os.path.join(d, "out")).option("checkpointLocation", os.path.join(d, "ckpt")).trigger(availableNow=True).start()
        assert q.awaitTermination(120)

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000b")
    try:
        write("a.log", 80)
        run()
        write("b.log", 50)
        run()
        got = spark.read.parquet(os.path.join(d, "out")).drop("batch")
        want = T.parse_megatron_steps(S.read_log_lines(spark, src))
        assert want.count() == 128
        assert sorted(map(tuple, got.select(*want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("pretty", [None, 1])
def test_traces_with_unlike_fields_come_back_unchanged(spark, pretty):
    d = tempfile.mkdtemp(prefix="stepfold-variant-")
    traces = {"a": [{"name": "k", "ts": 1, "args": {"x": 1}, "id": 7}, {"name": "m", "ts": 2.5}],
              "b": [{"name": "k", "ts": "late", "args": [1, "two", None], "id": {"deep": [True]}}, {"name": None}], "c": []}
    for name, events in traces.items():
        with open(os.path.join(d, f"{name}.json"), "w") as f:
            json.dump({"traceEvents": events, "displayTimeUnit": "ns"}, f, indent=pretty)
    with open(os.path.join(d, "d.json"), "w") as f:
        json.dump({"other": 1}, f)
    events = S.read_trace_events(spark, d)
    assert dict(events.dtypes)["event"] == "variant"
    order = lambda some: sorted((json.dumps(e, sort_keys=True) for e in some))
    got = [(r["file"], json.loads(r["e"])) for r in events.where("event is not null").select("file", F.to_json("event").alias("e")).collect()]
    assert order(got) == order([(f"{n}.json", e) for n, some in traces.items() for e in some])
    R.write_merged_trace(events, os.path.join(d, "merged"))
    back = [json.loads(r[0]) for r in spark.read.text(os.path.join(d, "merged")).collect()]
    assert order(back) == order([e for some in traces.values() for e in some])

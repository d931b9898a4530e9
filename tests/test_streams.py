"""The stateful streams against their batch jobs: several files, a restart from the checkpoint, repeats, late flushes."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from stepfold.operators import losses as L
from stepfold.operators import windows as W
from stepfold.streaming import logs as ST


def _run(spark, build, schema, batches):
    """Rows that the stream over ``batches`` (one file each) emits; the query is stopped and begun again for each."""
    d = tempfile.mkdtemp(prefix="stepfold-streams-")
    src, out = os.path.join(d, "in"), os.path.join(d, "out")
    os.makedirs(src)
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        q = (build(spark.readStream.schema(schema).parquet(src)).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", os.path.join(d, "ckpt")).trigger(availableNow=True).start())
        assert q.awaitTermination(120)
    return spark.read.parquet(out)


def _values(df, *names):
    return sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*names).collect()], key=repr)


@pytest.fixture(scope="module", autouse=True)
def _utc(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    yield
    spark.conf.set("spark.sql.session.timeZone", old)


def test_running_averages_resume(spark):
    schema = "path string, line_no long, iter long, elapsed_ms double"
    iters = [1, 2, 3, 4, 5, 6, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14]
    rows = [(p, i, it, 100.0 + 7 * i) for p in ("a", "b") for i, it in enumerate(iters)]
    got = _run(spark, lambda s: ST.stream_running_averages(s, reset=4), schema, [[r for r in rows if r[1] < 9], [r for r in rows if r[1] >= 9]])
    want = W.running_averages(spark.createDataFrame(rows, schema), ["elapsed_ms"], reset=4)
    names = ("path", "line_no", "iter", "elapsed_ms", "elapsed_ms_avg")
    assert _values(got, *names) == _values(want, *names)


def test_carried_values_resume(spark):
    schema = "run int, iter long, used double, sampled boolean"
    rows = [(r, i, float(10 * r + i) if i % 5 else None, i % 3 == 2) for r in (1, 2) for i in range(20)]
    got = _run(spark, lambda s: ST.stream_carry_forward(s, "used", "sampled", "run", "iter"), schema,
               [[r for r in rows if r[1] < 7], [r for r in rows if r[1] >= 7]])
    want = W.carry_forward(spark.createDataFrame(rows, schema), "used", "sampled", ["run"], ["iter"], "carried")
    assert _values(got, "run", "iter", "used", "carried") == _values(want, "run", "iter", "used", "carried")


def _timed(df):
    return df.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s")))


def test_last_line_of_a_step(spark):
    schema = "path string, iter long, line_no long, s long, loss double"
    first = [("a", 1, 0, 0, 1.0), ("a", 2, 1, 5, 2.0), ("a", 1, 2, 9, None)]
    second = [("a", 1, 3, 20, 4.0), ("b", 1, 0, 30, 5.0), ("z", 1, 0, 100_000, 0.0)]
    got = _run(spark, lambda s: ST.stream_dedup_steps(_timed(s)), schema, [first, second, [("z", 2, 1, 200_000, 0.0)]])
    rows = _values(got.where("path <> 'z'"), "path", "iter", "line_no", "loss")
    assert rows == sorted([("a", 1, 3, 4.0), ("a", 2, 1, 2.0), ("b", 1, 0, 5.0)], key=repr)


def test_interval_loss(spark):
    schema = "run int, iter long, key string, num double, den double, skipped boolean, s long"
    rows = [(r, i, k, float("nan") if i == 7 else 3.0 * i + r, None if k == "b" else 2.0, i in (4, 7), 10 * i)
            for r in (1, 2) for i in range(1, 26) for k in ("a", "b")]
    end = [(9, 1, "a", 1.0, 1.0, False, 10 ** 6)]
    got = _run(spark, lambda s: ST.stream_interval_loss(_timed(s), 10), schema,
               [[r for r in rows if r[1] <= 13], [r for r in rows if r[1] > 13], end])
    want = L.interval_loss(spark.createDataFrame(rows, schema), 10)
    names = ("run", "interval", "key", "avg_loss", "advanced", "skipped_iters", "nan_iters")
    assert _values(got.where("run < 9"), *names) == _values(want, *names)

"""Global positions and running sums with few partitions, rows over the sample size, wide rows, hot groups and nulls."""

import random

import pytest
from pyspark.sql import functions as F

from stepfold.operators import common as C
from stepfold.operators.common import global_index, global_prefix_sum


@pytest.mark.parametrize("partitions", ["1", "2", "7"])
def test_positions_are_dense(spark, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(5000).select(
            F.pmod(F.xxhash64("id"), F.lit(100003)).alias("k"), "id", F.repeat(F.lit("x"), 200).alias("wide"),
            F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, "a").alias("g"), (F.col("id") % 5).alias("v")).repartition(4)
        rows = sorted(global_index(df, ["k", "id"], "pos").collect(), key=lambda r: (r.k, r.id))
        assert [r.pos for r in rows] == list(range(5000))
        sums = sorted(global_prefix_sum(df, ["k", "id"], "v", "at").collect(), key=lambda r: (r.k, r.id))
        total = 0
        for r in sums:
            assert r["at"] == total
            total += r.v
        by_group = {}
        for r in sorted(global_index(df, ["k", "id"], "pos", group=["g"]).collect(), key=lambda r: (r.k, r.id)):
            assert r.pos == by_group.get(r.g, 0)
            by_group[r.g] = r.pos + 1
        assert global_index(df.limit(0), ["k"], "pos").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_last_value_and_percentiles_of_a_hot_group(spark, parts):
    rng = random.Random(parts)
    rows = [("hot" if i % 3 else f"g{i % 4}", i, rng.choice([None, *range(40)])) for i in range(1500)]
    rows += [("void", 9000 + i, None) for i in range(3)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = spark.createDataFrame(rows, "g string, i int, v int").withColumn("v", F.col("v").cast("double"))
        carried = {(r.g, r.i): r.c for r in C.global_last(df, ["i"], ["g"], F.col("v"), "c").collect()}
        q = {r.g: (list(r.q), r.least, r.largest) for r in C.exact_percentiles(df, ["g"], "v", (0.5, 0.95, 1.0)).collect()}
        want = {r.g: (r.q, r.a, r.b) for r in df.groupBy("g").agg(
            F.percentile("v", F.array(F.lit(0.5), F.lit(0.95), F.lit(1.0))).alias("q"), F.min("v").alias("a"), F.max("v").alias("b")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    last = {}
    for g, i, v in rows:
        last[g] = v if v is not None else last.get(g)
        assert carried[g, i] == last[g]
    assert q.pop("void") == ([None] * 3, None, None)
    want.pop("void")
    assert q.keys() == want.keys()
    for g in q:
        assert q[g][0] == pytest.approx(want[g][0]) and q[g][1:] == want[g][1:]

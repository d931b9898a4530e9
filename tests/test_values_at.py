"""Exact percentiles without ranking every row: odd values, null groups, few partitions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from stepfold.operators import common as C


@pytest.mark.parametrize("limit", [0, 100_000])
def test_percentiles_look_at_few_rows(spark, monkeypatch, limit):
    def no_rank_of_every_row(*args, **kwargs):
        raise AssertionError("all values are ranked")

    monkeypatch.setattr(C, "global_running", no_rank_of_every_row)
    monkeypatch.setattr(C, "FEW_ROWS", limit)
    rng = random.Random(5)
    rows = [(rng.choice(["a", None, "b"]), rng.choice([None, rng.uniform(-5, 5), float(rng.randrange(4)), -0.0, 1e300])) for _ in range(6000)]
    rows += [("tight", 1 + i * 1e-12) for i in range(700)] + [("one", 3.0)] * 9 + [("void", None)] * 3
    rows += [("odd", x) for x in (math.nan, math.inf, -math.inf, 0.0, 5e-324, -1.0, math.inf)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    shares = (0.0, 0.5, 0.95, 1.0)
    found = {r.g: r for r in C.exact_percentiles(df, ["g"], "v", shares).collect()}
    want = {r.g: r for r in df.groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, shares))).alias("q"), F.min("v").alias("least"),
                                                F.max("v").alias("largest")).collect()}
    assert found.keys() == want.keys() and list(found["void"].q) == [None] * 4
    for g, r in want.items():
        if g != "void":
            assert [*map(repr, found[g].q)] == [*map(repr, [x + 0.0 for x in r.q])] or found[g].q == pytest.approx(r.q, rel=1e-12, nan_ok=True)
        assert repr((found[g].least, found[g].largest)) == repr((r.least, r.largest))


def test_places_of_the_total(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    got = {r.g: (r._total, r.x) for r in C.values_at(df, ["g"], "v", {"x": F.floor(F.col("_total") * 0.1)}).collect()}
    assert got == {0: (334, 99), 1: (333, 100), 2: (333, 101)}

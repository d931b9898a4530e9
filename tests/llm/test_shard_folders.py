"""Shards written as one folder each hold every document once."""

import os

from pyspark.sql import functions as F

from stepfold.llm import sharding


def test_write_shards(spark, tmp_path):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    sharded = sharding.shard(docs, "doc_id", F.octet_length("text"), 1000)
    sharding.write_shards(sharded, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["doc_id"] for r in back.collect()) == list(range(300))
    sizes = back.groupBy("depth", "prefix", "page").agg(F.sum("bytes").alias("n")).collect()
    assert len(sizes) > 5 and all(r["n"] <= 1000 for r in sizes)
    assert sum(len(files) for _, _, files in os.walk(tmp_path / "out") if any(f.endswith(".parquet") for f in files)) > 0

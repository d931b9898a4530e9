"""Connected components of a link table by alternating large-star and small-star
steps (Kiveris et al. 2014), as joins and aggregates. No node's links are ever
gathered in one task: minima are pre-aggregated and joins may be split when skewed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepfold.llm.common import checkpointed


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(lo, hi))"), F.expr("bit_xor(xxhash64(hi, lo, 7))")).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionAll(
        edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
            .join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").select(
        F.col("m").alias("lo"), F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo")).alias("hi"))
    return moved.where("lo < hi").distinct()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node with a link to another node; the
    component is its smallest node. Null ends and loops are no links; an empty
    table gives an empty result."""
    edges = links.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).distinct()
    edges = checkpointed(edges)
    before = _state(edges)
    while before[0]:
        edges = checkpointed(_small_star(_large_star(edges)))
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(roots)

"""URL filters by a sort-merge range join.

A rule is a host and a path prefix; it fits its host and all subdomains. With the
labels of a host reversed ("org.example/" + path), a rule is the interval of keys
that begin with its own key. A URL has one key for each suffix of its host for
which rules exist. Keys and rules are dealt to ranges of the key order, a rule to
every range that its interval meets. Each range is sorted and swept once with a
stack of the rules whose intervals are open: intervals are nested or disjoint, so
the top of the stack is the longest rule of that host that fits.

Work is done once per distinct (host, path), so repeated URLs cost one key, and keys are distinct before
they are dealt: the many hosts below one suffix that share a path are one key of the sweep, and take its
rule by a join that may be split. Among
rules that fit, the longest (host and path together) wins, then the one with the
longer host; of equal rules with different verdicts, the verdict last in the
alphabet ("block") wins. URLs that no rule fits get ``default``. A null URL, or
one without "://", has an empty host and path, which no rule fits. Rules without a host are dropped.
"""

from __future__ import annotations

import string
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepfold.llm.common import checkpointed

SAMPLED_KEYS = 64  # for each range, keys sampled to find its ends


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (lower-cased A-Z) and path of a URL column."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _key(host: str, path: str) -> Column:
    """The reversed host, a slash and the path: unambiguous, as hosts hold no slash."""
    return F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\."))), F.lit("/"), F.col(path)).cast("binary")


def longest_rules(places: DataFrame, rules: DataFrame, ranges: int) -> DataFrame:
    """(host, path, rule_host, rule_path, verdict) for each distinct (host, path) that a rule fits."""
    rules = (rules.select(F.translate("host", string.ascii_uppercase, string.ascii_lowercase).alias("rule_host"),
                          F.coalesce("path", F.lit("")).alias("rule_path"), "verdict")
             .where("rule_host is not null").groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict")))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    pairs = places.select("host", "path", F.explode(suffixes).alias("suffix"))
    pairs = checkpointed(pairs.join(rules.select(F.col("rule_host").alias("suffix")).distinct(), "suffix", "left_semi"))
    keys = checkpointed(pairs.select("suffix", "path").distinct().select(_key("suffix", "path").alias("key"), F.col("suffix").alias("host"), "path"))
    some = keys.orderBy(F.xxhash64("key", "host"), "key", "host").limit(SAMPLED_KEYS * ranges).select("key").collect()
    sampled = sorted(bytes(r[0]) for r in some)
    ends = sorted({sampled[i * len(sampled) // ranges] for i in range(1, ranges)}) if sampled else []

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = [bisect_right(ends, k) for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), *batch.columns], names=["range", *batch.schema.names])

    def deal_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [(bisect_right(ends, k), bisect_right(ends, k + b"\xff")) for k in batch.column(0).to_pylist()]
            row = pa.array([i for i, (a, b) in enumerate(spans) for _ in range(a, b + 1)], pa.int64())
            place = pa.array([p for a, b in spans for p in range(a, b + 1)], pa.int32())
            yield pa.RecordBatch.from_arrays([place, *(c.take(row) for c in batch.columns)], names=["range", *batch.schema.names])

    text = "key binary, host string, path string"
    dealt = keys.mapInArrow(deal, f"range int, {text}").withColumn("verdict", F.lit(None).cast("string"))
    opened = (rules.select(_key("rule_host", "rule_path").alias("key"), F.col("rule_host").alias("host"), F.col("rule_path").alias("path"), "verdict")
              .mapInArrow(deal_rules, f"range int, {text}, verdict string"))
    rows = dealt.withColumn("url", F.lit(1)).unionAll(opened.withColumn("url", F.lit(0)).select("range", "key", "host", "path", "verdict", "url"))

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, stack = None, []
        for batch in batches:
            out = []
            for place, key, host, path, verdict, is_url in zip(*(c.to_pylist() for c in batch.columns)):
                if place != current:
                    current, stack = place, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if not is_url:
                    stack.append((key, host, path, verdict))
                elif stack:
                    out.append((host, path, *stack[-1][1:]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.string()) for i in range(5)],
                                             names=["host", "path", "rule_host", "rule_path", "verdict"])

    swept = (rows.repartition("range").sortWithinPartitions("range", "key", "url")
             .mapInArrow(sweep, "host string, path string, rule_host string, rule_path string, verdict string"))
    swept = pairs.join(swept.withColumnRenamed("host", "suffix"), ["suffix", "path"])
    longest = F.struct((F.length("rule_host") + F.length("rule_path")).alias("n"), F.length("rule_host").alias("h"), "rule_host", "rule_path", "verdict")
    return swept.groupBy("host", "path").agg(F.max(longest).alias("r")).select("host", "path", "r.rule_host", "r.rule_path", "r.verdict")


def judge(df: DataFrame, id_col: str, url_col: str, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) of every URL; rules have host, path and verdict."""
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(df[id_col].alias("id"), df[url_col].alias("url"))
    host, path = host_and_path("url")
    rows = rows.select("id", host.alias("host"), path.alias("path"))
    found = longest_rules(rows.select("host", "path").distinct(), rules, ranges)
    return (rows.join(found, ["host", "path"], "left")
            .select("id", "host", "path", F.concat("rule_host", "rule_path").alias("rule"), F.coalesce("verdict", F.lit(default)).alias("verdict")))

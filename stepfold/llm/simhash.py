"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are stored vertically: plane b holds bit b of 64 fingerprints in
each machine word. A query's bits turn a plane into 64 difference bits a word,
and carry-save adders count them in three bitwise counters, three planes a
step. A word (64 fingerprints) is abandoned once all its counts exceed the radius.

Equal fingerprints are one node. Two fingerprints within ``radius`` bits agree
on at least t of radius + t disjoint blocks of bits, so each is dealt to every
choice of t blocks under their value and the buckets are compared on their own.
t is the least for which buckets are small; every choice is exact. A bucket over
``tile`` rows is split, and its tiles are compared pair by pair. A comparison
leaves one link per row and tile at most: those that keep linked rows reachable
from each other.

Null and empty texts have fingerprint zero. Rows with a null id get a
fingerprint and no component. Rows that repeat an id or a text link like others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stepfold.llm.common import checkpointed, find, raw_texts, type_of, union
from stepfold.llm.components import connected_components

BITS = 64
SEED = 42
HASHES_AT_A_TIME = 1 << 17
TILE = 4096  # fingerprints that one task compares with as many others
CHECK_PLANES = 24  # planes counted before and between the tests that abandon words
QUERIES_AT_A_TIME = 128


def shingle_hashes(text: bytes, words_each: int) -> list[int]:
    """XXH64 of each word shingle of a text; a shorter text is one shingle, one without words has none."""
    words = text.lower().split()
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) <= words_each:
        return [digest(join(words), SEED)] if words else []
    return [digest(join(words[i:i + words_each]), SEED) for i in range(len(words) - words_each + 1)]


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(hashes: list[int]) -> int:
    """A bit is set if it is set in over half of the hashes."""
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), HASHES_AT_A_TIME):
        counts += _bit_counts(np.array(hashes[i:i + HASHES_AT_A_TIME], dtype=np.uint64))
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """(id, fp) of every whole text; fp holds the 64 bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(shingle_hashes(t, shingle_words)) for t in raw_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))], names=["id", "fp"])

    return df.select(df[id_col].alias("id"), df[text_col].alias("text")).mapInArrow(run, f"id {type_of(df, id_col)}, fp long")


def with_fingerprints(df: DataFrame, text_col: str, shingle_words: int, name: str) -> DataFrame:
    """``df`` with a further column of the fingerprints of its texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(shingle_hashes(t, shingle_words)) for t in raw_texts(batch.column(text_col))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.array(fps, dtype=np.uint64).view(np.int64))], names=[*batch.schema.names, name])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(name, LongType())]))


class BitPlanes:
    """Fingerprints stored as bit planes."""

    def __init__(self, fps: np.ndarray):
        self.n, self.words = len(fps), -(-len(fps) // 64)
        bits = np.zeros((self.words * 64, BITS), dtype=np.uint8)
        bits[:self.n] = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        self.planes = np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")
        self.present = np.zeros(self.words * 64, dtype=np.uint8)
        self.present[:self.n] = 1
        self.present = np.packbits(self.present, bitorder="little").view("<u8")

    def within(self, queries: np.ndarray, radius: int, first_word: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """All (query, fingerprint) positions at ``radius`` bits or fewer, in words from ``first_word`` on."""
        flips = -((queries[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1))  # all ones where the bit is set
        q, w = np.divmod(np.arange(len(queries) * (self.words - first_word)), max(1, self.words - first_word))
        w = w + first_word
        counters = [np.zeros(len(q), dtype=np.uint64) for _ in range(_digits(radius) + 1)]
        for b in range(0, BITS, 3):
            if b and b % CHECK_PLANES == 0:  # abandon words in which no count is within the radius any more
                open_ = (~_exceeds(counters, radius) & self.present[w]) != 0
                q, w, counters = q[open_], w[open_], [c[open_] for c in counters]
                if not len(q):
                    break
            x, y, z = (self.planes[i][w] ^ flips[q, i] if i < BITS else None for i in (b, b + 1, b + 2))
            if y is None:
                _add(counters, [x])
            else:
                half = x ^ y
                _add(counters, [half ^ z, (x & y) | (half & z)])
        alive = ~_exceeds(counters, radius) & self.present[w]
        some = np.flatnonzero(alive)
        lanes = np.unpackbits(alive[some].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, lane = np.nonzero(lanes)
        return q[some][row], w[some][row] * 64 + lane


def _digits(radius: int) -> int:
    return max(2, (radius + 1).bit_length())  # a triple of planes adds a bit of weight 2


def _add(counters: list[np.ndarray], bits: list[np.ndarray]) -> None:
    """Add one bit of weight 1 and, if given, one of weight 2 to each lane; the last counter keeps any overflow."""
    carry = counters[0] & bits[0]
    counters[0] ^= bits[0]
    for i in range(1, len(counters) - 1):
        c = counters[i]
        if i == 1 and len(bits) > 1:
            half = c ^ carry
            counters[i], carry = half ^ bits[1], (c & carry) | (half & bits[1])
        else:
            counters[i], carry = c ^ carry, c & carry
    counters[-1] |= carry


def _exceeds(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count is over ``radius``: a bitwise comparison from the highest digit down."""
    over, equal = counters[-1].copy(), ~counters[-1]
    for i in range(len(counters) - 2, -1, -1):
        if radius >> i & 1:
            equal &= counters[i]
        else:
            over |= equal & counters[i]
            equal &= ~counters[i]
    return over


def forest(fps: np.ndarray, n_left: int | None, radius: int) -> np.ndarray:
    """Root of each fingerprint among those it can reach. With ``n_left``, only
    the first ``n_left`` are compared with the others."""
    parent = np.arange(len(fps))
    shift = n_left or 0
    planes = BitPlanes(fps[shift:])
    for start in range(0, n_left or len(fps), QUERIES_AT_A_TIME):
        block = fps[start:min(start + QUERIES_AT_A_TIME, n_left or len(fps))]
        q, f = planes.within(block, radius, 0 if n_left else start // 64)
        union(parent, q + start, f + shift)
    return find(parent, np.arange(len(fps)))


def _blocks(count: int) -> list[tuple[int, int]]:
    """(first bit, bits) of ``count`` blocks that cover all bits."""
    cuts = [round(i * BITS / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def bucket_keys(rows: int, radius: int, tile: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Choices of blocks that deal out ``rows`` fingerprints, each with the bits of its value that are used."""
    wanted = max(0, math.ceil(math.log2(max(1, rows) / (tile / 4))))
    for t in range(1, 5):
        blocks = _blocks(radius + t)
        if min(sum(sorted(b for _, b in blocks)[:t]), 60) >= wanted or t == 4:
            return [(list(chosen), min(wanted, sum(b for _, b in chosen), 60)) for chosen in combinations(blocks, t)]
    raise AssertionError


def link_forest(nodes: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Links (a, b) between the nodes (fp distinct, rep) within ``radius`` bits:
    enough of them to reach every linked node, none beyond the radius."""
    keys = []
    for blocks, used in bucket_keys(nodes.count(), radius, tile):
        value, width = F.lit(0).cast("long"), 0
        for first, bits in blocks:
            value = F.shiftleft(value, bits).bitwiseOR(F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << bits) - 1).cast("long")))
            width += bits
        keys.append(F.shiftrightunsigned(value, width - used) if used else F.lit(0).cast("long"))
    rows = nodes.select("fp", "rep", F.posexplode(F.array(*keys)).alias("table", "value"))
    crowded = rows.groupBy("table", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile)
    rows = (rows.join(crowded, ["table", "value"], "left")
            .withColumn("tiles", F.ceil(F.coalesce("n", F.lit(1)) / tile).cast("int"))
            .withColumn("own", F.pmod(F.xxhash64("fp"), "tiles").cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
            .select("table", "value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                    (F.col("own") != F.least("own", "other")).alias("right"), "fp", "rep"))
    node_type = nodes.schema["rep"].dataType.simpleString()

    def compare(group: pa.Table) -> pa.Table:
        fps, right = group["fp"].to_numpy().view(np.uint64), group["right"].to_numpy()
        order = np.argsort(right, kind="stable")
        n_left = int((~right).sum()) if group["i"][0] != group["j"][0] else None
        linked = np.zeros(0, dtype=np.int64)
        root = linked
        if n_left != 0 and n_left != len(fps):
            root = forest(fps[order], n_left, radius)
            linked = np.flatnonzero(root != np.arange(len(root)))
        reps = group["rep"].combine_chunks() if isinstance(group["rep"], pa.ChunkedArray) else group["rep"]
        reps = reps.take(pa.array(order))
        return pa.table({"a": reps.take(pa.array(root[linked])), "b": reps.take(pa.array(linked))})

    return rows.groupBy("table", "value", "i", "j").applyInArrow(compare, f"a {node_type}, b {node_type}")


def near_duplicates(df: DataFrame, id_col: str, text_col: str, shingle_words: int, radius: int, tile: int = TILE) -> DataFrame:
    """(id, fp, component, cluster) of every row; the component is the smallest id reachable by links.

    Rows are linked by their texts alone, so rows that share an id may lie in clusters of their own; the
    cluster, the least fingerprint reachable, tells those apart where their component is the same."""
    prints = checkpointed(fingerprints(df, id_col, text_col, shingle_words))
    nodes = checkpointed(prints.where("id is not null").groupBy("fp").agg(F.min("id").alias("least_id")))
    found = connected_components(link_forest(nodes.select("fp", F.col("fp").alias("rep")), radius, tile), "a", "b")
    found = found.select("node", F.col("component").alias("cluster"))
    clusters = nodes.join(found, nodes.fp == found.node, "left").select("fp", "least_id", F.coalesce("cluster", "fp").alias("cluster"))
    clusters = checkpointed(clusters)
    least = clusters.groupBy("cluster").agg(F.min("least_id").alias("component"))
    named = clusters.select("fp", "cluster").join(least, "cluster")
    has_id = F.col("id").isNotNull()
    return prints.join(named, "fp", "left").select(
        "id", "fp", F.when(has_id, F.col("component")).alias("component"), F.when(has_id, F.col("cluster")).alias("cluster"))


def hex_digits(fp: str):
    """The fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")

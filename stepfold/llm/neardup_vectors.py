"""Near-duplicate vectors by an exact metric range join.

Cosine >= c on unit vectors is Euclidean distance <= r = sqrt(2 - 2c). Pivots
cut the vectors into cells, a vector's home being its nearest pivot p. By the
triangle inequality a vector v at distance <= r from some member of cell i has
d(v, p_i) <= radius_i + r, and lies within r of the half space nearer to p_i
than to v's home p: (d(v, p_i)^2 - d(v, p)^2) / (2 d(p, p_i)) <= r. It is copied
to the cells that meet both, and cells join on their own: home rows against all
rows of the cell. Cells over ``home_rows`` are split into chunks of home rows.

Chunks stream their rows against the home rows, count links, and keep only as
many links as are needed to reach every linked row. Copies of one vector are one
weighted row, so a group of copies is never paired out.

A vector that is null, empty, zero or holds null or non-finite components links
with nothing, and so does one with a null id; vectors of unequal length don't
link. Repeated rows count as vectors of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepfold.llm.common import checkpointed, find, sorted_groups, type_of, union
from stepfold.llm.components import connected_components
from stepfold.llm.vectors import finite, matrix, sample, spread_out, unit

HOME_ROWS = 4096  # home rows of a chunk, held in memory while the cell's rows pass by
MAX_PIVOTS = 512
ROWS_AT_A_TIME = 512
SLACK = 1e-7  # added to bounds, far over rounding errors


def _exact_at_least(a: np.ndarray, b: np.ndarray, cosine: float) -> bool:
    """a.b >= cosine |a||b| without rounding errors."""
    dot = sum(Fraction(float(x)) * Fraction(float(y)) for x, y in zip(a, b))
    norms = sum(Fraction(float(x)) ** 2 for x in a) * sum(Fraction(float(x)) ** 2 for x in b)
    bound = Fraction(str(cosine))
    if (dot >= 0) != (bound >= 0):
        return dot >= 0
    return dot * dot >= bound * bound * norms if dot >= 0 else dot * dot <= bound * bound * norms


def _links(raw: np.ndarray, rows: np.ndarray, raw_home: np.ndarray, home: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions (row, home row) of all pairs that link. Single precision decides
    the pairs beyond its error bound, double precision those nearer, exact arithmetic a tie."""
    margin = max(1e-5, 2e-7 * rows.shape[1])
    found = rows.astype(np.float32) @ home.T
    i, j = np.divmod(np.flatnonzero(found >= np.float32(cosine - margin)), found.shape[1])
    near = np.flatnonzero(found[i, j] <= cosine + margin)
    if len(near):
        exact = np.einsum("ij,ij->i", rows[i[near]], unit(raw_home[j[near]]))
        linked = np.ones(len(i), dtype=bool)
        linked[near] = exact >= cosine
        for n in np.flatnonzero(np.abs(exact - cosine) < 1e-12):
            linked[near[n]] = _exact_at_least(raw[i[near[n]]], raw_home[j[near[n]]], cosine)
        i, j = i[linked], j[linked]
    return i, j


class _Chunk:
    """The home rows of one chunk and what is known of them so far."""

    def __init__(self, cosine: float):
        self.cosine, self.parts, self.ready = cosine, [], False

    def add_home(self, rows: pa.RecordBatch) -> None:
        self.parts.append(rows)

    def start(self) -> None:
        if self.ready:
            return
        self.ready = True
        table = pa.Table.from_batches(self.parts).combine_chunks()
        self.ids = table["rep"].combine_chunks() if isinstance(table["rep"], pa.ChunkedArray) else table["rep"]
        self.raw = matrix(table["vector"].combine_chunks() if isinstance(table["vector"], pa.ChunkedArray) else table["vector"])
        self.home, self.weight = unit(self.raw).astype(np.float32), table["weight"].to_numpy()
        self.count = self.weight - 1
        self.parent = np.arange(len(self.home))

    def compare(self, raw: np.ndarray, weight: np.ndarray, itself: bool, at: int = 0) -> np.ndarray:
        """Count the links of rows with the home rows; the first home row that each row links with, or -1."""
        self.start()
        rows = unit(raw)
        i, j = _links(raw, rows, self.raw, self.home, self.cosine)
        if itself:
            other = j != i + at
            i, j = i[other], j[other]
        self.count += np.bincount(j, weights=weight[i], minlength=len(self.home)).astype(np.int64)
        first = np.full(len(rows), -1)
        if len(i):
            begin = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
            first[i[begin]] = j[begin]
            if itself:
                union(self.parent, i + at, j)
            else:
                union(self.parent, first[i], j)
        return first


def _assign(pivots: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Squared distances to all pivots, the home and the distance to it."""
    squares = np.maximum(0, 2 - 2 * (unit(rows) @ pivots.T))
    home = squares.argmin(axis=1)
    return squares, home, np.sqrt(squares[np.arange(len(rows)), home])


def range_join(vectors: DataFrame, cosine: float, home_rows: int = HOME_ROWS) -> tuple[DataFrame, DataFrame]:
    """For distinct finite vectors of one length (rep, weight, vector): the
    weighted number of links of each (rep, n_links), and links (a, b) that keep
    linked vectors reachable from each other."""
    id_type, vector_type = type_of(vectors, "rep"), type_of(vectors, "vector")
    n = vectors.count()
    radius = math.sqrt(max(0.0, 2 - 2 * cosine)) + SLACK
    points = sample(vectors, "rep", "vector")
    pivots = spread_out(unit(points), min(MAX_PIVOTS, max(1, -(-n // home_rows)))) if len(points) else points
    n_pivots = max(1, len(pivots))

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, reach = np.zeros(n_pivots, dtype=np.int64), np.zeros(n_pivots)
        for batch in batches:
            if batch.num_rows:
                _, home, away = _assign(pivots, matrix(batch.column(0)))
                size += np.bincount(home, minlength=n_pivots)
                np.maximum.at(reach, home, away)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_pivots)), pa.array(size), pa.array(reach)], names=["cell", "size", "reach"])

    sizes, reach = np.zeros(n_pivots, dtype=np.int64), np.zeros(n_pivots)
    if n:
        found = vectors.select("vector").mapInArrow(homes, "cell long, size long, reach double")
        for row in found.groupBy("cell").agg(F.sum("size").alias("size"), F.max("reach").alias("reach")).collect():  # a row for each pivot
            sizes[row["cell"]], reach[row["cell"]] = row["size"], row["reach"]
    chunks = np.maximum(1, -(-sizes // home_rows))
    first_chunk = np.concatenate([[0], np.cumsum(chunks)])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        between = np.sqrt(np.maximum(1e-30, 2 - 2 * (pivots @ pivots.T)))
        for whole in batches:
            for lo in range(0, whole.num_rows, 2048):
                batch = whole.slice(lo, 2048)
                squares, home, away = _assign(pivots, matrix(batch.column(3)))
                near = np.sqrt(squares) <= reach + radius
                near &= (squares - (away ** 2)[:, None]) <= 2 * radius * between[home] + SLACK
                near &= sizes > 0
                near[np.arange(len(home)), home] = True
                own = first_chunk[home] + batch.column(0).to_numpy() % chunks[home]
                row, cell = np.nonzero(near)
                take = np.repeat(np.arange(len(row)), chunks[cell])
                part = np.arange(len(take)) - np.repeat(np.cumsum(chunks[cell]) - chunks[cell], chunks[cell])
                chunk = first_chunk[cell[take]] + part
                row = row[take]
                role = (chunk != own[row]).astype(np.int32)  # 0: home row, 1: a row to compare with
                for s in range(0, len(row), 8192):
                    at = pa.array(row[s:s + 8192])
                    yield pa.RecordBatch.from_arrays([pa.array(chunk[s:s + 8192]), pa.array(role[s:s + 8192]),
                                                      *(batch.column(i).take(at) for i in (1, 2, 3))],
                                                     names=["chunk", "role", "rep", "weight", "vector"])

    def results(chunk: _Chunk) -> Iterator[pa.RecordBatch]:
        chunk.start()
        for at in range(0, len(chunk.home), ROWS_AT_A_TIME):
            chunk.compare(chunk.raw[at:at + ROWS_AT_A_TIME], chunk.weight[at:at + ROWS_AT_A_TIME], True, at)
        root = find(chunk.parent, np.arange(len(chunk.home)))
        yield pa.RecordBatch.from_arrays([chunk.ids, chunk.ids.take(pa.array(root)), pa.array(chunk.count)], names=["a", "b", "n_links"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, chunk = None, None
        for (key, role), rows in sorted_groups(batches, 2):
            if key != current:
                if chunk is not None:
                    yield from results(chunk)
                current, chunk = key, _Chunk(cosine)
            if role == 0:
                chunk.add_home(rows)
                continue
            if not chunk.parts:
                continue  # no home rows hashed to this chunk
            for at in range(0, rows.num_rows, ROWS_AT_A_TIME):
                some = rows.slice(at, ROWS_AT_A_TIME)
                first = chunk.compare(matrix(some.column(4)), some.column(3).to_numpy(), False)
                linked = np.flatnonzero(first >= 0)
                if len(linked):
                    yield pa.RecordBatch.from_arrays([some.column(2).take(pa.array(linked)), chunk.ids.take(pa.array(first[linked])),
                                                      pa.array(np.full(len(linked), -1))], names=["a", "b", "n_links"])
        if chunk is not None and chunk.parts:
            yield from results(chunk)

    dealt = (vectors.select(F.pmod(F.xxhash64("rep"), F.lit(1 << 30)).alias("salt"), "rep", "weight", "vector")
             .mapInArrow(deal, f"chunk long, role int, rep {id_type}, weight long, vector {vector_type}")
             .repartition("chunk").sortWithinPartitions("chunk", "role"))
    found = checkpointed(dealt.mapInArrow(join, f"a {id_type}, b {id_type}, n_links long"))
    return found.where("n_links >= 0").selectExpr("a AS rep", "n_links"), found.select("a", "b")


def near_duplicates(df: DataFrame, id_col: str, vector_col: str, cosine: float, home_rows: int = HOME_ROWS) -> DataFrame:
    """(id, n_links, component) of every row."""
    rows = df.select(df[id_col].alias("id"), df[vector_col].alias("vector"))
    usable = F.col("id").isNotNull() & finite("vector") & F.exists("vector", lambda x: x != 0)
    valid = rows.where(usable)
    classes = checkpointed(valid.groupBy("vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight")))
    counts, links = None, None
    for (length,) in classes.select(F.size("vector")).distinct().collect():  # one join for each length in use
        c, e = range_join(classes.where(F.size("vector") == length), cosine, home_rows)
        counts, links = (c, e) if counts is None else (counts.unionAll(c), links.unionAll(e))
    if counts is None:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    named = connected_components(links, "a", "b").withColumnRenamed("node", "rep")
    named = counts.join(named, "rep", "left").select("rep", "n_links", F.coalesce("component", "rep").alias("component"))
    by_vector = classes.join(named, "rep").select("vector", "n_links", "component")
    linked = valid.join(by_vector, "vector").select("id", "n_links", "component")
    alone = rows.where(~F.coalesce(usable, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return linked.unionAll(alone)

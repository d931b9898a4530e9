"""Exact top-k search by inner product with a dual-tree cover-tree search.

Queries are taken in blocks and the rows in chunks of bounded size; every block
meets every chunk. Both are indexed by cover trees: a node's children are
centres that cover its points at half its radius, or the most spread out
``BRANCHES`` of them, and each node keeps its measured covering radius. No pair of points
under a query node (centre q, radius a) and a row node (centre p, radius b) scores
above q.p + a|p| + b|q| + ab, so the pair is pruned when that is below the worst
kth score that the node's queries have reached. A pruning task leaves at most k
rows a query, and a window keeps the best k of all tasks.

Vectors are whole numbers; scores are exact. Rows with a null id, a null vector
or one with null or non-finite components take no part, and rows of another
length than a query are no candidates for it. A query's own row is every row with its id. Query rows that repeat an
id and its vector are one query, rows that share an id with unlike vectors are queries of
their own with k results each; a candidate that stands in several rows counts as often.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stepfold.llm.common import sorted_groups
from stepfold.llm.vectors import finite, matrix

CHUNK_ROWS = 8192  # rows of one cover tree
BLOCK_QUERIES = 4096
BRANCHES = 32
LEAF = 64


class CoverTree:
    """Nodes hold a centre, a covering radius and either children or points."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.centre, self.radius, self.children, self.members = [], [], [], []
        if len(points):
            self._build(np.arange(len(points)), 0)
            self.centres = points[np.array(self.centre)]
            self.radii = np.array(self.radius)
            self.norms = np.sqrt(np.einsum("ij,ij->i", self.centres, self.centres))

    def _away(self, rows: np.ndarray, centre: int) -> np.ndarray:
        gap = self.points[rows] - self.points[centre]
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))

    def _build(self, rows: np.ndarray, centre_at: int) -> int:
        centre = int(rows[centre_at])
        away = self._away(rows, centre)
        node, radius = len(self.centre), float(away.max())
        self.centre.append(centre)
        self.radius.append(radius)
        self.children.append([])
        self.members.append(None)
        if len(rows) <= LEAF or radius == 0:
            self.members[node] = rows
            return node
        owner, nearest, chosen = np.zeros(len(rows), dtype=np.int64), away, [centre_at]
        while len(chosen) < BRANCHES and nearest.max() > radius / 2:
            far = int(nearest.argmax())
            away = self._away(rows, int(rows[far]))
            closer = away < nearest
            owner[closer], nearest = len(chosen), np.minimum(nearest, away)
            chosen.append(far)
        for i, at in enumerate(chosen):
            mine = np.flatnonzero(owner == i)
            self.children[node].append(self._build(rows[mine], int(np.searchsorted(mine, at))))
        return node


class _Search:
    """One block of queries and the best k rows that they have met so far."""

    def __init__(self, ids: np.ndarray, twins: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.twins, self.k, self.tree = ids, twins, k, CoverTree(vectors)
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.under = [None] * len(self.tree.centre)
        for node in reversed(range(len(self.under))):  # children come after their parent
            own = self.tree.members[node]
            self.under[node] = own if own is not None else np.concatenate([self.under[c] for c in self.tree.children[node]])

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        rows = CoverTree(vectors)
        if len(ids) and len(self.ids):
            self._visit(0, np.array([0]), rows, ids)

    def _bounds(self, node: int, others: np.ndarray, rows: CoverTree) -> np.ndarray:
        q, a, b = self.tree, self.tree.radii[node], rows.radii[others]
        exact = rows.centres[others] @ q.centres[node]
        bound = exact + a * rows.norms[others] + b * q.norms[node] + a * b
        return bound + 1e-9 * (1 + np.abs(bound))

    def _visit(self, node: int, others: np.ndarray, rows: CoverTree, ids: np.ndarray) -> None:
        worst = self.scores[self.under[node], -1].min()  # of the node's queries
        bounds = self._bounds(node, others, rows)
        others = others[np.argsort(-bounds, kind="stable")][: int((bounds >= worst).sum())]
        if not len(others):
            return
        leaf = self.tree.members[node] is not None
        if not leaf and self.tree.radii[node] >= rows.radii[others].max():
            for child in self.tree.children[node]:
                self._visit(child, others, rows, ids)
            return
        inner = [o for o in others if rows.members[o] is None]
        points = [rows.members[o] for o in others if rows.members[o] is not None]
        if leaf and points:
            self._compare(self.under[node], np.concatenate(points), rows, ids)
        wider = [c for o in inner for c in rows.children[o]]
        if not leaf and points:
            wider += [int(o) for o in others if rows.members[o] is not None]
            if not inner:
                for child in self.tree.children[node]:
                    self._visit(child, others, rows, ids)
                return
        if wider:
            self._visit(node, np.array(wider), rows, ids)

    def _compare(self, queries: np.ndarray, at: np.ndarray, rows: CoverTree, ids: np.ndarray) -> None:
        scores = self.tree.points[queries] @ rows.points[at].T
        scores[self.ids[queries][:, None] == ids[at][None, :]] = -np.inf
        scores = np.concatenate([self.scores[queries], scores], axis=1)
        found = np.concatenate([self.found[queries], np.broadcast_to(ids[at], (len(queries), len(at)))], axis=1)
        if scores.shape[1] > 4 * self.k:  # all that reach the kth best score, ties too, are few
            kth = np.partition(scores, -self.k, axis=1)[:, -self.k]
            keep = (scores >= kth[:, None]).any(axis=0)
            scores, found = scores[:, keep], found[:, keep]
        order = np.lexsort((found, -scores), axis=1)[:, : self.k]
        self.scores[queries] = np.take_along_axis(scores, order, axis=1)
        self.found[queries] = np.take_along_axis(found, order, axis=1)

    def best(self) -> pa.RecordBatch:
        query, at = np.nonzero(self.scores > -np.inf)
        return pa.RecordBatch.from_arrays([pa.array(self.ids[query]), pa.array(self.twins[query]), pa.array(self.found[query, at]),
                                           pa.array(self.scores[query, at].astype(np.int64))], names=["query_id", "twin", "id", "score"])


def search(df: DataFrame, id_col: str, vector: Column, is_query: Column, k: int) -> DataFrame:
    """(query_id, rank, id, score): the k rows of highest inner product for each
    row that ``is_query`` selects, ties to the smaller id. ``vector`` gives whole
    numbers whose inner products stay below 2^53."""
    rows = df.select(df[id_col].cast("long").alias("id"), vector.cast("array<double>").alias("vector"), is_query.alias("query"))
    rows = rows.where(F.col("id").isNotNull() & finite("vector") & (F.size("vector") > 0)).withColumn("length", F.size("vector"))
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("query"), 1))).first()
    chunks, blocks = max(1, -(-n // CHUNK_ROWS)), max(1, -(-n_queries // BLOCK_QUERIES))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    part = lambda count: F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")
    # twin tells queries of one id apart; as a hash of the vector it is the same wherever the row is dealt
    queries = rows.where("query").dropDuplicates(["id", "vector"]).withColumn("twin", F.xxhash64("vector"))
    queries = queries.select("length", part(blocks).alias("block"), every(chunks).alias("chunk"), F.lit(0).alias("role"), "id", "twin", "vector")
    others = rows.select("length", every(blocks).alias("block"), part(chunks).alias("chunk"), F.lit(1).alias("role"), "id", F.lit(0).cast("long").alias("twin"), "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts = None, {0: [], 1: []}

        def close() -> Iterator[pa.RecordBatch]:
            if parts[0] and parts[1]:
                queries, others = ([np.concatenate([p[i] for p in parts[role]]) for i in (0, 1, 2)] for role in (0, 1))
                block = _Search(*queries, k)
                block.meet(others[0], others[2])
                yield block.best()

        for (*key, role), some in sorted_groups(batches, 4):
            if key != current:
                yield from close()
                current, parts = key, {0: [], 1: []}
            parts[role].append((some.column(4).to_numpy(), some.column(5).to_numpy(), matrix(some.column(6))))
        yield from close()

    dealt = queries.unionAll(others).repartition("length", "block", "chunk").sortWithinPartitions("length", "block", "chunk", "role")
    found = dealt.mapInArrow(run, "query_id long, twin long, id long, score long")
    order = W.partitionBy("query_id", "twin").orderBy(F.col("score").desc(), F.col("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")

"""Helpers shared by the training-data operators: table access, shared
checkpoints, Arrow text batches and streaming over sorted groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stepfold.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the copy, so
    later steps read the same rows whatever executor is lost."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """Each text as str; null is the empty text, ill-formed bytes become U+FFFD."""
    return [x.decode("utf-8", "replace") for x in raw_texts(column)]


def annotate(df: DataFrame, text_col: str, carry: list[str], fields: list[tuple[str, str]],
             worker: Callable[[], Callable[[list[str]], list[pa.Array]]]) -> DataFrame:
    """The columns ``carry`` of every row and new ``fields`` (name, type) worked out
    from its text, without a shuffle. ``worker`` is called once in each task and
    gives the function from texts to the new columns."""
    names = [*carry, *(name for name, _ in fields)]
    schema = ", ".join([f"`{c}` {type_of(df, c)}" for c in carry] + [f"`{n}` {t}" for n, t in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = worker()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *work(texts(batch.column(len(carry))))], names=names)

    return df.select(*[df[c] for c in carry], df[text_col].alias("_text")).mapInArrow(run, schema)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer name that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sorted_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Slices (key, rows) of batches sorted by their first ``n_keys`` columns. A
    group that spans batches comes in several slices, so no group is held whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)]
        change = np.zeros(batch.num_rows, dtype=bool)
        change[0] = True
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        starts = np.flatnonzero(change).tolist()
        for s, e in zip(starts, [*starts[1:], batch.num_rows]):
            yield tuple(k[s].item() for k in keys), batch.slice(s, e - s)


def find(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Roots of ``nodes`` in a union-find forest (pointer jumping)."""
    roots = parent[nodes]
    while True:
        up = parent[roots]
        if np.array_equal(up, roots):
            return roots
        roots = up


def union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of each pair (a[i], b[i]) in place; the smallest index of a set is its root."""
    while len(a):
        a, b = find(parent, a), find(parent, b)
        differ = a != b
        if not differ.any():
            return
        a, b = a[differ], b[differ]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))

"""Bounded-space online packing of tokenised documents into training sequences.

Each task reads its documents once and keeps a fixed number of open windows. Full
windows are cut from a long document as they are; its rest goes to the window
that it fits best (least room left). If it fits none and no window is free, the
fullest is emitted to make room: its gap is first filled with a cut of the
rest, unless the gap is so small that padding costs less than a cut. The windows
that are open at the end of a task are leftovers; groups of tasks of bounded
size merge theirs in the same way and then end to end, so at most one
window of a group is padded by more than that.

The added tokens of the vocabulary file (end-of-document marks, say) that stand in a
text are plain text, or with ``added`` one id each, as the tokenizers library has it.

A null text is empty and packs its end-of-document id alone. Rows that repeat
an id or a text are packed like others; a null id stays null.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepfold.llm.bpe import Encoder
from stepfold.llm.common import checkpointed, texts, type_of

WINDOWS = 64
LEAST_CUT = 8  # a gap below this is padded rather than filled by a cut
TASKS_MERGED = 32  # tasks whose leftovers are merged together
MERGED = 1 << 62  # sequence ids of merged leftovers begin here
EACH_TASK = 1 << 32  # sequence ids of one task or group


@lru_cache(maxsize=1)
def byte_signs() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary file stands for: visible
    Latin-1 signs stand for themselves, the other bytes for signs from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


class AddedTokens:
    """Encodes texts that may hold added tokens: each is its own id, and only what lies between is merged."""

    def __init__(self, between: Encoder, ids: dict[str, int]):
        self.between, self.ids = between.encode, {t: np.array([i], dtype="<u4").tobytes() for t, i in ids.items()}
        self.split = re.compile("(" + "|".join(re.escape(t) for t in sorted(ids, key=len, reverse=True)) + ")").split

    def encode(self, text: str) -> bytes:
        parts = self.split(text)
        if len(parts) == 1:
            return self.between(text)
        return b"".join(self.ids[p] if i % 2 else self.between(p) for i, p in enumerate(parts) if p)


@lru_cache(maxsize=2)
def json_encoder(path: str, pattern: str, added: bool = False) -> Encoder | AddedTokens:
    """The vocabulary of a byte-level BPE file of the tokenizers library, whose ids
    rise with the order of its merges; the merging itself is tiktoken's, which
    gives the same ids and is several times faster."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    if added and any(t[flag] for t in spec.get("added_tokens", []) for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{path}: added tokens that take in or depend on their neighbours")
    signs = byte_signs()
    ranks = {bytes(signs[s] for s in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    ids_of = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    plain = Encoder(lambda part: array("I", ids_of(part)).tobytes())
    return AddedTokens(plain, special) if added and special else plain


class Packer:
    """Open windows of one task. Pieces are (id, start, ids as bytes, tokens of the document)."""

    def __init__(self, length: int, emit: Callable[[list], None], windows: int = WINDOWS):
        self.length, self.emit, self.most = length, emit, windows
        self.open: list[tuple[int, list]] = []  # (room left, pieces)

    def add(self, pieces: list) -> None:
        """Place pieces that together are no longer than a window in one window, or cut them."""
        while pieces:
            size = sum(len(p[2]) for p in pieces) // 4
            if size == self.length:
                return self.emit(pieces)
            best = min((i for i, (room, _) in enumerate(self.open) if room >= size), key=lambda i: self.open[i][0], default=None)
            if best is not None:
                room, held = self.open[best]
                held += pieces
                if room == size:
                    self.open.pop(best)
                    self.emit(held)
                else:
                    self.open[best] = (room - size, held)
                return None
            if len(self.open) < self.most:
                self.open.append((self.length - size, list(pieces)))
                return None
            room, held = self.open.pop(min(range(len(self.open)), key=lambda i: self.open[i][0]))
            if room >= LEAST_CUT:
                head, pieces = cut(pieces, room)
                held += head
            self.emit(held)

    def add_document(self, doc_id, ids: bytes) -> None:
        n, step = len(ids) // 4, 4 * self.length
        whole = n // self.length
        for i in range(whole):
            self.emit([(doc_id, i * self.length, ids[i * step:(i + 1) * step], n)])
        if n % self.length:
            self.add([(doc_id, whole * self.length, ids[whole * step:], n)])

    def close(self) -> None:
        """Join what is open end to end."""
        pieces = [p for _, held in sorted(self.open, key=lambda w: w[0]) for p in held]
        self.open = []
        while pieces:
            head, pieces = cut(pieces, self.length)
            self.emit(head)


def cut(pieces: list, size: int) -> tuple[list, list]:
    """The first ``size`` ids of pieces and what follows them."""
    head, rest = [], list(pieces)
    while rest and size:
        doc_id, start, ids, tokens = rest.pop(0)
        taken = min(size, len(ids) // 4)
        head.append((doc_id, start, ids[:4 * taken], tokens))
        size -= taken
        if 4 * taken < len(ids):
            rest.insert(0, (doc_id, start + taken, ids[4 * taken:], tokens))
    return head, rest


class _Rows:
    """Collects pieces of sequences as Arrow rows."""

    def __init__(self, id_type: pa.DataType, first_sequence: int):
        self.id_type, self.sequence, self.columns = id_type, first_sequence, [[] for _ in range(8)]

    def emit(self, pieces: list, leftover: bool = False) -> None:
        offset = 0
        for doc_id, start, ids, tokens in pieces:
            size = len(ids) // 4
            for column, value in zip(self.columns, (doc_id, start, size, zlib.crc32(ids), tokens, self.sequence, offset, ids if leftover else None)):
                column.append(value)
            offset += size
        self.sequence += 1

    def batch(self, with_ids: bool) -> pa.RecordBatch:
        types = [self.id_type, *[pa.int64()] * 6, pa.binary()]
        names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        n = 8 if with_ids else 7
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(self.columns[:n], types)], names=names[:n])
        self.columns = [[] for _ in range(8)]
        return out


def pack(df: DataFrame, id_col: str, text_col: str, path: str, pattern: str, length: int, end_id: int, windows: int = WINDOWS,
         added: bool = False) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset): the pieces of all documents."""
    id_type = type_of(df, id_col)
    schema = f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = json_encoder(path, pattern, added).encode, None
        for batch in batches:
            if packer is None:
                rows = _Rows(batch.column(0).type, TaskContext.get().partitionId() * EACH_TASK)
                packer = Packer(length, rows.emit, windows)
            for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                packer.add_document(doc_id, encode(text) + end)
                if len(rows.columns[0]) >= 20_000:
                    yield rows.batch(True)
            yield rows.batch(True)
        if packer is not None:
            for _, held in packer.open:
                rows.emit(held, leftover=True)
            yield rows.batch(True)

    def merge(group: pa.Table) -> pa.Table:
        group = group.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        rows = _Rows(group.schema.field("id").type, MERGED + group["merge"][0].as_py() * EACH_TASK)
        packer = Packer(length, rows.emit, windows)
        held: dict[int, list] = {}
        for *piece, sequence in zip(*(group[c].to_pylist() for c in ("id", "start", "ids", "doc_tokens", "sequence_id"))):
            held.setdefault(sequence, []).append(tuple(piece))
        for pieces in sorted(held.values(), key=lambda w: -sum(len(p[2]) for p in w)):
            packer.add(pieces)
        packer.close()
        return pa.Table.from_batches([rows.batch(False)])

    packed = checkpointed(df.select(df[id_col].alias("id"), df[text_col].alias("text")).mapInArrow(run, schema + ", ids binary"))
    left = packed.where("ids is not null").withColumn("merge", F.expr(f"sequence_id div {EACH_TASK * TASKS_MERGED}"))
    return packed.where("ids is null").drop("ids").unionAll(left.groupBy("merge").applyInArrow(merge, schema))

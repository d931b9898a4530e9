"""Best-fit packing by minimum bin slack over the counts of lengths.

Documents are tokenised, and only those longer than a sequence are cut. What is
packed is then described by how many pieces there are of each length, a table of at most
``length`` rows. From it sequences are filled one after the other: the longest piece left
opens a sequence, and a subset-sum recurrence over the lengths still available (a bitset of
the sums that can be reached, longer pieces first) finds the combination that leaves the
least slack. It is removed, as often as the counts allow at once: while its pieces
last, it stays the fullest. So the plan costs the same for any number of documents.

The plan says which running numbers of a length go where; the pieces are numbered within
their length by key ranges, so a length that very many documents share is spread over
tasks, and placed by a join with the plan's at most ``length`` rows.

A null text is empty and packs its end-of-document id alone. Rows that repeat an
id or a text are packed like others; a null id stays null. An empty table gives no row.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stepfold.llm.common import checkpointed, raw_texts, type_of
from stepfold.llm.packing import byte_signs
from stepfold.operators.common import global_index

MAX_REMEMBERED, LONGEST_REMEMBERED = 400_000, 64  # chunks whose ids a task keeps, and their bytes at most
WORD_END, END_BYTE = "</w>", "\0"  # how the vocabulary marks the end of a word, and the byte that stands for it here


class WordTokens:
    """Ids of whole texts by a tokenizer that drops white space and never joins across it.

    A text is cut at ASCII white space, where no normalisation or match reaches across, and each distinct chunk is
    encoded once. Chunks of ASCII and Latin-1 letters, digits and marks need only be lowered and cut into
    matches, which tiktoken merges by the vocabulary's own order, an end byte standing for the end of a word; it gives the
    same ids several times faster. All other chunks go to the tokenizers library itself."""

    #: Lowered sign by sign, composed already, no added token ("<|") inside.
    PLAIN = re.compile("(?!.*<[|])[!-~À-ÖØ-öø-ÿ]+").fullmatch
    #: The matches of the vocabulary's pattern over such chunks when lowered.
    MATCHES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^0-9a-zß-öø-ÿ]+").findall

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        signs = byte_signs()
        ranks = {}
        for token, i in vocabulary.items():
            word = token.removesuffix(WORD_END)
            ranks[bytes(signs[c] for c in word) + END_BYTE.encode() * (word != token)] = i
        if len(ranks) != len(vocabulary):
            raise ValueError(f"{path}: tokens that the end byte makes equal")
        self.merge = tiktoken.Encoding("file", pat_str=f"[^{END_BYTE}]+{END_BYTE}", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.chunks: dict[bytes, bytes] = {}

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8", "replace")
        if self.PLAIN(text):
            packed = array("I", self.merge(END_BYTE.join(self.MATCHES(text.lower())) + END_BYTE)).tobytes()
        else:
            packed = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(chunk) <= LONGEST_REMEMBERED:
            if len(self.chunks) >= MAX_REMEMBERED:
                self.chunks.clear()
            self.chunks[chunk] = packed
        return packed

    def encode(self, text: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        known = self.chunks.get
        return b"".join([known(chunk) or self._chunk(chunk) for chunk in text.split()])


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """One for each vocabulary in a Python worker."""
    return WordTokens(path)


def pieces(df: DataFrame, id_col: str, text_col: str, path: str, length: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, doc_tokens[, ids]): the ids of every text and the end id, cut every ``length`` ids."""
    names = ["id", "piece", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    end, step = np.array([end_id], dtype="<u4").tobytes(), 4 * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_tokens(path).encode
        for batch in batches:
            row, piece, start, size, crc, tokens, ids = [], [], [], [], [], [], []
            for i, text in enumerate(raw_texts(batch.column(1))):
                packed = encode(text) + end
                for k, at in enumerate(range(0, len(packed), step)):
                    part = packed[at:at + step]
                    for column, value in zip((row, piece, start, size, crc, tokens, ids), (i, k, at // 4, len(part) // 4, zlib.crc32(part), len(packed) // 4, part if with_ids else None)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, size, crc, tokens)),
                 *[pa.array(ids, pa.binary())] * with_ids], names=names)

    schema = f"id {type_of(df, id_col)}, piece int, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return df.select(df[id_col].alias("id"), df[text_col].alias("text")).mapInArrow(run, schema)


def fullest(left: dict[int, int], room: int) -> dict[int, int]:
    """How many pieces of each length fill ``room`` with the least slack, if ``left`` says how many there are of each
    (longest first). Longer pieces are taken before shorter ones where both leave the same slack."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length, count in left.items():
        count = min(count, room // length)
        times = 1
        while count:  # counts in powers of two: 1, 2, 4, ... and the rest
            times = min(times, count)
            wider = reach | (reach << length * times) & mask
            if wider != reach:
                steps.append((length, times, reach))
                reach = wider
            count -= times
            times *= 2
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + times
            total -= length * times
    return taken


def plan(counts: dict[int, int], length: int) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths and how many sequences are filled with each."""
    left, out = dict(sorted(counts.items(), reverse=True)), []
    while left:
        longest = next(iter(left))
        left[longest] -= 1
        taken = fullest(left, length - longest)
        left[longest] += 1
        taken[longest] = taken.get(longest, 0) + 1
        times = min(left[size] // n for size, n in taken.items())
        for size, n in taken.items():
            left[size] -= n * times
            if not left[size]:
                del left[size]
        out.append((taken, times))
    return out


def places(spark: SparkSession, found: list[tuple[dict[int, int], int]]) -> DataFrame:
    """(size, uses): for each length the runs of its numbers that the plan places, in order: first number,
    first sequence, pieces a sequence, offset of the first of them."""
    uses: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for taken, times in found:
        offset = 0
        for size, n in sorted(taken.items(), reverse=True):
            first = used.get(size, 0)
            uses.setdefault(size, []).append((first, sequence, n, offset))
            used[size] = first + n * times
            offset += n * size
        sequence += times
    return spark.createDataFrame(list(uses.items()), "size long, uses array<struct<first: long, sequence: long, n: long, offset: long>>")


def pack(df: DataFrame, id_col: str, text_col: str, path: str, length: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]): where every piece goes."""
    cut = pieces(df, id_col, text_col, path, length, end_id, with_ids).withColumn("_row", F.monotonically_increasing_id())
    cut = checkpointed(cut)  # the row numbers stay as they are, whatever task is run again
    found = plan({r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}, length)
    numbered = global_index(cut.select("_row", "length") if with_ids else cut, ["_row"], "_number", ["length"])
    if with_ids:  # the ids stay out of the numbering
        numbered = cut.join(numbered.drop("length"), "_row")
    use = F.expr("element_at(filter(uses, u -> u.first <= _number), -1)")
    placed = numbered.join(F.broadcast(places(df.sparkSession, found)), F.col("length") == F.col("size")).withColumn("_use", use)
    at = F.col("_number") - F.col("_use.first")
    return placed.select("id", "piece", "start", "length", "ids_crc32", "doc_tokens",
                         F.expr("_use.sequence + (_number - _use.first) div _use.n").alias("sequence_id"),
                         (F.col("_use.offset") + at % F.col("_use.n") * F.col("length")).alias("offset"), *["ids"] * with_ids)

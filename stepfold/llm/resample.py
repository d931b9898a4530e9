"""Importance resampling towards a target distribution, with n-gram hashes cut from prefix CRCs.

Documents and target texts are bags of hashed word n-grams. The log ratio of the
two smoothed bucket distributions is a bucket's gain; a document's weight is the mean
gain of its n-grams. Weights with Gumbel noise of the document's id are
ranked, and the highest are drawn: a sample without replacement in proportion to the exponential of the weights.

Each document is brought to words with one space between and scanned once; the running
CRC-32 is kept before and after every word. The CRC of any n-gram follows from two of
these prefixes: that of its begin, moved over the n-gram's length by multiplication with a
power of x over GF(2), cancels out of that of its end. No n-gram is ever built or read again.

A null text has no words. A document without n-grams weighs 0. A null id hashes like an empty one and comes
first among equal scores. Rows that repeat an id have the same noise, and each is drawn for itself.
An empty target leaves the gains to the smoothing alone; an empty table gives no row.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepfold.llm.common import checkpointed, raw_texts, type_of
from stepfold.operators.common import global_index

POLYNOMIAL = 0xEDB88320  # of CRC-32, reflected
SCALE = 1000
RUN_WORDS = 200_000  # words hashed at once

#: Words are runs of digits, ASCII letters and bytes beyond ASCII, with A-Z lowered; other bytes separate.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@lru_cache(maxsize=1)
def shift_tables() -> list[np.ndarray]:
    """Multiplication by x^(8 2^k) for k = 0, 1, ...: what each value of each of the four bytes of a CRC becomes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = (step >> 1) ^ np.where(step & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    register = np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], dtype=np.uint32)
    tables = [(register >> 8) ^ step[register & 255]]
    while len(tables) < 40:
        tables.append(_apply(tables[-1], tables[-1]))
    return tables


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24]


def shifted(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Each CRC as it stands in that of a text which goes on for ``size`` bytes."""
    crc, tables = crc.copy(), shift_tables()
    for k in range(int(size.max(initial=0)).bit_length()):
        at = np.flatnonzero((size >> k) & 1)
        crc[at] = _apply(tables[k], crc[at])
    return crc


class Prefixes:
    """Running CRCs of a run of documents: before and after each word, with places in bytes."""

    def __init__(self, documents: list[list[bytes]]):
        self.n_words = np.array([len(words) for words in documents], np.int64)
        total = int(self.n_words.sum())
        both, sizes = np.empty(2 * total, np.uint32), np.fromiter(map(len, chain.from_iterable(documents)), np.int64, total)
        done = 0
        for words in documents:  # word, space, word, space, ...
            n = 2 * len(words)
            both[done:done + n] = np.fromiter(accumulate(chain.from_iterable(zip(words, repeat(b" "))), _continue, initial=0), np.uint32, n + 1)[1:]
            done += n
        self.after = both[0::2]
        self.before = np.concatenate([np.zeros(1, np.uint32), both[1::2]])[:total]  # a space later the next word begins
        self.document = np.repeat(np.arange(len(documents)), self.n_words)
        self.before[(np.cumsum(self.n_words) - self.n_words)[self.n_words > 0]] = 0
        self.end = np.cumsum(sizes + 1) - 1  # within the run; a document's own places differ by a constant
        self.start = self.end - sizes

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, CRC-32) of every run of ``n`` words."""
        count = max(0, len(self.after) - n + 1)
        first = np.flatnonzero(self.document[:count] == self.document[n - 1:])
        last = first + n - 1
        return self.document[first], self.after[last] ^ shifted(self.before[first], self.end[last] - self.start[first])


def _continue(crc: int, part: bytes) -> int:
    return zlib.crc32(part, crc)


def prefix_runs(texts: list[bytes]) -> Iterator[Prefixes]:
    """The texts in order, in runs of bounded size (one very long text is a run of its own)."""
    held, size = [], 0
    for text in texts:
        words = text.translate(WORD_BYTES).split()
        if held and size + len(words) > RUN_WORDS:
            yield Prefixes(held)
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield Prefixes(held)


def bucket_counts(df: DataFrame, text_col: str, least: int, most: int, buckets: int) -> DataFrame:
    """(bucket, n) of all n-grams of ``least`` to ``most`` words; a task passes on at most ``buckets`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for prefixes in prefix_runs(raw_texts(batch.column(0))):
                for n in range(least, most + 1):
                    counts += np.bincount(prefixes.ngrams(n)[1] % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), pa.array(counts[used])], names=["bucket", "n"])

    return df.select(df[text_col]).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln(target share / source share)) of every bucket, shares smoothed by one in each bucket.
    Both tables have at most ``buckets`` rows."""
    s, t = (dict(df.select("bucket", "n").collect()) for df in (source, target))
    all_s, all_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    return np.array([math.floor(SCALE * math.log((t.get(b, 0) + 1) * all_s / ((s.get(b, 0) + 1) * all_t))) for b in range(buckets)], np.int64)


def weigh(df: DataFrame, id_col: str, text_col: str, gain: np.ndarray, least: int, most: int) -> DataFrame:
    """(id, n_words, n_features, weight): the floored mean gain of every document's n-grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, sums = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for prefixes in prefix_runs(raw_texts(batch.column(1))):
                size = len(prefixes.n_words)
                n, total = np.zeros(size, np.int64), np.zeros(size, np.int64)
                for k in range(least, most + 1):
                    document, crc = prefixes.ngrams(k)
                    n += np.bincount(document, minlength=size)
                    np.add.at(total, document, gain[crc % np.uint32(len(gain))])
                n_words.append(prefixes.n_words)
                n_features.append(n)
                sums.append(total)
            n, total = np.concatenate(n_features), np.concatenate(sums)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(n_words)), pa.array(n), pa.array(total // np.maximum(n, 1))],
                names=["id", "n_words", "n_features", "weight"])

    return df.select(df[id_col].alias("id"), df[text_col].alias("text")).mapInArrow(
        run, f"id {type_of(df, id_col)}, n_words long, n_features long, weight long")


def noise(seed: int, id_col: str) -> Column:
    """Gumbel noise of an id in thousandths: floor(-1000 ln(-ln u)), u from the first 32 bits of SHA-256."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(SCALE)) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


def resample(df: DataFrame, id_col: str, text_col: str, target: DataFrame, target_text_col: str, least: int, most: int, buckets: int,
             seed: int, least_words: int, percent: int) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document; rank from 1 for the ``percent`` of the documents
    of at least ``least_words`` words that are drawn (rounded down), else null."""
    gain = gains(bucket_counts(df, text_col, least, most, buckets), bucket_counts(target, target_text_col, least, most, buckets), buckets)
    weighed = weigh(df, id_col, text_col, gain, least, most).withColumn("score", F.col("weight") + noise(seed, "id"))
    # the row number is written with the rows, so it parts equal rows the same way whenever a task is run again
    weighed = checkpointed(weighed.withColumns({"_order": -F.col("score"), "_row": F.monotonically_increasing_id()}))
    able = weighed.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    ranked = global_index(able, ["_order", "id", "_row"], "_place")
    rank = F.when(F.col("_place") < drawn, F.col("_place") + 1).alias("rank")
    columns = ["id", "n_features", "weight", "score"]
    rest = weighed.where(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, rank).unionAll(rest)

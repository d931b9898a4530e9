"""Language identification by language-bitmask n-gram filters.

A bit-sliced Bloom filter holds one bit plane per language: slot s of the planes
is one mask of languages, and the AND of the masks at an n-gram's slots names all
languages that contain it at once. A text's n-grams are counted by language
(popcounts of the planes); plane l answers yes by chance with probability
fill_l ^ hashes, and the counts are corrected for that before the largest decides.

N-grams are runs of 1 to 3 letters of lower-cased words with a space at either
end, packed exactly into 63 bits. A language contains those whose share of its
n-grams is at least ``least_share`` and at least ``least_ratio`` of their largest
share in any language, so it holds 1 / least_share of them at most.

The filters are learned from a bounded sample: up to ``max_docs`` texts, spread
evenly over the languages, picked by a hash of the id. Texts that are null or
have no letter get ``und`` with score 0. Null languages teach nothing; with
nothing learned every text is ``und``. Equal evidence goes to the language with
more texts, then to the smaller name. A text without a known n-gram gets that
language too, with score 0.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepfold.llm.common import annotate, checkpointed, texts
from stepfold.operators.common import values_at

UNKNOWN = "und"
MAX_DOCS = 20_000
LOST = 0.001  # share of labelled texts that a language's least score may lie above
LEAST_SHARE = 2e-5
LEAST_RATIO = 0.05
HASHES = 3
SLOTS_PER_GRAM = 24  # slots for each n-gram of the language that holds most
CHARS_AT_A_TIME = 1 << 19
SPACE = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point itself if it is a letter, else a space."""
    table = np.full(sys.maxunicode + 1, SPACE, dtype=np.uint32)
    is_letter = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), dtype=bool, count=len(table))
    table[is_letter] = np.flatnonzero(is_letter)
    return table


def grams(some: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the texts, and the number of n-grams of each text."""
    codes = [_letters()[np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "replace"), "<u4")] for t in some]
    text = np.concatenate([*codes, np.full(2, SPACE, np.uint32)]).astype(np.uint64)
    owner = np.repeat(np.arange(len(some) + 1), [*map(len, codes), 2])
    a, b, c = text[:-2], text[1:-1], text[2:]
    same = owner[2:] == owner[:-2]
    s = np.uint64(SPACE)
    three = (b != s) & ~((a == s) & (c == s)) & same
    one = (a == s) & (b != s) & (c == s) & same
    two = (a != s) & (b != s) & (owner[1:-1] == owner[:-2])
    shift = np.uint64(21)
    found = [(a << shift | b) << shift | c, a << shift | b, b]
    keys = np.concatenate([k[m] for k, m in zip(found, (three, two, one))])
    of = np.concatenate([owner[:-2][m] for m in (three, two, one)])
    order = np.argsort(of, kind="stable")
    return keys[order], np.bincount(of, minlength=len(some))[: len(some)]


def _groups(some: list[str]) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of texts of bounded length; a longer text is a run of its own."""
    start = size = 0
    for i, t in enumerate(some):
        if i > start and size + len(t) > CHARS_AT_A_TIME:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(some):
        yield start, len(some)


class Filters:
    """Bit planes of all languages, interleaved: one mask of languages for each slot."""

    def __init__(self, languages: list[str], members: list[np.ndarray]):
        self.languages = languages
        most = max([1, *map(len, members)])
        self.bits = max(10, int(np.ceil(np.log2(most * SLOTS_PER_GRAM))))
        words = max(1, -(-len(languages) // 64))
        self.masks = np.zeros((1 << self.bits, words), dtype=np.uint64)
        for i, keys in enumerate(members):
            for slots in self._slots(keys):
                self.masks[slots, i // 64] |= np.uint64(1 << (i % 64))
        self.chance = np.array([self._plane(self.masks, i).mean() ** HASHES for i in range(len(languages))])

    def _slots(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        for i in range(HASHES):
            h = keys ^ np.uint64(0x9E3779B97F4A7C15 * (i + 1) & 0xFFFFFFFFFFFFFFFF)
            for multiplier in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
                h = (h ^ (h >> np.uint64(31))) * np.uint64(multiplier)
            yield (h >> np.uint64(64 - self.bits)).astype(np.int64)

    @staticmethod
    def _plane(masks: np.ndarray, i: int) -> np.ndarray:
        return (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Mask of all languages that contain each n-gram."""
        masks = None
        for slots in self._slots(keys):
            masks = self.masks[slots] if masks is None else masks & self.masks[slots]
        return masks

    def shares(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each text the share of its n-grams that each language contains, corrected, and its number of n-grams."""
        keys, counts = grams(some)
        masks = self.lookup(keys)
        ends = np.cumsum(counts)
        out = np.zeros((len(some), len(self.languages)))
        for i, chance in enumerate(self.chance):
            total = np.concatenate([[0], np.cumsum(self._plane(masks, i).astype(np.int64))])
            hits = total[ends] - total[ends - counts]
            out[:, i] = np.clip((hits - counts * chance) / np.maximum(1, counts) / max(1e-9, 1 - chance), 0, 1)
        return out, counts

    def predict(self, some: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(some), np.zeros(len(some))
        shares, counts = self.shares(some)
        best = shares.argmax(axis=1)
        top, total = shares[np.arange(len(some)), best], shares.sum(axis=1)
        score = np.where(counts > 0, top * top / np.maximum(total, 1e-12), 0.0)
        return [self.languages[b] if n else UNKNOWN for b, n in zip(best, counts)], score


def _sample(rows: DataFrame, max_docs: int) -> tuple[list[str], DataFrame]:
    """The languages by falling number of texts, and about ``max_docs`` rows (id, text, lang) spread evenly over them by a hash of the id."""
    have = sorted(rows.groupBy("lang").count().collect(), key=lambda r: (-r["count"], r["lang"]))
    quota = max(1, max_docs // max(1, len(have)))
    place, picked = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(1 << 30)), F.lit(False)
    for r in have:
        picked |= (F.col("lang") == r["lang"]) & (place < F.lit(int((1 << 30) * min(1.0, quota / r["count"]))))
    return [r["lang"] for r in have], rows.where(picked)


def least_scores(df: DataFrame, text_col: str, lang_col: str, filters: Filters, lost: float = LOST) -> dict[str, float]:
    """For each language the greatest score that no more than ``lost`` of its labelled texts stay below, from all texts whose
    language is predicted as labelled."""
    rows = df.select(df[text_col].alias("text"), df[lang_col].alias("lang")).where("text is not null and lang is not null")
    scored = checkpointed(predict(rows, "text", filters, ["lang"]).where("lang = lang_pred").select("lang", "score"))
    found = values_at(scored, ["lang"], "score", {"least_score": F.floor(F.col("_total") * lost)})
    return {r["lang"]: r["least_score"] for r in found.collect()}


def learn(df: DataFrame, id_col: str, text_col: str, lang_col: str, max_docs: int = MAX_DOCS,
          least_share: float = LEAST_SHARE, least_ratio: float = LEAST_RATIO) -> Filters:
    """Filters from labelled texts. The number of languages is taken to be bounded."""
    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"), df[lang_col].alias("lang")).where("text is not null and lang is not null")
    languages, picked = _sample(rows, max_docs)
    if not languages:
        return Filters([], [])
    number = {lang: i for i, lang in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = texts(batch.column(0))
            langs = np.array([number[x] for x in batch.column(1).to_pylist()], dtype=np.int32)
            for lang in np.unique(langs):
                mine = [some[i] for i in np.flatnonzero(langs == lang)]
                for first, end in _groups(mine):
                    keys, n = np.unique(grams(mine[first:end])[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), lang)), pa.array(keys.astype(np.int64)), pa.array(n)],
                                                     names=["lang", "gram", "n"])

    counted = picked.select("text", "lang").mapInArrow(count, "lang int, gram long, n long")
    sums = [F.coalesce(F.sum(F.when(F.col("lang") == i, F.col("n"))), F.lit(0)).alias(f"n{i}") for i in range(len(languages))]
    by_gram = checkpointed(counted.groupBy("gram").agg(*sums))
    totals = by_gram.agg(*[F.sum(f"n{i}") for i in range(len(languages))]).first()
    by_gram = by_gram.select("gram", *[(F.col(f"n{i}") / F.lit(totals[i] or 1)).alias(f"s{i}") for i in range(len(languages))])
    share = F.greatest(*[F.col(f"s{i}") for i in range(len(languages))], F.lit(0.0))
    known = by_gram.where(share >= least_share).collect()  # languages / least_share n-grams at most
    keys = np.array([r[0] for r in known], dtype=np.int64).view(np.uint64)
    table = np.array([r[1:] for r in known], dtype=np.float64).reshape(len(known), len(languages))
    peak = table.max(axis=1, initial=0)
    return Filters(languages, [keys[(table[:, i] >= least_share) & (table[:, i] >= least_ratio * peak)] for i in range(len(languages))])


def predict(df: DataFrame, text_col: str, filters: Filters, carry: list[str], lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """The columns ``carry``, the predicted language and its score for every whole text."""
    def worker():
        def work(some: list[str]) -> list[pa.Array]:
            langs, scores = [], [np.empty(0)]
            for first, end in _groups(some):
                found, share = filters.predict(some[first:end])
                langs += found
                scores.append(share)
            return [pa.array(langs, pa.string()), pa.array(np.concatenate(scores))]
        return work

    return annotate(df, text_col, carry, [(lang, "string"), (score, "double")], worker)

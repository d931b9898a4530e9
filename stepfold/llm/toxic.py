"""Toxic documents by marks: words and word beginnings that labelled toxic texts hold and clean ones don't.

A mark is a whole word, or a beginning of 3 to 8 letters with the least number of
distinct words of the text that begin with it. One mark is enough, whatever the
text's length: nothing is thinned out in a long text. Words are lower-cased and
freed of signs at either end.

The marks are learned from a bounded sample of labelled rows, ``max_rows`` of
them, evenly toxic and clean, picked by a hash of the id and dealt into ``PARTS`` parts by
another. For each part the others propose marks: a feature is tested if ``LEAST_TEXTS``
texts hold it, and proposed if toxic texts hold it more often than chance explains
(Chernoff's bound of the binomial tail, over all tested features at once). The clean
texts of the part left out tell how strong a mark must be: no more than ``LOST`` of
them, all parts together, may hold one. Only marks that every choice of parts
proposes so strongly are kept. With too few labels nothing is proposed and nothing is
rejected. Null and empty texts hold no mark.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepfold.llm.common import checkpointed, texts

MAX_ROWS = 6_000
SIGNS = ".,;:!?\"')(*#%&$|"
SHORTEST, LONGEST = 3, 8  # letters of a beginning
MOST_WORDS = 4  # greatest number of words that a mark asks for
LEAST_TEXTS = 3
CHANCE = 0.01  # of any false proposal
PARTS = 3
LOST = 0.001  # share of held-out clean texts that marks may reject
AT_A_TIME = 200_000  # features counted in a worker before they are passed on
MAX_REMEMBERED = 200_000  # words kept in a worker


def core(word: str) -> str:
    return word.strip(SIGNS).lower()


def features(text: str) -> list[tuple[str, int]]:
    """(word, 0) of each distinct word, (beginning, n) of each beginning that n or more distinct words have."""
    words = {core(w) for w in set(text.split())} - {""}
    begun = Counter(w[:k] for w in words for k in range(SHORTEST, min(LONGEST, len(w)) + 1))
    return [*zip(words, repeat(0)), *((b, n) for b, most in begun.items() for n in range(1, min(most, MOST_WORDS) + 1))]


class Marks:
    """Strengths by feature; ``strength`` is that of a text's strongest mark."""

    def __init__(self, strengths: dict[tuple[str, int], float]):
        self.strengths = strengths
        self._begin = {b for b, n in strengths if n}
        self._known: dict[str, tuple | None] = {}  # word -> (core, its beginnings that are marks), None if it can't matter

    def _look(self, word: str) -> tuple | None:
        own = core(word)
        begun = [own[:k] for k in range(SHORTEST, min(LONGEST, len(own)) + 1) if own[:k] in self._begin]
        found = (own, begun) if begun or (own, 0) in self.strengths else None
        if len(self._known) >= MAX_REMEMBERED:
            self._known.clear()
        if len(word) < 64:
            self._known[word] = found
        return found

    def strength(self, text: str) -> float:
        known, look, held = self._known, self._look, {}
        for w in set(text.split()):
            found = known[w] if w in known else look(w)
            if found:
                held[found[0]] = found[1]
        if not held:
            return -math.inf
        counts = Counter(b for begun in held.values() for b in begun)
        marks = [*zip(held, repeat(0)), *((b, n) for b, most in counts.items() for n in range(1, min(most, MOST_WORDS) + 1))]
        return max(self.strengths.get(m, -math.inf) for m in marks)


def _proposed(toxic: int, clean: int, toxics: int, cleans: int, tested: int) -> bool:
    if not toxic or not toxics or not cleans:
        return False
    n, share = toxic + clean, toxics / (toxics + cleans)
    p = toxic / n
    if p <= share:
        return False
    distance = p * math.log(p / share) + ((1 - p) * math.log((1 - p) / (1 - share)) if p < 1 else 0.0)
    return -n * distance < math.log(CHANCE / tested)


def learn(df: DataFrame, id_col: str, text_col: str, toxic_col: str, max_rows: int = MAX_ROWS) -> Marks | None:
    """Marks from labelled rows; ``toxic_col`` is 1 or 0, others teach nothing."""
    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"), df[toxic_col].cast("int").alias("toxic")).where("toxic in (0, 1)")
    have = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}  # two rows
    if len(have) < 2:
        return None
    place, picked = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30)), F.lit(False)
    for level, n in have.items():
        picked |= (F.col("toxic") == level) & (place < F.lit(int((1 << 30) * min(1.0, max_rows / 2 / n))))
    marks = learn_from(checkpointed(rows.where(picked).withColumn("part", part_of("id"))))
    return marks[0] if marks else None


def part_of(id_col: str) -> Column:
    return F.pmod(F.xxhash64(id_col, F.lit(8)), F.lit(PARTS)).cast("int")


def learn_from(sample: DataFrame) -> tuple[Marks, list[dict[tuple[str, int], float]]] | None:
    """Marks from a bounded sample (text, toxic 0 or 1, part), and for each part the marks that the other parts alone give."""
    names = [f"{kind}{part}" for part in range(PARTS) for kind in ("clean", "toxic")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[int]] = {}

        def batch_of() -> pa.RecordBatch:
            columns = zip(*((f, n, *seen) for (f, n), seen in found.items()))
            types = [pa.string(), pa.int32(), *[pa.int64()] * len(names)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["feature", "words", *names])

        for batch in batches:
            for text, toxic, part in zip(texts(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                for f in features(text):
                    found.setdefault(f, [0] * len(names))[2 * part + toxic] += 1
                if len(found) >= AT_A_TIME:
                    yield batch_of()
                    found.clear()
        if found:
            yield batch_of()

    held = {(r["part"], r["toxic"]): r["count"] for r in sample.groupBy("part", "toxic").count().collect()}  # two rows a part
    counted = sample.select("text", "toxic", "part").mapInArrow(count, "feature string, words int, " + ", ".join(f"{n} long" for n in names))
    counted = (counted.groupBy("feature", "words").agg(*[F.sum(n).alias(n) for n in names])
               .where(" + ".join(names) + f" >= {LEAST_TEXTS}"))
    counted = checkpointed(counted)
    tested = counted.count()
    all_toxic, all_clean = (" + ".join(n for n in names if n.startswith(kind)) for kind in ("toxic", "clean"))
    toxics, cleans = (sum(n for (_, level), n in held.items() if level == t) for t in (1, 0))
    likely = counted.where(f"{all_toxic} >= {LEAST_TEXTS} and ({all_toxic}) * {cleans} > ({all_clean}) * {toxics}")
    strengths: list[dict[tuple[str, int], float]] = [{} for _ in range(PARTS)]  # by the part left out
    for f, n, *seen in likely.toLocalIterator():
        for part, own in enumerate(strengths):
            toxic, clean = sum(seen[1::2]) - seen[2 * part + 1], sum(seen[::2]) - seen[2 * part]
            others = toxics - held.get((part, 1), 0), cleans - held.get((part, 0), 0)
            if _proposed(toxic, clean, *others, tested):
                own[f, n] = math.log((toxic + 0.5) / (others[0] + 1)) - math.log((clean + 0.5) / (others[1] + 1))
    agreed = {f: min(own[f] for own in strengths) for f in strengths[0] if all(f in own for own in strengths)}
    if not agreed:
        return None

    def strongest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = [Marks(own) for own in strengths]
        for batch in batches:
            found = [marks[part].strength(t) for t, part in zip(texts(batch.column(0)), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.float64())], names=["strength"])

    if not held.keys() & {(part, 0) for part in range(PARTS)}:
        return None
    scored = sample.where("toxic = 0").select("text", "part").mapInArrow(strongest, "strength double").collect()  # about max_rows / 2
    cut = sorted((r[0] for r in scored), reverse=True)[int(LOST * len(scored))]
    agreed = {f: s for f, s in agreed.items() if s > cut}
    return (Marks(agreed), [{f: s for f, s in own.items() if s > cut} for own in strengths]) if agreed else None

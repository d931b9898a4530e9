"""Quality classifier: ordinal (cumulative-link) logistic regression on hashed text.

Grades 0 < 1 < .. < K-1 share one weight vector w over hashed features x and have
ordered thresholds t_1 < .. < t_{K-1}: P(grade >= k) = sigmoid(w.x - t_k). The
expected grade is the sum of these tails, and a document is selected if its tail
at ``cut`` reaches ``least``. With marks the cut is the top grade; labels too few to teach any can't tell good
prose from toxic good prose, and the cut is grade 1. ``least`` is the greatest value that loses no more than ``LOST`` of the labels at or above
the cut, each judged by a model of the other parts; without marks, one half at most.

Features are the words of the whole text, their letter case and punctuation
shape, and the number of words that repeat the word before; x is their count
over the root of the number of words. One more feature is 1, in a text of any length, if the text holds a
mark of toxic texts (``toxic``); it has its weight from the regression like all others. While fitting, each row's mark
feature comes from marks that the other rows gave, so the weight is that of marks in texts which taught none.

The model is fitted on a bounded sample of graded rows: at most ``max_rows`` labels, evenly over the
classes of grade and toxicity, are picked from the narrow labels by a hash of the id before any text is read, and
weighted back to the classes' true shares. A label counts once, with one text of its id.

Null and empty texts have x = 0 and are scored by the thresholds alone. Grades
that are null teach nothing. If fewer than two grades occur, there is nothing to
separate: every document has tail 1.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepfold.llm import toxic
from stepfold.llm.common import annotate, checkpointed, texts, type_of
from stepfold.llm.toxic import Marks

BUCKETS = 1 << 16
MAX_ROWS = 6_000
MAX_LABELS = 12_000  # of a sample that also teaches marks
LOST = 0.001  # share of held-out good labels that the least tail may reject
STEPS = 150
RATE = 0.1
RIDGE = 3e-5
MAX_REMEMBERED = 200_000  # word scores kept in a worker
REPEATS = 0  # the bucket of words that repeat the word before
MARKED = BUCKETS  # the bucket of texts that hold a mark


def _bucket(feature: str) -> int:
    return 1 + zlib.crc32(feature.encode("utf-8", "replace")) % (BUCKETS - 1)


def word_features(word: str) -> tuple[int, int]:
    """Buckets of a word's own feature and of its shape (case and last sign)."""
    core = word.rstrip(".,;:!?\"')*#%&$|")
    tail = word[len(core):]
    case = "A" if core.isupper() and len(core) > 1 else "Aa" if core[:1].isupper() else "a" if core.islower() else "0" if core.isdigit() else "?"
    return _bucket("w " + core.lower()), _bucket(f"s {case} {tail[:2]}")


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text's features."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    distinct: dict[str, int] = {}
    for w in words:
        distinct[w] = distinct.get(w, 0) + 1
    pairs = np.array([word_features(w) for w in distinct], dtype=np.int64)
    counts = np.array(list(distinct.values()), dtype=np.float64)
    repeats = sum(map(operator.eq, words, words[1:]))
    at, into = np.unique(np.concatenate([pairs[:, 0], pairs[:, 1], [REPEATS]]), return_inverse=True)
    values = np.bincount(into, weights=np.concatenate([counts, counts, [repeats]]))
    return at, values / np.sqrt(len(words))


@dataclass
class OrdinalModel:
    weights: np.ndarray  # by bucket
    thresholds: np.ndarray  # ascending, one less than the grades
    marks: dict[tuple[str, int], float] = field(default_factory=dict)  # strengths of the marks behind the mark feature
    cut: int = 1
    least: float = 0.5

    def tails(self, eta: np.ndarray) -> np.ndarray:
        """P(grade >= 1), .. P(grade >= K-1) by row."""
        return _sigmoid(np.asarray(eta)[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, weight: np.ndarray, n_grades: int) -> OrdinalModel:
    """Maximum likelihood with a ridge penalty, by Adam over all rows."""
    sizes = np.array([len(r[0]) for r in rows])
    at, x = (np.concatenate([*(r[i] for r in rows), np.zeros(0)]) for i in (0, 1))
    at = at.astype(np.int64)
    used, at = np.unique(at, return_inverse=True)
    of = np.repeat(np.arange(len(rows)), sizes)
    share = weight / weight.sum()
    upto = np.clip(np.cumsum(np.bincount(grades, weights=share, minlength=n_grades))[:-1], 1e-6, 1 - 1e-6)
    first = np.log(upto / (1 - upto))
    # parameters: weights, first threshold, logs of the gaps between thresholds
    theta = np.concatenate([np.zeros(len(used)), first[:1], np.log(np.maximum(np.diff(first), 1e-3))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    row = np.arange(len(rows))
    for step in range(1, STEPS + 1):
        w, cuts = theta[:len(used)], np.cumsum(np.r_[theta[len(used)], np.exp(theta[len(used) + 1:])])
        eta = np.bincount(of, weights=x * w[at], minlength=len(rows))
        bounds = np.concatenate([[np.inf], -cuts, [-np.inf]])  # P(grade >= k) = sigmoid(eta + bounds[k])
        tail = _sigmoid(np.clip(eta[:, None] + bounds[None, :], -60, 60))
        tail[:, 0], tail[:, -1] = 1, 0
        slope = tail * (1 - tail)
        p = np.maximum(tail[row, grades] - tail[row, grades + 1], 1e-12)
        up, down = slope[row, grades] / p * share, slope[row, grades + 1] / p * share
        d_eta = up - down
        d_cut = np.zeros(n_grades + 1)
        np.add.at(d_cut, grades, -up)
        np.add.at(d_cut, grades + 1, down)
        d_cut = d_cut[1:n_grades]
        gaps = np.exp(theta[len(used) + 1:])
        from_here = np.cumsum(d_cut[::-1])[::-1]
        gradient = np.concatenate([np.bincount(at, weights=x * d_eta[of], minlength=len(used)) - RIDGE * w, from_here[:1], from_here[1:] * gaps])
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient ** 2
        theta = theta + RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-10)
    weights = np.zeros(BUCKETS + 1)
    weights[used] = theta[:len(used)]
    return OrdinalModel(weights, np.cumsum(np.r_[theta[len(used)], np.exp(theta[len(used) + 1:])]))


class _WordScores(dict):
    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        a, b = word_features(word)
        score = float(self.weights[a] + self.weights[b])
        if len(self) >= MAX_REMEMBERED:
            self.clear()
        if len(word) < 64:
            self[word] = score
        return score


def linear_score(text: str, scores: _WordScores) -> float:
    words = text.split()
    if not words:
        return 0.0
    repeats = sum(map(operator.eq, words, words[1:]))
    return (sum(map(scores.__getitem__, words)) + repeats * float(scores.weights[REPEATS])) / len(words) ** 0.5


def _vectors(sample: DataFrame, marks: list[dict[tuple[str, int], float]]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """Features, grades and parts of a bounded sample (id, text, grade, part); a row's mark feature is by the marks of its part."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_part = [Marks(own) for own in marks]
        for batch in batches:
            found = []
            for text, part in zip(texts(batch.column(1)), batch.column(3).to_pylist()):
                at, x = features(text)
                if of_part[part].strengths and of_part[part].strength(text) > -np.inf:
                    at, x = np.append(at, MARKED), np.append(x, 1.0)
                found.append((at, x))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
                                              pa.array([f[1].astype(np.float32) for f in found], pa.list_(pa.float32()))], names=["id", "grade", "part", "at", "x"])

    found = sample.mapInArrow(extract, f"id {type_of(sample, 'id')}, grade int, part int, at array<int>, x array<float>").toArrow().sort_by("id")
    vectors = []
    for chunk in range(found["at"].num_chunks):
        at, x = found["at"].chunk(chunk), found["x"].chunk(chunk)
        cuts = at.offsets.to_numpy()[1:-1] - at.offsets[0].as_py()
        vectors += zip(np.split(at.flatten().to_numpy(), cuts), np.split(x.flatten().to_numpy().astype(np.float64), cuts))
    return vectors, found["grade"].to_numpy(), found["part"].to_numpy()


def labelled_sample(df: DataFrame, id_col: str, text_col: str, labels: DataFrame, max_rows: int = MAX_LABELS) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """(id, text, grade, toxic, part) of at most ``max_rows`` labels (id, grade, toxic; an id once), as many of each class of grade and
    toxicity, and how many labels each class has. The ids are picked before the texts are read, and sent to them."""
    labels = labels.where("id is not null and grade >= 0 and toxic in (0, 1)")
    have = {(r["grade"], r["toxic"]): r["count"] for r in labels.groupBy("grade", "toxic").count().collect()}  # two rows for each grade
    quota, picked = max(1, max_rows // max(1, len(have))), labels.limit(0)
    for grade, level in sorted(have):
        own = labels.where((F.col("grade") == grade) & (F.col("toxic") == level))
        picked = picked.unionAll(own.orderBy(F.xxhash64("id", F.lit(5)), "id").limit(quota))
    texts_of = df.select(df[id_col].alias("id"), df[text_col].alias("text")).join(F.broadcast(picked), "id")
    once = texts_of.groupBy("id", "grade", "toxic").agg(F.min_by("text", F.struct(F.length("text"), F.xxhash64("text"))).alias("text"))
    return checkpointed(once.select("id", "text", "grade", "toxic", toxic.part_of("id").alias("part"))), have


def train_with_marks(df: DataFrame, id_col: str, text_col: str, labels: DataFrame, max_rows: int = MAX_LABELS) -> OrdinalModel | None:
    """Marks and model, both from one bounded sample of the labels (id, grade, toxic)."""
    sample, have = labelled_sample(df, id_col, text_col, labels, max_rows)
    taken = {(r["grade"], r["toxic"]): r["count"] for r in sample.groupBy("grade", "toxic").count().collect()}
    levels = sorted({grade for grade, _ in taken})
    if len(levels) < 2:
        return None
    learned = toxic.learn_from(sample.select("text", "toxic", "part")) if len({level for _, level in taken}) == 2 else None
    marks, by_part = learned or (Marks({}), [{}] * toxic.PARTS)
    vectors, classes, part = _vectors(sample.select("id", "text", (F.col("grade") * 2 + F.col("toxic")).cast("int").alias("grade"), "part"), by_part)
    weight = np.array([have[c] / n for c, n in sorted(taken.items())])[np.searchsorted([2 * g + t for g, t in sorted(taken)], classes)]
    grades = np.searchsorted(levels, classes // 2)
    model = fit(vectors, grades, weight, len(levels))
    model.marks = marks.strengths
    model.cut = len(levels) - 1 if marks.strengths else 1
    model.least = min(_least_tail(vectors, grades, weight, part, model.cut), 1.0 if marks.strengths else 0.5)
    return model


def _least_tail(vectors: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, weight: np.ndarray, part: np.ndarray, cut: int) -> float:
    """The greatest tail that rejects no more than ``LOST`` of the rows of grade ``cut`` or more, each by a model of the other parts."""
    tails: list[float] = []
    for own in np.unique(part):
        rest, good = np.flatnonzero(part != own), np.flatnonzero((part == own) & (grades >= cut))
        if set(grades[rest]) != set(grades):
            continue
        model = fit([vectors[i] for i in rest], grades[rest], weight[rest], int(grades.max()) + 1)
        eta = np.array([float(model.weights[at] @ x) for at, x in (vectors[i] for i in good)])
        tails += model.tails(eta)[:, cut - 1].tolist()
    return sorted(tails)[int(LOST * len(tails))] if tails else 0.5


def train(df: DataFrame, id_col: str, text_col: str, grade_col: str, max_rows: int = MAX_ROWS) -> OrdinalModel | None:
    """Fit on a bounded sample of graded rows. Grades are small whole numbers from 0."""
    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"), df[grade_col].cast("int").alias("grade")).where("grade >= 0")
    have = {r["grade"]: r["count"] for r in rows.groupBy("grade").count().collect()}  # one row for each grade
    if len(have) < 2:
        return None
    levels = sorted(have)
    quota = max(1, max_rows // len(levels))
    place, picked = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)), None
    for g in levels:
        own = (F.col("grade") == g) & (place < F.lit(int((1 << 30) * min(1.0, quota / have[g]))))
        picked = own if picked is None else picked | own

    vectors, grades, _ = _vectors(rows.where(picked).select("id", "text", "grade", F.lit(0).alias("part")), [{}])
    grades = np.searchsorted(levels, grades)
    taken = np.bincount(grades, minlength=len(levels))
    true = np.array([have[g] for g in levels], dtype=np.float64)
    if (taken == 0).any():
        return None
    return fit(vectors, grades, (true / taken)[grades], len(levels))


def score(df: DataFrame, text_col: str, model: OrdinalModel | None, cut: int, least: float, carry: list[str],
          names: tuple[str, str, str] = ("expected_grade", "tail", "selected"), marks: Marks | None = None) -> DataFrame:
    """The columns ``carry``, the expected grade, tail = P(grade >= cut) and whether it reaches ``least``, for every whole text.
    ``marks``, if given, are asked besides: a text that holds one isn't selected whatever its tail."""
    strengths, own = marks.strengths if marks else {}, model.marks if model else {}

    def worker():
        words, barred, marked = _WordScores(model.weights) if model else None, Marks(strengths), Marks(own)

        def linear(text: str) -> float:
            return linear_score(text, words) + (model.weights[MARKED] if own and marked.strength(text) > -np.inf else 0.0)

        def work(some: list[str]) -> list[pa.Array]:
            clear = np.array([not strengths or barred.strength(t) == -np.inf for t in some], dtype=bool)
            if not model:
                return [pa.array(np.zeros(len(some))), pa.array(np.ones(len(some))), pa.array(clear)]
            tails = model.tails(np.array([linear(t) for t in some], dtype=np.float64))
            tail = tails[:, min(cut, tails.shape[1]) - 1]
            return [pa.array(tails.sum(axis=1)), pa.array(tail), pa.array((tail >= least) & clear)]
        return work

    return annotate(df, text_col, carry, list(zip(names, ("double", "double", "boolean"))), worker)

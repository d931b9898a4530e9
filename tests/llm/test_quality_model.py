"""The ordinal model: its maximum against a plain maximiser, marks as a feature, the bounded sample."""

import numpy as np
from pyspark.sql import functions as F

from stepfold.llm import quality, queries, toxic
from stepfold.llm.common import table


def likelihood(w, cuts, x, grades, weight):
    """Weighted mean log likelihood less the ridge penalty, written out."""
    total = 0.0
    for row, g, a in zip(x, grades, weight / weight.sum()):
        eta = float(row @ w)
        above = [1.0, *(1 / (1 + np.exp(-(eta - c))) for c in cuts), 0.0]
        total += a * np.log(max(above[g] - above[g + 1], 1e-12))
    return total - 0.5 * quality.RIDGE * float(w @ w)


def test_fit_reaches_the_maximum(monkeypatch):
    monkeypatch.setattr(quality, "STEPS", 6000)
    monkeypatch.setattr(quality, "RATE", 0.002)
    monkeypatch.setattr(quality, "RIDGE", 0.01)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 4))
    noisy = x @ np.array([1.0, -0.5, 0.25, 0.0]) + rng.logistic(size=200)
    grades = np.digitize(noisy, [-0.5, 0.8])
    weight = rng.uniform(0.5, 2, 200)
    model = quality.fit([(np.arange(4), row) for row in x], grades, weight, 3)
    w, cuts = model.weights[:4], model.thresholds
    best = likelihood(w, cuts, x, grades, weight)
    for i in range(4):  # no step in any direction gains
        for step in (-1e-3, 1e-3):
            moved = w.copy()
            moved[i] += step
            assert likelihood(moved, cuts, x, grades, weight) <= best + 1e-8
    for i in range(2):
        for step in (-1e-3, 1e-3):
            moved = cuts.copy()
            moved[i] += step
            assert likelihood(w, moved, x, grades, weight) <= best + 1e-8
    numeric = [(likelihood(w + 1e-5 * e, cuts, x, grades, weight) - likelihood(w - 1e-5 * e, cuts, x, grades, weight)) / 2e-5 for e in np.eye(4)]
    assert np.abs(numeric).max() < 1e-4


def test_sample_is_bounded_and_even(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    docs = docs.unionAll(docs.where("doc_id < 2000"))  # repeated ids
    labels = spark.range(4000).select("id", F.when(F.col("id") % 10 == 0, 0).when(F.col("id") % 10 == 1, 1).otherwise(2).alias("grade"),
                                      (F.col("id") % 10 == 1).cast("int").alias("toxic"))
    sample, have = quality.labelled_sample(docs, "doc_id", "text", labels, max_rows=300)
    assert have == {(0, 0): 400, (1, 1): 400, (2, 0): 3200}
    got = sample.collect()
    assert len(got) == len({r["id"] for r in got}) == 300
    assert all(r["text"] == f"text {r['id']}" for r in got)
    empty = quality.labelled_sample(docs.limit(0), "doc_id", "text", labels.limit(0), max_rows=300)
    assert empty[0].count() == 0 and empty[1] == {}
    assert quality.train_with_marks(docs.limit(0), "doc_id", "text", labels) is None


def test_toxic_documents_go_by_the_model_alone(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    seen = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)) == 0
    model = queries.quality_model(docs, labels.where(seen))
    assert model.marks and model.cut == 2 and model.weights[quality.MARKED] < 0
    probe = queries.graded(docs, labels.where(~seen))
    got = quality.score(probe, "text", model, model.cut, model.least, ["grade", "toxic"]).collect()
    kept = {g: [r["selected"] for r in got if r["grade"] == g] for g in (0, 1, 2)}
    assert sum(kept[0]) < 0.05 * len(kept[0]) and sum(kept[1]) < 0.5 * len(kept[1]) and sum(kept[2]) >= 0.998 * len(kept[2])


def test_marks_of_a_part_come_from_the_others(spark):
    rows = [(i, f"old prose {'vile' if i % 2 else 'mill'} x{i}", i % 2, i % 3) for i in range(300)]
    learned = toxic.learn_from(spark.createDataFrame(rows, "id long, text string, toxic int, part int"))
    marks, by_part = learned
    assert ("vile", 0) in marks.strengths and len(by_part) == toxic.PARTS and all(("vile", 0) in own for own in by_part)

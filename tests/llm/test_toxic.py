"""Toxic documents of good prose are rejected and clean ones kept, by labels that taught nothing."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from stepfold.llm import quality, queries, toxic
from stepfold.llm.common import table

PROSE = ["the", "river", "runs", "past", "old", "mill", "stone", "light"]


def test_marks_reject_one_word_in_a_long_text(spark):
    rng = random.Random(11)

    def text(words, extra=()):
        return " ".join([rng.choice(PROSE) for _ in range(words)] + list(extra))

    rows = [(i, text(60, ["vile!"] if i % 2 else []), i % 2, 1) for i in range(300)]
    rows += [(300 + i, text(60, [f"Nast{a}", f"nast{b},"] if i % 2 else [f"nast{a}"]), i % 2, 1) for i in range(300) for a, b in [rng.sample("abcdefgh", 2)]]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int, grade int")
    marks = toxic.learn(df, "doc_id", "text", "toxic")
    assert ("vile", 0) in marks.strengths and ("nast", 2) in marks.strengths and ("nast", 1) not in marks.strengths
    probe = [(0, text(20_000, ["vile."]), False), (1, text(20_000), True), (2, "nasta nastb", False), (3, "nasta nasta", True), (4, None, True), (5, "", True)]
    docs = spark.createDataFrame([r[:2] for r in probe], "doc_id long, text string")
    got = {r["doc_id"]: r["selected"] for r in quality.score(docs, "text", None, 1, 0.5, ["doc_id"], marks=marks).collect()}
    assert got == {i: kept for i, _, kept in probe}


def test_too_few_labels_teach_no_marks(spark):
    rows = [(i, "vile prose" if i < 2 else "old prose", int(i < 2)) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert toxic.learn(df, "doc_id", "text", "toxic") is None
    assert toxic.learn(df.where("toxic = 0"), "doc_id", "text", "toxic") is None


def test_query_and_stage_reject_toxic_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs = table(spark, sf, "documents")
    seen = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)) == 0
    rows = queries.graded(docs, table(spark, sf, "labels"))
    marks = toxic.learn(rows.where(seen), "doc_id", "text", "toxic")
    probe = rows.where(~seen & (F.col("grade") > 0)).select("doc_id", "text", "toxic")
    got = quality.score(probe, "text", None, 1, 0.5, ["doc_id", "toxic"], marks=marks).collect()
    kept = {t: [r["selected"] for r in got if r["toxic"] == t] for t in (0, 1)}
    assert sum(kept[1]) < 0.5 * len(kept[1]) and sum(kept[0]) >= 0.998 * len(kept[0])
    labels = {r["doc_id"]: r for r in rows.where("grade > 0").select("doc_id", "toxic").collect()}
    selected = {r["doc_id"] for r in queries.op2_quality(spark, sf).where("selected").select("doc_id").collect()}
    staged = {r["doc_id"] for r in corpus_pipeline.quality_grade(spark, docs, sf).select("doc_id").collect()}
    assert selected == staged
    toxics, cleans = ([i for i, r in labels.items() if r["toxic"] == t] for t in (1, 0))
    assert sum(i in selected for i in toxics) < 0.5 * len(toxics) and sum(i in selected for i in cleans) >= 0.995 * len(cleans)

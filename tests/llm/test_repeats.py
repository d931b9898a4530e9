"""Rows that share an id: queries of the top-k search, and documents of the near-duplicates stage."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stepfold.llm import queries, topk
from stepfold.session import ensure_checkpoint_dir
from tests.llm.test_operators import brute_fingerprint
from tests.oracle import duck

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, fp string, cluster long, `rows` int"


def top_k(rows, k, every):
    """Brute force: a query for each distinct (id, vector), a candidate for each row of another id."""
    out = []
    for q, vector in sorted({(i, tuple(v)) for i, v in rows if i % every == 0}):
        scores = sorted((-int(np.dot(vector, v)), i) for i, v in rows if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("repeats", [[0, 0, 1, 2, 3], [0, 0, 0, 5, 5, 1, 1, 2, 3, 10, 10]])
def test_repeated_query_rows(spark, repeats):
    rng = np.random.default_rng(4)
    same = {i: rng.integers(-9, 9, 4).tolist() for i in set(repeats)}
    rows = [(i, same[i]) for i in repeats] + [(0, [1, 2, 3, 4]), (5, [4, 3, 2, 1]), (5, [4, 3, 2, 1])]
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id long, v array<long>, twin long, `rank` int")
    got = topk.search(df, "vec_id", F.col("v"), F.col("vec_id") % 5 == 0, 3)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "id", "score").collect()) == top_k(rows, 3, 5)


def test_oracle_of_repeated_query_rows(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=3)]) for i in (0, 1, 2, 50, 51, 100)]
    rows += [rows[0], rows[1], (50, [0.5, 0.25, -1.0]), (50, None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(tuple(r) for r in queries.op4_top_k(spark, str(tmp_path)).collect())
    con = duck("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert got == sorted(con.execute(queries.ORACLE["op4_top_k"]).fetchall()) and len(got) == 20


def text(seed, n=60):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, 5000, n))


def kept(spark, rows):
    df = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y", 1, 2) for i, t in rows], SCHEMA)
    out = corpus_pipeline.near_duplicates(spark, df, "")
    assert out.columns == df.columns
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)


def test_unlike_texts_of_one_id_stay(spark):
    a, b, c, d = (text(s) for s in (1, 2, 3, 4))
    assert kept(spark, [(3, a), (5, a), (5, b)]) == [(3, a), (5, b)]
    rows = [(3, a), (5, a), (5, b), (5, c), (5, c), (2, d), (5, d), (7, c), (7, c), (None, a), (None, a), (9, None), (9, ""), (8, "")]
    assert kept(spark, rows) == sorted([(3, a), (5, b), (5, c), (2, d), (None, a), (None, a), (8, "")], key=str)


def test_one_of_each_group_against_brute_force(spark):
    rng = np.random.default_rng(6)
    base = [text(s, 400) for s in range(12)]
    near = [" ".join(w if rng.random() > 0.004 else "new" for w in t.split()) for t in base]
    rows = [(int(rng.integers(0, 9)), (base + near)[int(rng.integers(0, 24))]) for _ in range(80)]
    fps = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):  # rows of one group take its least number
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4 and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    heads = {g: min(rows[i][0] for i in range(len(rows)) if group[i] == g) for g in set(group)}
    got = kept(spark, rows)
    where = {t: group[i] for i, (_, t) in enumerate(rows)}
    assert sorted((where[t], i) for i, t in got) == sorted(heads.items())


def test_stage_folders_go(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("a", lambda s, d, _: d.limit(5)), ("b", lambda s, d, _: d), ("c", lambda s, d, _: d.select("doc_id"))])
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() == 5
    folder = out.inputFiles()[0].rsplit("/", 2)[0].removeprefix("file:").replace("///", "/")
    import os
    assert sorted(os.listdir(folder)) == ["2-c"] and folder.startswith(ensure_checkpoint_dir(spark).removeprefix("file:").replace("///", "/"))

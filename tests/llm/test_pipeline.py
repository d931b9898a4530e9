"""The pipeline's stages by brute force over their own inputs, and the SQL oracles."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stepfold.llm import queries
from stepfold.llm.common import table
from tests.llm.test_operators import brute_fingerprint, brute_spans, check_pieces, components_of
from tests.oracle import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, duck_sf001, name):
    assert compare(spark, duck_sf001, name, queries.QUERIES[name], queries.ORACLE[name], SF) == []


def test_stages(spark):
    extra = [(10 ** 6, None, "en", "s", 0), (10 ** 6 + 1, "", "en", "s", 0), (10 ** 6 + 2, "12 34", None, None, None), (None, None, None, None, None)]
    docs = table(spark, SF, "documents")
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).unionByName(docs.where("doc_id < 3"))
    docs = docs.withColumn("selected", F.lit("x")).withColumn("_copy", F.lit(1)).cache()
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF).cache()
        assert after.columns == docs.columns
        a, b = before.collect(), after.collect()
        if name == "language":
            assert {r["doc_id"] for r in a} - {r["doc_id"] for r in b} >= {10 ** 6, 10 ** 6 + 1, 10 ** 6 + 2, None}
            assert len(b) >= 0.99 * (len(a) - 4)
        elif name == "quality":
            kept = {r["doc_id"] for r in b}
            good = [r["doc_id"] for r in a if labels.get(r["doc_id"]) == 1]
            assert sum(i in kept for i in good) >= 0.98 * len(good)
        elif name == "near_duplicates":
            rows = sorted(a, key=lambda r: r["doc_id"])
            fps = [brute_fingerprint(r["text"]) for r in rows]
            links = [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 4]
            roots = components_of(len(rows), links)
            assert sorted(r["doc_id"] for r in b) == sorted({rows[i]["doc_id"] for i in roots})
        elif name == "personal_data":
            texts = {r["doc_id"]: r["text"] for r in a}
            assert len(a) == len(b)
            for r in b:
                spans = brute_spans(texts[r["doc_id"]])
                assert not any(texts[r["doc_id"]][s:e] in r["text"] for k in spans for s, e in spans[k])
                assert r["n_chars"] == len(r["text"])
                if not any(spans.values()) and not re.search(r"[=:]|[A-Z0-9]{16}", texts[r["doc_id"]]):
                    assert r["text"] == texts[r["doc_id"]]
        before = after
    rows = before.select("doc_id", "text").orderBy("doc_id").collect()
    place = {r["doc_id"]: i for i, r in enumerate(rows)}
    pieces = [r.asDict() | {"id": place[r["doc_id"]]} for r in corpus_pipeline.STAGES[-1][1](spark, before, SF).collect()]
    padding, n = check_pieces(pieces, [r["text"] for r in rows], 1024)
    assert padding < 0.05 * 1024 * n

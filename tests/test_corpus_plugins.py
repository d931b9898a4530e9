"""Splitter and tokenizer plug-ins, and a corpus of both levels written at once and read merged."""

import re
import zlib

from pyspark.sql import functions as F

from stepfold.operators import corpus as C
from stepfold.sinks import reports as R

TEXTS = ["One two. Three!", "", None, "no end", "a\nb\n\nc", "x. " * 500]


def docs(spark):
    return spark.createDataFrame([(i, t, i % 3) for i, t in enumerate(TEXTS)], "doc_id long, text string, shard int")


def by_line(texts):
    return [[s for s in t.split("\n") if s] for t in texts]


def ids(texts):
    return [[zlib.crc32(w.encode()) % 100 for w in re.findall(r"\w+", t)] for t in texts]


def test_splitter_plug_in(spark):
    got = {r["doc_id"]: r["sentences"] for r in C.split_sentences(docs(spark), splitter=by_line).collect()}
    assert got == {i: [] if t is None else by_line([t])[0] for i, t in enumerate(TEXTS)}
    whole = C.split_sentences(docs(spark), split=False, splitter=by_line).where("doc_id = 4").first()
    assert whole["sentences"] == [TEXTS[4]]
    encoded = C.encode_documents(C.split_sentences(docs(spark), splitter=by_line)).where("doc_id = 4").first()
    assert len(encoded["sentence_lens"]) == 3


def test_tokenizer_plug_in(spark):
    got = {r["doc_id"]: r["tokens"] for r in C.tokenize_with(docs(spark), ids).collect()}
    assert got == {i: ids([t or ""])[0] for i, t in enumerate(TEXTS)}


def test_both_levels_in_one_write(spark, tmp_path):
    base = docs(spark).withColumn("key", F.lit("text"))
    levels = {level: C.encode_documents(C.split_sentences(base, split=level == "sentence")).select("key", "shard", "doc_id", "tokens", "sentence_lens", "n_tokens")
              for level in ("document", "sentence")}
    path = str(tmp_path / "corpus")
    R.write_token_corpora(levels, path)
    for level, encoded in levels.items():
        want = sorted((r["shard"], r["doc_id"], r["tokens"], r["sentence_lens"], r["n_tokens"]) for r in encoded.collect())
        rows = R.read_token_corpus(spark, path, "text", level).orderBy("doc_index").collect()
        assert [(r["shard"], r["doc_id"], r["tokens"], r["sentence_lens"], r["n_tokens"]) for r in rows] == want
        assert [r["doc_index"] for r in rows] == list(range(len(TEXTS)))
        assert [r["token_offset"] for r in rows] == [sum(len(x[2]) for x in want[:i]) for i in range(len(want))]
        assert [r["sentence_offset"] for r in rows] == [sum(len(x[3]) for x in want[:i]) for i in range(len(want))]
    assert R.read_token_corpus(spark, path, "other", "document").count() == 0
    plan = R.read_token_corpus(spark, path, "text", "sentence")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(key" in plan

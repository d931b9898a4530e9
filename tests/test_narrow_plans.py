"""What windows and joins move: no texts, tokens or length arrays."""

import re

from stepfold.operators import checkpoint as CK
from stepfold.operators import corpus as C
from stepfold.operators.common import written
from stepfold.plans import q_corpus


def scanned(df) -> set[str]:
    """Columns that the plan which ran takes from written rows."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {c.split("#")[0] for cols in re.findall(r"Scan ExistingRDD\[([^\]]*)\]", plan) for c in cols.split(",")}


def test_corpus_windows_move_numbers_only(spark):
    docs = written(q_corpus.v_docs(spark, "/root/testdata/sf0.001"))
    encoded = written(C.encode_documents(C.split_sentences(docs)))
    sizes = C.document_sizes(encoded)
    assert sizes.columns == ["doc_id", "n_sentences", "n_tokens"]
    sharded = C.partition_documents(sizes, 4).withColumnRenamed("shard_rr", "shard")
    for df in (C.corpus_stats(docs, 4, 10), C.merge_shards(sharded, "shard"), C.shard_totals(sharded, "shard")):
        found = scanned(df)
        assert found and not found & {"text", "tokens", "sentences", "sentence_lens"}


def test_rank_logs_read_two_ranks_only(spark):
    lines = spark.createDataFrame([(run, f"run_{run}/rank-{r}/info.log", i, f"[20240101 00:00:0{i}][u][x.py:{i}]: message {i} of {r}") for run in (1, 2) for r in range(4 + run) for i in range(3)],
                                  "run int, path string, line_no long, line string")
    got = sorted((r["run"], r["msg"]) for r in CK.read_rank_logs(lines).collect())
    assert got == sorted((run, f"message {i} of {r}") for run in (1, 2) for r in (0, 3 + run) for i in range(3))

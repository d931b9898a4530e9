"""Registered queries and oracles of the corpus jobs (``documents`` and ``pages``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepfold.operators import corpus as C
from stepfold.plans.finalize import rounded
from stepfold.plans.tables import table

QUERIES = {}
ORACLE = {}

VOCAB, SEQ_LEN, N_SHARDS, SEED = 32000, 128, 8, 42
PAGE_BASE = 1000000000


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def v_docs(spark, sf_dir):
    """(doc_id, key, text): documents under key 'text', pages under key 'html'."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.lit("text").alias("key"), F.col("text"))
    p = table(spark, sf_dir, "pages").select((F.col("page_id") + PAGE_BASE).alias("doc_id"),
                                             F.lit("html").alias("key"), F.col("html").alias("text"))
    return d.unionByName(p)


def length_id(w):
    """Tested token id: arithmetic on the token length (DuckDB has no xxhash64 twin)."""
    return F.length(w) * 7919 + 13


def order_key(c="doc_id"):
    return (F.col(c) * 7919 + SEED) % 104729


def _encoded(spark, sf_dir):
    return C.encode_documents(C.split_sentences(v_docs(spark, sf_dir)), VOCAB, key_fn=length_id)


def _samples(spark, sf_dir):
    return C.fixed_length_samples(_encoded(spark, sf_dir), SEQ_LEN, order_key())


# typed out on their own, so that a wrong pattern of the implementation shows
SENT = r"[^\s][^.!?]*(?:[.!?]+[^\s.!?][^.!?]*)*[.!?]*"
TOK = r"[A-Za-z0-9_]+|[^A-Za-z0-9_\s]"
DOCS = f"""docs AS (
  SELECT doc_id, 'text' AS key, text FROM documents
  UNION ALL SELECT page_id + {PAGE_BASE}, 'html', html FROM pages),
enc AS (
  SELECT doc_id, key, text, regexp_extract_all(text, '{SENT}') AS sents,
         list_transform(regexp_extract_all(text, '{TOK}'), lambda w: CAST(1 + (length(w) * 7919 + 13) % {VOCAB - 1} AS BIGINT)) AS ids
  FROM docs),
encd AS (
  SELECT doc_id, key, text, sents, CASE WHEN len(ids) > 0 THEN list_append(ids, 0) ELSE ids END AS toks FROM enc)"""


@register("split_sentences", f"""WITH {DOCS}
SELECT doc_id, key, CAST(len(sents) AS INTEGER) AS n_sentences,
       CAST(coalesce(list_sum(list_transform(sents, lambda s: length(s))), 0) AS BIGINT) AS sentence_chars,
       CAST(length(sents[1]) AS INTEGER) AS first_len, CAST(length(sents[-1]) AS INTEGER) AS last_len
FROM encd""")
def q_split_sentences(spark, sf_dir):
    s = C.split_sentences(v_docs(spark, sf_dir))
    return s.select("doc_id", "key", F.size("sentences").alias("n_sentences"),
                    F.aggregate("sentences", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("sentence_chars"),
                    F.length(F.try_element_at("sentences", F.lit(1))).alias("first_len"),
                    F.length(F.try_element_at("sentences", F.lit(-1))).alias("last_len"))


@register("encode_documents", f"""WITH {DOCS}
SELECT doc_id, key, CAST(len(toks) AS BIGINT) AS n_tokens, CAST(len(sents) AS INTEGER) AS n_sentences,
       CAST(coalesce(list_sum(toks), 0) AS BIGINT) AS token_sum
FROM encd""")
def q_encode_documents(spark, sf_dir):
    e = _encoded(spark, sf_dir)
    return e.select("doc_id", "key", "n_tokens", F.size("sentence_lens").alias("n_sentences"),
                    F.aggregate("tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("token_sum"))


@register("partition_documents", f"""WITH {DOCS}, ix AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM docs)
SELECT doc_id, idx, CAST(idx % {N_SHARDS} AS INTEGER) AS shard_rr,
       CAST(floor(idx / ceil((SELECT count(*) FROM docs) / {N_SHARDS})) AS INTEGER) AS shard_seq
FROM ix""")
def q_partition_documents(spark, sf_dir):
    return C.partition_documents(v_docs(spark, sf_dir).select("doc_id"), N_SHARDS) \
        .select("doc_id", "idx", "shard_rr", "shard_seq")


@register("corpus_stats", f"""WITH {DOCS}, ix AS (
  SELECT doc_id, text, CAST((row_number() OVER (ORDER BY doc_id) - 1) % {N_SHARDS} AS INTEGER) AS shard FROM docs),
b AS (SELECT shard, (row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1) // 50 AS bucket, text FROM ix),
g AS (SELECT shard, CAST(bucket AS BIGINT) AS bucket, count(*) AS docs, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes FROM b GROUP BY ALL)
SELECT shard, bucket, docs, bytes,
       CAST(sum(docs) OVER (PARTITION BY shard ORDER BY bucket) AS BIGINT) AS cum_docs,
       round(sum(bytes) OVER (PARTITION BY shard ORDER BY bucket) / 1048576.0, 8) AS cum_mb
FROM g""")
def q_corpus_stats(spark, sf_dir):
    return C.corpus_stats(v_docs(spark, sf_dir), N_SHARDS, 50)


@register("merge_shards", f"""WITH {DOCS}, ix AS (
  SELECT *, CAST((row_number() OVER (ORDER BY doc_id) - 1) % {N_SHARDS} AS INTEGER) AS shard FROM encd)
SELECT doc_id, shard, row_number() OVER (ORDER BY shard, doc_id) - 1 AS doc_index,
       CAST(coalesce(sum(len(sents)) OVER w, 0) AS BIGINT) AS sentence_offset,
       CAST(coalesce(sum(len(toks)) OVER w, 0) AS BIGINT) AS token_offset
FROM ix WINDOW w AS (ORDER BY shard, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def q_merge_shards(spark, sf_dir):
    sh = C.partition_documents(C.document_sizes(_encoded(spark, sf_dir)), N_SHARDS).withColumnRenamed("shard_rr", "shard")
    return C.merge_shards(sh, "shard").select("doc_id", "shard", "doc_index", "sentence_offset", "token_offset")


@register("shard_totals", f"""WITH {DOCS}, ix AS (
  SELECT *, CAST((row_number() OVER (ORDER BY doc_id) - 1) % {N_SHARDS} AS INTEGER) AS shard FROM encd),
p AS (SELECT shard, count(*) AS docs, CAST(sum(len(sents)) AS BIGINT) AS sentences, CAST(sum(len(toks)) AS BIGINT) AS tokens
      FROM ix GROUP BY shard)
SELECT shard, docs, sentences, tokens,
       CAST(coalesce(sum(docs) OVER w, 0) AS BIGINT) AS docs_offset,
       CAST(coalesce(sum(sentences) OVER w, 0) AS BIGINT) AS sentences_offset,
       CAST(coalesce(sum(tokens) OVER w, 0) AS BIGINT) AS tokens_offset
FROM p WINDOW w AS (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def q_shard_totals(spark, sf_dir):
    sh = C.partition_documents(C.document_sizes(_encoded(spark, sf_dir)), N_SHARDS).withColumnRenamed("shard_rr", "shard")
    return C.shard_totals(sh, "shard").select("shard", "docs", F.col("sentences").cast("long").alias("sentences"),
                                              "tokens", "docs_offset", "sentences_offset", "tokens_offset")


@register("train_valid_split", f"""WITH {DOCS}
SELECT doc_id, CASE WHEN ((doc_id * 7919 + {SEED}) % 104729) % 104729 < 0.05 * 104729 THEN 'valid' ELSE 'train' END AS split
FROM docs""")
def q_train_valid_split(spark, sf_dir):
    return C.hash_split(v_docs(spark, sf_dir), valid_fraction=0.05, key=order_key()).select("doc_id", "split")


@register("ratio_split", f"""WITH {DOCS}, ix AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM docs),
n AS (SELECT count(*) AS n FROM docs)
SELECT doc_id, idx, CASE WHEN idx < round(n * 0.98) THEN 'train' WHEN idx < round(n * 0.99) THEN 'valid' ELSE 'test' END AS split
FROM ix, n""")
def q_ratio_split(spark, sf_dir):
    return C.ratio_split(v_docs(spark, sf_dir).select("doc_id"), "98,1,1").select("doc_id", "idx", "split")


@register("blend_sources", f"""WITH {DOCS}, j AS (
  SELECT doc_id, key, row_number() OVER (PARTITION BY key ORDER BY doc_id) - 1 AS j FROM docs),
k AS (SELECT *, (j + 0.5) / CASE key WHEN 'text' THEN 0.7 ELSE 0.3 END AS blend_key FROM j)
SELECT doc_id, key, j, round(blend_key, 8) AS blend_key, row_number() OVER (ORDER BY blend_key, key) - 1 AS position FROM k""")
def q_blend_sources(spark, sf_dir):
    b = C.blend_sources(v_docs(spark, sf_dir).select("doc_id", "key"), {"text": 0.7, "html": 0.3}, source="key")
    return b.select("doc_id", "key", "j", "blend_key", "position")


SAMPLES = DOCS + f""",
od AS (SELECT doc_id, toks, len(toks) AS n FROM encd WHERE len(toks) > 0),
off AS (SELECT *, coalesce(sum(n) OVER (ORDER BY (doc_id * 7919 + {SEED}) % 104729, doc_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM od),
tk AS (SELECT doc_id, o + generate_subscripts(toks, 1) - 1 AS g, unnest(toks) AS t FROM off),
total AS (SELECT sum(n) AS total FROM od),
st AS (SELECT g // {SEQ_LEN} AS sample_id, g, doc_id, t FROM tk
       UNION ALL SELECT g // {SEQ_LEN} - 1, g, doc_id, t FROM tk WHERE g % {SEQ_LEN} = 0 AND g > 0),
sv AS (SELECT st.* FROM st, total WHERE (sample_id + 1) * {SEQ_LEN} + 1 <= total)"""


@register("fixed_length_samples", f"""WITH {SAMPLES}
SELECT CAST(sample_id AS BIGINT) AS sample_id, count(*) AS n_tokens, CAST(sum(t) AS BIGINT) AS token_sum,
       count(DISTINCT doc_id) AS n_docs
FROM sv GROUP BY sample_id""")
def q_fixed_length_samples(spark, sf_dir):
    s = _samples(spark, sf_dir)
    return s.select("sample_id", F.size("tokens").cast("long").alias("n_tokens"),
                    F.aggregate("tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("token_sum"),
                    F.size(F.array_distinct("doc_ids")).cast("long").alias("n_docs"))


@register("sample_masks", f"""WITH {SAMPLES}, r AS (
  SELECT sample_id, g - sample_id * {SEQ_LEN} AS i, t FROM sv),
m AS (SELECT sample_id, i, t,
             coalesce(max(CASE WHEN t = 0 THEN i END) OVER w, -1) AS last_eod,
             coalesce(sum(CASE WHEN t = 0 THEN 1 ELSE 0 END) OVER w, 0) AS seg
      FROM r WINDOW w AS (PARTITION BY sample_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT CAST(sample_id AS BIGINT) AS sample_id, CAST(sum(CASE WHEN t = 0 THEN 0 ELSE 1 END) AS BIGINT) AS n_loss,
       CAST(max(i - last_eod - 1) AS BIGINT) AS max_position, CAST(max(seg) AS BIGINT) AS max_segment
FROM m GROUP BY sample_id""")
def q_sample_masks(spark, sf_dir):
    m = C.sample_masks(_samples(spark, sf_dir))
    total = F.aggregate("loss_mask", F.lit(0), lambda a, x: a + x)
    return m.select("sample_id", total.cast("long").alias("n_loss"),
                    F.array_max("position_ids").cast("long").alias("max_position"),
                    F.array_max("segment_ids").cast("long").alias("max_segment"))


SHARD_FMT = "c4-train.%05d-of-01024.json.gz"


def v_shard_listing(spark, sf_dir):
    d = v_docs(spark, sf_dir).select((F.col("doc_id") % 40).alias("s")).distinct()
    return d.filter(~F.col("s").isin(5, 17, 33)).select(F.format_string(SHARD_FMT, "s").alias("name"))


@register("shard_completeness", """WITH docs AS (SELECT doc_id FROM documents UNION ALL SELECT page_id + 1000000000 FROM pages),
have AS (SELECT DISTINCT doc_id % 40 AS s FROM docs WHERE doc_id % 40 NOT IN (5, 17, 33))
SELECT printf('c4-train.%05d-of-01024.json.gz', r) AS name FROM range(40) t(r) WHERE r NOT IN (SELECT s FROM have)""")
def q_shard_completeness(spark, sf_dir):
    return C.shard_completeness(v_shard_listing(spark, sf_dir), 40, SHARD_FMT)


@register("corpus_count", f"""WITH {DOCS}
SELECT CAST(doc_id % {N_SHARDS} AS INTEGER) AS shard, count(*) AS documents FROM docs GROUP BY ROLLUP (doc_id % {N_SHARDS})""")
def q_corpus_count(spark, sf_dir):
    d = v_docs(spark, sf_dir).select((F.col("doc_id") % N_SHARDS).cast("int").alias("shard"))
    return d.rollup("shard").agg(F.count(F.lit(1)).alias("documents"))


@register("slice_sequences", f"""WITH {SAMPLES}, r AS (
  SELECT sample_id, g - sample_id * {SEQ_LEN} AS i, t FROM sv WHERE g - sample_id * {SEQ_LEN} < {SEQ_LEN})
SELECT CAST(sample_id AS BIGINT) AS sample_id, CAST(i // {SEQ_LEN // 4} AS INTEGER) AS part, count(*) AS n,
       CAST(sum(t) AS BIGINT) AS token_sum
FROM r GROUP BY ALL""")
def q_slice_sequences(spark, sf_dir):
    s = _samples(spark, sf_dir).withColumn("tokens", F.slice("tokens", 1, SEQ_LEN))
    sl = C.slice_sequences(s, 4)
    return sl.select("sample_id", F.col("part").cast("int").alias("part"), F.size("piece").cast("long").alias("n"),
                     F.aggregate("piece", F.lit(0).cast("long"), lambda a, x: a + x).alias("token_sum"))

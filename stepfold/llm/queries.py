"""Registered queries of the training-data operators and their DuckDB oracles
(operators that SQL can't express have none; tests/llm checks them by brute force)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepfold.llm import (bpe, divergence, langid, neardup_vectors, packing, pii, quality, resample, sharding, simhash, slackpacking, topk,
                          urlfilter)
from stepfold.llm.common import checkpointed, table

SEQUENCE, END_ID = 1024, 0
COSINE = 0.9
QUERY_EVERY, TOP = 50, 5
SHARD_BYTES = 1 << 20
SIMHASH_WORDS, SIMHASH_RADIUS = 4, 4
LEAST_DOCS, TOP_TERMS = 30, 50
NGRAM_WORDS, BUCKETS, SEED, LEAST_WORDS, DRAWN_PERCENT = (1, 1), 10_000, 2024, 20, 10
LONG_SEQUENCE = 2048
# host, path, verdict
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), "doc_id", "text", path, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


def label_grades(labels: DataFrame) -> DataFrame:
    """(doc_id, grade, toxic) of each labelled id, grades 0 poor, 1 fair but toxic, 2 good. Contradicting labels of one document count as the worse."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2))
    return labels.select("doc_id", grade.alias("grade"), "toxic").groupBy("doc_id").agg(F.min("grade").alias("grade"), F.max("toxic").alias("toxic"))


def graded(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with their grade and label ``toxic``."""
    return docs.select("doc_id", "text").join(label_grades(labels), "doc_id")


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.OrdinalModel | None:
    return quality.train_with_marks(docs, "doc_id", "text", label_grades(labels).withColumnRenamed("doc_id", "id"))


def selected(docs: DataFrame, labels: DataFrame, carry: list[str], names: tuple[str, str, str] = ("expected_grade", "tail", "selected")) -> DataFrame:
    """Expected grade, tail at the model's cut and whether it reaches the model's least, for all documents."""
    model = quality_model(docs, labels)
    return quality.score(docs, "text", model, model.cut if model else 1, model.least if model else 0.0, carry, names)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selected(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])


def op3_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup_vectors.near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", COSINE)
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.transform("embedding", lambda x: F.floor(F.lit(256) * x.cast("double")))
    rows = table(spark, sf_dir, "embeddings").withColumn("whole", F.when(topk.finite("embedding"), whole))
    found = topk.search(rows, "vec_id", F.col("whole"), F.col("vec_id") % QUERY_EVERY == 0, TOP)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def packed(docs: DataFrame) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(docs, "doc_id", "text", path, public_tokenizers.PATTERN, SEQUENCE, END_ID, added=True).withColumnRenamed("id", "doc_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs, "doc_id", F.octet_length("text"), SHARD_BYTES).select("doc_id", "bytes", "depth", "prefix", "page")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", SIMHASH_WORDS, SIMHASH_RADIUS)
    return found.select(F.col("id").alias("doc_id"), simhash.hex_digits("fp").alias("fingerprint"), F.col("component").alias("component_id"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = checkpointed(pii.candidates(docs, "text").drop("text"))  # the texts are searched once
    found = pii.with_added(found, pii.train_on(found))
    base = {k: f"base_{k}" for k in pii.BASE}
    return found.select("doc_id", *[F.size(c).cast("long").alias(f"n_{k}") for k, c in base.items()],
                        F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined({**base, pii.ADDED: "added"}).alias("spans"))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def language_filters(docs: DataFrame) -> langid.Filters:
    """Learned from the documents that aren't held out."""
    return langid.learn(docs.where(~held_out()), "doc_id", "text", "lang")


def language_least_scores(docs: DataFrame, filters: langid.Filters) -> dict[str, float]:
    return langid.least_scores(docs.where(~held_out()), "text", "lang", filters)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, "text", language_filters(docs), ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlfilter.judge(table(spark, sf_dir, "pages"), "page_id", "url", rules).withColumnRenamed("id", "page_id")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), "text", "lang", "source", LEAST_DOCS, TOP_TERMS)


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.resample(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "text", *NGRAM_WORDS,
                              BUCKETS, SEED, LEAST_WORDS, DRAWN_PERCENT)
    return found.withColumnRenamed("id", "doc_id")


def op13_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return slackpacking.pack(table(spark, sf_dir, "documents"), "doc_id", "text", path, LONG_SEQUENCE, END_ID).withColumnRenamed("id", "doc_id")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_bpe, op2_quality, op3_near_vectors, op4_top_k, op5_packing, op6_sharding, op7_simhash, op8_pii,
                                   op9_language, op10_urls, op11_divergence, op12_resample, op13_slack_packing, pipeline)}

_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS_SQL = f"regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE = {
    "op3_near_vectors": f"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a), c AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(c.m, vec_id)) AS component_id,
  coalesce(vec_id = least(vec_id, coalesce(c.m, vec_id)), false) AS kept
FROM embeddings LEFT JOIN n ON vec_id = n.a LEFT JOIN c ON vec_id = c.a""",
    "op4_top_k": f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
    , q.e AS e FROM (SELECT DISTINCT vec_id, e FROM v WHERE vec_id % {QUERY_EVERY} = 0) q
    JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id, e ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {TOP}""",
    "op6_sharding": f"""
WITH h AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS bytes,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash FROM documents),
d AS (SELECT unnest(range(0, 41))::INTEGER AS depth),
sizes AS (SELECT depth, hash >> (60 - depth) AS prefix, sum(bytes) AS total FROM h, d GROUP BY 1, 2),
leaf AS (SELECT h.doc_id, h.bytes, h.hash, min(s.depth) AS depth FROM h JOIN sizes s ON s.prefix = h.hash >> (60 - s.depth)
  WHERE s.total <= {SHARD_BYTES} GROUP BY ALL)
SELECT doc_id, bytes, depth, hash >> (60 - depth) AS prefix, 0::BIGINT AS page FROM leaf""",
    "op10_urls": f"""
WITH p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
rules(rh, rp, v) AS (VALUES {_RULES_SQL}),
f AS (SELECT page_id, host, path, rh || rp AS rule, v,
    row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rh) + length(rp) DESC, length(rh) DESC) AS n
  FROM (SELECT DISTINCT page_id, host, path FROM u) JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.v, 'allow') AS verdict
FROM u LEFT JOIN f ON f.n = 1 AND f.page_id IS NOT DISTINCT FROM u.page_id AND f.host = u.host AND f.path = u.path""",
    "op11_divergence": f"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS i, {_LOWERED} AS t FROM documents),
w AS (SELECT lang, source, i, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
vocabulary AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= {LEAST_DOCS}),
own AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term),
c AS (SELECT g.lang, g.source, v.term, coalesce(own.n, 0) AS n, v.total FROM (SELECT DISTINCT lang, source FROM d) g
  JOIN vocabulary v ON v.lang = g.lang LEFT JOIN own ON own.lang = g.lang AND own.source = g.source AND own.term = v.term),
s AS (SELECT *, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER g + 5 * count(*) OVER g) AS p,
    1 + (1000000000::HUGEINT * (total + 5)) // (sum(total) OVER g + 5 * count(*) OVER g) AS q FROM c WINDOW g AS (PARTITION BY lang, source)),
pair AS (SELECT a.lang, a.source, b.source AS item, sum(abs(x.p - y.p)) AS value FROM (SELECT DISTINCT lang, source FROM d) a
  JOIN (SELECT DISTINCT lang, source FROM d) b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s x ON x.lang = a.lang AND x.source = a.source LEFT JOIN s y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source),
r AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0)::BIGINT AS value FROM pair
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM s WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r
QUALIFY part = 'pair' OR rank <= {TOP_TERMS}""",
    "op12_resample": f"""
WITH crc_step AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM (SELECT unnest(range(256)) AS i))),
d AS (SELECT doc_id, row_number() OVER () AS i, {_WORDS_SQL} AS words FROM documents),
b AS (SELECT {_WORDS_SQL} AS words FROM benchmark),
f AS (SELECT i, unnest(words) AS word FROM d), g AS (SELECT unnest(words) AS word FROM b),
h AS (SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(word))),
    lambda k: ('0x' || substr(hex(encode(word)), 2 * k + 1, 2))::BIGINT)),
    lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]))) % {BUCKETS} AS bucket
  FROM (SELECT word FROM f UNION SELECT word FROM g), crc_step),
s AS (SELECT bucket, count(*) AS s FROM f JOIN h USING (word) GROUP BY bucket), t AS (SELECT bucket, count(*) AS t FROM g JOIN h USING (word) GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM f) + {BUCKETS})
    / ((s + 1)::DOUBLE * ((SELECT count(*) FROM g) + {BUCKETS}))))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
w AS (SELECT i, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM f JOIN h USING (word) JOIN gain USING (bucket) GROUP BY i),
r AS (SELECT d.i, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
    (('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN w USING (i)),
k AS (SELECT i, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM r WHERE n_features >= {LEAST_WORDS}
  QUALIFY rank <= {DRAWN_PERCENT} * count(*) OVER () // 100)
SELECT doc_id, n_features, weight, score, rank FROM r LEFT JOIN k USING (i)""",
}

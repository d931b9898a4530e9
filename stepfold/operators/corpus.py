"""Corpus preparation (CRP1-13): documents -> sentences -> tokens -> shards,
splits, blends and fixed-length samples with masks.

Whole texts are processed (no chunking, no prefixes). Every global order
(shards, splits, blends, sample packing) is built with range partitioning and
prefix sums over small per-partition tables, never with a window without a
partition key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepfold.operators.common import exclusive_prefix_sum, global_index, global_prefix_sum, global_running, written

# Fixed rules of the default splitter and tokenizer (ours; the trained
# sentence model and subword vocabularies are external artefacts).
# A sentence runs from a non-space character to a run of [.!?] that is
# followed by whitespace or the end of the text.
SENTENCE = r"[^\s][^.!?]*(?:[.!?]+[^\s.!?][^.!?]*)*[.!?]*"
TOKEN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_\s]"
EOD = 0


def split_sentences(docs: DataFrame, text: str = "text", split: bool = True,
                    splitter: Callable[[list[str]], list[list[str]]] | None = None) -> DataFrame:
    """CRP1: ``sentences`` array per document (whole text; one sentence when
    splitting is off). ``splitter`` takes the place of the rule: it gets the texts of an Arrow
    batch and gives the sentences of each; a null text has none either way."""
    t = F.col(text)
    if split and splitter:
        def run(texts: pd.Series) -> pd.Series:
            return pd.Series(splitter(texts.fillna("").tolist()))
        sents = F.pandas_udf(run, "array<string>")(t)
    else:
        sents = F.regexp_extract_all(t, F.lit(SENTENCE), 0) if split else F.array(t)
    return docs.withColumn("sentences", F.when(t.isNull(), F.array().cast("array<string>")).otherwise(sents))


def default_token_ids(tokens: Column, vocab_size: int, key_fn=None) -> Column:
    """Token strings -> ids in [1, vocab). Default id = 1 + pmod(xxhash64(tok), vocab-1);
    ``key_fn`` replaces the hash (tested query: length-based arithmetic)."""
    if key_fn is None:
        return F.transform(tokens, lambda w: (1 + F.pmod(F.xxhash64(w), F.lit(vocab_size - 1))).cast("int"))
    return F.transform(tokens, lambda w: (1 + F.pmod(key_fn(w), F.lit(vocab_size - 1))).cast("int"))


def encode_documents(docs: DataFrame, vocab_size: int = 32000, append_eod: bool = True,
                     key_fn=None) -> DataFrame:
    """CRP2: tokens of all sentences concatenated; ``sentence_lens`` for the
    non-empty sentences only; with ``append_eod`` a non-empty document gets
    the EOD id and its last length + 1; an empty document stays empty."""
    per_sent = F.transform("sentences", lambda s: default_token_ids(
        F.regexp_extract_all(s, F.lit(TOKEN), 0), vocab_size, key_fn))
    # each step is a column of its own, so the tokens are found once
    df = docs.withColumn("_kept", F.filter(per_sent, lambda a: F.size(a) > 0))
    df = df.withColumn("_lens", F.transform("_kept", lambda a: F.size(a)))
    n = F.size("_lens")
    eod = F.lit(append_eod) & (n > 0)
    lens = F.when(eod, F.transform("_lens", lambda v, i: F.when(i == n - 1, v + 1).otherwise(v))).otherwise(F.col("_lens"))
    total = F.aggregate("_lens", F.lit(0).cast("long"), lambda a, v: a + v)
    return df.withColumn("n_tokens", total + F.when(eod, 1).otherwise(0)).withColumn("sentence_lens", lens).withColumn(
        "tokens", F.concat(F.flatten("_kept"), F.when(eod, F.array(F.lit(EOD))).otherwise(F.array().cast("array<int>")))) \
        .drop("_kept", "_lens")


def tokenize_with(docs: DataFrame, encode_batch: Callable[[list[str]], list[list[int]]], text: str = "text") -> DataFrame:
    """Plug-in point for subword tokenizers: ``encode_batch`` gets the texts of an
    Arrow batch and gives the ids of each, as column ``tokens``; a null text is
    empty. A tokenizer that is built on first use in the callable is built once per Python worker."""
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(encode_batch(texts.fillna("").tolist()))
    return docs.withColumn("tokens", F.pandas_udf(run, "array<int>")(F.col(text)))


def partition_documents(docs: DataFrame, n: int, order: Sequence[str] = ("doc_id",)) -> DataFrame:
    """CRP3: shard of every document for n shards, round-robin (idx mod n) and
    sequential blocks of ceil(total / n)."""
    idx = global_index(docs, list(order), out="idx")
    total = docs.agg(F.count(F.lit(1)).alias("_total"))
    block = F.ceil(F.col("_total") / n)
    return idx.crossJoin(F.broadcast(total)).withColumn("shard_rr", F.pmod("idx", F.lit(n)).cast("int")) \
        .withColumn("shard_seq", F.floor(F.col("idx") / block).cast("int")).drop("_total")


def corpus_stats(docs: DataFrame, n: int, interval: int, text: str = "text", order: Sequence[str] = ("doc_id",)) -> DataFrame:
    """CRP4: documents and MB per round-robin shard at every ``interval``
    documents, with cumulative values. A document's place in its shard is
    ``idx div n``; only its order key and byte length leave the scan, and the
    running values of a shard go by ranges, not in one task."""
    sizes = written(docs.select(*order, F.octet_length(text).alias("_bytes")))
    indexed = global_index(sizes, list(order), out="idx")
    b = written(indexed.select(F.pmod("idx", F.lit(n)).cast("int").alias("shard"), F.expr(f"(idx div {n}) div {interval}").alias("bucket"), "_bytes")
                .groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("docs"), F.sum("_bytes").alias("bytes")))
    before = global_running(b, ["bucket"], ["shard"], {"_docs": F.sum("docs"), "_bytes": F.sum("bytes")})
    return before.select("shard", "bucket", "docs", "bytes", (F.col("_docs") + F.col("docs")).alias("cum_docs"),
                         ((F.col("_bytes") + F.col("bytes")) / 1048576.0).alias("cum_mb"))


def document_sizes(encoded: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(keep, n_sentences, n_tokens) of every document, written once: what merging needs of the corpus, without tokens or lengths."""
    return written(encoded.select(*keep, F.size("sentence_lens").cast("long").alias("n_sentences"), F.col("n_tokens").cast("long").alias("n_tokens")))


def merge_shards(sizes: DataFrame, shard: str, order: Sequence[str] = ("doc_id",)) -> DataFrame:
    """CRP5: shards concatenated in order; every document (``document_sizes`` with its shard) with its re-based
    document index and its first sentence and token in the merged corpus."""
    return global_running(sizes, [shard, *order], [], {
        "doc_index": F.count(F.lit(1)), "sentence_offset": F.sum("n_sentences"), "token_offset": F.sum("n_tokens")})


def shard_totals(sizes: DataFrame, shard: str) -> DataFrame:
    """CRP5: documents, sentences and tokens of each shard and their offsets in the merged corpus."""
    out = sizes.groupBy(shard).agg(F.count(F.lit(1)).alias("docs"), F.sum("n_sentences").alias("sentences"), F.sum("n_tokens").alias("tokens"))
    for c in ("docs", "sentences", "tokens"):
        out = exclusive_prefix_sum(out, [], [shard], c, f"{c}_offset")
    return out


def hash_split(docs: DataFrame, valid_fraction: float = 0.005, seed: int = 42, key: Column | None = None,
               buckets: int = 104729) -> DataFrame:
    """CRP6: seeded split, reproducible whatever the partitioning:
    valid iff pmod(key, buckets) < fraction * buckets; key defaults to xxhash64(seed, doc_id)."""
    k = key if key is not None else F.xxhash64(F.lit(seed), F.col("doc_id"))
    return docs.withColumn("split", F.when(F.pmod(k, F.lit(buckets)) < valid_fraction * buckets, "valid")
                           .otherwise("train"))


def ratio_split(docs: DataFrame, weights: str = "99,1,0", order: Sequence[str] = ("doc_id",)) -> DataFrame:
    """CRP7: "99,1,0" weights -> contiguous train/valid/test ranges of the
    global document order; boundaries round(cumulative share * n)."""
    w = [float(x) for x in weights.split(",")]
    while len(w) < 3:
        w.append(0.0)
    s = sum(w)
    cum = [sum(w[:i + 1]) / s for i in range(3)]
    idx = global_index(docs, list(order), out="idx")
    n = docs.agg(F.count(F.lit(1)).alias("_n"))
    b1 = F.round(F.col("_n") * cum[0])
    b2 = F.round(F.col("_n") * cum[1])
    return idx.crossJoin(F.broadcast(n)).withColumn(
        "split", F.when(F.col("idx") < b1, "train").when(F.col("idx") < b2, "valid").otherwise("test")).drop("_n")


def blend_sources(sources: DataFrame, weights: dict[str, float], source: str = "source",
                  order: Sequence[str] = ("doc_id",), size: int | None = None) -> DataFrame:
    """CRP8: weighted mix. Sample j of source s gets order key (j + 0.5) / w_s
    (weights normalised); the blend is the global order by (key, source),
    cut to ``size``. Every prefix follows the weights to within one sample."""
    tot = sum(weights.values())
    wmap = F.create_map(*[v for k, x in sorted(weights.items()) for v in (F.lit(k), F.lit(x / tot))])
    j = global_index(sources.filter(F.col(source).isin(list(weights))), list(order), out="j", group=[source])
    keyed = j.withColumn("blend_key", (F.col("j") + 0.5) / F.element_at(wmap, F.col(source)))
    pos = global_index(keyed, ["blend_key", source], out="position")
    return pos.filter(F.col("position") < size) if size is not None else pos


def fixed_length_samples(encoded: DataFrame, seq_len: int, order_key: Column, epoch: int = 0) -> DataFrame:
    """CRP9: documents in shuffled order (``order_key``) concatenated and cut
    every ``seq_len`` tokens; each sample has seq_len + 1 tokens (the label
    token overlaps the next sample). Only the overlap ranges are exploded;
    a sample's pieces are bounded by seq_len + 1 tokens.

    Output: (sample_id, tokens, doc_ids) with one doc id per token.
    """
    ids = [c for c in ("doc_id", "key") if c in encoded.columns]  # unique together
    # texts are tokenised once; offsets come from the lengths alone, and the tokens move once, to meet them
    docs = written(encoded.withColumn("epoch", F.lit(epoch)).withColumn("_ok", order_key).select(*ids, "_ok", "n_tokens", "tokens"))
    lengths = docs.select(*ids, "_ok", "n_tokens").filter(F.col("n_tokens") > 0)
    off = docs.select(*ids, "tokens").join(global_prefix_sum(lengths, ["_ok", *ids], "n_tokens", "offset"), ids)
    first = F.floor(F.greatest(F.col("offset") - 1, F.lit(0)) / seq_len).cast("long")
    last = F.floor((F.col("offset") + F.col("n_tokens") - 1) / seq_len).cast("long")

    def piece(sample):
        lo = F.greatest(sample * seq_len, F.col("offset"))
        hi = F.least(sample * seq_len + seq_len + 1, F.col("offset") + F.col("n_tokens"))
        tokens = F.slice("tokens", (lo - F.col("offset") + 1).cast("int"), F.greatest(hi - lo, F.lit(0)).cast("int"))
        return F.struct(sample.alias("sample_id"), lo.alias("start"), tokens.alias("piece"))

    # cut in the row: only pieces are exploded, never a document's whole token array
    pieces = off.select("doc_id", F.explode(F.transform(F.sequence(first, last), piece)).alias("z")) \
        .select("z.sample_id", "z.start", "z.piece", "doc_id").filter(F.size("piece") > 0)
    total = lengths.agg(F.sum("n_tokens").alias("_total"))
    # a sample exists when it has at least one label token (seq_len + 1 tokens overall)
    grouped = pieces.groupBy("sample_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "piece", "doc_id"))).alias("_p"))
    return grouped.crossJoin(F.broadcast(total)).filter(
        (F.col("sample_id") + 1) * seq_len + 1 <= F.col("_total")).select(
        "sample_id",
        F.flatten(F.transform("_p", lambda z: z["piece"])).alias("tokens"),
        F.flatten(F.transform("_p", lambda z: F.array_repeat(z["doc_id"], F.size(z["piece"])))).alias("doc_ids"))


def sample_masks(samples: DataFrame, eod: int = EOD) -> DataFrame:
    """CRP10: per sample, arrays over its tokens of the loss mask (0 at EOD),
    position ids restarting after each EOD, and segment (document) numbers.
    A sample is a bounded row, so nothing is shuffled."""
    df = samples.withColumn("_ends", F.filter(F.transform("tokens", lambda t, i: F.when(t == eod, i)),
                                              lambda i: i.isNotNull()))
    before = lambda i: F.filter("_ends", lambda e: e < i)
    return df.select(
        "sample_id", "tokens", F.transform("tokens", lambda t: (t != eod).cast("int")).alias("loss_mask"),
        F.transform("tokens", lambda t, i: i - F.coalesce(F.array_max(before(i)) + 1, F.lit(0))).alias("position_ids"),
        F.transform("tokens", lambda t, i: F.size(before(i))).alias("segment_ids"))


def shard_completeness(listing: DataFrame, n: int, fmt: str, name: str = "name") -> DataFrame:
    """CRP11: expected shard names 0..n-1 that are absent (left anti join)."""
    exp = listing.sparkSession.range(n).select(F.format_string(fmt, F.col("id")).alias(name))
    return exp.join(listing.select(name), name, "left_anti")


def slice_sequences(samples: DataFrame, n: int, tokens: str = "tokens") -> DataFrame:
    """CRP13: n equal contiguous slices of every sequence; error when the
    length is not divisible by n."""
    size = F.size(tokens)
    ok = F.when(size % n != 0, F.raise_error(F.lit(f"sequence length not divisible by {n}"))).otherwise(size / n)
    return samples.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("part")).withColumn(
        "piece", F.slice(tokens, (F.col("part") * ok + 1).cast("int"), ok.cast("int")))

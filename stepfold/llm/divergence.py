"""Source divergence audit by count-level bitmaps.

How far do the sources of a language differ in their words? Every group
(language, source) gives each kept term of its language the smoothed share
p = 1 + floor(10^9 (count + 5) / (N + 5 V)). As p depends on a term only by its
count, a group is described by one bitmap of term ids for each count that occurs
in it. For two groups the AND of two bitmaps and a popcount give the terms that
have count c here and count d there; that cell of the joint table is multiplied
by |p(c) - q(d)|. The bitmap of count 0 is the complement of the others.

Bitmaps are kept sparse, as words of 64 term ids. Ids go by falling frequency, so
that the terms of a word have few distinct counts; words are dealt in turn to
chunks, and sources to tiles of bounded size, and each (chunk, pair of tiles) is worked on its own.

Null languages, sources and texts are the empty string. A group without terms
counts like any other; a language with no kept term gives pairs of value 0; one with a
single source gives none. Repeated rows are documents of their own. Ill-formed bytes of a term become
U+FFFD. An empty table gives no row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stepfold.llm.common import checkpointed, raw_texts
from stepfold.operators.common import global_index

SCALE, SMOOTH = 10 ** 9, 5
MAX_HELD = 300_000  # counters a task keeps before it passes them on
WORD = 64  # term ids of a word
CHUNK_WORDS = 16  # words of a chunk
TILE_SOURCES = 64  # sources of a tile, on average

#: Terms are runs of ASCII letters and bytes beyond ASCII, with A-Z lowered; other bytes separate.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(df: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term. Every
    group that occurs also has a row whose term is null. Counted in each task before the shuffle."""
    def rows(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> pa.RecordBatch:
        langs, sources, terms, n, docs = [], [], [], [], []
        for (lang, source), (occurs, within) in held.items():
            size = len(occurs) + 1
            langs += [lang] * size
            sources += [source] * size
            terms += [None, *(t.decode("utf-8", "replace") for t in occurs)]
            n += [0, *occurs.values()]
            docs += [0, *map(within.__getitem__, occurs)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in ((langs, pa.string()), (sources, pa.string()), (terms, pa.string()), (n, pa.int64()), (docs, pa.int64()))],
            names=["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw_texts(batch.column(2))):
                words = text.translate(TERM_BYTES).split()
                occurs, within = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(occurs)
                occurs.update(words)
                within.update(set(words))
                size += len(occurs) - before
                if size >= MAX_HELD:
                    yield rows(held)
                    held, size = {}, 0
        yield rows(held)

    clean = df.select(F.coalesce(df[lang_col].cast("string"), F.lit("")).alias("lang"),
                      F.coalesce(df[source_col].cast("string"), F.lit("")).alias("source"), df[text_col].alias("text"))
    counts = clean.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, terms: str) -> Column:
    """p of a count; whole numbers of 38 digits, so exact for any corpus."""
    return F.expr(f"1 + (cast({SCALE} as decimal(38, 0)) * ({count} + {SMOOTH})) div ({total} + {SMOOTH} * {terms})")


def tile_values(lang: str, chunk: int, first: int, second: int, table: pa.Table) -> pa.Table:
    """Values of all pairs of sources of a pair of tiles over one chunk of term ids.

    Rows with a word of -1 name the sources with their p of count 0."""
    word = table["word"].to_numpy()
    source, tile = table["source"].to_pylist(), table["tile"].to_numpy()
    p, bits = table["p"].to_numpy(), table["bits"].to_numpy().view(np.uint64)
    marks = np.flatnonzero(word < 0)
    terms, chunks = table["terms"][int(marks[0])].as_py(), table["chunks"][int(marks[0])].as_py()
    marks = sorted(marks.tolist(), key=lambda i: (tile[i] != first, source[i]))
    names, zero = [source[i] for i in marks], p[marks]
    here, alone = int((tile[marks] == first).sum()), first == second
    place = {s: i for i, s in enumerate(names)}
    value = np.zeros((here, len(names)), np.int64)

    rows = np.flatnonzero(word >= 0)
    rows = rows[np.argsort(word[rows], kind="stable")]
    ends = np.flatnonzero(np.diff(word[rows], append=-1)) + 1
    empty = sum(min(WORD, terms - WORD * w) for w in range(chunk, -(-terms // WORD), chunks))  # terms of no source here
    for at in np.split(rows, ends[:-1]) if len(rows) else []:
        width = min(WORD, terms - WORD * int(word[at[0]]))
        empty -= width
        owner = np.array([place[source[i]] for i in at])
        order = np.argsort(owner, kind="stable")
        at, owner = at[order], owner[order]
        taken = np.zeros(len(names), np.uint64)
        np.bitwise_or.at(taken, owner, bits[at])
        absent = np.uint64((1 << width) - 1) & ~taken  # count 0: the complement of all other counts
        level = np.concatenate([bits[at], absent])
        share_of = np.concatenate([p[at], zero])
        owner = np.concatenate([owner, np.arange(len(names))])
        order = np.argsort(owner, kind="stable")
        level, share_of = level[order], share_of[order]
        starts = np.searchsorted(owner[order], np.arange(len(names) + 1))
        for a in range(here):
            b = a + 1 if alone else here  # pairs within a tile once, else all between the tiles
            if b == len(names):
                continue
            own, others = slice(starts[a], starts[a + 1]), slice(starts[b], None)
            cells = np.bitwise_count(level[own, None] & level[None, others]).astype(np.int64)
            cells *= np.abs(share_of[own, None] - share_of[None, others])
            value[a, b:] += np.add.reduceat(cells.sum(axis=0), starts[b:-1] - starts[b])
    value += empty * np.abs(zero[:here, None] - zero[None, :])
    a, b = np.triu_indices(here, 1) if alone else map(np.ravel, np.mgrid[:here, here:len(names)])
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array([names[i] for i in a], pa.string()),
                     "b": pa.array([names[i] for i in b], pa.string()), "value": pa.array(value[a, b])})


def audit(df: DataFrame, text_col: str, lang_col: str, source_col: str, least_docs: int, top: int) -> DataFrame:
    """(lang, source, part, item, value, rank). Part ``pair``: every other source of the language with the
    sum of |p - q| over all kept terms. Part ``term``: the ``top`` terms that the source uses more than its language does.
    Kept are the terms in at least ``least_docs`` documents of a language."""
    counts = checkpointed(term_counts(df, text_col, lang_col, source_col))
    vocabulary = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    vocabulary = checkpointed(vocabulary.where(F.col("docs") >= least_docs).select("lang", "term", "total", (-F.col("total")).alias("_order")))
    vocabulary = global_index(vocabulary, ["_order", "term"], "id", ["lang"]).drop("_order")
    kept = checkpointed(counts.join(vocabulary, ["lang", "term"]).select("lang", "source", "term", "n", "total", "id"))

    langs = kept.groupBy("lang").agg(F.countDistinct("id").alias("terms"), F.sum("n").alias("lang_total"))
    groups = (counts.where("term is null").select("lang", "source")
              .join(kept.groupBy("lang", "source").agg(F.sum("n").alias("group_total")), ["lang", "source"], "left").join(langs, "lang", "left")
              .fillna(0, ["group_total", "terms", "lang_total"]))
    tiles = groups.groupBy("lang").agg(F.ceil(F.count("*") / TILE_SOURCES).cast("int").alias("tiles"))
    groups = checkpointed(groups.join(tiles, "lang").select(
        "*", F.greatest(F.ceil(F.col("terms") / (WORD * CHUNK_WORDS)), F.lit(1)).alias("chunks"),
        F.expr("cast(pmod(xxhash64(source), tiles) as int)").alias("tile"),
        F.when(F.col("terms") > 0, share("0", "group_total", "terms")).otherwise(0).alias("zero")))

    shared = kept.join(groups, ["lang", "source"]).withColumn("p", share("n", "group_total", "terms"))
    places = ["lang", "source", "tile", "tiles", "terms", "chunks"]
    words = (shared.withColumn("word", F.expr(f"id div {WORD}")).groupBy(*places, "word", "n", "p")
             .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(id % {WORD} as int))")).alias("bits")).drop("n")
             .withColumn("chunk", F.col("word") % F.col("chunks")))
    marks = groups.select(*places, F.lit(-1).cast("long").alias("word"), F.col("zero").alias("p"), F.lit(0).cast("long").alias("bits"),
                          F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    dealt = words.unionByName(marks).withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    dealt = dealt.withColumns({"first": F.least("tile", "other"), "second": F.greatest("tile", "other")})

    def pairs(key: tuple, table: pa.Table) -> pa.Table:
        return tile_values(*(k.as_py() for k in key), table)

    sums = (dealt.groupBy("lang", "chunk", "first", "second").applyInArrow(pairs, "lang string, a string, b string, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pair = sums.select("lang", "value", both.alias("_")).select("lang", "_.source", F.lit("pair").alias("part"), "_.item", "value")
    term = (shared.withColumn("q", share("total", "lang_total", "terms")).where("p > q")
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = pair.withColumn("rank", F.row_number().over(order))
    term = term.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pair.unionByName(term)

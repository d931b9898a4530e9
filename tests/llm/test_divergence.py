"""Source divergence against a plain recount, over ties, empty groups, several chunks and several tiles."""

import collections
import random
import re

import pytest

from stepfold.llm import divergence, queries
from tests.oracle import duck

SCHEMA = "doc_id long, text string, lang string, source string, id long, term string, value string, `rank` int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        held = collections.Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = {t for t, n in held.items() if n >= least}
        groups = {s: collections.Counter() for _, s, _ in (d for d in docs if d[0] == lang)}
        whole = collections.Counter()
        for d in docs:
            if d[0] == lang:
                some = [t for t in d[2] if t in kept]
                groups[d[1]].update(some)
                whole.update(some)

        def share(counts):
            return {t: 1 + 10 ** 9 * (counts[t] + 5) // (sum(counts.values()) + 5 * len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in groups.items()}, share(whole)
        for s in groups:
            pair = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s]
            term = [(t, p[s][t] - q[t]) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                order = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(order)}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i % 3, *r, 1, "x", "y", 2) for i, r in enumerate(rows)], SCHEMA)


def got(df, least, top):
    rows = [tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in divergence.audit(df, "text", "lang", "source", least, top).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(n, words, sources, seed):
    rng = random.Random(seed)
    names = [f"wört{i}" if i % 5 else "".join(chr(97 + int(c)) for c in str(i)) for i in range(words)]
    text = lambda: " ".join(rng.choice(names[:1 + int(words * rng.random() ** 3)]) for _ in range(rng.randint(0, 60)))
    rows = [(text(), rng.choice(["en", "de", None]), "hot" if rng.random() < 0.4 else f"s{rng.randrange(sources)}") for _ in range(n)]
    extra = [(None, "en", "hot"), ("", "fr", "alone"), ("12 + 3", "it", None), (None, None, None), ("Mixed CASE ÄÖ xx" * 2, "en", "s1")]
    return rows + extra + [rows[0]] * 3 + [(" ".join(names * 20), "de", "long")]


@pytest.mark.parametrize("least,top", [(1, 3), (3, 50), (10 ** 6, 5)])
def test_against_a_recount(spark, least, top):
    rows = corpus(250, 120, 6, 1)
    assert got(frame(spark, rows), least, top) == brute(rows, least, top)


def test_several_chunks_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(divergence, "CHUNK_WORDS", 1)
    monkeypatch.setattr(divergence, "TILE_SOURCES", 3)
    monkeypatch.setattr(divergence, "MAX_HELD", 50)
    rows = corpus(200, 300, 12, 2)
    assert got(frame(spark, rows), 2, 4) == brute(rows, 2, 4)


def test_empty_table(spark):
    assert got(frame(spark, []), 1, 5) == set()


def test_shares_stay_exact_for_counts_beyond_a_long(spark):
    n, total = 9 * 10 ** 14, 10 ** 15 + 1
    row = spark.sql(f"select {n}L as n, {total}L as total, 7L as v").select(divergence.share("n", "total", "v").alias("p")).first()
    assert row["p"] == 1 + 10 ** 9 * (n + 5) // (total + 35)


def test_query_and_oracle_agree_with_a_recount(spark):
    rows = duck("/root/testdata/sf0.001").execute("select text, lang, source from documents").fetchall()
    want = brute(rows, queries.LEAST_DOCS, queries.TOP_TERMS)
    found = queries.op11_divergence(spark, "/root/testdata/sf0.001").collect()
    assert {tuple(r) for r in found} == want and len(found) == len(want)

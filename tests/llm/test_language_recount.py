"""Predictions against a recount with plain sets, and the language stage against gibberish."""

import collections

import numpy as np

import corpus_pipeline
from stepfold.llm import langid, queries
from stepfold.llm.common import table

SF = "/root/testdata/sf0.001"


def plain_grams(text):
    letters = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    out = []
    for i, c in enumerate(letters):
        if i + 3 <= len(letters) and letters[i + 1] != " " and not (c == " " and letters[i + 2] == " "):
            out.append(letters[i:i + 3])
        if i + 3 <= len(letters) and c == " " and letters[i + 2] == " " and letters[i + 1] != " ":
            out.append(letters[i + 1])
        if i + 2 <= len(letters) and c != " " and letters[i + 1] != " ":
            out.append(letters[i:i + 2])
    return out


def key(gram):
    value = 0
    for c in gram:
        value = value << 21 | ord(c)
    return value


def test_predictions_against_plain_sets(spark):
    docs = table(spark, SF, "documents")
    filters = queries.language_filters(docs)
    learned = [r for r in docs.where(~queries.held_out()).collect() if r["text"] and r["lang"]]
    totals, counts = collections.Counter(), collections.defaultdict(collections.Counter)
    for r in learned:
        counts[r["lang"]].update(plain_grams(r["text"]))
    for lang, c in counts.items():
        totals[lang] = sum(c.values())
    share = {lang: {g: n / totals[lang] for g, n in c.items()} for lang, c in counts.items()}
    peak = collections.defaultdict(float)
    for own in share.values():
        for g, s in own.items():
            peak[g] = max(peak[g], s)
    members = {lang: {g for g, s in own.items() if s >= langid.LEAST_SHARE and s >= langid.LEAST_RATIO * peak[g]} for lang, own in share.items()}
    assert sorted(filters.languages) == sorted(members)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    agree = near = 0
    rows = queries.op9_language(spark, SF).collect()
    for r in rows:
        grams = plain_grams(texts[r["doc_id"]] or "")
        if not grams:
            assert r["lang_pred"] == "und" and r["score"] == 0
            agree, near = agree + 1, near + 1
            continue
        exact = {lang: sum(g in own for g in grams) / len(grams) for lang, own in members.items()}
        best = max(exact, key=lambda x: (exact[x], -filters.languages.index(x)))
        score = exact[best] ** 2 / max(sum(exact.values()), 1e-12)
        agree += r["lang_pred"] == best
        near += abs(r["score"] - score) < 0.02
    assert agree >= 0.99 * len(rows) and near >= 0.99 * len(rows)
    for lang, own in members.items():  # every n-gram of a language answers for it
        masks = filters.lookup(np.array([key(g) for g in own], np.uint64))
        assert (filters._plane(masks, filters.languages.index(lang)) == 1).all()


def test_gibberish_goes_and_texts_stay(spark):
    docs = table(spark, SF, "documents")
    junk = ["xqzk vwpx qqzj kxvq zzxw " * 20, "жщыъ эюя цчш " * 20, "12 34", "", None]
    more = spark.createDataFrame([(10 ** 6 + i, t, None, None, None) for i, t in enumerate(junk)], docs.schema)
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, docs.unionByName(more), SF).collect()}
    assert not any(10 ** 6 + i in kept for i in range(len(junk)))
    labelled = [r["doc_id"] for r in docs.collect() if r["lang"] and any(c.isalpha() for c in r["text"] or "")]
    assert sum(i in kept for i in labelled) >= 0.98 * len(labelled)

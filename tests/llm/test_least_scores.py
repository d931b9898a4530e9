"""The least score of a language comes from every labelled text, beyond the 20,000 that the filters learn from."""

import math

from stepfold.llm import langid


def test_all_labelled_texts_count(spark):
    learned = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate([("the cat sat on the mat", "en"), ("le chat est sur la table", "fr")])],
                                    "id int, text string, lang string")
    filters = langid.learn(learned, "id", "text", "lang")
    some = [f"the {'cat' * (i % 7)} {'zq' * (i % 211)}x" for i in range(25_000)] + [None]
    rows = spark.createDataFrame([(i, t, "en") for i, t in enumerate(some)], "id int, text string, lang string").repartition(4)
    found = langid.least_scores(rows, "text", "lang", filters, lost=0.01)
    langs, scores = filters.predict(some[:-1])
    mine = sorted(s for lang, s in zip(langs, scores) if lang == "en")
    assert len(mine) > langid.MAX_DOCS
    assert found == {"en": mine[math.floor(len(mine) * 0.01)]}

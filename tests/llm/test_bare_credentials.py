"""Credentials without a name, by issuer's prefix or as long mixed tokens, and names with digits."""

import random

from stepfold.llm import pii
from tests.llm.test_operators import PERSONAL, frame

BODY = "16C7e42F292c6912E7710c838347Ae178B4a"
BARE = [p + BODY for p in pii.ISSUED_PREFIXES] + ["sk-proj4f9a8b7c6d5e", "AIzaSyD4x8kQ2mZ7vB1nC3wE5rT6yU8iO0pA", "xoxb-123456789012-abcDEF", "api_key2=abcdefgh1234",
                                                  "q8Zr2LxV9bTn4KdW7sYc"]
PLAIN = ["we take task-oriented-designs home", "a Donaudampfschifffahrtsgesellschaft sails", "sk-nothing and AIza alone", "ghp_ is a prefix", "internationalisation2 of Software"]


def test_bare_credentials_are_found_whole(spark):
    rng = random.Random(3)
    texts = [f"{rng.choice(['then', 'we saw'])} {token} {rng.choice(['here', 'and more'])}" for token in BARE for _ in range(4)]
    df = frame(spark, texts + PLAIN * 4 + PERSONAL)
    rows = pii.all_spans(df, "text", pii.train(df, "text")).withColumn("clean", pii.redacted("text")).collect()
    by_text = {r["text"]: r for r in rows}
    for text in texts:
        token = next(t for t in BARE if f" {t} " in text)
        assert [s["found"] for s in by_text[text]["added"]] == [token], text
        assert by_text[text]["clean"] == text.replace(token, "[SECRET]")
    for text in PLAIN:
        assert by_text[text]["added"] == [] and by_text[text]["clean"] == text


def test_long_runs_stay_linear(spark):
    texts = ["a" * 200_000, "A1" * 100_000, "1a" * 100_000, "sk-" * 60_000, "Ab" * 100_000 + "_1"]
    df = frame(spark, texts)
    assert len(pii.all_spans(df, "text", pii.train(df, "text")).collect()) == len(texts)

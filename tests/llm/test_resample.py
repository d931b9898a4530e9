"""Importance resampling: prefix CRCs against zlib, and the draw against a plain recount."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from stepfold.llm import resample

SCHEMA = "doc_id long, text string, id string, `rank` int, weight double, n_words int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def features(text, least, most):
    words = words_of(text)
    return [" ".join(words[i:i + n]).encode() for n in range(least, most + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, least, most, buckets, seed, least_words, percent):
    bags = [[zlib.crc32(f) % buckets for f in features(t, least, most)] for _, t in rows]
    s = collections.Counter(b for bag in bags for b in bag)
    t = collections.Counter(zlib.crc32(f) % buckets for x in target for f in features(x, least, most))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for (doc_id, text), bag in zip(rows, bags):
        weight = sum(gain[b] for b in bag) // len(bag) if bag else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(bag), weight, score, None, len(words_of(text))])
    able = sorted((r for r in out if r[5] >= least_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for i, r in enumerate(able[:len(able) * percent // 100]):
        r[4] = i + 1
    return out


def got(spark, rows, target, *rest):
    df = spark.createDataFrame([(i, t, "x", 1, 2.0, 3) for i, t in rows], SCHEMA)
    found = resample.resample(df, "doc_id", "text", spark.createDataFrame([(t,) for t in target], "text string"), "text", *rest)
    assert found.columns == ["id", "n_features", "weight", "score", "rank"]
    return [tuple(r) for r in found.collect()]


def corpus(n, seed=3):
    rng = random.Random(seed)
    vocabulary = ["alpha", "Beta", "x1", "straße", "日本", "été", "don't", "a_b", "🙂", "z"] + [f"w{i}" for i in range(200)]
    text = lambda: rng.choice([" ", "\n", " - "]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, 80)))
    rows = [(i, text()) for i in range(n)]
    rows += [(None, "one two three"), (None, None), (n, ""), (n + 1, "..."), (n + 2, "wort " * 30_000), (n + 3, "y" * 40_000)]
    return rows + [rows[5]] * 3 + [(7, rows[9][1]), (None, rows[5][1])]


KEY = lambda r: tuple((x is not None, x or 0) for x in r)


@pytest.mark.parametrize("least,most,buckets,least_words,percent", [(1, 1, 10_000, 20, 10), (1, 3, 97, 0, 50), (2, 2, 1000, 3, 100), (1, 2, 1, 5, 0)])
def test_against_a_recount(spark, least, most, buckets, least_words, percent):
    rows, target = corpus(200), ["alpha beta x1 w3", None, "w3 W4 w5 日本", ""]
    want = brute(rows, target, least, most, buckets, 2024, least_words, percent)
    assert sorted(got(spark, rows, target, least, most, buckets, 2024, least_words, percent), key=KEY) == sorted((tuple(r[:5]) for r in want), key=KEY)


def test_empty_tables(spark):
    assert got(spark, [], [], 1, 1, 100, 1, 0, 50) == []
    rows = corpus(20)
    assert sorted(got(spark, rows, [], 1, 1, 100, 1, 0, 50), key=KEY) == sorted((tuple(r[:5]) for r in brute(rows, [], 1, 1, 100, 1, 0, 50)), key=KEY)


def test_prefixes_give_every_ngram(monkeypatch):
    monkeypatch.setattr(resample, "RUN_WORDS", 100)
    texts = [(t or "").encode() for _, t in corpus(60)]
    for n in (1, 2, 5, 40):
        want = [zlib.crc32(f) for t in texts for f in features(t.decode(), n, n)]
        assert [int(c) for p in resample.prefix_runs(texts) for c in p.ngrams(n)[1]] == want


def test_shift_agrees_with_appended_text():
    rng = random.Random(1)
    for size in (0, 1, 2, 3, 17, 255, 4096, 100_001):
        a, b = rng.randbytes(rng.randint(0, 50)), rng.randbytes(size)
        moved = resample.shifted(np.array([zlib.crc32(a)], np.uint32), np.array([size]))
        assert int(moved[0]) ^ zlib.crc32(a + b) == zlib.crc32(b)

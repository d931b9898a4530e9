"""Minimum bin slack packing: ids against the tokenizers library, the plan against all combinations, the places whole."""

import collections
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stepfold.llm import slackpacking

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
SCHEMA = "doc_id long, text string, id string, length int, sequence_id string, size int, _row string, _number int"
rng = random.Random(11)
ODD = ["a", "Z", "é", "É", "ß", "ü", "×", "'s", "'", "''S", "1", "23", "!", "--", "<|", "<|endoftext|>", "<|startoftext|>x", "<|endoftext", "Σ", "ΣΑΣ", "İ", "ŉ", "é",
       "́", "ﬁ", "Ⅳ", "½", "日本", "🙂", " ", " ", "\x1c", "\x85", "\x00", "ǅ", "_", "don't", "I'LL", "naïveté", "Å", "Å", "‍"]
SPACES = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c", "", ""]


def odd_text(n):
    return "".join(rng.choice(ODD) + rng.choice(SPACES) for _ in range(n))


def test_ids_are_the_librarys():
    tokens = slackpacking.WordTokens(PATH)
    texts = ["", " ", "Hello  World's 123 <|endoftext|>a", "x" * 5000, "don't'S ''s 12ab", *[odd_text(rng.randint(1, 30)) for _ in range(1500)], odd_text(20_000)]
    for text in texts:
        assert np.frombuffer(tokens.encode(text.encode()), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, repr(text)


def test_ids_stay_right_when_little_is_remembered(monkeypatch):
    monkeypatch.setattr(slackpacking, "MAX_REMEMBERED", 3)
    monkeypatch.setattr(slackpacking, "LONGEST_REMEMBERED", 4)
    tokens = slackpacking.WordTokens(PATH)
    for _ in range(100):
        text = odd_text(20)
        assert np.frombuffer(tokens.encode(text.encode()), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_fullest_against_all_combinations():
    for _ in range(200):
        left = dict(sorted({rng.randint(1, 30): rng.randint(1, 4) for _ in range(rng.randint(1, 5))}.items(), reverse=True))
        room = rng.randint(0, 60)
        best = max(t for t in (sum(n * k for n, k in zip(c, left)) for c in itertools.product(*(range(m + 1) for m in left.values()))) if t <= room)
        taken = slackpacking.fullest(left, room)
        assert sum(k * n for k, n in taken.items()) == best
        assert all(0 < n <= left[k] for k, n in taken.items())


def test_plan_uses_every_piece_once_and_little_slack():
    for most, n, common in ((50, 40, 16), (2048, 4000, 37), (300, 5, 256), (2048, 4000, 1300)):
        counts = collections.Counter(min(2048, max(1, int(rng.lognormvariate(5, 1.2)))) % most + 1 for _ in range(n))
        counts[common] += 100_000  # a length that very many pieces share
        found = slackpacking.plan(counts, 2048)
        used = collections.Counter()
        for taken, times in found:
            assert times > 0 and sum(k * m for k, m in taken.items()) <= 2048
            used.update({k: m * times for k, m in taken.items()})
        assert used == counts
        least = max(-(-sum(k * m for k, m in counts.items()) // 2048), sum(m for k, m in counts.items() if k > 1024))
        assert sum(times for _, times in found) <= least * 1.01 + 1


def texts():
    words = lambda n: " ".join(rng.choice(["alpha", "Beta", "straße", "x1", "!!"]) for _ in range(n))
    long = words(9000)
    return [None, "", " ", "a", "a", long, long, words(2047), words(2046), "é" * 3000, *["same words here"] * 300, *[words(rng.randint(1, 400)) for _ in range(200)]]


@pytest.mark.parametrize("length", [16, 2048])
def test_places_are_whole(spark, length):
    rows = texts()
    ids = [None if i == 3 else i // 2 for i in range(len(rows))]  # a null id and repeated ids
    df = spark.createDataFrame([(i, t, "x", 1, "y", 2, "z", 3) for i, t in zip(ids, rows)], SCHEMA).repartition(5)
    found = [r.asDict() for r in slackpacking.pack(df, "doc_id", "text", PATH, length, 0, with_ids=True).collect()]
    want = collections.Counter()
    for i, t in zip(ids, rows):
        packed = np.array([*LIBRARY.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for k, at in enumerate(range(0, len(packed), length)):
            part = packed[at:at + length].tobytes()
            want[i, k, at, len(part) // 4, zlib.crc32(part), len(packed), part] += 1
    columns = ("id", "piece", "start", "length", "ids_crc32", "doc_tokens", "ids")
    assert collections.Counter(tuple(bytes(r[c]) if c == "ids" else r[c] for c in columns) for r in found) == want
    sequences = collections.defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))]
        assert sum(n for _, n in held) <= length
    assert len(sequences) <= -(-sum(r["length"] for r in found) // length) * 1.02 + 1
    narrow = slackpacking.pack(df, "doc_id", "text", PATH, length, 0)
    assert narrow.columns == ["id", "piece", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert narrow.select("sequence_id").distinct().count() == len(sequences)


def test_empty_table(spark):
    assert slackpacking.pack(spark.createDataFrame([], SCHEMA), "doc_id", "text", PATH, 2048, 0).collect() == []

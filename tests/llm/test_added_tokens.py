"""The packed ids are those of the tokenizers library as the contract calls it, added tokens in the text included."""

import collections
import zlib

import numpy as np
from tokenizers import Tokenizer

from stepfold.llm import queries
from tests.llm.test_operators import JSON, LONG, frame

MARK = "<|endoftext|>"
MARKED = [f"a {MARK} b", MARK, f"{MARK}{MARK}", f" {MARK} ", f"x{MARK}y  {MARK}\n z", "<|endoftext|", f"<|{MARK}|>", f"{LONG}{MARK} {LONG}", "plain", "", None]


def test_added_tokens_keep_their_ids(spark):
    tok = Tokenizer.from_file(JSON)
    assert tok.encode(MARKED[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    pieces = collections.defaultdict(list)
    for r in queries.packed(frame(spark, MARKED).drop("id")).collect():
        pieces[r["doc_id"]].append(r)
    for i, text in enumerate(MARKED):
        ids, at = np.array([*tok.encode(text or "", add_special_tokens=False).ids, queries.END_ID], dtype="<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids)), text
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes()), text
            at += r["length"]
        assert at == len(ids)

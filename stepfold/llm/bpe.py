"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decode.

A sequence of tokens is the BPE encoding of its bytes exactly if every adjacent
pair of tokens is the encoding of its own bytes. The encodings of a vocabulary
are therefore the paths of a nondeterministic transducer whose states are (last
whole token, trie node of the token in progress), and every prefix has exactly
one encoding. The transducer is determinised on demand: a deterministic state
is the set of live readings with the tokens on which they still disagree, and a
token is emitted as soon as all live readings share it, that is after a
lookahead bounded by the longest token. States and transitions are remembered
and dropped together when a limit is reached, so memory stays bounded.

Nulls encode as the empty text; the empty text has no ids. A text of any length
is read once from left to right; repeated texts have equal results.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from stepfold.llm.common import texts, type_of

MAX_STATES = 150_000  # deterministic states kept before the transducer starts afresh
MAX_REMEMBERED = 300_000  # words whose encodings a table keeps before it starts afresh
LONGEST_REMEMBERED = 64  # characters of the longest word kept
DECODE_IDS = 65_536  # ids decoded at a time


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge_plainly(piece: bytes, ranks: dict[bytes, int], whole: int = 1) -> list[bytes]:
    """The definition of BPE: join the adjacent pair of lowest rank, leftmost first, until no pair or only ``whole`` parts are left."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > whole:
        joined = [ranks.get(x + y) for x, y in zip(parts, parts[1:])]
        best = min((r for r in joined if r is not None), default=None)
        if best is None:
            break
        i = joined.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Transducer:
    """Encodes pieces byte by byte. ``merges`` ranks every token, single bytes included."""

    def __init__(self, merges: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = merges, max_states
        self.bytes_of = {rank: token for token, rank in merges.items()}
        self._trie: dict[int, int] = {}  # node * 256 + byte -> node
        self._token: list[int] = [-1]
        self._inner: set[int] = set()  # nodes that go on
        for token, rank in merges.items():
            node = 0
            for byte in token:
                self._inner.add(node)
                key = node << 8 | byte
                nxt = self._trie.get(key)
                if nxt is None:
                    nxt = self._trie[key] = len(self._token)
                    self._token.append(-1)
                node = nxt
            self._token[node] = rank
        self._pairs: dict[int, bool] = {}
        self._edges: dict[tuple[bytes, int], list] = {}
        self._forget()

    def _forget(self) -> None:
        start = (((), -1, 0),)
        self._states = [start]
        self._number = {start: 0}
        self._next: dict[int, tuple[int, bytes]] = {}  # state * 256 + byte -> state * 256, packed ids emitted
        self._rest: dict[int, bytes] = {}  # state * 256 -> packed ids at the end of a piece
        if len(self._pairs) > 8 * self.max_states:
            self._pairs = {}

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, float]]:
        """The parts that stand at one end of a token while it is merged (side 0:
        its left end, 1: its right), each with the rank of the merge that ends it."""
        key = (token, side)
        known = self._edges.get(key)
        if known is None:
            if len(token) == 1:
                known = [(token, math.inf)]
            else:
                part = merge_plainly(token, self.ranks, whole=2)[-side]
                known = [*self._edge(part, side)[:-1], (part, self.ranks[token]), (token, math.inf)]
            self._edges[key] = known
        return known

    def _adjacent(self, last: int, token: int) -> bool:
        """True if ``last`` may be followed by ``token`` in an encoding: while both
        are merged, no merge across their border ever comes first."""
        key = last << 32 | token
        known = self._pairs.get(key)
        if known is None:
            known = True
            if last >= 0:
                left, right = self._edge(self.bytes_of[last], 1), self._edge(self.bytes_of[token], 0)
                i = j = 0
                while True:
                    (x, x_ends), (y, y_ends) = left[i], right[j]
                    across = self.ranks.get(x + y)
                    if across is not None and across < x_ends and across <= y_ends:
                        known = False
                        break
                    if x_ends == y_ends == math.inf:
                        break
                    if x_ends <= y_ends:
                        i += 1
                    else:
                        j += 1
            self._pairs[key] = known
        return known

    def _step(self, key: int) -> tuple[int, bytes]:
        """Determinise one transition: move every live reading over one byte. The
        readings stay in the order in which their tokens in progress began."""
        byte, moved, done = key & 255, [], None
        trie, inner, tokens, pairs = self._trie, self._inner, self._token, self._pairs
        for reading in self._states[key >> 8]:
            pending, last, node = reading
            node = trie.get(node << 8 | byte)
            if node is None:
                continue
            if node in inner:
                moved.append((pending, last, node))
            token = tokens[node]
            if token >= 0 and done is None:
                fits = pairs.get(last << 32 | token)
                if fits is None:
                    fits = self._adjacent(last, token)
                if fits:
                    done = ((*pending, token), token, 0)
        moved.append(done)
        packed = b""
        first = moved[0][0]
        if first:
            agreed = len(first)
            for reading in moved:
                pending = reading[0]
                while pending[:agreed] != first[:agreed]:
                    agreed -= 1
                if not agreed:
                    break
            if agreed:
                packed = struct.pack(f"<{agreed}I", *first[:agreed])
                moved = [(pending[agreed:], last, node) for pending, last, node in moved]
        state = tuple(moved)
        number = self._number.get(state)
        if number is None:
            number = self._number[state] = len(self._states)
            self._states.append(state)
        self._next[key] = out = (number << 8, packed)
        return out

    def _end(self, state: int) -> bytes:
        """Ids that are still pending where a piece ends: those of the reading with no token in progress."""
        pending = self._states[state >> 8][-1][0]
        self._rest[state] = packed = struct.pack(f"<{len(pending)}I", *pending)
        return packed

    def encode(self, piece: bytes) -> bytes:
        """Ids of one piece as little-endian unsigned 32-bit integers."""
        if not piece:
            return b""
        whole = self.ranks.get(piece)
        if whole is not None:
            return struct.pack("<I", whole)
        if len(self._states) > self.max_states:
            self._forget()
        step, state, out = self._next.get, 0, []
        for byte in piece:
            state, packed = step(state | byte) or self._step(state | byte)
            if packed:
                out.append(packed)
        out.append(self._rest.get(state) or self._end(state))
        return b"".join(out)


class Encoder:
    """Encodes whole texts, word by word. ``encode_part`` gives the packed ids of a part of a text.

    A space that follows a visible character and precedes one always begins a
    new match of the pattern, so a text whose spaces are all single is cut there
    and its words are looked up; other texts are encoded as one part."""

    def __init__(self, encode_part: Callable[[str], bytes]):
        self.encode_part, self._words, self._odd = encode_part, _Words(encode_part), re.compile(r" \s").search

    def encode(self, text: str) -> bytes:
        if self._odd(text):
            return self.encode_part(text)
        words = self._words
        first, *rest = text.split(" ")
        return words[first] + b"".join(map(words.__getitem__, map(" ".__add__, rest)))


class _Words(dict):
    """Packed ids of words (a space and what follows it up to the next) or matches, worked out on first use. When
    it is full it starts afresh, but the words of the full table are still known until it is full again, so
    common words are never worked out anew."""

    def __init__(self, encode_part: Callable[[str], bytes]):
        self.encode_part, self._before = encode_part, {}

    def __missing__(self, word: str) -> bytes:
        packed = self._before.get(word)
        if packed is None:
            packed = self.encode_part(word)
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= MAX_REMEMBERED:
                self._before = dict(self)
                self.clear()
            self[word] = packed
        return packed


def transducer_parts(transducer: Transducer, pattern: str) -> Callable[[str], bytes]:
    """Splits a part by the pattern and encodes each match; matches are remembered, as words that
    differ in the signs around them share theirs."""
    split, known = regex.compile(pattern).findall, _Words(lambda match: transducer.encode(match.encode()))

    def encode_part(part: str) -> bytes:
        if part[1:].isalpha() and (part[0] == " " or part[0].isalpha()):
            return known[part]  # one match
        return b"".join([known[match] for match in split(part)])

    return encode_part


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder for each vocabulary in a Python worker."""
    return Encoder(transducer_parts(Transducer(load_ranks(path)), pattern))


class TokenBytes:
    """The bytes of all tokens in one buffer, from which those of many ids are gathered at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)  # 0: no token has this id
        for token, rank in ranks.items():
            self.size[rank] = len(token)
        self.buffer = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)
        self.start = np.cumsum(self.size) - self.size

    def __call__(self, ids: np.ndarray) -> bytes:
        sizes = self.size[ids]
        if not sizes.all():
            raise ValueError("an id that no token has")
        ends = np.cumsum(sizes)
        at = np.repeat(self.start[ids] - (ends - sizes), sizes)
        return self.buffer[at + np.arange(len(at))].tobytes()


@lru_cache(maxsize=4)
def _tokens(path: str) -> TokenBytes:
    return TokenBytes(load_ranks(path))


class Utf8Stream:
    """Incremental UTF-8 decoder: a state machine over bytes that keeps only an
    unfinished character between calls; ill-formed bytes become U+FFFD."""

    # lead byte ranges: (first, last, further bytes, least and greatest second byte)
    LEADS = ((0xC2, 0xDF, 1, 0x80, 0xBF), (0xE0, 0xE0, 2, 0xA0, 0xBF), (0xE1, 0xEC, 2, 0x80, 0xBF),
             (0xED, 0xED, 2, 0x80, 0x9F), (0xEE, 0xEF, 2, 0x80, 0xBF), (0xF0, 0xF0, 3, 0x90, 0xBF),
             (0xF1, 0xF3, 3, 0x80, 0xBF), (0xF4, 0xF4, 3, 0x80, 0x8F))
    _LEAD = {b: row[2:] for row in LEADS for b in range(row[0], row[1] + 1)}

    def __init__(self):
        self._held = b""

    def _open(self, tail: bytes) -> int:
        """How many bytes at the end of ``tail`` begin a character that is not finished."""
        more = held = 0
        low, high = 0x80, 0xBF
        for byte in tail:
            if more and low <= byte <= high:
                more, held, low, high = more - 1, held + 1, 0x80, 0xBF
            elif byte in self._LEAD:
                more, low, high = self._LEAD[byte]
                held = 1
            else:
                more = 0
        return held if more else 0

    def verified(self, chunk: bytes) -> bytes:
        """The well-formed bytes up to the last finished character."""
        data = self._held + chunk
        start = max(0, len(data) - 4)
        while start < len(data) and start and data[start] & 0xC0 == 0x80:
            start += 1  # begin at a character
        keep = self._open(data[start:])
        self._held = data[len(data) - keep:]
        return _well_formed(data[:len(data) - keep])

    def rest(self) -> bytes:
        """What is left at the end of the stream."""
        held, self._held = self._held, b""
        return _well_formed(held)

    def feed(self, chunk: bytes) -> str:
        return self.verified(chunk).decode()

    def close(self) -> str:
        return self.rest().decode()


def _well_formed(data: bytes) -> bytes:
    if data.isascii():
        return data
    try:
        data.decode()
    except UnicodeDecodeError:
        return data.decode("utf-8", "replace").encode()
    return data


def decode(ids: np.ndarray, bytes_of: Callable[[np.ndarray], bytes], at_a_time: int = DECODE_IDS) -> Iterator[bytes]:
    """Text of a sequence of ids as UTF-8, piece by piece."""
    stream = Utf8Stream()
    for i in range(0, len(ids), at_a_time):
        yield stream.verified(bytes_of(ids[i:i + at_a_time]))
    yield stream.rest()


def encode_texts(df: DataFrame, id_col: str, text_col: str, path: str, pattern: str) -> DataFrame:
    """(id, ids array<int>, n_tokens) of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for batch in batches:
            packed = [np.frombuffer(enc.encode(t), "<u4").astype(np.int32) for t in texts(batch.column(1))]
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in packed])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*packed, np.empty(0, np.int32)])))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(np.diff(offsets).astype(np.int64))],
                                             names=["id", "ids", "n_tokens"])

    return df.select(df[id_col].alias("id"), df[text_col].alias("text")).mapInArrow(
        run, f"id {type_of(df, id_col)}, ids array<int>, n_tokens long")


def decode_ids(df: DataFrame, id_col: str, ids_col: str, path: str) -> DataFrame:
    """(id, text) of every array of ids; null ids give null text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path)
        for batch in batches:
            out = [None if ids is None else b"".join(decode(np.array(ids, np.int64), tokens)).decode() for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["id", "text"])

    return df.select(df[id_col].alias("id"), df[ids_col].alias("ids")).mapInArrow(
        run, f"id {type_of(df, id_col)}, text string")


def round_trip_digests(df: DataFrame, id_col: str, text_col: str, path: str, pattern: str) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): every whole text is encoded by
    the transducer and its ids decoded again; digests keep the result narrow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        tokens = _tokens(path)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in texts(batch.column(1)):
                packed = enc.encode(text)
                counts.append(len(packed) // 4)
                ids_sha.append(hashlib.sha256(packed).hexdigest())
                digest = hashlib.sha256()
                for part in decode(np.frombuffer(packed, "<u4"), tokens):
                    digest.update(part)
                text_sha.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select(df[id_col].alias("id"), df[text_col].alias("text")).mapInArrow(
        run, f"id {type_of(df, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string")

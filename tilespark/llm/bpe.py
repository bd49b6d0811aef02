"""Byte-level BPE encoding by a lazily determinised transducer, and streaming decoding by a UTF-8 state machine.

The nondeterministic transducer guesses where tokens end. Its configurations are (tokens not yet emitted, place in the
token trie); it may end a token only where the pair (previous token, token) survives merging, and the merged encoding is
the one path on which all pairs do. Determinising the subsets of configurations on demand gives a state for each subset
met; what all configurations agree on is emitted at once, so no more than the longest token is ever looked ahead.
States, pair verdicts and whole pieces are kept in caches of bounded size; within a long piece too, whose state at that
moment is all that stays.

Defined cases: null text encodes as empty, with no tokens; any text decodes to its own bytes; invalid or cut UTF-8 in a
stream of ids decodes to U+FFFD; other columns are ignored; repeated rows each give their own row.
"""

from __future__ import annotations

import base64
import hashlib
import importlib
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import documents, give_back, slices

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Pieces, states and pair verdicts that a worker keeps, and the lesser part of them that suits a worker which has other
#: work to come.
CACHED_PIECES, CACHED_STATES, CACHED_PAIRS = 400_000, 200_000, 800_000
SMALL = 0.25
NEVER = 1 << 60
DECODE_IDS = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Transducer:
    """encode(piece) gives the ids of one piece of text, whose merges cross none of its borders."""

    def __init__(self, ranks: dict[bytes, int], share: float = 1.0):
        self.max_states, self.max_pairs = int(share * CACHED_STATES), int(share * CACHED_PAIRS)
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.next: dict[int, int] = {}  # node << 8 | byte -> node
        self.token: list[int] = [-1]
        for token, rank in ranks.items():
            node = 0
            for b in token:
                key = node << 8 | b
                if key not in self.next:
                    self.next[key] = len(self.token)
                    self.token.append(-1)
                node = self.next[key]
            self.token[node] = rank
        self.pairs: dict[int, bool] = {}
        self.single = [ranks[bytes([x])] for x in range(256)]
        #: two tokens' ids -> that of their bytes together
        self.merged = {ranks[t[:i]] << 32 | ranks[t[i:]]: rank for t, rank in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        self._reset()

    def _reset(self) -> None:
        start = (-1, (((), 0),))
        self.states: list[tuple] = [start]
        self.number = {start: 0}
        self.arcs: dict[int, tuple[int, tuple[int, ...]]] = {}  # state << 8 | byte -> state, tokens emitted

    def survives(self, left: int, right: int) -> bool:
        """Whether merging the bytes of two tokens by rank gives these two tokens."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= self.max_pairs:
                self.pairs.clear()
            a, b = self.bytes_of[left], self.bytes_of[right]
            known = self.pairs[key] = a + b not in self.ranks and self._apart(a, b)
        return known

    def _apart(self, a: bytes, b: bytes) -> bool:
        """Merge the pair of least rank, leftmost first: do both sides become whole before a pair across them merges?"""
        merged = self.merged.get
        single = self.single
        parts = [single[x] for x in a + b]
        border = len(a)  # parts on the left
        ranks = [merged(x << 32 | y, NEVER) for x, y in zip(parts, parts[1:])]
        while len(parts) > 2:
            least = min(ranks)
            i = ranks.index(least)
            if i == border - 1:
                return False
            parts[i] = least  # a token's id is its rank
            del parts[i + 1], ranks[i]
            if i < border:
                border -= 1
            if i < len(ranks):
                ranks[i] = merged(least << 32 | parts[i + 1], NEVER)
            if i:
                ranks[i - 1] = merged(parts[i - 1] << 32 | least, NEVER)
        return True

    def _arc(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Configurations stand in the order of the places where their unfinished tokens begin."""
        last, configurations = self.states[state]
        after, whole, follow = [], None, self.next.get
        for pending, node in configurations:
            node = follow(node << 8 | byte)
            if node is None:
                continue
            after.append((pending, node))
            token = self.token[node]
            if whole is None and token >= 0:
                before = pending[-1] if pending else last
                if before < 0 or self.survives(before, token):
                    whole = (*pending, token)
        after.append((whole, 0))
        out: tuple[int, ...] = ()
        first = after[0][0]
        if first:  # nothing begins any more where the emitted tokens end, so some token may be agreed on
            agreed = 0
            shortest = min([len(p) for p, _ in after])
            while agreed < shortest and all([p[agreed] == first[agreed] for p, _ in after]):
                agreed += 1
            if agreed:
                out, last = first[:agreed], first[agreed - 1]
                after = [(p[agreed:], n) for p, n in after]
        new = (-1 if after[0][0] else last, tuple(after))
        at = self.number.get(new)
        if at is None:
            at = self.number[new] = len(self.states)
            self.states.append(new)
        arc = self.arcs[state << 8 | byte] = (at, out)
        return arc

    def _forget(self, state: int) -> int:
        """Drop all states but this one; gives its new number."""
        kept = self.states[state]
        self._reset()
        at = self.number.setdefault(kept, len(self.states))
        if at == len(self.states):
            self.states.append(kept)
        return at

    def encode(self, piece: bytes) -> list[int]:
        arcs, state, ids = self.arcs, 0, []
        for byte in piece:
            arc = arcs.get(state << 8 | byte)
            if arc is None:
                if len(self.states) >= self.max_states:
                    state = self._forget(state)
                    arcs = self.arcs
                arc = self._arc(state, byte)
            state = arc[0]
            if arc[1]:
                ids += arc[1]
        if piece:
            ids += self.states[state][1][-1][0]
        return ids


def _little(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Pieces(dict):
    """Piece of text -> its ids as little-endian 32-bit bytes, filled on demand.

    When full, it becomes the old generation, from which pieces met again come back; the rest goes with the next one.
    """

    def __init__(self, ranks: dict[bytes, int], share: float = 1.0):
        self.size = int(share * CACHED_PIECES)
        self.transducer = Transducer(ranks, share)
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        out = self.old.get(piece)
        if out is None:
            out = _little(self.transducer.encode(piece.encode()))
            if len(piece) > 64:
                return out
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[piece] = out
        return out


class Utf8Machine:
    """Incremental UTF-8: feed() gives the text that is complete, and keeps an unfinished last character."""

    def __init__(self):
        self.kept = b""

    def feed(self, data: bytes, last: bool = False) -> str:
        data = self.kept + data
        cut = len(data)
        if not last:
            for back in range(1, min(4, len(data)) + 1):
                b = data[-back]
                if b >= 0xC0:  # a first byte: is its character still short of bytes?
                    cut -= back if back < (4 if b >= 0xF0 else 3 if b >= 0xE0 else 2) else 0
                    break
                if b < 0x80:
                    break
        self.kept = data[cut:]
        return data[:cut].decode("utf-8", "replace")


def decode_stream(ids: Iterable[np.ndarray], bytes_of: dict[int, bytes]) -> Iterator[tuple[bytes, str]]:
    """Chunks of ids -> (their bytes, the text completed by them)."""
    machine = Utf8Machine()
    for chunk in ids:
        raw = b"".join(map(bytes_of.__getitem__, chunk.tolist()))
        yield raw, machine.feed(raw)
    yield b"", machine.feed(b"", last=True)


def decoded(ids: bytes, bytes_of: dict[int, bytes]) -> bytes:
    array = np.frombuffer(ids, "<u4")
    return b"".join(part for part, _ in decode_stream((array[i : i + DECODE_IDS] for i in range(0, len(array), DECODE_IDS)), bytes_of))


_CODECS: dict[tuple[str, str, float], tuple] = {}


def codec(path: str, pattern: str, share: float = 1.0) -> tuple:
    """A worker builds the tables of a vocabulary once."""
    import regex

    if (path, pattern, share) not in _CODECS:
        _CODECS[path, pattern, share] = (Pieces(read_ranks(path), share), regex.compile(pattern).findall)
    return _CODECS[path, pattern, share]


def encode_texts(texts: Iterable[str | None], path: str, pattern: str, share: float = 1.0) -> Iterator[bytes]:
    pieces, split = codec(path, pattern, share)
    for text in texts:
        yield b"".join(map(pieces.__getitem__, split(text or "")))


def default_vocabulary() -> tuple[str, str]:
    public = importlib.import_module("public_tokenizers")
    return public.path(VOCABULARY), public.PATTERN


def encode_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    def run(batches):
        bytes_of = codec(path, pattern)[0].transducer.bytes_of
        for batch in slices(batches):
            rows = []
            for ids in encode_texts(batch.column(1).to_pylist(), path, pattern):
                array = np.frombuffer(ids, "<u4")
                raw = hashlib.sha256()
                for part, _ in decode_stream((array[i : i + DECODE_IDS] for i in range(0, len(array), DECODE_IDS)), bytes_of):
                    raw.update(part)
                rows.append((len(array), hashlib.sha256(ids).hexdigest(), raw.hexdigest()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string())))], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_ids(docs: DataFrame, path: str, pattern: str, share: float = SMALL) -> DataFrame:
    """docs (doc_id, source, text) -> doc_id, source, n_tokens, ids (little-endian unsigned 32-bit integers).

    The ids are decoded again as a stream; a text that doesn't come back as it was ends the job. The tables and caches
    go when a task ends: the worker may have other work to come.
    """

    def run(batches):
        try:
            bytes_of = codec(path, pattern, share)[0].transducer.bytes_of
            for batch in slices(batches):
                texts = batch.column(2).to_pylist()
                ids = list(encode_texts(texts, path, pattern, share))
                for text, found in zip(texts, ids):
                    if decoded(found, bytes_of) != (text or "").encode():
                        raise ValueError("an encoded text doesn't decode to itself")
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "source", "n_tokens", "ids"])
        finally:
            _CODECS.pop((path, pattern, share), None)
            give_back()

    return docs.select("doc_id", "source", "text").mapInArrow(run, "doc_id long, source string, n_tokens long, ids binary")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(documents(spark, sf_dir, "doc_id", "text"), *default_vocabulary())


QUERIES = {"op2_byte_bpe": op2_byte_bpe}
SQL: dict[str, str] = {}

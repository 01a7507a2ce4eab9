"""Byte-pair encoding and decoding with a public byte-level vocabulary.

A text is cut at the vocabulary's added tokens, the rest into words by the
vocabulary's pattern. The bytes of a word become a doubly linked list of symbols;
a priority queue holds the neighbouring pairs that have a merge, least rank first
and of equal ranks the leftmost. A popped pair is merged unless it is stale: one of
its symbols is gone or has grown since it was queued. A merge queues the two pairs
around the new symbol. A word of n bytes costs O(n log n), however long it is.
Decoding concatenates the byte strings of the ids.

The words of natural text repeat, so every Python worker remembers the ids of the
last ``MEMO_WORDS`` distinct short words; what it remembers only saves time. The
vocabulary is read once by the driver and broadcast: its size doesn't depend on the
texts. Texts are mapped row by row, nothing is shuffled.

Edge cases: a null or empty text has no ids, null or no ids decode to the empty
text; texts of any length and words of any length are encoded whole; ids outside
the vocabulary decode to nothing; bytes that aren't UTF-8 decode to U+FFFD; equal
rows give equal ids; an empty table gives no rows; all other columns pass through,
one that has the name of the output column is replaced.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# fixed values: the word pattern of byte-level vocabularies
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words (of at most ``MEMO_CHARS`` characters) whose ids a worker remembers.
MEMO_WORDS = 1 << 19
MEMO_CHARS = 64


def byte_letters() -> list[str]:
    """The character that stands for each byte in the vocabulary's strings: visible
    Latin-1 characters stand for themselves, the others are numbered from U+0100."""
    visible = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + rest.index(b)) for b in range(256)]


@dataclass
class Vocabulary:
    """Merges, byte strings and added tokens of a byte-level vocabulary."""

    first: list[int]                    # id of every single byte
    ranks: dict[tuple[int, int], int]   # pair of ids -> rank of its merge
    merged: list[int]                   # rank -> id that the pair becomes
    pieces: dict[int, bytes]            # id -> byte string
    added: dict[str, int] = field(default_factory=dict)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From a tokenizer file (JSON) of a byte-level BPE without normalizer."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]
        plain = (model["type"] == "BPE" and split["type"] == "ByteLevel" and spec["normalizer"] is None
                 and not split["add_prefix_space"] and split["use_regex"] and not model.get("ignore_merges")
                 and not model.get("byte_fallback") and not model.get("dropout"))
        if not plain or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} isn't a plain byte-level BPE vocabulary")
        ids, letters = model["vocab"], byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        ranks = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(pairs)}
        pieces = {i: bytes(byte_of[c] for c in s) for s, i in ids.items()}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pieces |= {i: s.encode("utf-8") for s, i in added.items()}
        return cls([ids[c] for c in letters], ranks, [ids[a + b] for a, b in pairs], pieces, added)


def merge_word(vocabulary: Vocabulary, word: bytes) -> list[int]:
    """The ids of one word."""
    rank_of, merged = vocabulary.ranks.get, vocabulary.merged
    symbol: list = list(map(vocabulary.first.__getitem__, word))
    n = len(symbol)
    # a queued pair is one number, rank * n + place of its left symbol
    queue = [r * n + at for at, r in enumerate(map(rank_of, zip(symbol, symbol[1:]))) if r is not None]
    if not queue:
        return symbol
    heapify(queue)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while queue:
        least = heappop(queue)
        rank, at = least // n, least % n
        right = after[at]
        # stale: the left symbol is gone (None), has no right neighbour, or the pair is another one now
        if right >= n or rank_of((symbol[at], symbol[right])) != rank:
            continue
        new = merged[rank]
        symbol[at], symbol[right] = new, None
        after[at] = end = after[right]
        if end < n:
            before[end] = at
            r = rank_of((new, symbol[end]))
            if r is not None:
                heappush(queue, r * n + at)
        start = before[at]
        if start >= 0:
            r = rank_of((symbol[start], new))
            if r is not None:
                heappush(queue, r * n + start)
    return [s for s in symbol if s is not None]


class Memo(dict):
    """Packed ids (4-byte integers) by word; words that aren't there are encoded."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> bytes:
        packed = array("i", merge_word(self.vocabulary, word.encode("utf-8", "replace"))).tobytes()
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = packed
        return packed


class Encoder:
    """Encodes and decodes texts in one worker; ids are packed as 4-byte integers."""

    def __init__(self, vocabulary: Vocabulary):
        import regex

        self.vocabulary = vocabulary
        self.words = regex.compile(WORD_PATTERN).findall
        longest_first = sorted(vocabulary.added, key=len, reverse=True)
        self.added = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self.memo = Memo(vocabulary)
        # byte strings by id; the last one stands for all ids that don't exist
        self.pieces = np.full(max(vocabulary.pieces, default=-1) + 2, b"", dtype=object)
        for i, piece in vocabulary.pieces.items():
            self.pieces[i] = piece

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.memo.__getitem__, self.words(text)))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.added is None:
            return self._plain(text)
        parts = self.added.split(text)  # texts between the added tokens, and these at the odd places
        return b"".join([array("i", [self.vocabulary.added[p]]).tobytes() if k % 2 else self._plain(p)
                         for k, p in enumerate(parts)])

    def decode(self, ids: np.ndarray) -> str:
        known = (ids >= 0) & (ids < len(self.pieces))
        return b"".join(self.pieces[np.where(known, ids, -1)].tolist()).decode("utf-8", "replace")


def _encoder(shared) -> Encoder:
    """The worker's encoder for a broadcast vocabulary; kept while the worker lives."""
    vocabulary = shared.value
    kept = getattr(vocabulary, "encoder", None)
    if kept is None:
        kept = vocabulary.encoder = Encoder(vocabulary)
    return kept


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of a text column as an array of int."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("array<int>")
    def to_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(shared)
        for texts in batches:
            packed = [encoder.encode(t) for t in texts.to_pylist()]
            ends = np.cumsum([0, *[len(p) // 4 for p in packed]], dtype=np.int32)
            flat = np.frombuffer(b"".join(packed), np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))

    return docs.withColumn(ids, to_ids(F.col(f"`{text}`")))


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with the text of an id array column."""
    small_batches(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("string")
    def to_text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(shared)
        for lists in batches:
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            yield pa.array([encoder.decode(flat[a:b]) for a, b in zip(ends - sizes, ends)], pa.string())

    return encoded.withColumn(text, to_text(F.col(f"`{ids}`")))

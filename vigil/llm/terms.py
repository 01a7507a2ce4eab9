"""Hashed features of UTF-8 text, computed on whole byte arrays.

No Python loop runs over words or characters; the cost is a few array passes over
the text's bytes.
"""

from __future__ import annotations

import numpy as np

_MUL = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)

# ASCII letters lower-cased; what isn't an ASCII letter, digit or a byte of a
# non-ASCII character separates words
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_WORD_BYTE = np.zeros(256, dtype=bool)
_WORD_BYTE[48:58] = _WORD_BYTE[97:123] = _WORD_BYTE[128:] = True


def text_bytes(text: str | None) -> np.ndarray:
    """Bytes of the text with A-Z lower-cased."""
    return _FOLD[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)]


def _spread(h: np.ndarray, bits: int) -> np.ndarray:
    return ((h * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


def word_terms(text: str | None, bits: int, prefixes: tuple[int, ...] = ()) -> np.ndarray:
    """Distinct hashed words of a text, and prefixes of the given numbers of bytes of
    its longer words; a prefix that occurs two, three and four times is a further
    term each time."""
    b = text_bytes(text)
    inside = _WORD_BYTE[b]
    edge = np.flatnonzero(np.diff(np.r_[False, inside, False].astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, dtype=np.int64)
    # polynomial hash of every prefix by running sums: sum of byte * MUL**position
    at = np.arange(len(b), dtype=np.int64)
    owner = np.cumsum(np.bincount(start, minlength=len(b))[:len(b)])
    place = np.where(inside, at - start[np.maximum(owner - 1, 0)], 0)
    power = np.multiply.accumulate(np.full(int(place.max()) + 1, _MUL, dtype=np.uint64))
    total = np.r_[np.uint64(0), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power[place])]
    found = [_spread(total[end] - total[start], bits)]
    for k in prefixes:
        s = start[end - start > k]
        h, n = np.unique((total[s + k] - total[s]) ^ (_MIX >> np.uint64(k)), return_counts=True)
        found += [_spread(h[n >= times] + np.uint64(times), bits) for times in (1, 2, 3, 4)]
    return np.unique(np.concatenate(found))


def gram_counts(text: str | None, bits: int, sizes: tuple[int, ...]) -> np.ndarray:
    """Counts of hashed byte n-grams; runs of non-word bytes and digits act as one space."""
    b = text_bytes(text)
    letter = _WORD_BYTE[b] & ~((b >= 48) & (b <= 57))
    b = np.where(letter, b, np.uint8(32))
    b = np.r_[np.uint8(32), b[letter | np.r_[True, letter[:-1]]] if len(b) else b, np.uint8(32)].astype(np.uint64)
    out = np.zeros(1 << bits, dtype=np.float32)
    for n in sizes:
        if len(b) < n:
            continue
        h = np.full(len(b) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            h = h * np.uint64(257) + b[k:len(b) - n + 1 + k]
        out += np.bincount(_spread(h, bits), minlength=1 << bits)
    return out

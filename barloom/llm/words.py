"""Words of Arrow text columns as 64-bit hashes, whole columns at a time.

A word is a maximal run of bytes of one class.  The hash of a short one is a polynomial over its bytes
modulo 2**64, taken from prefix sums (the base is odd, so powers can be inverted), then mixed.  Long runs
of two symbols can be built that collide under every such polynomial, so words over ``LONG`` bytes are
hashed with BLAKE2.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
#: Bytes of the longest word whose hash is a polynomial.
LONG = 32

#: Bytes of words in the two senses used here.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), 0x5F, *range(0x80, 0x100)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column, without gaps, and each text's offsets (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    large = pa.types.is_large_string(texts.type)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, values = texts.buffers()
    at = np.frombuffer(ends, np.int64 if large else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8)[at[0] : at[-1]] if values is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def _powers(name: str, base: int, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _POWERS[name] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end) of some bytes; none may be empty."""
    sums = _BYTE[data]
    sums *= _powers("up", _BASE, len(data))
    np.cumsum(sums, out=sums)
    total = sums[end - 1]
    total -= np.where(start > 0, sums[start - 1], np.uint64(0))
    total *= _powers("down", _INVERSE, len(data))[start]
    out = mix(total)
    for i in np.flatnonzero(end - start > LONG).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]], digest_size=8).digest(), "little")
    return out


def word_hashes(texts: pa.Array, word_bytes: np.ndarray = LETTERS, unicode_lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column in order, and each text's offsets in them.

    Upper-case letters count as lower-case ones: in all scripts, or A-Z alone.
    """
    if unicode_lower:
        texts = pc.utf8_lower(texts)
    data, offsets = flat_bytes(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    if not unicode_lower:
        data = _LOWER[data]
    inside = word_bytes[data]
    head = inside.copy()
    head[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    head[first] = inside[first]
    tail = inside.copy()  # the last byte of a word
    tail[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    tail[last] = inside[last]
    start, end = np.flatnonzero(head), np.flatnonzero(tail) + 1
    return span_hashes(data, start, end), np.searchsorted(start, offsets)


def ngram_hashes(words: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word runs inside each text; a text of 1 to n-1 words gives one, of all its words."""
    count = np.diff(offsets)
    grams = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    ends = np.zeros(len(offsets), np.int64)
    np.cumsum(grams, out=ends[1:])
    if not len(words):
        return np.zeros(0, np.uint64), ends
    at = np.repeat(offsets[:-1] - ends[:-1], grams) + np.arange(ends[-1])
    stop = np.repeat(offsets[1:], grams)
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        here = at + k
        there = here < stop
        term = words[np.minimum(here, len(words) - 1)]
        out = np.where(there, mix(out * np.uint64(0xD6E8FEB86659FD93) + term), out)
    return out, ends

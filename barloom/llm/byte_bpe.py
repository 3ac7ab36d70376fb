"""Byte-level BPE over Arrow text columns.

The pre-tokenizer of byte-level BPE starts a new piece at every ASCII white-space byte that
follows a visible character, at punctuation after a letter or digit, and after a single line break.
So a text may be cut there and each *distinct* segment encoded once per batch; ids of the whole
text are then gathered with numpy.  The ids are those that the
``tokenizers`` library gives for the whole text (tests compare both).
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from barloom.llm.words import flat_bytes, span_hashes

#: Distinct segments that a Python worker remembers; beyond it, those not met again are forgotten.
CACHE_SEGMENTS = 600_000
#: Bytes of remembered segments and their ids.
CACHE_BYTES = 32 << 20
#: Text that is encoded at a time.
ENCODE_BYTES = 1_500_000

_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_PUNCTUATION = _VISIBLE & ~_ALNUM
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def segment_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which a text may be cut without changing its pre-tokens.

    A cut is made before white space whose predecessor is visible: printable ASCII, or the last
    byte of a character that cannot be one of Unicode's white-space characters; before ASCII
    punctuation that follows an ASCII letter or digit; and after a line break between two visible
    ASCII characters (of which the second may be one of Latin-1's letters).
    """
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        before = data[:-1]
        visible = (before > 0x20) & (before < 0x7F)
        high = before >= 0x80
        if high.any():
            second = np.concatenate([[0], data[:-2]]) if n > 2 else np.zeros(n - 1, np.uint8)
            third = np.concatenate([[0, 0], data[:-3]]) if n > 3 else np.zeros(n - 1, np.uint8)
            maybe_space = ((second == 0xC2) & ((before == 0x85) | (before == 0xA0))) | (third == 0xE1) | (third == 0xE2) | (third == 0xE3)
            visible |= high & ~maybe_space
        cut[1:n] = (_SPACE[data[1:]] & visible) | (_ALNUM[before] & _PUNCTUATION[data[1:]])
        if n > 2:
            cut[2:n] |= (data[1:-1] == 0x0A) & _VISIBLE[data[:-2]] & (_VISIBLE[data[2:]] | (data[2:] == 0xC3))
    cut[offsets[:-1]] = True
    cut[n] = False
    return np.flatnonzero(cut)


def distinct_segments(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Index of each segment in the array of distinct segments, and that array."""
    ends = np.append(starts, len(data)).astype(np.int32)
    segments = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    coded = segments.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def ragged_gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate flat[start[i]:start[i]+length[i]]; also the offsets of each run in the result."""
    ends = np.zeros(len(length) + 1, np.int64)
    np.cumsum(length, out=ends[1:])
    at = np.repeat(start - ends[:-1], length)
    at += np.arange(ends[-1])
    return flat[at], ends


def same_spans(left: np.ndarray, left_start: np.ndarray, right: np.ndarray, right_start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether each pair of spans of one length has equal bytes; no length may be 0."""
    if not len(length):
        return np.zeros(0, bool)
    a, ends = ragged_gather(left, left_start, length)
    b, _ = ragged_gather(right, right_start, length)
    return np.logical_and.reduceat(a == b, ends[:-1])


class SegmentTable:
    """Ids of remembered segments.  A 64-bit hash finds a segment and its bytes are compared, so that a segment never gets another's ids.

    Over ``limit`` segments or ``most_bytes`` of them and their ids, those that have not been asked for since the last clearing are forgotten.
    """

    def __init__(self, limit: int = CACHE_SEGMENTS, most_bytes: int = CACHE_BYTES):
        self.limit, self.most_bytes = limit, most_bytes
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros(0, np.uint64)
        self.start, self.length, self.name, self.size = (np.zeros(0, np.int32) for _ in range(4))
        self.asked = np.zeros(0, bool)
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.names, self.named = np.zeros(1 << 16, np.uint8), 0

    def _forget(self) -> None:
        full = 4 * self.used + self.named > self.most_bytes
        keep = self.asked if 2 * self.asked.sum() < self.limit and not (full and 2 * self.asked.sum() > len(self.asked)) else np.zeros(len(self.asked), bool)
        flat, ends = ragged_gather(self.flat, self.start[keep], self.length[keep])
        names, name_ends = ragged_gather(self.names, self.name[keep], self.size[keep])
        self.key, self.length, self.size = self.key[keep], self.length[keep], self.size[keep]
        self.start, self.name, self.asked = ends[:-1].astype(np.int32), name_ends[:-1].astype(np.int32), np.zeros(len(self.key), bool)
        self.flat, self.used = np.concatenate([flat, np.zeros(1 << 16, np.int32)]), len(flat)
        self.names, self.named = np.concatenate([names, np.zeros(1 << 16, np.uint8)]), len(names)

    def lookup(self, data: np.ndarray, at: np.ndarray, encode) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each segment start in ``flat``, and how many there are.

        data, at: the bytes of different segments one after another, none empty, and their offsets.  encode: from indices of segments to all their ids and how many each has.
        """
        if len(self.key) > self.limit or 4 * self.used + self.named > self.most_bytes:
            self._forget()
        key, size = span_hashes(data, at[:-1], at[1:]) if len(at) > 1 else np.zeros(0, np.uint64), np.diff(at)
        place = np.searchsorted(self.key, key)
        found, taken = np.zeros(len(key), bool), np.zeros(len(key), bool)
        if len(self.key):
            near = np.minimum(place, len(self.key) - 1)
            taken = self.key[near] == key
            maybe = np.flatnonzero(taken & (self.size[near] == size))
            found[maybe] = same_spans(data, at[maybe], self.names, self.name[near[maybe]], size[maybe])
            self.asked[near[found]] = True
        start, length = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        start[found], length[found] = self.start[place[found]], self.length[place[found]]
        missing = np.flatnonzero(~found)
        for lo in range(0, len(missing), 8192):
            part = missing[lo : lo + 8192]
            ids, length[part] = encode(part)
            while self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.used : self.used + len(ids)] = ids
            start[part] = self.used + np.cumsum(length[part]) - length[part]
            self.used += len(ids)
        if len(missing):
            new = missing[np.unique(key[missing], return_index=True)[1]]
            new = new[~taken[new]]  # equal hashes: the newcomer isn't remembered
            names, ends = ragged_gather(data, at[new], size[new])
            while self.named + len(names) > len(self.names):
                self.names = np.concatenate([self.names, np.zeros_like(self.names)])
            self.names[self.named : self.named + len(names)] = names
            for column, values in (("key", key[new]), ("start", start[new]), ("length", length[new]), ("name", ends[:-1] + self.named), ("size", size[new]), ("asked", np.zeros(len(new), bool))):
                setattr(self, column, np.insert(getattr(self, column), place[new], values))
            self.named += len(names)
        return start, length


class ByteBpe:
    """Whole-text encoding with the ``tokenizers`` library; each distinct segment is encoded once while remembered."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # control strings in a text are ordinary text
        size = self.tokenizer.get_vocab_size()
        # Byte-level tokens are spelled with one character for each byte.
        self.token_bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        self.table = SegmentTable()

    def encode_segments(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the segments, one after another, and how many each has.

        Segments that start with white space and end visibly are encoded joined together: the
        joints are cuts that the pre-tokenizer makes itself.  So are those that start with a letter
        or digit, with line breaks between them.
        """
        data, offsets = flat_bytes(words)
        size = np.diff(offsets)
        first, last = data[np.minimum(offsets[:-1], len(data) - 1)], data[offsets[1:] - 1]
        closed = (size > 0) & _VISIBLE[last]
        spaced, bare = closed & (size > 1) & _SPACE[first], closed & _ALNUM[first]
        lengths = np.zeros(len(words), np.int64)
        parts: list = [None] * len(words)
        for some, mark in ((spaced, ""), (bare, "\n")):
            at = np.flatnonzero(some)
            if not len(at):
                continue
            chosen = words if len(at) == len(words) else words.take(pa.array(at))
            if mark:  # a visible character first, so that each line break is a piece of its own
                text = "." + mark + mark.join(chosen.to_pylist())
                ids = np.array(self._ids(text), np.int32)
                stops = np.cumsum(size[at] + 1) + 1
            else:
                ids = np.array(self._ids(flat_bytes(chosen)[0].tobytes().decode()), np.int32)
                stops = np.cumsum(size[at])
            ends = np.searchsorted(np.cumsum(self.token_bytes[ids]), stops) + 1
            begins = np.concatenate([[1], ends[:-1]]) + 1 if mark else np.concatenate([[0], ends[:-1]])
            lengths[at] = ends - begins
            if len(at) == len(words) and not mark:
                return ids, lengths
            for i, lo, hi in zip(at.tolist(), begins.tolist(), ends.tolist()):
                parts[i] = ids[lo:hi]
        rest = np.flatnonzero(~(spaced | bare))
        for i, e in zip(rest.tolist(), self.tokenizer.encode_batch_fast(words.take(pa.array(rest)).to_pylist(), add_special_tokens=False)):
            parts[i] = np.array(e.ids, np.int32)
            lengths[i] = len(parts[i])
        return np.concatenate(parts) if parts else np.zeros(0, np.int32), lengths

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts (null: empty) and the offsets of each text in them."""
        data, offsets = flat_bytes(texts)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        starts = segment_starts(data, offsets)
        index, words = distinct_segments(data, starts)
        start, length = self.table.lookup(*flat_bytes(words), lambda at: self.encode_segments(words.take(pa.array(at))))
        ids, ends = ragged_gather(self.table.flat, start[index], length[index])
        return ids, ends[np.searchsorted(starts, offsets)]

    def sentence_ends(self) -> np.ndarray:
        """For each id: whether its text ends a sentence (full stop, exclamation or question mark, line break)."""
        marks = (".", "!", "?", "…", "。", "！", "？", '."', ".)")
        out = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for i in range(len(out)):
            text = self.tokenizer.decode([i], skip_special_tokens=False)
            out[i] = "\n" in text or text.rstrip(" ").endswith(marks)
        return out


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """One encoder for each Python worker and vocabulary."""
    return ByteBpe(path)


def text_slices(column: pa.Array, most_bytes: int = 1_000_000):
    """(first, last) row ranges of a column that hold about most_bytes of text each, one row at least."""
    sizes = np.nan_to_num(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(float))
    ends = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + most_bytes, "right")))
        yield lo, hi
        lo = hi

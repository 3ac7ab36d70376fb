"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

The vocabulary comes from a SentencePiece model of merge (BPE) type without text normalisation.  A
text gets a space in front (the model's dummy prefix), spaces become ``▁``, and adjacent symbols are
merged, best-scored pair first, leftmost first among equals.  Symbols without a piece become bytes.

**Merge-dropout.**  A merge that comes up on the agenda is skipped when a hash of the occurrence's key and
the merge's place in the segment falls below the dropout probability; it comes up again only when a
neighbour's merge renews the pair.  Every occurrence of a segment has a key of its own, a hash of seed, document and
place, so equal segments are cut independently within and across documents, yet the same
seed always gives the same ids.  With dropout 0 the ids are those of the library.

No piece has ``▁`` after another character, and many pairs of ASCII characters stand together in no
piece, so no merge crosses such places: texts are cut there.  The agendas of many segments are worked off together, a merge of each at a time
(``Agendas``).  A segment is first processed without dropout, once while remembered, with the places of the merges that come up; an
occurrence whose key skips none of these takes the remembered ids, and every other one has an agenda of its own.  A ``▁`` in the text itself is written
as its bytes, so decoding gives every text back.

Cases: null and empty texts have no ids and decode to an empty text; repeated rows are encoded
alike; null doc_ids are allowed; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.llm.byte_bpe import SegmentTable, distinct_segments, ragged_gather, text_slices
from barloom.llm.common import table
from barloom.llm.words import flat_bytes, mix

DROPOUT, SEED = 0.1, 1
#: Different segments that a worker remembers.
CACHE_WORDS = 400_000
#: Symbols of a word from which on its agenda is a heap.
LONG_WORD = 64
SPACE = "▁"
#: Stands for a ``▁`` of the text itself while a word is processed (a code point that no text has).
OWN_SPACE = "\ud800"
NEVER = float("inf")
#: A merge's place: its first symbol's position times this, plus the characters of its piece.
PLACE = 1 << 16
_STEP, _64 = 0x9E3779B97F4A7C15, (1 << 64) - 1


def skipped(key: int, place: int, level: int) -> bool:
    """Whether an occurrence's key skips the merge at a place; level: the dropout probability times 2**32.  The same as ``all_skipped``."""
    x = key + place * _STEP & _64
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & _64
    x = (x ^ x >> 27) * 0x94D049BB133111EB & _64
    return (x ^ x >> 31) >> 32 < level


def all_skipped(keys: np.ndarray, places: np.ndarray, level: int) -> np.ndarray:
    return mix(keys + places.astype(np.uint64) * np.uint64(_STEP)) >> np.uint64(32) < np.uint64(level)


class PieceModel:
    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib = self.library
        size = lib.vocab_size()
        special = {i for i in range(size) if lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)}
        self.byte_ids = {int(lib.id_to_piece(i)[3:5], 16): i for i in range(size) if lib.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.pieces = {lib.id_to_piece(i): i for i in range(size) if i not in special and not lib.is_byte(i)}
        self.text_of = {i: p for p, i in self.pieces.items()}
        #: Merges by text; a lower rank is better.
        self.rank = {p: -lib.get_score(i) for p, i in self.pieces.items() if len(p) > 1}

    def merged(self, word: str, skip: float = 0.0, key: int = 0) -> list[str]:
        """The symbols that an agenda of merges leaves of one word.

        The agenda of a word is short: a list with the rank of each adjacent pair, whose least
        entry is the next merge.  Words of many symbols have a heap instead.
        """
        return (self._merged_by_heap if len(word) > LONG_WORD else self._merged_by_list)(word, skip, key)

    def _merged_by_list(self, word: str, skip: float = 0.0, key: int = 0) -> list[str]:
        symbols = list(word)
        rank = self.rank.get
        agenda = [rank(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        level = int(skip * 4294967296)
        begin = list(range(len(symbols)))
        while agenda and (best := min(agenda)) != NEVER:
            i = agenda.index(best)
            joined = symbols[i] + symbols[i + 1]
            if level and skipped(key, begin[i] * PLACE + len(joined), level):
                agenda[i] = NEVER  # until a neighbour's merge renews the pair
                continue
            symbols[i] = joined
            del symbols[i + 1], begin[i + 1], agenda[i]
            if i < len(agenda):
                agenda[i] = rank(joined + symbols[i + 1], NEVER)
            if i:
                agenda[i - 1] = rank(symbols[i - 1] + joined, NEVER)
        return symbols

    def _merged_by_heap(self, word: str, skip: float, key: int) -> list[str]:
        symbols, n = list(word), len(word)
        rank = self.rank.get
        level = int(skip * 4294967296)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(r, i, a + b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := rank(a + b)) is not None]
        heapify(agenda)
        while agenda:
            _, i, joined = heappop(agenda)
            j = after[i]
            if symbols[i] is None or j >= n or symbols[i] + symbols[j] != joined:
                continue  # one of the two has been merged since
            if level and skipped(key, i * PLACE + len(joined), level):
                continue
            symbols[i], symbols[j] = joined, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank(joined + symbols[k])) is not None:
                    heappush(agenda, (r, i, joined + symbols[k]))
            if (h := before[i]) >= 0 and (r := rank(symbols[h] + joined)) is not None:
                heappush(agenda, (r, h, symbols[h] + joined))
        return [s for s in symbols if s is not None]

    def word_ids(self, word: str, skip: float, key: int) -> list[int]:
        return self.symbol_ids(self.merged(word, skip, key))

    def symbol_ids(self, symbols: list[str]) -> list[int]:
        ids, known = [], self.pieces.get
        for symbol in symbols:
            i = known(symbol)
            if i is not None:
                ids.append(i)
            else:
                raw = SPACE if symbol == OWN_SPACE else symbol
                ids.extend(self.byte_ids[b] for b in raw.encode())
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces and runs of bytes, without the space in front."""
        out, held = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is None:
                if held:
                    out.append(held.decode())
                    held.clear()
                out.append(self.text_of[i].replace(SPACE, " "))
            else:
                held.append(b)
        if held:
            out.append(held.decode())
        return "".join(out)[1:]


class Agendas:
    """Agendas of many words at once, with arrays: the same as ``PieceModel.merged``.

    A symbol is a number: of a character its code point, of a longer piece ``MULTI`` and its id.
    """

    MULTI = 0x110000

    def __init__(self, model: PieceModel):
        self.model = model
        number = lambda t: ord(t) if len(t) == 1 else self.MULTI + model.pieces[t]
        order = {p: k for k, p in enumerate(sorted(model.rank, key=model.rank.get))}
        scores = {score: k for k, score in enumerate(sorted(set(model.rank.values())))}
        pairs = sorted(
            (number(p[:k]) << 22 | number(p[k:]), order[p]) for p in order for k in range(1, len(p)) if (k == 1 or p[:k] in order) and (len(p) - k == 1 or p[k:] in order))
        self.pair, merge = (np.array(x, np.int64) for x in zip(*pairs))
        self.none, self.never = len(order), len(scores)
        self.merge = np.append(merge, self.none).astype(np.int32)
        self.rank = np.array([*(scores[model.rank[p]] for p in order), self.never], np.int32)
        self.merged, self.size = np.array([number(p) for p in order], np.int32), np.array([len(p) for p in order])
        self.chars: dict[int, list[int]] = {}

    def _find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Numbers of the merges of symbols a and b; ``none`` if there is none."""
        key = a.astype(np.int64) << 22 | b
        at = np.searchsorted(self.pair, key)
        at[at == len(self.pair)] = 0
        return self.merge[np.where((self.pair[at] == key) & (b >= 0), at, len(self.pair))]

    def run(self, codes: np.ndarray, start: np.ndarray, length: np.ndarray, keys: np.ndarray | None = None, level: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Symbols left of the words codes[start : start + length], how many of each word, and, word by word in the order in which they came up, the places
        of all merges and how many.  keys: each word's, if merges are skipped."""
        rows, symbols, where, places = [], [], [], []
        least = 0
        for width in (4, 8, 16, 32, LONG_WORD):
            some = np.flatnonzero((length > least) & (length <= width))
            least = width
            for lo in range(0, len(some), 16384):
                self._batch(some[lo : lo + 16384], codes, start, length, width, keys, level, rows, symbols, where, places)
        order, symbol = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, symbols))
        by = np.argsort(order, kind="stable")
        of_place, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (where, places))
        by_place = np.argsort(of_place, kind="stable")
        return symbol[by], np.bincount(order, minlength=len(length)), place[by_place], np.bincount(of_place, minlength=len(length))

    def _batch(self, word, codes, start, length, width, keys, level, rows, symbols, where, places) -> None:
        """A symbol stands where its first character was; ``after`` and ``before`` lead to its neighbours, over a last column that stays empty."""
        n, column = len(word), np.arange(width + 1)
        inside = column < length[word][:, None]
        s = np.where(inside, codes[np.minimum(start[word][:, None] + column, len(codes) - 1)].astype(np.int32), np.int32(-1))
        after = np.broadcast_to(np.minimum(column + 1, width).astype(np.int8), (n, width + 1)).copy()
        before = np.broadcast_to((column - 1).astype(np.int8), (n, width + 1)).copy()
        merge = self._find(s[:, :-1], s[:, 1:])
        agenda = self.rank[merge]

        def leave(some: np.ndarray) -> None:
            at, col = np.nonzero(s[some] >= 0)
            rows.append(word[some][at])
            symbols.append(s[some][at, col])

        while len(word):
            i = agenda.argmin(1)
            live = agenda[np.arange(len(word)), i] < self.never
            if 2 * np.count_nonzero(live) <= len(word):
                leave(~live)
                word, s, after, before, merge, agenda, i = (x[live] for x in (word, s, after, before, merge, agenda, i))
                row = np.arange(len(word))
            else:
                row = np.flatnonzero(live)
                i = i[row]
            if not len(row):
                continue
            m = merge[row, i]
            place = i * PLACE + self.size[m]
            where.append(word[row])
            places.append(place)
            if level:
                skip = all_skipped(keys[word[row]], place, level)
                agenda[row[skip], i[skip]] = self.never  # until a neighbour's merge renews the pair
                row, i, m = row[~skip], i[~skip], m[~skip]
            joined = self.merged[m]
            j = after[row, i]
            k = after[row, j]
            s[row, i], s[row, j] = joined, -1
            after[row, i], before[row, k] = k, i
            agenda[row, j] = self.never
            merge[row, i] = found = self._find(joined, s[row, k])
            agenda[row, i] = self.rank[found]
            h = before[row, i]
            back = np.flatnonzero(h >= 0)
            row, h = row[back], h[back]
            merge[row, h] = found = self._find(s[row, h], joined[back])
            agenda[row, h] = self.rank[found]

    def ids(self, symbols: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols (count of each word), bytes for characters without a piece, and how many ids each word has."""
        size = np.ones(len(symbols), np.int64)
        single = np.flatnonzero(symbols < self.MULTI)
        different, which = np.unique(symbols[single], return_inverse=True)
        lists = []
        for c in different.tolist():
            if c not in self.chars:
                self.chars[c] = self.model.symbol_ids([chr(c)])
            lists.append(self.chars[c])
        sizes = np.array([len(x) for x in lists], np.int64)
        size[single] = sizes[which]
        flat = np.array([i for x in lists for i in x], np.int64)
        own, _ = ragged_gather(flat, (np.cumsum(sizes) - sizes)[which], sizes[which])
        ends = np.concatenate([[0], np.cumsum(size)])
        out = np.zeros(ends[-1], np.int64)
        many = np.zeros(len(symbols), bool)
        many[single] = True
        inner = np.repeat(many, size)
        out[inner] = own
        out[~inner] = symbols[~many] - self.MULTI
        edge = np.concatenate([[0], np.cumsum(count)])
        return out, np.diff(ends[edge])


def code_points(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, with spaces and ``▁`` as words have them, and where those of each word (at: byte offsets) start."""
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).copy()
    codes[codes == ord(SPACE)] = ord(OWN_SPACE)
    codes[codes == 0x20] = ord(SPACE)
    return codes, np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at]


class PieceEncoder:
    def __init__(self, path: str, dropout: float, seed: int):
        self.model, self.dropout, self.seed = PieceModel(path), dropout, seed
        self.agendas = Agendas(self.model)
        self.level = int(dropout * 4294967296)
        self.table = SegmentTable(CACHE_WORDS)
        # Neighbouring ASCII characters that stand together in some piece; between others no merge is possible.
        self.together = np.ones((256, 256), bool)
        self.together[:128, :128] = False
        for piece in self.model.rank:
            text = piece.replace(SPACE, " ")
            for a, b in zip(text, text[1:]):
                if a < "\x80" and b < "\x80":
                    self.together[ord(a), ord(b)] = True

    def occurrence_keys(self, doc_keys: np.ndarray, place: np.ndarray) -> np.ndarray:
        """A key for each occurrence: a hash of seed, document and place."""
        seed = mix(np.array([self.seed], np.int64).astype(np.uint64) + np.uint64(1))
        return mix(mix(doc_keys.astype(np.uint64) + seed) + place.astype(np.uint64))

    def _cut(self, words: pa.Array, index: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where those of each occurrence start and how many they are; index: each occurrence's word, keys: its key."""
        data, at = flat_bytes(words)
        codes, begin = code_points(data, at)
        n_codes = np.diff(begin)
        start, length = np.zeros(len(index), np.int64), np.zeros(len(index), np.int64)
        parts, used = [], 0

        def keep(which: np.ndarray, ids: np.ndarray, first: np.ndarray, count: np.ndarray) -> None:
            nonlocal used
            start[which], length[which] = first + used, count
            parts.append(ids)
            used += len(ids)

        long = np.flatnonzero((n_codes > LONG_WORD)[index])
        found = [self.model.word_ids("".join(map(chr, codes[begin[i] : begin[i + 1]].tolist())), self.dropout, k) for i, k in zip(index[long].tolist(), keys[long].tolist())]
        count = np.fromiter(map(len, found), np.int64, len(found))
        keep(long, np.fromiter((i for f in found for i in f), np.int32, int(count.sum())), np.cumsum(count) - count, count)
        left = np.flatnonzero((n_codes <= LONG_WORD)[index])
        some, node = np.unique(index[left], return_inverse=True)

        def new(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Rows of the table: how many ids, the ids, and the places of merges that a key may skip."""
            symbols, n, places, n_places = self.agendas.run(codes, begin[some[which]], n_codes[some[which]])
            ids, n_ids = self.agendas.ids(symbols, n)
            if not self.level:
                places, n_places = places[:0], n_places * 0
            size = 1 + n_ids + n_places
            head = np.cumsum(size) - size
            rows = np.zeros(size.sum(), np.int32)
            rows[head] = n_ids
            rows[np.repeat(head + 1 - (np.cumsum(n_ids) - n_ids), n_ids) + np.arange(len(ids))] = ids
            rows[np.repeat(head + 1 + n_ids - (np.cumsum(n_places) - n_places), n_places) + np.arange(len(places))] = places
            return rows, size

        named, names_at = ragged_gather(data, at[some], at[some + 1] - at[some])
        first, size = self.table.lookup(named, names_at, new)
        n_ids = self.table.flat[first].astype(np.int64)
        ids, ends = ragged_gather(self.table.flat, first + 1, n_ids)
        done = np.ones(len(left), bool)
        if self.level:
            n_places = size - 1 - n_ids
            places, _ = ragged_gather(self.table.flat, (first + 1 + n_ids)[node], n_places[node])
            owner = np.repeat(np.arange(len(left)), n_places[node])
            done[owner[all_skipped(keys[left][owner], places, self.level)]] = False
        keep(left[done], ids, ends[:-1][node[done]], n_ids[node[done]])
        again = left[~done]
        symbols, n, _, _ = self.agendas.run(codes, begin[index[again]], n_codes[index[again]], keys[again], self.level)
        ids, n_ids = self.agendas.ids(symbols, n)
        keep(again, ids, np.cumsum(n_ids) - n_ids, n_ids)
        return np.concatenate(parts).astype(np.int32), start, length

    def encode(self, texts: pa.Array, doc_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts, and each text's offsets in them; doc_keys: a number for each text."""
        texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise("", texts, " "))  # a space in front, if there is a text
        data, offsets = flat_bytes(texts)
        n = len(data)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        head = np.zeros(n, bool)
        head[1:] = ~self.together[data[:-1], data[1:]] | ((data[1:] == 0x20) & (data[:-1] != 0x20))
        head[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(head)
        index, words = distinct_segments(data, starts)
        index = index.astype(np.int64)
        doc = np.searchsorted(offsets, starts, "right") - 1
        place = np.arange(len(starts)) - np.searchsorted(starts, offsets)[doc]
        flat, start, length = self._cut(words, index, self.occurrence_keys(doc_keys[doc], place))
        ids, at = ragged_gather(flat, start, length)
        return ids, at[np.searchsorted(starts, offsets)]


@lru_cache(maxsize=4)
def piece_encoder(path: str, dropout: float, seed: int) -> PieceEncoder:
    return PieceEncoder(path, dropout, seed)


class ColumnDecoder:
    """Decodes whole columns: bytes of all ids are gathered from one table."""

    def __init__(self, model: PieceModel):
        size = model.library.vocab_size()
        raw = [bytes([model.byte_of[i]]) if i in model.byte_of else model.text_of.get(i, "").replace(SPACE, " ").encode() for i in range(size)]
        self.flat = np.frombuffer(b"".join(raw), np.uint8)
        self.length = np.array([len(r) for r in raw], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def decode(self, ids: np.ndarray, at: np.ndarray) -> pa.Array:
        data, ends = ragged_gather(self.flat, self.start[ids], self.length[ids])
        edge = ends[at]
        keep = np.ones(len(data), bool)
        keep[edge[:-1][np.diff(edge) > 0]] = False  # the space in front
        offsets = np.concatenate([[0], np.cumsum(np.maximum(np.diff(edge) - 1, 0))]).astype(np.int32)
        out = pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[keep]))])
        out.validate(full=True)
        return out


def encode(docs: DataFrame, model_path: str, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """doc_id, n_ids, ids (little-endian unsigned 16-bit, 32-bit for larger vocabularies), decoded (the text that the ids give back), lossless."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(model_path, dropout, seed)
        decoder = ColumnDecoder(encoder.model)
        width = 2 if encoder.model.library.vocab_size() <= 1 << 16 else 4
        for batch in batches:
            texts = batch.column("text")
            for lo, hi in text_slices(texts):
                part = texts.slice(lo, hi - lo)
                doc_ids = batch.column("doc_id").slice(lo, hi - lo)
                ids, at = encoder.encode(part, pc.fill_null(doc_ids, 0).to_numpy(zero_copy_only=False))
                decoded = decoder.decode(ids, at)
                raw = ids.astype(f"<u{width}").tobytes()
                cut = (at * width).tolist()
                yield pa.record_batch([
                    doc_ids, pa.array(np.diff(at)), pa.array([raw[a:b] for a, b in zip(cut, cut[1:])], pa.binary()), decoded, pc.equal(decoded, part),
                ], names=["doc_id", "n_ids", "ids", "decoded", "lossless"])

    return docs.mapInArrow(run, "doc_id long, n_ids long, ids binary, decoded string, lossless boolean")


def op9(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (of the ids as stored), decoded_chars, decoded_crc32 (of the decoded text's bytes), lossless."""
    import public_tokenizers

    done = encode(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return done.select("doc_id", "n_ids", F.crc32("ids").alias("ids_crc32"), F.length("decoded").cast("long").alias("decoded_chars"), F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"), "lossless")

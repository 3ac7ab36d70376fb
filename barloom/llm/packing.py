"""Packing of documents into token sequences, in document order.

Each range of documents is one stream of ids, cut into windows by dynamic programming.  A cut may
fall after a document, after a sentence, or (in sentences that are not short) every ``STRIDE``
ids.  With K windows the cost is ``K * window`` ids (text and padding) plus a penalty for each
document that is cut.  ``best[j] = min(best[i]) + window + penalty[j]`` over the cuts i at most one
window before j, so the candidates for i are a sliding window and a monotone queue gives each
minimum in constant time on average.

Cases: a null text is an empty one, an empty document has its end id alone; null doc_ids come
first; repeated rows are packed as often as they occur; an empty table gives no pieces; other
columns are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.llm.byte_bpe import ENCODE_BYTES, byte_bpe, text_slices
from barloom.llm.common import in_order, parts_for, table, text_bytes

WINDOW = 2048
#: Penalties, in ids: a cut after a sentence inside a document, and one inside a sentence.
SENTENCE_PENALTY, INNER_PENALTY = 2, 10
#: Sentences longer than this may also be cut inside, every STRIDE ids.
LONG_SENTENCE, STRIDE = 24, 12
#: Ids that a task holds at a time; the last window of each such run is carried over to the next.
RUN_IDS = 1 << 20
#: Text in each range of documents.  Each range ends in one window that is not full.
RANGE_BYTES = 8 << 20

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def best_cuts(positions: list[int], penalties: list[int], window: int) -> list[int]:
    """Indices of the cuts of the cheapest division, first and last position included.

    Neighbouring positions must be at most a window apart.
    """
    cost = [0] * len(positions)
    came = [0] * len(positions)
    queue = deque([0])
    for j in range(1, len(positions)):
        low = positions[j] - window
        while positions[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        came[j] = i
        c = cost[j] = cost[i] + window + penalties[j]
        while queue and cost[queue[-1]] >= c:
            queue.pop()
        queue.append(j)
    cuts = [len(positions) - 1]
    while cuts[-1]:
        cuts.append(came[cuts[-1]])
    return cuts[::-1]


def candidates(ids: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which the stream may be cut, from 0 to its length, and their penalties."""
    penalty = np.full(len(ids) + 1, -1, np.int64)
    penalty[1:][sentence_end[ids]] = SENTENCE_PENALTY
    penalty[0] = penalty[len(ids)] = 0
    penalty[doc_ends] = 0
    at = np.flatnonzero(penalty >= 0)
    stride = min(STRIDE, window)
    for i in np.flatnonzero(np.diff(at) > min(LONG_SENTENCE, window)):
        inner = np.arange(at[i] + stride, at[i + 1], stride)
        penalty[inner] = INNER_PENALTY
    at = np.flatnonzero(penalty >= 0)
    return at, penalty[at]


class _Run:
    """Packs one stream of documents, a bounded run of ids at a time."""

    def __init__(self, sentence_end: np.ndarray, window: int, first_sequence: int, run_ids: int = RUN_IDS):
        self.sentence_end, self.window, self.sequence, self.run_ids = sentence_end, window, first_sequence, run_ids
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple] = []  # (doc_id, ids of it packed already, ids of it in this run, all its ids)
        self.held = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.docs.append((doc_id, 0, len(ids), len(ids)))
        self.held += len(ids)

    def full(self) -> bool:
        return self.held >= self.run_ids

    def flush(self, last: bool) -> pa.RecordBatch | None:
        if not self.held:
            return None
        ids = np.concatenate(self.ids)
        ends = np.cumsum([d[2] for d in self.docs])
        at, penalty = candidates(ids, ends, self.sentence_end, self.window)
        cuts = at[best_cuts(at.tolist(), penalty.tolist(), self.window)]
        if not last and len(cuts) > 2:
            cuts = cuts[:-1]
        stop = cuts[-1]
        edges = np.unique(np.concatenate([cuts, ends[ends < stop]]))
        lo, hi = edges[:-1], edges[1:]
        doc = np.searchsorted(ends, lo, "right")
        window = np.searchsorted(cuts, lo, "right") - 1
        packed = np.array([d[1] for d in self.docs])
        begin = ends - np.array([d[2] for d in self.docs])
        raw = ids.astype("<u4")
        out = pa.record_batch([
            pa.array([self.docs[i][0] for i in doc.tolist()], pa.int64()),
            pa.array(packed[doc] + lo - begin[doc]), pa.array(hi - lo),
            pa.array(np.array([d[3] for d in self.docs])[doc]),
            pa.array(self.sequence + window), pa.array(lo - cuts[window]),
            pa.array([raw[a:b].tobytes() for a, b in zip(lo.tolist(), hi.tolist())], pa.binary()),
        ], names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
        self.sequence += len(cuts) - 1
        k = int(np.searchsorted(ends, stop, "right"))
        rest = self.docs[k:]
        if rest:
            d, cut = rest[0], int(stop - begin[k])
            rest = [(d[0], d[1] + cut, d[2] - cut, d[3]), *rest[1:]]
        self.docs, self.ids, self.held = rest, [ids[stop:]], len(ids) - int(stop)
        return out


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, window: int = WINDOW, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Pieces of sequences of at most ``window`` ids: doc_id, start (the document's ids before the
    piece), length, doc_tokens (with the end id), sequence_id, offset (in the sequence) and ids
    (little-endian unsigned 32-bit).  Documents keep the order of doc_id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = parts_for(text_bytes(docs), range_bytes)
    ordered = in_order(docs, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer_path)
        runner = _Run(bpe.sentence_ends(), window, TaskContext.get().partitionId() << 32)
        end = np.array([end_id], np.int32)
        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id").to_pylist()
            for lo, hi in text_slices(texts, ENCODE_BYTES):
                ids, at = bpe.encode(texts.slice(lo, hi - lo))
                for i in range(lo, hi):
                    runner.add(doc_ids[i], np.concatenate([ids[at[i - lo] : at[i - lo + 1]], end]))
                if runner.full():
                    yield runner.flush(False)
        if (out := runner.flush(True)) is not None:
            yield out

    return ordered.mapInArrow(run, PIECES)


def op2(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return digest(pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

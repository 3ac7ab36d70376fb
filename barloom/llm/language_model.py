"""Language-model scores from a weighted backoff automaton over word bigrams, at corpus size.

The states of the automaton are the words (and the start of a text).  A bigram that occurs in the
training texts is an arc ``h -> w`` of weight ``log10((c(hw) + MU p(w)) / (c(h) + MU))``; every state
has one failure arc of weight ``log10(MU / (c(h) + MU))`` to the empty state, whose arcs are the words:
``p(w) = c(w) / (N + N1)``, and ``N1 / (N + N1)`` for all unknown words as one type, with N1 the number
of words seen once (Good and Turing's estimate of what is new).  Weights of a state's arcs, with
what the failure arc passes on, sum to 1.  A text is traversed once from left to right: each word
follows its arc, or the failure arc and then the word's own.

The state after a word is known from the word alone, so all steps of a text are taken at once.

The automaton is never in one place.  Texts are dealt out in parts by doc_id and text.  Each part sends its
*different* words and bigrams, with its own training counts, to the buckets of their 64-bit hashes;
a bucket adds the parts' counts up and answers each part with the totals of what it asked, in its order.  A
part then knows all arcs and failure weights that its texts can use, and traverses them.  So every
n-gram of the corpus is counted once, traffic is one row for each (part, bucket), and a word that is
everywhere costs one entry for each part.

Cases: null and empty texts are a single end token; repeated rows are scored each (and learned each);
null doc_ids have remainder 0, so they are held out; without training texts the base score is
log10(0.1/0.1) and every word unknown; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.llm.byte_bpe import text_slices
from barloom.llm.common import parts_for, remainder, table, text_bytes
from barloom.llm.words import NOT_SPACE, mix, word_hashes

MU = 20.0
PART_BYTES = 8 << 20
FOLDS, HELD_OUT = 10, 0

#: The lowest two bits of a key tell what it counts.
BIGRAM, WORD, START = np.uint64(0), np.uint64(1), np.uint64(2)
_HIGH = np.uint64(0xFFFFFFFFFFFFFFFC)
_END_WORD, _START_WORD = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


class _Tokens:
    """The tokens of a part's texts: keys of words, of contexts and of bigrams."""

    def __init__(self, texts: pa.Array):
        parts, counts = [], []
        for lo, hi in text_slices(texts):
            words, at = word_hashes(texts.slice(lo, hi - lo), NOT_SPACE, unicode_lower=False)
            parts.append(np.insert(words, at[1:], _END_WORD))
            counts.append(np.diff(at) + 1)
        words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.length = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.start = np.cumsum(self.length) - self.length
        before = np.empty_like(words)
        before[1:] = words[:-1]
        before[self.start] = _START_WORD
        self.word = mix(words) & _HIGH | WORD
        self.bigram = mix(before * np.uint64(0x9E3779B97F4A7C15) + words) & _HIGH | BIGRAM
        self.doc = np.repeat(np.arange(len(self.length)), self.length)


_START_KEY = (mix(np.array([_START_WORD])) & _HIGH | START)[0]


def _coded(tokens: _Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys, ascending, and the index of each word's and each bigram's key in them."""
    keys, index = np.unique(np.concatenate([tokens.word, tokens.bigram, [_START_KEY]]), return_inverse=True)
    n = len(tokens.word)
    return keys, index[:n], index[n : 2 * n]


def pack_ascending(keys: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as differences of as few bytes each as the greatest needs."""
    if not len(keys):
        return b""
    gaps = np.diff(keys)
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    return bytes([width]) + keys[:1].tobytes() + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_ascending(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.uint64)
    width = raw[0]
    gaps = np.frombuffer(raw, np.uint8, offset=9).reshape(-1, width)
    wide = np.zeros((len(gaps), 8), np.uint8)
    wide[:, :width] = gaps
    return np.cumsum(np.concatenate([np.frombuffer(raw, "<u8", 1, 1), wide.view("<u8").ravel()]))


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts as one byte each, the large ones after them."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return small.tobytes() + counts[counts >= 255].astype("<u8").tobytes()


def unpack_counts(raw: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw, "<u8", offset=n).astype(np.int64)
    return counts


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.Table]]:
    """Tables of the rows of one key each, from batches sorted by it."""
    now, held = None, []
    for batch in batches:
        keys = batch.column(key).to_numpy()
        edge = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(edge, edge[1:]):
            if a == b:
                continue
            if now is not None and keys[a] != now:
                yield now, pa.Table.from_batches(held)
                held = []
            now = int(keys[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield now, pa.Table.from_batches(held)


def _ask(parts: int):
    edges = np.array([(b << 64) // parts for b in range(1, parts)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _groups(batches, "part"):
            tokens = _Tokens(rows.column("text").combine_chunks())
            keys, word, bigram = _coded(tokens)
            train = ~rows.column("held_out").to_numpy()
            learned = train[tokens.doc]
            counts = np.bincount(word[learned], minlength=len(keys)) + np.bincount(bigram[learned], minlength=len(keys))
            counts[np.searchsorted(keys, _START_KEY)] = train.sum()
            cut = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
            for b, (lo, hi) in enumerate(zip(cut, cut[1:])):
                yield pa.record_batch([pa.array([b], pa.int64()), pa.array([part], pa.int64()), pa.array([pack_ascending(keys[lo:hi])], pa.binary()), pa.array([pack_counts(counts[lo:hi])], pa.binary())], names=["bucket", "part", "keys", "counts"])

    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for bucket, rows in _groups(batches, "bucket"):
        parts = rows.column("part").to_pylist()
        keys = [unpack_ascending(r) for r in rows.column("keys").to_pylist()]
        counts = [unpack_counts(r, len(k)) for r, k in zip(rows.column("counts").to_pylist(), keys)]
        different, index = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(index, np.concatenate(counts).astype(np.float64), len(different)).astype(np.int64)
        words = total[(different & np.uint64(3)) == WORD]
        tokens, types, once = int(words.sum()), int((words > 0).sum()), int((words == 1).sum())
        edge = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).tolist()
        for part, a, b in zip(parts, edge, edge[1:]):
            yield pa.record_batch([pa.array([x], t) for x, t in ((part, pa.int64()), (bucket, pa.int64()), (pack_counts(total[index[a:b]]), pa.binary()), (b - a, pa.int64()), (tokens, pa.int64()), (types, pa.int64()), (once, pa.int64()))],
                                  names=["part", "bucket", "counts", "n", "tokens", "types", "once"])


def _traverse(mu: float):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        if not docs.num_rows:
            return schema.empty_table()
        tokens = _Tokens(docs.column("text").combine_chunks())
        keys, word, bigram = _coded(tokens)
        answers = answers.sort_by("bucket")
        counts = np.concatenate([unpack_counts(r, n) for r, n in zip(answers.column("counts").to_pylist(), answers.column("n").to_pylist())])
        total, types, once = (sum(answers.column(c).to_pylist()) for c in ("tokens", "types", "once"))
        of_word, of_bigram = counts[word], counts[bigram]
        context = np.empty_like(of_word)
        context[1:] = of_word[:-1]
        context[tokens.start] = counts[np.searchsorted(keys, _START_KEY)]
        once = max(once, 1)
        own = np.where(of_word > 0, of_word, once) / (total + once)
        arc = np.log10((of_bigram + mu * own) / (context + mu))
        failure = np.log10(mu / (context + mu)) + np.log10(own)
        step = np.where(of_bigram > 0, arc, failure)
        base = np.log10((of_word + 0.1) / (total + 0.1 * (types + 1)))
        return pa.table([
            docs.column("doc_id"), docs.column("held_out"), pa.array(tokens.length), pa.array(np.add.reduceat((of_word > 0).astype(np.int64), tokens.start)),
            pa.array(np.full(len(tokens.length), total)), pa.array(np.add.reduceat(base, tokens.start)), pa.array(np.add.reduceat(step, tokens.start)),
        ], schema=schema)

    return run


def scores(docs: DataFrame, mu: float = MU, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = parts_for(text_bytes(docs), part_bytes)
    dealt = docs.withColumn("held_out", remainder(F.col("doc_id"), FOLDS) == HELD_OUT).withColumn("part", F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(parts)))
    dealt = dealt.repartition(parts, "part")
    asked = dealt.sortWithinPartitions("part").mapInArrow(_ask(parts), "bucket long, part long, keys binary, counts binary")
    answered = asked.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_answer, "part long, bucket long, counts binary, n long, tokens long, types long, once long")
    return dealt.groupBy("part").cogroup(answered.groupBy("part")).applyInArrow(
        _traverse(mu), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op6(spark: SparkSession, folder: str) -> DataFrame:
    return scores(table(spark, folder, "documents"))

"""Language of texts: a bidirectional gated recurrent network over bytes.

Each direction is a layer of ``HIDDEN`` gated recurrent units whose inputs are bytes; a position's label scores are a linear map of
both directions' states there, and softmax makes them probabilities.  A document's probabilities are the mean over all its positions that
hold a letter (a byte of A-Z, a-z or beyond ASCII).  Texts are read whole, in windows of ``WINDOW`` bytes: within one the state runs
through, and windows of a batch run side by side, longest first, so that a step works on those that are not over yet.

Learning (numpy, backpropagation through time, Adam) takes windows of ``TRAIN_BYTES`` bytes from a bounded sample: of each of the ``MOST_LANGS`` most
frequent languages about ``DOCS_EACH`` doc_ids, by a hash, and ``WINDOWS_EACH`` windows of each.  Windows are dealt out in ``SHARDS``; in each of
``ROUNDS`` rounds every shard learns from the common weights in a Spark task, and the shards' weights are averaged.

Cases: a null text and one without any letter are ``und`` with score 0; a text shorter than a training window is repeated to fill it; rows with a null
doc_id aren't learned from but are labelled; of several texts of one doc_id and language the least is learned; without anything to learn from all
texts are ``und``; bytes that no sample had keep their first weights; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barloom.llm.byte_bpe import text_slices
from barloom.llm.common import remainder, table, written
from barloom.llm.words import flat_bytes, mix

HIDDEN, WINDOW = 16, 256
TRAIN_BYTES, BATCH, RATE = 96, 64, 0.01
DOCS_EACH, WINDOWS_EACH, MOST_LANGS = 600, 3, 256
SHARDS, ROUNDS = 4, 4
#: Bytes of text that run side by side.
SIDE_BYTES = 512 << 10
HELD_OUT, FOLDS = 2, 4
UNKNOWN = "und"

LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: Weights by name; the first axis of the recurrent ones is the direction.  Gates stand in the order update, reset, candidate.
Weights = dict[str, np.ndarray]


def first_weights(labels: int, hidden: int = HIDDEN, seed: int = 5) -> Weights:
    rng = np.random.default_rng(seed)
    small = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[-2])).astype(np.float32)
    return {"byte": 8 * small(2, 256, 3 * hidden), "state": small(2, hidden, 3 * hidden), "out": small(2, hidden, labels), "bias": np.zeros(labels, np.float32)}


def _gates(pre: np.ndarray, hu: np.ndarray, hidden: int) -> tuple[np.ndarray, np.ndarray]:
    """Update and reset gates side by side, and the candidate; ``pre`` is overwritten."""
    gates = pre[..., : 2 * hidden]
    gates += hu[..., : 2 * hidden]
    gates *= 0.5
    np.tanh(gates, out=gates)
    gates += 1
    gates *= 0.5
    candidate = pre[..., 2 * hidden :]
    candidate += gates[..., hidden:] * hu[..., 2 * hidden :]
    np.tanh(candidate, out=candidate)
    return gates, candidate


class Reader:
    """The network's weights as reading needs them: gate by gate, so that every step works on whole arrays; the halves of
    ``sigmoid(x) = (1 + tanh(x / 2)) / 2`` stand in the weights."""

    def __init__(self, w: Weights):
        hidden = w["state"].shape[1]
        by_gate = lambda x: np.ascontiguousarray(x.reshape(2, -1, 3, hidden).transpose(2, 0, 1, 3))
        half = np.array([0.5, 0.5, 1.0], np.float32)[:, None, None, None]
        self.table = (by_gate(w["byte"]) * half).reshape(-1, hidden)  # gate, direction, byte
        self.state = by_gate(w["state"]) * np.float32(0.5)
        self.out, self.bias, self.hidden = w["out"], w["bias"], hidden
        self.rows = (256 * np.arange(6)).reshape(3, 2, 1)

    def scores(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Label scores (logits), a row for each label, of every byte of windows [start, start + size) that cover ``data`` in order."""
        labels, n, steps = len(self.bias), len(start), int(size.max(initial=0))
        order = np.argsort(-size, kind="stable")
        first, last = start[order], start[order] + size[order] - 1
        running = np.searchsorted(-size[order], -np.arange(steps), "left")  # windows longer than each step
        found = np.empty((steps, 2, n, labels), np.float32)
        state = np.zeros((2, n, self.hidden), np.float32)
        for t, m in enumerate(running.tolist()):
            h = state[:, :m]
            codes = np.stack([data[first[:m] + t], data[last[:m] - t]])
            pre = self.table.take(codes + self.rows, 0)
            told = np.matmul(h, self.state)
            gates, candidate = pre[:2], pre[2]
            gates += told[:2]
            np.tanh(gates, out=gates)
            gates += 1
            told[2] *= gates[1]
            candidate += told[2]
            np.tanh(candidate, out=candidate)
            candidate -= h
            candidate *= gates[0]
            candidate *= 0.5
            h += candidate
            np.matmul(h, self.out, out=found[t, :, :m])
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        column = np.repeat(place, size)
        within = np.arange(len(data)) - np.repeat(start, size)
        rest = np.repeat(size, size) - 1 - within
        found = found.reshape(-1, labels)
        both = found.take(2 * n * within + column, 0)
        both += found.take(2 * n * rest + n + column, 0)
        both += self.bias
        return np.ascontiguousarray(both.T)


def softmax(x: np.ndarray, axis: int = -1) -> np.ndarray:
    x = np.exp(x - x.max(axis, keepdims=True))
    x /= x.sum(axis, keepdims=True)
    return x


def windows_of(offsets: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the windows of texts; none crosses a text's end."""
    length = np.diff(offsets)
    count = -(-length // window)
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = np.repeat(offsets[:-1], count) + within * window
    return start, np.minimum(window, np.repeat(offsets[1:], count) - start)


def label_texts(network: Reader, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The most probable label of each text, and its probability; -1 and 0 for a text without letters."""
    has = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    label, score = np.full(len(texts), -1), np.zeros(len(texts))
    for lo, hi in text_slices(texts, SIDE_BYTES):
        data, offsets = flat_bytes(texts.slice(lo, hi - lo))
        total = np.zeros((hi - lo, len(network.bias)))
        for at in range(0, len(data), 4 * SIDE_BYTES):  # a very long text goes in stretches of whole windows
            edge = np.clip(offsets, at, at + 4 * SIDE_BYTES) - at
            piece = data[at : at + 4 * SIDE_BYTES]
            p = softmax(network.scores(piece, *windows_of(edge)), 0)
            p *= LETTER[piece]
            doc = np.repeat(np.arange(hi - lo), np.diff(edge))
            for k in range(len(p)):
                total[:, k] += np.bincount(doc, p[k], hi - lo)
        mass = total.sum(1)
        good = has[lo:hi] & (mass > 0)
        best = total.argmax(1)
        label[lo:hi][good] = best[good]
        score[lo:hi][good] = (total.max(1)[good] / mass[good]).clip(0, 1)
    return label, score


def loss_and_gradient(w: Weights, data: np.ndarray, label: np.ndarray) -> tuple[float, Weights]:
    """Mean cross-entropy over the letters of windows of equal size (windows x bytes), and its gradient by backpropagation through time."""
    n, size = data.shape
    hidden = w["state"].shape[1]
    codes = np.stack([data.T, data.T[::-1]])  # direction, step, window
    h = np.zeros((size + 1, 2, n, hidden), np.float32)
    hus, gates, candidates = [], [], []
    for t in range(size):
        pre = np.stack([w["byte"][0][codes[0, t]], w["byte"][1][codes[1, t]]])
        hu = np.matmul(h[t], w["state"])
        g, c = _gates(pre, hu, hidden)
        h[t + 1] = h[t] + g[..., :hidden] * (c - h[t])
        hus.append(hu[..., 2 * hidden :])
        gates.append(g)
        candidates.append(c)
    ahead, back = h[1:, 0], h[1:, 1][::-1]  # by position
    p = softmax(ahead @ w["out"][0] + back @ w["out"][1] + w["bias"])
    counts = LETTER[data.T]
    total = max(1, int(counts.sum()))
    at = np.arange(n)
    loss = float(-np.log(np.maximum(p[:, at, label], 1e-12))[counts].sum() / total)
    p[:, at, label] -= 1
    p *= counts[..., None] / np.float32(total)
    flat = p.reshape(size * n, -1)
    grad = {"bias": flat.sum(0), "out": np.stack([ahead.reshape(size * n, -1).T @ flat, back.reshape(size * n, -1).T @ flat]), "state": np.zeros_like(w["state"]), "byte": np.zeros_like(w["byte"])}
    from_out = np.stack([p @ w["out"][0].T, (p @ w["out"][1].T)[::-1]], axis=1)  # step, direction, window, unit
    carried = np.zeros((2, n, hidden), np.float32)
    inner = np.empty((size, 2, n, 3 * hidden), np.float32)
    for t in range(size - 1, -1, -1):
        d = carried + from_out[t]
        z, r, c, before = gates[t][..., :hidden], gates[t][..., hidden:], candidates[t], h[t]
        dc = d * z * (1 - c * c)
        dz = d * (c - before) * z * (1 - z)
        dr = dc * hus[t] * r * (1 - r)
        through = np.concatenate([dz, dr, dc * r], axis=-1)
        inner[t] = np.concatenate([dz, dr, dc], axis=-1)
        grad["state"] += np.matmul(before.transpose(0, 2, 1), through)
        carried = d * (1 - z) + np.matmul(through, w["state"].transpose(0, 2, 1))
    for side in range(2):
        np.add.at(grad["byte"][side], codes[side].ravel(), inner[:, side].reshape(size * n, -1))
    return loss, grad


class Adam:
    def __init__(self, w: Weights, rate: float = RATE):
        self.w, self.rate, self.t = w, rate, 0
        self.first, self.second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))

    def step(self, grad: Weights) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        for k, g in grad.items():
            g = g * min(1.0, 1.0 / max(norm, 1e-12))
            self.first[k] += 0.1 * (g - self.first[k])
            self.second[k] += 0.001 * (g * g - self.second[k])
            self.w[k] -= (self.rate * (self.first[k] / (1 - 0.9**self.t)) / (np.sqrt(self.second[k] / (1 - 0.999**self.t)) + 1e-8)).astype(np.float32)


def _packed_weights(w: Weights) -> bytes:
    return b"".join(w[k].astype("<f4").tobytes() for k in sorted(w))


def _unpacked(raw: bytes, like: Weights) -> Weights:
    flat, out, at = np.frombuffer(raw, "<f4"), {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _training_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of the sampled texts, at places that a hash of the doc_id gives."""
    for batch in batches:
        label, shard, order, raw = [], [], [], []
        for doc_id, of, text in zip(batch.column("doc_id").to_pylist(), batch.column("label").to_pylist(), batch.column("text").cast(pa.large_string())):
            data = text.as_py().encode()
            if not LETTER[np.frombuffer(data, np.uint8)].any():
                continue
            data = data if len(data) >= TRAIN_BYTES else (data + b" ") * (TRAIN_BYTES // (len(data) + 1) + 1)
            keys = mix(np.uint64(doc_id & (1 << 64) - 1) + np.arange(WINDOWS_EACH, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).tolist()
            for key in keys[: max(1, len(data) // TRAIN_BYTES)]:
                at = key % (len(data) - TRAIN_BYTES + 1)
                label.append(of)
                shard.append(key >> 32 & 0xFFFF)
                order.append(key >> 1)
                raw.append(data[at : at + TRAIN_BYTES])
        yield pa.record_batch([pa.array(label, pa.int32()), pa.array([s % SHARDS for s in shard], pa.int32()), pa.array(order, pa.int64()), pa.array(raw, pa.binary())], names=["label", "shard", "place", "bytes"])


def _learner(sent, seed: int):
    """One shard's pass over its windows, from the common weights."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        rows = pa.Table.from_batches(found)
        data = np.frombuffer(b"".join(rows["bytes"].to_pylist()), np.uint8).reshape(rows.num_rows, TRAIN_BYTES)
        shard, label = rows["shard"].to_numpy(), rows["label"].to_numpy()
        for s in np.unique(shard).tolist():
            own = np.flatnonzero(shard == s)
            learner = Adam({k: v.copy() for k, v in sent.value.items()})
            order = np.random.default_rng(seed * 1000 + s).permutation(own)
            for at in range(0, len(order), BATCH):
                some = order[at : at + BATCH]
                learner.step(loss_and_gradient(learner.w, data[some], label[some])[1])
            yield pa.record_batch([pa.array([len(own)], pa.int64()), pa.array([_packed_weights(learner.w)], pa.binary())], names=["n", "weights"])

    return run


def fit(docs: DataFrame, docs_each: int = DOCS_EACH, rounds: int = ROUNDS) -> tuple[list[str], Weights]:
    """The learned languages and the network's weights, from documents (doc_id, text, lang)."""
    spark = docs.sparkSession
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("doc_id is not null and text is not null and lang is not null")
    langs = sorted(known.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(MOST_LANGS).collect())
    if not langs:
        return [], first_weights(1)
    numbers = spark.createDataFrame([(r["lang"], k, r["count"]) for k, r in enumerate(langs)], "lang string, label int, n long")
    some = known.join(F.broadcast(numbers), "lang").where(F.pmod(F.xxhash64("doc_id", F.lit(12)), F.col("n")) < docs_each)
    some = some.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    windows = written(some.mapInArrow(_training_windows, "label int, shard int, place long, bytes binary"), "language-windows")
    w = first_weights(len(langs))
    for k in range(rounds):
        sent = spark.sparkContext.broadcast(w)
        dealt = windows.repartition(SHARDS, "shard").sortWithinPartitions("shard", "place", "label", "bytes")
        learned = dealt.mapInArrow(_learner(sent, k), "n long, weights binary").collect()  # one row of fixed size for each shard
        n = sum(r["n"] for r in learned)
        if n:
            parts = [(r["n"] / n, _unpacked(bytes(r["weights"]), w)) for r in sorted(learned, key=lambda r: bytes(r["weights"]))]
            w = {name: sum(share * part[name] for share, part in parts).astype(np.float32) for name in w}
    return [r["lang"] for r in langs], w


def predict(docs: DataFrame, model: tuple[list[str], Weights]) -> DataFrame:
    """doc_id, lang_pred and score of every document."""
    langs, sent = model[0], docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, network = sent.value[0], Reader(sent.value[1])
        names = pa.array([*langs, UNKNOWN])
        for batch in batches:
            label, score = label_texts(network, batch.column("text"))
            yield pa.record_batch([batch.column("doc_id"), names.take(pa.array(np.where(label < 0, len(langs), label))), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if not langs:
        return texts.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id, FOLDS) == HELD_OUT


def op12(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

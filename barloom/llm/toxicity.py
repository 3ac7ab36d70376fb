"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its words, pairs of neighbours, and pairs with one or two words between
them, hashed into ``2**BITS`` places; each counts once in a text.  Every coordinate has its own
learning rate, and L1 keeps only coordinates that pull.

Learning takes a sample of the different labelled doc_ids, by a hash, of ``MOST_ROWS`` on average
if there are more (so the list of learned doc_ids that is broadcast is bounded too).  It is spread
over Spark: the rows are dealt out in shards of about ``SHARD_ROWS`` rows, each shard is one learner
(``EPOCHS`` passes in a fixed order), and the learners' weights are averaged.
What is broadcast for scoring are the averaged weights that are not zero: at most ``2**BITS`` of them, 12 bytes each.

Cases: a null text is an empty one; a text without words gets the intercept's score; labelled
doc_ids without a document, and labels that are null, are ignored; a label that is given twice counts once, and of
several texts of one doc_id the least is learned; without any labels all scores are 0; null doc_ids are scored; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.llm.byte_bpe import text_slices
from barloom.llm.common import remainder, table
from barloom.llm.words import mix, word_hashes

BITS = 20
SKIPS = (1, 2, 3)
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 0.1
EPOCHS, SHARD_ROWS, MOST_ROWS = 3, 8_192, 40_000
THRESHOLD = 0.3
HELD_OUT, FOLDS = 2, 4


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature places of all texts, and the number of the text that each belongs to."""
    words, at = word_hashes(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(at))
    places, docs = [words >> np.uint64(64 - BITS)], [doc]
    for gap in SKIPS:
        same = doc[gap:] == doc[:-gap]
        pair = mix(words[:-gap] * np.uint64(0x9E3779B97F4A7C15) + words[gap:] + np.uint64(gap))[same]
        places.append(pair >> np.uint64(64 - BITS))
        docs.append(doc[gap:][same])
    return np.concatenate(places).astype(np.int64), np.concatenate(docs)


class Ftrl:
    """FTRL-proximal with per-coordinate rates; the last coordinate is the intercept (without L1)."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.size = size

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        pull = np.where(at == self.size, 0.0, L1)
        w = -(z - np.sign(z) * pull) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)
        return np.where(np.abs(z) <= pull, 0.0, w)

    def learn(self, at: np.ndarray, label: float) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = p - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _learners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard, held = None, []

    def result():
        model = Ftrl(1 << BITS)
        rng = np.random.default_rng(11)
        for _ in range(EPOCHS):
            for i in rng.permutation(len(held)).tolist():
                model.learn(*held[i])
        every = np.arange(model.size + 1)
        w = model.weights(every)
        some = np.flatnonzero(w)
        return pa.record_batch([pa.array(some), pa.array(w[some])], names=["place", "weight"])

    for batch in batches:
        texts = batch.column("text")
        shards, labels = batch.column("shard").to_numpy(), batch.column("label").to_numpy()
        for lo, hi in text_slices(texts):
            places, docs = features(texts.slice(lo, hi - lo))
            order = np.argsort(docs, kind="stable")
            places, edge = places[order], np.searchsorted(docs[order], np.arange(hi - lo + 1))
            for i in range(hi - lo):
                if held and shards[lo + i] != shard:
                    yield result()
                    held = []
                shard = shards[lo + i]
                own = np.unique(places[edge[i] : edge[i + 1]]).astype(np.int32)
                held.append((np.append(own, np.int32(1 << BITS)), float(labels[lo + i])))
    if held:
        yield result()


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights of the averaged model (the intercept's place is ``2**BITS``), from ``labels`` (doc_id, label)."""
    labels = labels.where("doc_id is not null and label is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
    labels = labels.distinct()
    n = labels.count()
    if n > most_rows:
        labels = labels.where(F.pmod(F.xxhash64("doc_id", F.lit(41)), F.lit(n)) < most_rows)
    shards = max(1, -(-min(n, most_rows) // SHARD_ROWS))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(labels), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))
    rows = rows.repartition(shards, "shard").sortWithinPartitions("shard", F.xxhash64("doc_id"), "doc_id", "text", "label").select("shard", "text", "label")
    learned = rows.mapInArrow(_learners, "place long, weight double")
    mean = learned.groupBy("place").agg((F.sum("weight") / shards).alias("weight")).where("weight <> 0").toArrow()
    place, weight = mean["place"].to_numpy(), mean["weight"].to_numpy()
    order = np.argsort(place)
    return place[order].astype(np.int64), weight[order].astype(np.float64)


def _scores(texts: pa.Array, table: np.ndarray, known: bool) -> np.ndarray:
    """Scores of a column of texts; ``table`` has the weights by place."""
    out = np.zeros(len(texts))
    for lo, hi in text_slices(texts) if known else ():
        at, doc = features(texts.slice(lo, hi - lo))
        pulls = np.flatnonzero(table[at])
        both = np.unique(doc[pulls] << (BITS + 1) | at[pulls])
        total = np.bincount(both >> (BITS + 1), table[both & ((1 << BITS + 1) - 1)].astype(np.float64), hi - lo) + table[1 << BITS]
        out[lo:hi] = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
    return out


def _sent(spark: SparkSession, model: tuple[np.ndarray, np.ndarray]):
    """A function for tasks that gives the table of weights from what is broadcast."""
    held = spark.sparkContext.broadcast((model[0].astype(np.int32), model[1].astype(np.float32)))
    made: list[np.ndarray] = []

    def table() -> np.ndarray:
        if not made:
            out = np.zeros((1 << BITS) + 1, np.float32)
            out[held.value[0]] = held.value[1]
            made.append(out)
        return made[0]

    return table


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id and score (0 to 1) of every document."""
    weights, known = _sent(docs.sparkSession, model), len(model[0]) > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = weights()
        for batch in batches:
            yield pa.record_batch([batch.column("doc_id"), pa.array(_scores(batch.column("text"), table, known))], names=["doc_id", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, score double")


def clean(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, whose score is below the threshold, as op7 predicts, or that have
    no words at all; rows are judged one by one, so a doc_id may be null or repeated.  Texts alone go to Python, and a boolean comes back."""
    weights, known = _sent(docs.sparkSession, model), len(model[0]) > 0

    @F.arrow_udf("boolean")
    def passes(column: pa.Array) -> pa.Array:
        keep = _scores(column, weights(), known) < threshold
        high = np.flatnonzero(~keep)
        for lo, hi in text_slices(texts := column.take(pa.array(high))):
            keep[high[lo:hi]] = np.diff(word_hashes(texts.slice(lo, hi - lo))[1]) == 0
        return pa.array(keep)

    return docs.where(passes(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def fit_on_folds(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    known = labels.select("doc_id", F.col("toxic").alias("label")).where(remainder(F.col("doc_id"), FOLDS) != HELD_OUT)
    return fit(docs, known)


def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fit_on_folds(docs, table(spark, folder, "labels"))
    return score(docs, model).select("doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

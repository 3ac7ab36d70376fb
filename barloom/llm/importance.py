"""Importance resampling towards a target distribution, over hashed runs of words.

A feature is a run of up to ``order`` consecutive words; its bucket is the crc32 of its bytes, words joined by one
space, modulo ``buckets``.  Counts over all texts of the source and of the target give each bucket a gain, the
logarithm of the ratio of both smoothed shares; a document's weight is the sum of its features' gains.  With Gumbel noise
of a hash of the document's id added, the highest scores are a sample without replacement.

Batch concatenation: the texts of a batch, with every byte that belongs to no word blanked, are joined with a separator
between them; one regex pass finds all words, ``searchsorted`` in the documents' offsets tells the document of each, a
run whose last word lies in another document than its first is masked, and ``bincount`` gives counts or weights.
A task sends one row for each bucket that it has seen, and the gains that are broadcast are ``buckets`` integers.

Ranks come from ranges of the scores: each is numbered by itself and starts after the sizes of those before it.

Cases: a null text is an empty one and has no features (weight 0); documents without a doc_id are drawn like others, with the hash of an empty id, and come
after all others in ties; repeated rows are documents of their own; an empty source or target leaves smoothed shares; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from barloom.llm.byte_bpe import text_slices
from barloom.llm.common import table, written
from barloom.llm.words import flat_bytes

ORDER, BUCKETS = 1, 10_000
LEAST_WORDS, DRAWN_PERCENT, SEED = 20, 10, 2024
#: Ranked documents of one range.
RANGE_ROWS = 500_000

_SEPARATOR = 0x0A
_WORD = re.compile(rb"[^ \n]+")
#: Upper-case A-Z become lower case, bytes outside words become blanks.
_WORDS_ONLY = bytes(b + 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


class _Buckets(dict):
    """Buckets of features; short ones are remembered."""

    def __init__(self, buckets: int, most: int = 200_000):
        super().__init__()
        self.buckets, self.most = buckets, most

    def __missing__(self, feature: bytes) -> int:
        found = zlib.crc32(feature) % self.buckets
        if len(feature) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[feature] = found
        return found


def features(texts: pa.Array, order: int, known: _Buckets) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs of up to ``order`` words of a column of texts, and the number of the text that each belongs to."""
    data, offsets = flat_bytes(texts)
    n = len(texts)
    begins = offsets[:-1] + np.arange(n)  # a separator stands before each text but the first
    joined = np.full(len(data) + max(0, n - 1), _SEPARATOR, np.uint8)
    joined[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = np.frombuffer(data.tobytes().translate(_WORDS_ONLY), np.uint8)
    words = _WORD.findall(joined.tobytes())
    inside = (joined != 0x20) & (joined != _SEPARATOR)
    head = inside.copy()
    head[1:] &= ~inside[:-1]
    doc = np.searchsorted(begins, np.flatnonzero(head), "right") - 1
    found, docs = [np.fromiter(map(known.__getitem__, words), np.int64, len(words))], [doc]
    for run in range(2, order + 1):
        first = np.flatnonzero(doc[run - 1 :] == doc[: len(doc) - run + 1])
        found.append(np.fromiter((known[b" ".join(words[i : i + run])] for i in first.tolist()), np.int64, len(first)))
        docs.append(doc[first])
    return np.concatenate(found), np.concatenate(docs)


def bucket_counts(docs: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket: ``buckets`` integers, whatever the data."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros(buckets, np.int64), _Buckets(buckets)
        for batch in batches:
            for lo, hi in text_slices(texts := batch.column("text")):
                total += np.bincount(features(texts.slice(lo, hi - lo), order, known)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed share in the target over that in the source, rounded down."""
    s, t, buckets = source.astype(np.float64), target.astype(np.float64), len(source)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, order: int = ORDER) -> DataFrame:
    """doc_id, n_words, n_features and weight of every document."""
    held = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, known = held.value, _Buckets(len(held.value))
        for batch in batches:
            texts, n = batch.column("text"), np.zeros(batch.num_rows, np.int64)
            weight, first_order = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for lo, hi in text_slices(texts):
                bucket, doc = features(texts.slice(lo, hi - lo), order, known)
                n[lo:hi] = np.bincount(doc, minlength=hi - lo)
                weight[lo:hi] = np.bincount(doc, gain[bucket].astype(np.float64), hi - lo)  # sums of integers: exact
                words = n[lo:hi] if order == 1 else np.bincount(features(texts.slice(lo, hi - lo), 1, known)[1], minlength=hi - lo)
                first_order[lo:hi] = words
            yield pa.record_batch([batch.column("doc_id"), pa.array(first_order), pa.array(n), pa.array(weight.astype(np.int64))], names=["doc_id", "n_words", "n_features", "weight"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of Gumbel noise by a hash of the id, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000.0)


def ranked(rows: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Adds the ``rank`` of each row (doc_id, score), from 1: higher scores first, ties to smaller doc_ids, rows without one last."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    parts = max(1, -(-rows.count() // range_rows))
    ranged = written(rows.repartitionByRange(parts, *order).withColumn("__range", F.spark_partition_id()), "importance-ranges")
    sizes = {r["__range"]: r["count"] for r in ranged.groupBy("__range").count().collect()}  # a number for each range
    starts, start = [], 0
    for k in sorted(sizes):
        starts.append((k, start))
        start += sizes[k]
    starts = rows.sparkSession.createDataFrame(starts, "__range int, __start long")
    within = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return ranged.join(F.broadcast(starts), "__range").withColumn("rank", F.col("__start") + within).drop("__range", "__start")


def resample(docs: DataFrame, target: DataFrame, order: int = ORDER, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = DRAWN_PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; rank is null for those that aren't drawn.

    Of the documents with ``least_words`` words or more, ``percent`` of a hundred are drawn (rounded down).  ``target``: rows with a text.
    """
    gain = gains(bucket_counts(docs, order, buckets), bucket_counts(target, order, buckets))
    scored = written(weigh(docs, gain, order).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "importance-scores")
    able = F.col("n_words") >= least_words
    drawn = percent * scored.where(able).count() // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    chosen = ranked(scored.where(able)).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return chosen.select(*columns, "rank").unionByName(scored.where(~able).select(*columns, F.lit(None).cast("long").alias("rank")))


def op13(spark: SparkSession, folder: str) -> DataFrame:
    return resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


#: crc32 stands byte by byte over each different word; ``steps`` is its table, made by its rule.
ORACLE = r"""
WITH steps AS (SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384))) AS t),
words AS (
  SELECT 0 AS side, doc_id AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS word FROM documents
  UNION ALL SELECT 1, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) FROM benchmark),
places AS (
  SELECT word, xor(list_reduce([4294967295] || list_transform(range(octet_length(encode(word))), lambda i: CAST('0x' || substr(hex(encode(word)), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket FROM (SELECT DISTINCT word FROM words), steps),
placed AS (SELECT side, id, bucket FROM words JOIN places USING (word)),
totals AS (SELECT count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM placed),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(count(*) FILTER (side = 1) AS DOUBLE) + 1) * (s + 10000) / ((CAST(count(*) FILTER (side = 0) AS DOUBLE) + 1) * (t + 10000)))) AS BIGINT) AS gain
  FROM placed, totals GROUP BY bucket, s, t),
weights AS (SELECT id AS doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM placed JOIN gains USING (bucket) WHERE side = 0 GROUP BY id),
scores AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM documents d LEFT JOIN weights USING (doc_id)),
able AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scores WHERE n_features >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank FROM scores s LEFT JOIN able USING (doc_id)
"""

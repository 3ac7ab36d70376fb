"""Hard negatives of anchors among all vectors: for each of an anchor's positives, the best rows of other labels in a window of scores.

Components become ``floor(scale * x)``; a row's score is its exact integer inner product with the anchor.  An anchor's
positives are its best other rows of the same label; a negative of a positive is a row of another label with
``low * positive <= 100 * score <= high * positive``.

Both searches are a vertical scan (BOND).  Candidates stand in blocks by columns.  An anchor reads a block's columns in
descending order of its own components' magnitude, ``STEP`` at a time, and adds them to the candidates' partial scores; what the
columns not yet read can add at least and at most follows from each column's minimum and maximum in the block.  A candidate whose bounds meet no
window (for positives: whose upper bound lies below the best ones so far) leaves the block's bitmap.  What is left
after the last column has its exact score, and the best of each window are kept.

Spark deals anchors and candidates out in tiles: a tile holds a group of anchors, and one group of candidates streams through it, sorted
by label.  The search of positives deals by label, so candidates travel to the anchors of their own label alone.  Vectors travel
as 16-bit integers where all components fit.  Tiles return their best rows, which Spark merges.

Cases: rows with a null vec_id, label or vector, an empty vector, or with any null or non-finite component (also after scaling) take no part; zero
vectors do; only vectors of an anchor's length are its candidates; repeated rows are rows of their own, and an anchor's copies may be its positives; ties
go by vec_id; a negative positive score has an empty window; scores beyond 64 bits count as the largest or smallest ones; fewer positives or negatives than
asked for are all returned; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from barloom.llm.common import parts_for, spread_join, table, written
from barloom.llm.words import flat_bytes

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90
ANCHOR_EVERY, LABELS = 100, 10
#: Columns read between two looks at the bitmap, candidates of a block, bytes of anchors (as doubles) and candidates of a tile.
STEP, BLOCK, ANCHOR_BYTES, CANDIDATES = 8, 4096, 32 << 20, 65_536
MOST_PARTITIONS = 10_000
#: Integers below it are exact in double precision.
EXACT = 2.0**53
MOST = (1 << 63) - 1

_TILE = ["size", "part", "q", "c", "kind", "wide"]


class _Block:
    """Candidates by columns, with each column's least and greatest value."""

    def __init__(self, rows: np.ndarray, vec_id: np.ndarray, label: np.ndarray, x: np.ndarray):
        self.rows, self.vec_id, self.label = rows, vec_id, label
        self.columns = np.ascontiguousarray(x.T)
        self.least, self.most = self.columns.min(1), self.columns.max(1)
        self.size = max(-self.least.min(), self.most.max())


def _exact(a: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Scores in Python's integers, held within 64 bits."""
    ints = [int(v) for v in a]
    return np.array([min(MOST, max(-MOST, sum(p * int(v) for p, v in zip(ints, column)))) for column in columns.T], np.int64)


def scan(a: np.ndarray, block: _Block, bitmap: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the candidates in the bitmap whose score lies in one of the windows."""
    alive = np.flatnonzero(bitmap)
    if not len(alive) or not len(low):
        return alive[:0], np.zeros(0, np.int64)
    if np.abs(a).sum() * block.size >= EXACT:
        score = _exact(a, block.columns[:, alive])
        there = ((score >= low[:, None]) & (score <= high[:, None])).any(0)
        return alive[there], score[there]
    order = np.argsort(-np.abs(a), kind="stable")
    ends = np.stack([a * block.least, a * block.most])[:, order]
    below, above = (np.append(np.cumsum(e[::-1])[::-1], 0.0) for e in (ends.min(0), ends.max(0)))  # of the columns from a place on
    partial = np.zeros(len(alive))
    for at in range(0, len(a), STEP):
        dims = order[at : at + STEP]
        columns = block.columns[dims]
        partial += a[dims] @ (columns if len(alive) == columns.shape[1] else columns[:, alive])
        end = min(at + STEP, len(a))
        there = np.zeros(len(alive), bool)
        for lo, hi in zip(low, high):
            there |= (partial + above[end] >= lo) & (partial + below[end] <= hi)
        if not there.all():
            alive, partial = alive[there], partial[there]
            if not len(alive):
                break
    return alive, partial.astype(np.int64)


class _Best:
    """The best rows so far, at most k: higher scores first, then smaller vec_ids and rows."""

    def __init__(self, k: int):
        self.k, self.found = k, np.zeros((3, 0), np.int64)

    def add(self, score: np.ndarray, vec_id: np.ndarray, row: np.ndarray) -> None:
        both = np.concatenate([self.found, np.stack([score, vec_id, row])], axis=1)
        self.found = both[:, np.lexsort((both[2], both[1], -both[0]))[: self.k]]

    @property
    def least(self) -> int:
        """The score that a further row must reach."""
        return int(self.found[0, -1]) if self.found.shape[1] == self.k else -MOST


class _Anchors:
    """The anchors of a tile; each has windows with their best rows."""

    def __init__(self, positives: int, negatives: int, low: int, high: int):
        self.k, self.low, self.high, self.positives = negatives, low, high, positives
        self.held: list[tuple] = []

    def add(self, part: pa.RecordBatch, x: np.ndarray) -> None:
        row, vec_id, label = (part.column(c).to_numpy() for c in ("row", "vec_id", "label"))
        scores = part.column("positives").to_pylist()
        for i in range(len(x)):
            if scores[i] is None:
                windows = [(-MOST, MOST, _Best(self.positives))]
            else:
                windows = [(max(-MOST, -(-self.low * p // 100)), min(MOST, self.high * p // 100), _Best(self.k)) for p in scores[i]]
            self.held.append((int(row[i]), int(vec_id[i]), int(label[i]), x[i], windows, scores[i] is None))

    def meet(self, block: _Block) -> None:
        for row, _, label, a, windows, same in self.held:
            bitmap = (block.label == label) & (block.rows != row) if same else block.label != label
            low = np.array([max(lo, best.least) for lo, _, best in windows], np.int64)
            high = np.array([hi for _, hi, _ in windows], np.int64)
            at, score = scan(a, block, bitmap, low[low <= high], high[low <= high])
            for lo, (_, hi, best) in zip(low.tolist(), windows):
                inside = (score >= lo) & (score <= hi)
                if inside.any():
                    best.add(score[inside], block.vec_id[at[inside]], block.rows[at[inside]])

    def results(self) -> pa.RecordBatch:
        anchor, window, found = [], [], []
        for row, _, _, _, windows, _ in self.held:
            for j, (_, _, best) in enumerate(windows):
                n = best.found.shape[1]
                anchor.append(np.full(n, row))
                window.append(np.full(n, j))
                found.append(best.found)
        score, vec_id, other = np.concatenate([np.zeros((3, 0), np.int64), *found], axis=1)
        return pa.record_batch([pa.array(np.concatenate([np.zeros(0, np.int64), *anchor])), pa.array(np.concatenate([np.zeros(0, np.int64), *window])), pa.array(score), pa.array(vec_id), pa.array(other)], names=["anchor", "window", "score", "vec_id", "row"])


def _matrix(vectors: pa.Array, size: int, wide: int) -> np.ndarray:
    return flat_bytes(vectors)[0].view("<f8" if wide else "<i2").reshape(len(vectors), size).astype(np.float64)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Slices of batches in which the tile, the kind and the width stay the same."""
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in _TILE])
        edges = (np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist()
        for lo, hi in zip([0, *edges], [*edges, batch.num_rows]):
            if hi > lo:
                yield tuple(keys[:, lo].tolist()), batch.slice(lo, hi - lo)


def _tiles(positives: int, negatives: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tile, waiting = None, None, []

        def close() -> None:
            nonlocal tile, waiting
            if waiting:
                size, *_, kind, wide = now
                part = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                waiting = []
                if kind == 0:
                    tile = tile or _Anchors(positives, negatives, low, high)
                    tile.add(part, _matrix(part.column("vector"), size, wide))
                elif tile is not None:
                    tile.meet(_Block(*(part.column(c).to_numpy() for c in ("row", "vec_id", "label")), _matrix(part.column("vector"), size, wide)))

        for key, rows in _runs(batches):
            if key != now:
                close()
                if now is not None and key[:4] != now[:4] and tile is not None:
                    yield tile.results()
                    tile = None
                now = key
            waiting.append(rows)
            if sum(r.num_rows for r in waiting) >= BLOCK:
                close()
        close()
        if tile is not None:
            yield tile.results()

    return run


def _packed(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.floor(batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            edge = np.concatenate([[0], np.cumsum(batch.column("size").to_numpy())]).tolist()
            raw, wide = [], []
            for a, b in zip(edge, edge[1:]):
                fits = bool(np.abs(flat[a:b]).max() < 1 << 15)
                wide.append(0 if fits else 1)
                raw.append(flat[a:b].astype("<i2" if fits else "<f8").tobytes())
            yield pa.record_batch([*(batch.column(c) for c in ("row", "vec_id", "label", "size")), pa.array(wide, pa.int32()), pa.array(raw, pa.binary())], names=["row", "vec_id", "label", "size", "wide", "vector"])

    return run


def _some(n: Column | int) -> Column:
    return F.pmod(F.xxhash64("row", F.lit(5)), F.lit(n) if isinstance(n, int) else n)


def _every(n: Column | int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), (F.lit(n) if isinstance(n, int) else n).cast("long") - 1))


def _groups(anchors: Column, size: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(anchors * size * 8 / ANCHOR_BYTES))


def _search(asked: DataFrame, offered: DataFrame, tiles: int, *limits: int) -> DataFrame:
    """anchor (its row), window, score, vec_id and row of the tiles' best candidates."""
    columns = [*_TILE, "row", "vec_id", "label", "vector", "positives"]
    dealt = asked.withColumn("kind", F.lit(0)).select(*columns).unionByName(offered.withColumn("kind", F.lit(1)).withColumn("positives", F.lit(None).cast("array<long>")).select(*columns))
    dealt = dealt.repartition(min(MOST_PARTITIONS, max(12, tiles)), *_TILE[:4]).sortWithinPartitions(*_TILE, "label")
    return dealt.mapInArrow(_tiles(*limits), "anchor long, window long, score long, vec_id long, row long")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: float = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ``vectors``: vec_id, embedding, label; ``is_anchor``: of vec_id and label."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * F.lit(float(scale))) < F.lit(float("inf"))))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & finite
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")).where(F.coalesce(good, F.lit(False)))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("size", F.size("embedding").cast("long"))
    packed = written(rows.select("row", "vec_id", "label", "size", "embedding").mapInArrow(_packed(float(scale)), "row long, vec_id long, label long, size long, wide int, vector binary"), "negatives-vectors")
    limits = (positives, negatives, low, high)

    kinds = packed.groupBy("label", "size").agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("anchors"))
    kinds = written(kinds, "negatives-labels")
    n = kinds.agg(F.sum("n")).first()[0] or 0
    each = min(CANDIDATES, max(BLOCK, n // 64))
    kinds = kinds.withColumn("qs", _groups(F.col("anchors"), F.col("size"))).withColumn("cs", F.ceil(F.col("n") / each))
    placed = spread_join(packed, kinds.where("anchors > 0"), ["label", "size"], F.col("n"), n).withColumn("part", F.col("label"))
    asked = placed.where(is_anchor).withColumn("q", _some(F.col("qs"))).withColumn("c", _every(F.col("cs"))).withColumn("positives", F.lit(None).cast("array<long>"))
    offered = placed.withColumn("c", _some(F.col("cs"))).withColumn("q", _every(F.col("qs")))
    tiles = kinds.where("anchors > 0").agg(F.sum(F.col("qs") * F.col("cs"))).first()[0] or 0
    best = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "vec_id", "row")
    own = _search(asked, offered, tiles, *limits).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives)
    own = written(own.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("vec_id").alias("id"), "score"))).alias("own")), "negatives-positives")  # at most ``positives`` each

    anchors = packed.where(is_anchor).join(own.withColumnRenamed("anchor", "row"), "row").withColumn("positives", F.col("own.score")).withColumn("part", F.lit(0).cast("long"))
    sizes = kinds.groupBy("size").agg(_groups(F.sum("anchors"), F.col("size")).alias("qs"), F.ceil(F.sum("n") / each).alias("cs"), F.sum("n").alias("n"))
    tiles = sizes.agg(F.sum(F.col("qs") * F.col("cs"))).first()[0] or 0
    asked = spread_join(anchors, sizes, ["size"], F.col("n"), n).withColumn("q", _some(F.col("qs"))).withColumn("c", _every(F.col("cs")))
    offered = spread_join(packed, sizes, ["size"], F.col("n"), n).withColumn("part", F.lit(0).cast("long")).withColumn("c", _some(F.col("cs"))).withColumn("q", _every(F.col("qs")))
    best = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), "vec_id", "row")
    found = _search(asked, offered, tiles, *limits).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    of = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.posexplode("own").alias("window", "positive"))
    joined = found.join(of, [found["anchor"] == of["anchor"], found["window"] == of["window"]])
    return joined.select("anchor_id", F.col("positive.id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("positive.score").alias("positive_score"), F.col("score").alias("negative_score"))


def op11(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return mine(table(spark, folder, "embeddings").withColumn("label", moved), F.col("vec_id") % ANCHOR_EVERY == 0)


ORACLE = """
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM good a JOIN good b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) <= 10
"""

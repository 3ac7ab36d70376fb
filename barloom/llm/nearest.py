"""Nearest neighbours of a stated query set among all vectors, by a block matrix join.

Queries are dealt out in groups that fit a task, candidates in groups too; each (query group,
candidate group) is one tile, and candidates stream through it in blocks.  A block's products with
the queries are taken on int8 quantised vectors (one scale for each vector; sums of ``EXACT`` products of
int8 are exact in float32, and longer vectors are summed in slices of it).  With x = x' + e for each vector,
``|x.y - x'.y'| <= |e_x| |y| + |x'| |e_y|``, which bounds the squared distance from both sides.  A
pair survives if its lower bound reaches the query's k-th best so far, or the k-th upper bound of
the block; survivors' distances are recomputed from the original vectors in double precision and
kept in a heap for each query.  Spark merges the tiles' heaps, first where they are.

The result is exact, since only pairs that the bounds exclude are left out: a bound that overflows excludes nothing, and a distance
whose squares overflow or vanish is taken from scaled differences.

Cases: vectors that are null, zero or hold null or non-finite components take no part; only vectors
of a query's length are its candidates; if there are fewer than k, all are returned; equal distances
go by vec_id; candidates with the query's vec_id are its own; equal query rows are one query; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappush, heappushpop

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from barloom.llm.common import parts_for, table, written
from barloom.llm.embedding_dedup import usable

K, EVERY = 10, 100
#: Bytes of queries (as doubles) that a tile holds, least number of candidates of a tile, and candidates of one block product.
QUERY_BYTES, CANDIDATE_GROUP, BLOCK = 4 << 20, 8192, 2048
#: Partitions at most; each works off its tiles one after another.
MOST_PARTITIONS = 10_000
#: Products of int8 whose sum is exact in float32.
EXACT = 1024


class _Quantised:
    def __init__(self, x: np.ndarray):
        self.x = x
        scale = np.maximum(np.abs(x).max(1) / 127, 1e-300)
        self.q = np.rint(x / scale[:, None]).astype(np.int8)
        near = self.q * scale[:, None]
        self.scale, self.norm = scale, np.sqrt((x * x).sum(1))
        self.error, self.near_norm = np.sqrt(((x - near) ** 2).sum(1)), np.sqrt((near * near).sum(1))


def _vectors(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 vectors."""
    out = np.zeros((len(a), len(b)))
    for lo in range(0, a.shape[1], EXACT):
        out += a[:, lo : lo + EXACT].astype(np.float32) @ b[:, lo : lo + EXACT].astype(np.float32).T
    return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, in double precision."""
    gap = a - b
    out = np.sqrt((gap * gap).sum(1))
    odd = np.flatnonzero(~np.isfinite(out) | (out < 1e-140))
    if len(odd):
        half = a[odd] / 2 - b[odd] / 2  # the difference itself may overflow
        size = np.abs(half).max(1)
        size[size == 0] = 1.0
        half /= size[:, None]
        out[odd] = np.sqrt((half * half).sum(1)) * size * 2
    return out


class _Tile:
    """The queries of a tile and their heaps of (-distance, -vec_id)."""

    def __init__(self, ids: list[int], rows: list[bytes], k: int):
        self.ids, self.k = np.array(ids), k
        with np.errstate(over="ignore", invalid="ignore"):
            self.queries = _Quantised(_vectors(rows))
        self.heaps: list[list] = [[] for _ in ids]
        self.worst = np.full(len(ids), np.inf)

    def meet(self, ids: np.ndarray, rows: list[bytes]) -> None:
        with np.errstate(over="ignore", invalid="ignore"):
            self._meet(ids, rows)

    def _meet(self, ids: np.ndarray, rows: list[bytes]) -> None:
        c, q = _Quantised(_vectors(rows)), self.queries
        for at in range(0, len(self.ids), 256):
            s = slice(at, at + 256)
            dot = _products(q.q[s], c.q) * q.scale[s, None] * c.scale[None, :]
            squared = q.norm[s, None] ** 2 + c.norm[None, :] ** 2
            off = 2 * (q.error[s, None] * c.norm[None, :] + q.near_norm[s, None] * c.error[None, :]) + 1e-9 * squared
            squared = squared - 2 * dot
            own = self.ids[s, None] == ids[None, :]
            limit = self.worst[s] ** 2
            if len(ids) > self.k + 1:
                upper = np.where(own, np.inf, squared + off)
                limit = np.minimum(limit, np.partition(upper, self.k - 1, axis=1)[:, self.k - 1])
            row, col = np.nonzero(~(squared - off > limit[:, None] * (1 + 1e-12)) & ~own)
            for lo in range(0, len(row), 65536):
                r, o = row[lo : lo + 65536] + at, col[lo : lo + 65536]
                exact = distances(q.x[r], c.x[o])
                for i, distance, name in zip(r.tolist(), exact.tolist(), ids[o].tolist()):
                    heap = self.heaps[i]
                    if len(heap) < self.k:
                        heappush(heap, (-distance, -name))
                    else:
                        heappushpop(heap, (-distance, -name))
                    if len(heap) == self.k:
                        self.worst[i] = -heap[0][0]

    def results(self) -> pa.RecordBatch:
        rows = [(i, -n, -d) for i, heap in enumerate(self.heaps) for d, n in heap]
        at, name, distance = zip(*rows) if rows else ((), (), ())
        return pa.record_batch([pa.array(self.ids[list(at)] if at else [], pa.int64()), pa.array(name, pa.int64()), pa.array(distance, pa.float64())], names=["query_id", "vec_id", "score"])


def _tiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tile = None, None
        ids: list[int] = []
        rows: list[bytes] = []

        def close():
            nonlocal tile, ids, rows
            if tile is not None and ids:
                tile.meet(np.array(ids), rows)
            ids, rows = [], []

        for batch in batches:
            for key, kind, vec_id, raw in zip(*(batch.column(c).to_pylist() for c in ("tile", "kind", "vec_id", "vector"))):
                if key != now:
                    close()
                    if tile is not None:
                        yield tile.results()
                    now, tile = key, None
                if kind == 1 and tile is None:
                    tile = _Tile(ids, rows, k) if ids else False
                    ids, rows = [], []
                if tile is False:  # no queries here
                    tile, now, ids, rows = None, key, [], []
                    continue
                ids.append(vec_id)
                rows.append(raw)
                if kind == 1 and len(ids) == BLOCK:
                    close()
        close()
        if tile:
            yield tile.results()

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("embedding")
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        edge = np.concatenate([[0], np.cumsum(batch.column("size").to_numpy())]).tolist()
        yield pa.record_batch([batch.column("vec_id"), batch.column("size"), pa.array([flat[a:b].tobytes() for a, b in zip(edge, edge[1:])], pa.binary())], names=["vec_id", "size", "vector"])


def nearest(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (Euclidean distance) of each query's k nearest."""
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    packed = written(vectors.withColumn("size", F.size("embedding").cast("long")).mapInArrow(_packed, "vec_id long, size long, vector binary"), "nearest-vectors")
    queries = packed.where(is_query).distinct()
    n, longest = packed.agg(F.count("*"), F.max("size")).first()
    candidate_groups = parts_for(n, max(CANDIDATE_GROUP, n // 4096), 1)
    query_groups = parts_for(queries.count() * 8 * (longest or 1), QUERY_BYTES)
    name = lambda q, c: F.concat_ws("/", "size", q, c)
    some = lambda n: F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.withColumn("q", some(query_groups)).withColumn("c", every(candidate_groups)).withColumn("kind", F.lit(0))
    offered = packed.withColumn("c", some(candidate_groups)).withColumn("q", every(query_groups)).withColumn("kind", F.lit(1))
    columns = [name("q", "c").alias("tile"), "kind", "vec_id", "vector"]
    dealt = asked.select(*columns).union(offered.select(*columns)).repartition(min(MOST_PARTITIONS, max(12, candidate_groups * query_groups)), "tile").sortWithinPartitions("tile", "kind")
    found = dealt.mapInArrow(_tiles(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op10(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % EVERY == 0)

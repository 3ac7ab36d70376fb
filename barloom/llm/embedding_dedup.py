"""Embedding near-duplicates: pairs of vectors of one label with cosine similarity 0.98 or more.

For unit vectors, cosine >= s means squared distance <= 2 - 2s.  Vectors are rotated (a fixed
random rotation spreads structured energy evenly) and split into blocks of about 8 dimensions.  By
the pigeonhole principle, a pair within the whole budget is within the proportional budget
``(2 - 2s) * block / dimensions`` in one block at least, so the union of the blocks' range joins
loses no pair.

A block's range join is an equality join on the cells of a grid over its first coordinates, three of them and up to
``MOST_GRID_DIMS`` in large labels, each label by its own size:
a vector stands in its own cell, and visits those later cells that its range reaches, so two
vectors meet once.  The blocks' coordinates alone travel to the cells.  Vectors that have another one within the block's budget there, few beside near-duplicates,
follow and meet again: a pair is handled in the first block that admits it, and its
cosine is computed from the original vectors in double precision.  Equal vectors (told by 128 bits) are one node; cells with very many vectors are
dealt out in blocks.  Tasks return counts and spanning links instead of pairs.

Cases: vectors that are null, zero or hold null or non-finite components, and those with a null
label, link with nothing; components may be as large or small as doubles are; vectors of different lengths don't link; a repeated vec_id counts as two
vectors; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.llm.common import spread_join, table, written
from barloom.llm.graph import blocked, group_counts, link_report, local_labels, met

SIMILARITY = 0.98
BLOCK_DIMS, GRID_DIMS, MOST_GRID_DIMS = 8, 3, 5
#: Vectors of a label beyond which its grid has one coordinate more, and another for each time that it is four times as large.
GRID_LABEL = 65_536
#: Coordinates of a block that meet in one task; in larger cells blocks of them meet in pairs.
CELL_ROWS = 32_768
#: Width of a cell in radii of a block's range.
CELL = 2.5


def rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(17).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def blocks_of(d: int) -> list[tuple[int, int]]:
    n = max(1, d // BLOCK_DIMS)
    edges = np.linspace(0, d, n + 1).round().astype(int).tolist()
    return list(zip(edges, edges[1:]))


def usable(column) -> F.Column:
    """Neither null nor empty nor zero, and all components finite."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(column.isNotNull() & (F.size(column) > 0) & finite & F.exists(column, lambda x: x != 0), F.lit(False))


def grid_dims(n: F.Column) -> F.Column:
    """Coordinates of the grid of a label with n vectors: they bound how many cells a vector visits, whatever its label's size."""
    return sum(((n > GRID_LABEL * 4**k).cast("int") for k in range(MOST_GRID_DIMS - GRID_DIMS)), F.lit(GRID_DIMS))


def _unit(raw: list[bytes], kind) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as doubles, each times a power of two so that squares neither overflow nor vanish, and scaled to length 1."""
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])
    return x, x / np.sqrt((x * x).sum(1, keepdims=True))


def _cells(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, grid = batch.column("size").to_numpy(), batch.column("grid").to_numpy()
            for d, g in np.unique(np.stack([size, grid]), axis=1).T.tolist():
                part = batch.filter(pa.array((size == d) & (grid == g)))
                for lo in range(0, part.num_rows, 2048):
                    yield _cell_rows(part.slice(lo, 2048), d, similarity, g)

    return run


def _cell_rows(part: pa.RecordBatch, d: int, similarity: float, grid: int) -> pa.RecordBatch:
    x = part.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    turned = _unit([v.tobytes() for v in x], x.dtype)[1] @ rotation_of(d)
    where, names, blocks, homes, places = [], [], [], [], []
    for b, (lo, hi) in enumerate(blocks_of(d)):
        radius = np.sqrt((2 - 2 * similarity) * (hi - lo) / d) * (1 + 1e-9) + 1e-12
        width = CELL * radius
        at = turned[:, lo : lo + min(grid, hi - lo)]
        own = np.floor(at / width).astype(np.int64)
        first, last = np.floor((at - radius) / width).astype(np.int64), np.floor((at + radius) / width).astype(np.int64)
        base = 2 * (int(1 / width) + 3)
        code = lambda cell: np.dot(cell + base // 2, base ** np.arange(cell.shape[1])[::-1])  # noqa: B023, E731  ascending as tuples
        home = code(own)
        block = turned[:, lo:hi].astype("<f4")
        for step in product((0, 1), repeat=at.shape[1]):
            to = first + np.array(step)
            name = code(to)
            goes = np.flatnonzero((to <= last).all(1) & (name >= home))
            where.append(goes)
            names.append(name[goes])
            blocks.append(np.full(len(goes), b))
            homes.append((name == home)[goes])
            places += [v.tobytes() for v in block[goes]]
    take = pa.array(np.concatenate(where))
    return pa.record_batch([
        part.column("label").take(take), pa.array(np.full(len(take), d)), pa.array(np.concatenate(blocks)), pa.array(np.concatenate(names)), pa.array(np.concatenate(homes)), part.column("node").take(take), pa.array(places, pa.binary()),
    ], names=["label", "size", "block", "cell", "home", "node", "place"])


def _edges(group: np.ndarray) -> list[tuple[int, int]]:
    edge = np.append(np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])), len(group)).tolist()
    return [(x, y) for x, y in zip(edge, edge[1:]) if y - x > 1]


def _same(s: slice, *columns: np.ndarray) -> np.ndarray:
    """Which rows of a slice agree with which of all rows; keys are hashes, so different cells may share one."""
    out = np.ones((len(columns[0][s]), len(columns[0])), bool)
    for c in columns:
        if c[0] != c[-1] or (c != c[0]).any():
            out &= c[s, None] == c[None, :]
    return out


def _company(similarity: float):
    """The rows that have another one in their block's range, with tolerance for single precision."""
    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        group, home, cell, block, label, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("group", "home", "cell", "block", "label", "size"))
        places = batch.column("place").to_pylist()
        some = []
        for x, y in _edges(group):
            z = np.frombuffer(b"".join(places[x:y]), "<f4").reshape(y - x, -1).astype(np.float64)
            budget = (2 - 2 * similarity) * z.shape[1] / size[x] + 1e-5
            sq, here = (z * z).sum(1), np.zeros(y - x, bool)
            step = max(16, min(256, (1 << 22) // (y - x)))
            for at in range(0, y - x, step):
                s = slice(at, at + step)
                near = (sq[s, None] + sq[None, :] - 2 * (z[s] @ z.T) <= budget) & (home[x:y][s, None] | home[x:y][None, :])
                near &= _same(s, cell[x:y], block[x:y], label[x:y])
                near[np.arange(near.shape[0]), at + np.arange(near.shape[0])] = False
                here[s] |= near.any(1)
                here |= near.any(0)
            some.append(x + np.flatnonzero(here))
        if not some:
            return None
        take = pa.array(np.concatenate(some))
        names = ["key", "label", "size", "block", "cell", "home", "node"]
        return pa.record_batch([batch.column(c).take(take) for c in names], names=names)

    return kernel


def _close(similarity: float, kind: str):
    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        names = ("group", "lo", "hi", "side", "node", "copies", "home", "cell", "block", "size", "label")
        group, lo, hi, side, node, copies, home, cell, block, size, label_of = (batch.column(c).to_numpy(zero_copy_only=False) for c in names)
        vectors = batch.column("embedding")
        out: list[list] = [[], [], []]
        for x, y in _edges(group):
            d, b = int(size[x]), int(block[x])
            flat = vectors.slice(x, y - x).flatten().to_numpy(zero_copy_only=False).astype(kind)
            original, unit = _unit([flat.tobytes()] if y - x == 1 else [v.tobytes() for v in flat.reshape(y - x, -1)], kind)
            turned = unit @ rotation_of(d)
            spans = blocks_of(d)
            budget = [(2 - 2 * similarity) * (q - p) / d * (1 + 1e-9) + 1e-12 for p, q in spans]
            p, q = spans[b]
            z = turned[:, p:q]
            sq = (z * z).sum(1)
            links, firsts, seconds = np.zeros(y - x, np.int64), [], []
            for at in range(0, y - x, 256):
                near = sq[at : at + 256, None] + sq[None, :] - 2 * (z[at : at + 256] @ z.T) <= budget[b] + 1e-9
                near &= home[x:y][at : at + 256, None] | home[x:y][None, :]
                near &= _same(slice(at, at + 256), cell[x:y], block[x:y], label_of[x:y])
                i, j = np.nonzero(near)
                i = i + at
                keep = (i < j) & (node[x:y][i] != node[x:y][j])
                if lo[x] != hi[x]:
                    keep &= side[x:y][i] != side[x:y][j]
                i, j = i[keep], j[keep]
                for k in range(0, len(i), 50_000):
                    a, c = i[k : k + 50_000], j[k : k + 50_000]
                    gap = (turned[a] - turned[c]) ** 2
                    first = np.ones(len(a), bool)
                    for e in range(b):
                        first &= gap[:, spans[e][0] : spans[e][1]].sum(1) > budget[e]
                    first &= gap[:, p:q].sum(1) <= budget[b]
                    a, c = a[first], c[first]
                    u, v = original[a], original[c]
                    cosine = (u * v).sum(1) / (np.sqrt((u * u).sum(1)) * np.sqrt((v * v).sum(1)))
                    linked = cosine >= similarity
                    firsts.append(a[linked])
                    seconds.append(c[linked])
            if not firsts:
                continue
            a, c = np.concatenate(firsts), np.concatenate(seconds)
            if not len(a):
                continue
            np.add.at(links, a, copies[x:y][c])
            np.add.at(links, c, copies[x:y][a])
            label = local_labels(y - x, a, c)
            has = np.flatnonzero(links)
            for values, new in zip(out, (node[x:y][has], node[x:y][label[has]], links[has])):
                values.append(new)
        if not out[0]:
            return None
        return pa.record_batch([pa.array(np.concatenate(v)) for v in out], names=["node", "label", "links"])

    return kernel


_ROTATIONS: dict[int, np.ndarray] = {}


def rotation_of(d: int) -> np.ndarray:
    if d not in _ROTATIONS:
        _ROTATIONS[d] = rotation(d)
    return _ROTATIONS[d]


def near_duplicates(vectors: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """A row for each vector: vec_id, n_links, component_id (smallest vec_id reachable), kept."""
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"), F.col("label").cast("long").alias("label"))
    good = usable(F.col("embedding")) & F.col("label").isNotNull()
    vectors = vectors.withColumn("name", F.when(good, F.xxhash64("label", "embedding"))).withColumn("other", F.when(good, F.xxhash64("embedding", F.lit(7), "label")))
    first = F.min(F.struct(F.col("vec_id").isNull().alias("none"), "vec_id")).alias("first")
    nodes = vectors.where("name is not null").groupBy("name", "other").agg(F.count("*").alias("copies"), first, F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    nodes = written(nodes.withColumn("size", F.size("embedding").cast("long")).withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    labels = nodes.groupBy("label").agg(F.count("*").alias("n")).withColumn("grid", grid_dims(F.col("n")).cast("long"))
    if (labels.agg(F.max("n")).first()[0] or 0) > GRID_LABEL:
        placed = spread_join(nodes.select("label", "size", "node", "embedding"), labels, ["label"], F.col("n"), nodes.count())
    else:  # every label has the same grid
        placed = nodes.withColumn("grid", F.lit(GRID_DIMS).cast("long"))
    cells = placed.select("label", "size", "node", "embedding", "grid").mapInArrow(_cells(similarity), "label long, size long, block long, cell long, home boolean, node long, place binary")
    cells = cells.withColumn("key", F.xxhash64("label", "size", "block", "cell"))
    pairs = blocked(cells, "key", "node", group_counts(cells, "key", "vector-cells"), CELL_ROWS)
    met_first = met(pairs, "key", _company(similarity), "key long, label long, size long, block long, cell long, home boolean, node long")
    company = written(met_first.distinct(), "vector-company")
    whole = company.join(nodes.select("node", "copies", "embedding"), "node")
    partial = met(blocked(whole, "key", "node", group_counts(company, "key", "vector-groups"), 1024), "key", _close(similarity, "<f4" if kind == "float" else "<f8"), "node long, label long, links long")
    report = link_report(nodes.select("node", "name", "other", "copies", "first"), partial, "vector")
    total = nodes.agg(F.sum("copies")).first()[0] or 0
    found = spread_join(vectors.select("vec_id", "name", "other").where("name is not null"), report, ["name", "other"], F.col("copies"), total)
    found = found.select("vec_id", "n_links", F.col("least.vec_id").alias("component_id"))
    alone = vectors.where("name is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op5(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))


#: Vectors that are null, zero or hold null or non-finite components stay alone.
ORACLE = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept FROM embeddings e
  JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = e.vec_id LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) k ON k.a = e.vec_id
"""

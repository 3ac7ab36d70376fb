"""Links between rows: pairs inside groups of any size, and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barloom.llm.common import spread_join, written

#: Rows of a group that meet in one task; a larger group is dealt out as pairs of such blocks.
BLOCK = 512


def blocked(rows: DataFrame, key: str, node: str, counts: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows of all groups with two rows or more, each group dealt out as pairs of blocks.

    ``counts`` (key, in_group) tells how many rows each group has; groups it doesn't name have one.
    Adds ``lo`` and ``hi`` (the blocks that meet) and ``side`` (0: the row is of block lo).  Every
    two rows of a group meet exactly once: inside their block, or where their blocks meet.
    """
    total = counts.agg(F.sum("in_group")).first()[0] or 0
    n = F.ceil(F.col("in_group") / block)
    rows = spread_join(rows, counts, [key], F.col("in_group"), total).withColumn("own", F.pmod(F.xxhash64(node, F.lit(7)), n))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    return rows.select(
        *[c for c in rows.columns if c not in ("own", "other", "in_group")],
        F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") > F.col("other")).cast("int").alias("side"))


def group_counts(rows: DataFrame, key: str, name: str) -> DataFrame:
    """key and in_group of all groups with two rows or more, as a table."""
    return written(rows.groupBy(key).agg(F.count("*").alias("in_group")).where("in_group > 1"), name)


def met(rows: DataFrame, key: str, kernel: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``kernel`` to batches of whole groups (key, lo, hi) of ``blocked`` rows; the batch has their number in ``group``."""
    dealt = rows.repartition(key, "lo", "hi").sortWithinPartitions(key, "lo", "hi", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = pa.Table.from_batches([batch])
            held = pa.concat_tables([rest, held]) if rest is not None else held
            names = [held.column(c).to_numpy() for c in (key, "lo", "hi")]
            change = np.zeros(held.num_rows, bool)
            for x in names:
                change[1:] |= x[1:] != x[:-1]
            starts = np.flatnonzero(change)
            if not len(starts):
                rest = held
                continue
            cut = int(starts[-1])
            yield from _apply(kernel, held.slice(0, cut), np.cumsum(change)[:cut])
            rest = held.slice(cut)
        if rest is not None and rest.num_rows:
            yield from _apply(kernel, rest, np.zeros(rest.num_rows, np.int64))

    return dealt.mapInArrow(run, schema)


def _apply(kernel, held: pa.Table, group: np.ndarray) -> Iterator[pa.RecordBatch]:
    whole = held.combine_chunks().to_batches()[0]
    columns = {name: whole.column(name) for name in whole.schema.names} | {"group": pa.array(group)}
    out = kernel(pa.RecordBatch.from_pydict(columns))
    if out is not None and out.num_rows:
        yield out


def pair_chunks(group: np.ndarray, lo: np.ndarray, hi: np.ndarray, side: np.ndarray, most: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (first, second) of rows that meet; the rows of a group stand together, side 0 first."""
    n = len(group)
    ends = np.searchsorted(group, group, "right")
    zero = np.searchsorted(group * 2 + side, group * 2 + 1)  # where side 1 of the group starts
    first = np.where(lo == hi, np.arange(n) + 1, zero)
    width = np.where((lo == hi) | (side == 0), ends - first, 0)
    total = np.cumsum(width)
    at = 0
    while at < n:
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + most, "right")))
        w = width[at:to]
        a = np.repeat(np.arange(at, to), w)
        b = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + np.repeat(first[at:to], w)
        if len(a):
            yield a, b
        at = to


def local_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of n nodes by the links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def components(edges: DataFrame, name: str) -> DataFrame:
    """node, component: the smallest node reachable, for every node of the edges (a, b).

    Large-star and small-star steps in turn (Kiveris et al., 2014) until nothing changes; after
    each round the edges, never more than at first, are a table in the shared folder.  A hub's edges stay
    where they are: the least neighbours of hubs are sent to them.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, f"{name}-edges")
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
        seen, n = mark, 2 * mark[0]
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
        large = spread_join(both, low, ["a"], F.col("n"), n).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = spread_join(large, low, ["a"], F.col("n"), n).select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
        edges = written(small.select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct(), f"{name}-edges")


def link_report(nodes: DataFrame, partial: DataFrame, name: str) -> DataFrame:
    """All columns of ``nodes`` (node, copies, first, ...) with n_links and ``least`` (the least ``first`` of the nodes reachable), from
    partial results (node, label: a node linked to it, links: rows linked to it that were counted)."""
    partial = written(partial, f"{name}-links")
    group = components(partial.select(F.col("node").alias("a"), F.col("label").alias("b")), name)
    links = partial.groupBy("node").agg(F.sum("links").alias("links"))
    joined = nodes.join(links, "node", "left").join(group, "node", "left").select(
        *nodes.columns, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    joined = written(joined, f"{name}-report")
    least = joined.groupBy("component").agg(F.min("first").alias("least"), F.count("*").alias("in_component"))
    alone = joined.join(least.where("in_component = 1"), "component", "left_semi").withColumn("least", F.col("first"))
    more = least.where("in_component > 1")
    total = more.agg(F.sum("in_component")).first()[0] or 0
    return written(spread_join(joined, more, ["component"], F.col("in_component"), total).drop("in_component").unionByName(alone).drop("component"), f"{name}-least")

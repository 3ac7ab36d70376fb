"""Content hashes of ordered rows of any number, and order-independent ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from barloom.functions.canonical import canonical_json
from barloom.operators.merge import numbered

#: Rows of a chunk, and children of a node.
CHUNK, FANOUT = 1024, 256


def ordered_hash(rows: DataFrame, group: str, order: list[str], columns: list[str], each: int = CHUNK, fanout: int = FANOUT) -> DataFrame:
    """rows and content_sha256 of each group: the root of a tree of hashes over its rows in order.

    A chunk is the SHA-256 of up to ``each`` rows as a list of canonical JSON objects (values as text); a node above is that of up to ``fanout`` digests
    below it, joined by commas; the root is the first node that stands alone, one level above the chunks at least.  Rows are numbered in ranges, so no
    task meets more than a range, a chunk or a node.  Rows without a group are left out; ``order`` should be unique inside a group.
    """
    kept = rows.where(F.col(group).isNotNull()).select(group, *[F.col(c).alias(f"__o{k}") for k, c in enumerate(order)], canonical_json(columns).alias("__row"))
    ranked = numbered(kept, [group, *[f"__o{k}" for k in range(len(order))], "__row"], "__n")
    starts = ranked.groupBy(group).agg(F.min("__n").alias("__first"), F.count("*").alias("__size"))
    placed = ranked.join(starts, group).withColumn("__at", F.floor((F.col("__n") - F.col("__first")) / each))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("__n", "__row"))), lambda x: x["__row"])
    chunks = placed.groupBy(group, "__at").agg(F.max("__size").alias("__size"), F.sha2(F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]")), 256).alias("digest"))
    nodes = chunks.withColumn("__last", F.floor((F.col("__size") - 1) / each)).withColumn("__done", F.lit(False))
    largest = (starts.agg(F.max("__size")).first()[0] or 1) - 1
    last = largest // each
    while True:
        above = F.floor(F.col("__at") / fanout)
        joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__at", "digest"))), lambda x: x["digest"]), ",")
        nodes = nodes.groupBy(group, above.alias("__at"), F.floor(F.col("__last") / fanout).alias("__last"), "__size", "__done").agg(F.when(F.first("__done"), F.min("digest")).otherwise(F.sha2(joined, 256)).alias("digest"))
        nodes = nodes.withColumn("__done", F.col("__last") == 0)
        last //= fanout
        if not last:
            return nodes.select(group, F.col("__size").alias("rows"), F.col("digest").alias("content_sha256"))


def multiset_digest(columns: list[str]) -> Column:
    """An aggregate that tells a multiset of rows, whatever their order: their number and the sums of the four quarters of each row's SHA-256."""
    digest = F.sha2(canonical_json(columns), 256)
    sums = [F.sum(F.conv(F.substring(digest, 16 * k + 1, 16), 16, 10).cast("decimal(20,0)").cast("decimal(38,0)")).cast("string") for k in range(4)]
    return F.concat_ws(":", F.count("*").cast("string"), *sums)

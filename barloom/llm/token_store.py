"""Content-addressed store of token ids.

A document's ids are cut into chunks where a rolling hash of the last ``SPAN`` ids hits a mask, so
equal passages give equal chunks wherever they stand.  A store is a folder with

* ``objects/``: one row for each *different* chunk: its digest and its ids (little-endian, 2 bytes
  each, or 4 for vocabularies over 65,536 ids); and the documents' recipes as they were cut;
* ``recipes/``: one row for each document, in ascending order of doc_id: the digests of its chunks,
  its number of ids, the crc32 of its ids, the ids before it in its range and the hash of all of these (a leaf); files hold consecutive ranges;
* ``manifest/``: the Merkle tree over the leaves.  Each node has at most ``FANOUT`` children and is the hash of theirs:
  levels 1 to 3 inside a range (the third is the range's root), the later ones over the ranges, up to one root;
* ``ranges/``: the documents and ids of each range, and the ids of all ranges before it.

Chunks go to partitions by digest; each task first drops the repeats that it remembers, so a chunk
that a third of all documents share costs one row for each task, and partitions are sorted, so the rest of the repeats
stand together.

Reading verifies the store and what is rebuilt from it: every chunk against its digest, every recipe against its leaf, all leaves
against the tree up to its root, the ranges against the tree's, and every document against the number of ids and the crc32 that were taken before it was
cut: ``read_documents`` puts its ids together from the chunks of its recipe, ``read_digests`` joins the checked chunks' crc32.

Cases: a null text is an empty one; an empty document has its end id alone; null doc_ids come
first; repeated rows give one recipe each; an empty table gives an empty store; other columns are
ignored.  Reading raises an error at the first difference.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from barloom.llm.byte_bpe import ENCODE_BYTES, byte_bpe, text_slices
from barloom.llm.common import HEAVY, in_order, new_path, parts_for, table, text_bytes, written
from barloom.llm.words import mix

#: Ids that the rolling hash covers; mean and greatest length of a chunk.
SPAN, MEAN_CHUNK, MAX_CHUNK = 8, 256, 2048
DIGEST_BYTES = 16
#: Text for each partition of chunks and each range of recipes; digests that a task remembers.
CHUNK_BYTES, RECIPE_BYTES, SEEN = 8 << 20, 64 << 20, 100_000
#: Children of a node of the tree.
FANOUT = 256
OBJECTS = "kind int, digest binary, ids binary, doc_id long, n_tokens long, crc long"
RECIPES = "doc_id long, n_tokens long, crc long, recipe binary, leaf binary, range_id long, row long, start_in_range long"
NODES = "level int, range_id long, node long, digest string, documents long, tokens long"
RANGES = "range_id long, first_doc long, last_doc long, documents long, tokens long, tokens_before long"
_CHUNK, _RECIPE = 0, 1


def chunk_ends(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ends of all chunks of a stream of documents that end at ``ends``."""
    if not len(ids):
        return ends[:0]
    gear = mix(ids.astype(np.uint64) + np.uint64(1))
    rolling = gear.copy()
    for k in range(1, SPAN):
        rolling[k:] += gear[:-k] << np.uint64(k)
    cut = (rolling >> np.uint64(20)) % np.uint64(MEAN_CHUNK) == 0
    cut[ends[ends > 0] - 1] = True
    at = np.flatnonzero(cut) + 1
    gaps = np.diff(at, prepend=0)
    long = np.flatnonzero(gaps > MAX_CHUNK)
    more = [np.arange(at[i] - gaps[i] + MAX_CHUNK, at[i], MAX_CHUNK) for i in long]
    return np.sort(np.concatenate([at, *more])) if more else at


def digest_of(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=DIGEST_BYTES).digest()


def leaf_of(recipe: bytes, doc_id: int | None, n_tokens: int, crc: int, start_in_range: int) -> bytes:
    return digest_of(f"{doc_id}/{n_tokens}/{crc}/{start_in_range}/".encode() + recipe)


def write_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, width: int = 2) -> None:
    """Encode all documents and write the store to ``path``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = text_bytes(docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, seen = byte_bpe(tokenizer_path), set()
        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id")
            for lo, hi in text_slices(texts, ENCODE_BYTES):
                ids, at = bpe.encode(texts.slice(lo, hi - lo))
                n = hi - lo
                full = np.insert(ids, at[1:], end_id)
                at = at + np.arange(n + 1)
                ends = chunk_ends(full, at[1:])
                raw, wide = full.astype(f"<u{width}").tobytes(), memoryview(full.astype("<u4").tobytes())
                cuts = [0, *(ends * width).tolist()]
                digests, keys, bodies = [], [], []
                for a, b in zip(cuts, cuts[1:]):
                    body = raw[a:b]
                    digests.append(d := digest_of(body))
                    if d not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(d)
                        keys.append(d)
                        bodies.append(body)
                edge = np.searchsorted(ends, at[1:]) + 1
                first = [0, *edge.tolist()]
                recipes = [b"".join(digests[a:b]) for a, b in zip(first, first[1:])]
                wide_at = (at * 4).tolist()
                crcs = [zlib.crc32(wide[a:b]) for a, b in zip(wide_at, wide_at[1:])]
                m = len(keys)
                yield pa.record_batch([
                    pa.array(np.repeat([_CHUNK, _RECIPE], [m, n]), pa.int32()), pa.array(keys + recipes, pa.binary()), pa.array(bodies + [None] * n, pa.binary()),
                    pa.concat_arrays([pa.nulls(m, pa.int64()), doc_ids.slice(lo, n)]), pa.array([None] * m + np.diff(at).tolist(), pa.int64()), pa.array([None] * m + crcs, pa.int64()),
                ], names=["kind", "digest", "ids", "doc_id", "n_tokens", "crc"])

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # equal chunks stand together
        for batch in batches:
            if not batch.num_rows:
                continue
            kind, digest = batch.column("kind").to_numpy(), batch.column("digest")
            keep = np.ones(batch.num_rows, bool)
            keep[1:] = pc.not_equal(digest.slice(1), digest.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            keep[0] = digest[0].as_py() != before
            before = digest[batch.num_rows - 1].as_py() if kind[-1] == _CHUNK else None
            yield batch.filter(pa.array(keep | (kind == _RECIPE)))

    rows = docs.mapInArrow(cut, OBJECTS).withColumn("tie", F.monotonically_increasing_id())
    rows = rows.repartition(parts_for(total, CHUNK_BYTES), F.when(F.col("kind") == _CHUNK, F.xxhash64("digest")).otherwise(F.xxhash64("tie"))).drop("tie")
    rows.sortWithinPartitions("kind", "digest").mapInArrow(once, OBJECTS).write.parquet(f"{path}/objects")

    spark = docs.sparkSession
    loose = spark.read.schema(OBJECTS).parquet(f"{path}/objects").where(F.col("kind") == _RECIPE).select("doc_id", "n_tokens", "crc", F.col("digest").alias("text"))
    ordered = in_order(loose, parts_for(total, RECIPE_BYTES))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, row, part = 0, 0, TaskContext.get().partitionId()
        for batch in batches:
            n = batch.column("n_tokens").to_numpy()
            ends = before + np.cumsum(n)
            leaves = [leaf_of(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("text", "doc_id", "n_tokens", "crc")), (ends - n).tolist())]
            yield pa.record_batch([
                *(batch.column(c) for c in ("doc_id", "n_tokens", "crc", "text")), pa.array(leaves, pa.binary()),
                pa.array(np.full(len(n), part)), pa.array(np.arange(row, row + len(n))), pa.array(ends - n),
            ], names=["doc_id", "n_tokens", "crc", "recipe", "leaf", "range_id", "row", "start_in_range"])
            before, row = int(ends[-1]) if len(n) else before, row + len(n)

    ordered.mapInArrow(place, RECIPES).write.parquet(f"{path}/recipes")
    recipes = spark.read.schema(RECIPES).parquet(f"{path}/recipes")
    write_tree(recipes.select("range_id", "row", F.hex("leaf").alias("digest"), "n_tokens"), f"{path}/manifest")
    ranges = recipes.groupBy("range_id").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.count("*").alias("documents"), F.sum("n_tokens").alias("tokens"))
    with_sums_before(ranges, "range_id", "tokens").withColumnRenamed("before", "tokens_before").write.parquet(f"{path}/ranges")


def with_sums_before(rows: DataFrame, at: str, value: str) -> DataFrame:
    """Adds ``before``: the sum of the value over all rows with a smaller number ``at``.  Numbers are dense; sums are taken by groups of neighbours and then over the groups, so no task
    meets more than its group."""
    top = rows.agg(F.max(at)).first()[0] or 0

    def before(rows: DataFrame, top: int) -> DataFrame:
        group = F.floor(F.col(at) / (16 * FANOUT))
        inner = F.coalesce(F.sum(value).over(Window.partitionBy(group).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        rows = rows.withColumn("before", inner)
        if top < 16 * FANOUT:
            return rows
        groups = before(rows.groupBy(group.alias(at)).agg(F.sum(value).alias(value)), top // (16 * FANOUT)).select(F.col(at).alias("__group"), F.col("before").alias("__before"))
        return rows.withColumn("__group", group).join(groups, "__group").withColumn("before", F.col("before") + F.col("__before")).drop("__group", "__before")

    return before(rows, top)


def _parents(nodes: DataFrame, level: int, range_id, node) -> DataFrame:
    """The nodes above: each the hash of its children's digests, in order."""
    children = F.array_sort(F.collect_list(F.struct("range_id", "node", "digest")))  # FANOUT of them at most
    grouped = nodes.groupBy(range_id.cast("long").alias("r"), node.cast("long").alias("n")).agg(children.alias("c"), F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    digest = F.sha2(F.concat_ws(",", F.lit("node"), F.transform("c", lambda x: x["digest"])), 256)
    return grouped.select(F.lit(level).alias("level"), F.col("r").alias("range_id"), F.col("n").alias("node"), digest.alias("digest"), "documents", "tokens")


def _inner_tree(leaves: DataFrame) -> list[DataFrame]:
    """Levels 1 to 3 from leaves (range_id, row, digest, n_tokens): a range has at most ``FANOUT ** 3`` of them, as its size is bounded."""
    nodes = leaves.select("range_id", F.col("row").alias("node"), "digest", F.lit(1).cast("long").alias("documents"), F.col("n_tokens").alias("tokens"))
    own, above = F.col("range_id"), F.floor(F.col("node") / FANOUT)
    first = _parents(nodes, 1, own, above)
    second = _parents(first, 2, own, above)
    return [first, second, _parents(second, 3, own, F.lit(0))]


def write_tree(leaves: DataFrame, path: str) -> None:
    """All nodes of the tree.  Each level is read back for the next, so none is made twice."""
    spark = leaves.sparkSession
    levels = _inner_tree(leaves)
    levels[0].unionByName(levels[1]).unionByName(levels[2]).write.parquet(f"{path}/of=ranges")
    ranges, level = spark.read.schema(NODES).parquet(f"{path}/of=ranges").where("level = 3"), 3
    while True:
        level += 1
        _parents(ranges, level, F.floor(F.col("range_id") / FANOUT), F.lit(0)).write.parquet(f"{path}/of=level{level}")
        ranges = spark.read.schema(NODES).parquet(f"{path}/of=level{level}")
        if ranges.count() <= 1:
            return


def check_recipes(spark: SparkSession, path: str) -> None:
    """Raise an error if the recipes aren't those that the tree was made of.  A job of its own: no later plan can leave it out.

    Leaves are computed anew from the recipes, and nodes from leaves, so a changed recipe, leaf or number of ids, a lost file, a changed node and a
    range that the manifest doesn't know are all found; so are changed, repeated and missing rows of the ranges."""
    recipes = spark.read.schema(RECIPES).parquet(f"{path}/recipes")

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [leaf_of(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("recipe", "doc_id", "n_tokens", "crc", "start_in_range")))]
            if found != batch.column("leaf").to_pylist():
                raise ValueError("a recipe differs from its leaf")
            yield pa.record_batch([*(batch.column(c) for c in ("range_id", "row", "n_tokens")), pa.array([x.hex().upper() for x in found])], names=["range_id", "row", "n_tokens", "digest"])

    read = recipes.mapInArrow(leaves, "range_id long, row long, n_tokens long, digest string")
    told = spark.read.schema(NODES).parquet(f"{path}/manifest")
    top = told.agg(F.max("level")).first()[0] or 0
    first, _, _ = _inner_tree(read)
    stored = lambda level: told.where(F.col("level") == level)
    own, above = F.col("range_id"), F.floor(F.col("node") / FANOUT)
    # Each level from the stored one below it: together, all levels hold or one of them differs.
    found = first.unionByName(_parents(stored(1), 2, own, above)).unionByName(_parents(stored(2), 3, own, F.lit(0)))
    for level in range(4, top + 1):
        found = found.unionByName(_parents(stored(level - 1), level, F.floor(own / FANOUT), F.lit(0)))
    key, rest = ["level", "range_id", "node"], ["digest", "documents", "tokens"]
    both = told.select(*key, F.struct(*rest).alias("told")).join(found.select(*key, F.struct(*rest).alias("found")), key, "full_outer")
    bad = both.where(~F.col("found").eqNullSafe(F.col("told"))).select(*key).limit(1).collect()
    if bad:
        raise ValueError(f"recipes of range {bad[0].range_id} differ from the manifest (node {bad[0].node} of level {bad[0].level})")
    # Ranges: what stands before each follows from the tree's own numbers.
    summed_up = with_sums_before(stored(3).select("range_id", "documents", "tokens"), "range_id", "tokens").select("range_id", F.struct("documents", "tokens", F.col("before").alias("tokens_before")).alias("found"))
    ranges = spark.read.schema(RANGES).parquet(f"{path}/ranges").select("range_id", F.struct("documents", "tokens", "tokens_before").alias("told"))
    ranges = ranges.groupBy("range_id").agg(F.min("told").alias("told"), F.count("*").alias("rows"))
    bad = summed_up.join(ranges, "range_id", "full_outer").where(~F.col("found").eqNullSafe(F.col("told")) | (F.col("rows") > 1)).select("range_id").limit(1).collect()
    if bad:
        raise ValueError(f"range {bad[0].range_id} of the ranges differs from the manifest")
    if top and (top < 4 or told.where(F.col("level") == top).count() > 1):
        raise ValueError("the manifest has no root")


@lru_cache(maxsize=8192)
def _shift(n_bytes: int) -> np.ndarray:
    """Tables that carry a crc32 past n_bytes zero bytes: 4 rows of 256 numbers, one for each byte of the crc."""
    def times(m, v):
        out = 0
        for i in range(32):
            if v >> i & 1:
                out ^= m[i]
        return out

    power = [0xEDB88320, *(1 << i for i in range(31))]  # one zero bit
    result = [1 << i for i in range(32)]
    n = n_bytes * 8
    while n:
        if n & 1:
            result = [times(power, x) for x in result]
        power = [times(power, x) for x in power]
        n >>= 1
    tables = np.zeros((4, 256), np.uint32)
    for k in range(4):
        line = [0]
        for bit in range(8):
            line += [x ^ result[8 * k + bit] for x in line]
        tables[k] = line
    return tables


def joined_crcs(crc: np.ndarray, n_bytes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """crc32 of each run [at[i], at[i + 1]) of byte strings joined, from their own crc32 and lengths."""
    sizes, which = np.unique(n_bytes, return_inverse=True)
    tables = np.stack([_shift(int(x)) for x in sizes]) if len(sizes) else np.zeros((0, 4, 256), np.uint32)
    count = np.diff(at)
    out = np.zeros(len(count), np.uint32)
    for k in range(int(count.max(initial=0))):
        run = np.flatnonzero(count > k)
        i, now = at[run] + k, out[run]
        t = which[i]
        out[run] = tables[t, 0, now & 255] ^ tables[t, 1, now >> 8 & 255] ^ tables[t, 2, now >> 16 & 255] ^ tables[t, 3, now >> 24] ^ crc[i].astype(np.uint32)
    return out


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OBJECTS).parquet(f"{path}/objects").where(F.col("kind") == _CHUNK).select("digest", "ids")


def _checked(batch: pa.RecordBatch) -> list[bytes]:
    bodies = batch.column("ids").to_pylist()
    for d, body in zip(batch.column("digest").to_pylist(), bodies):
        if digest_of(body) != d:
            raise ValueError(f"chunk {d.hex()} is damaged")
    return bodies


def summed(chunks: DataFrame, width: int = 2) -> DataFrame:
    """digest, n and crc (crc32 of the ids as unsigned 32-bit integers) of chunks, each checked."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = _checked(batch)
            crcs = [zlib.crc32(np.frombuffer(body, f"<u{width}").astype("<u4")) for body in bodies]
            yield pa.record_batch([batch.column("digest"), pa.array([len(body) // width for body in bodies], pa.int64()), pa.array(crcs, pa.int64())], names=["digest", "n", "crc"])

    return chunks.mapInArrow(check, "digest binary, n long, crc long")


def exploded_recipes(spark: SparkSession, path: str) -> DataFrame:
    """One row for each chunk of each document: range_id, row, part (from 0), digest."""
    recipes = spark.read.schema(RECIPES).parquet(f"{path}/recipes")
    digest = F.expr(f"transform(sequence(0, length(recipe) div {DIGEST_BYTES} - 1), i -> substring(recipe, i * {DIGEST_BYTES} + 1, {DIGEST_BYTES}))")
    return recipes.select("range_id", "row", F.posexplode(digest).alias("part", "digest"))


def _parts(spark: SparkSession, path: str, checked) -> DataFrame:
    """What ``checked`` gives of the chunks, for each chunk of each document; a chunk that very many hold doesn't gather them in one task."""
    refs = exploded_recipes(spark, path)
    n = (spark.read.schema(RECIPES).parquet(f"{path}/recipes").agg(F.sum(F.octet_length("recipe"))).first()[0] or 0) // DIGEST_BYTES
    heavy = written(refs.groupBy("digest").agg(F.count("*").alias("uses")).where(F.col("uses") * HEAVY > n).select("digest"), "token-store-heavy")  # fewer than HEAVY
    chunks = _chunks(spark, path)
    few = checked(chunks.join(F.broadcast(heavy), "digest", "left_semi"))
    return refs.join(F.broadcast(heavy), "digest", "left_anti").join(checked(chunks), "digest").unionByName(refs.join(F.broadcast(few), "digest"))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the store's files.

    Every chunk is read and checked once; a document's crc32 is joined from those of its chunks in
    the order of its recipe, so ids aren't moved once for each document that holds them, and is compared with the one in its leaf."""
    check_recipes(spark, path)
    folded = _parts(spark, path, summed).groupBy("range_id", "row").agg(F.array_sort(F.collect_list(F.struct("part", "n", "crc"))).alias("parts"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("parts")
            at = parts.offsets.to_numpy().astype(np.int64)
            n, crc = (parts.values.field(name).to_numpy(zero_copy_only=False) for name in ("n", "crc"))
            n, crc, at = n[at[0] : at[-1]], crc[at[0] : at[-1]], at - at[0]
            ends = np.concatenate([[0], np.cumsum(n)])[at]
            yield pa.record_batch([batch.column("range_id"), batch.column("row"), pa.array(np.diff(ends)), pa.array(joined_crcs(crc, 4 * n, at).astype(np.int64))], names=["range_id", "row", "read_tokens", "ids_crc32"])

    folded = folded.mapInArrow(fold, "range_id long, row long, read_tokens long, ids_crc32 long")
    recipes = spark.read.schema(RECIPES).parquet(f"{path}/recipes").select("doc_id", "range_id", "row", "start_in_range", "n_tokens", "crc")
    ranges = spark.read.schema(RANGES).parquet(f"{path}/ranges").select("range_id", "tokens_before")
    same = F.col("read_tokens").eqNullSafe(F.col("n_tokens")) & F.col("ids_crc32").eqNullSafe(F.col("crc"))
    n_tokens = F.when(same, F.col("read_tokens")).otherwise(F.raise_error(F.lit("a document can't be rebuilt from its chunks")).cast("long"))
    before = F.coalesce("tokens_before", F.raise_error(F.lit("a document's range is unknown")).cast("long"))
    return recipes.join(folded, ["range_id", "row"], "left").join(ranges, "range_id", "left").select(
        "doc_id", (before + F.col("start_in_range")).alias("start"), n_tokens.alias("n_tokens"), "ids_crc32")


def read_documents(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """doc_id and ids (array) of every document, rebuilt from its chunks, each checked, and compared with its number of ids and crc32."""
    check_recipes(spark, path)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _checked(batch)
            yield batch

    whole = _parts(spark, path, lambda chunks: chunks.mapInArrow(check, "digest binary, ids binary")).groupBy("range_id", "row").agg(F.array_sort(F.collect_list(F.struct("part", "ids"))).alias("parts"))
    recipes = spark.read.schema(RECIPES).parquet(f"{path}/recipes").select("doc_id", "range_id", "row", "n_tokens", "crc")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                doc_id, n, crc, parts = (batch.column(c)[k].as_py() for c in ("doc_id", "n_tokens", "crc", "parts"))
                ids = np.frombuffer(b"".join(p["ids"] for p in parts or []), f"<u{width}")
                if len(ids) != n or zlib.crc32(ids.astype("<u4")) != crc:
                    raise ValueError("a document can't be rebuilt from its chunks")
                yield pa.record_batch([pa.array([doc_id], pa.int64()), pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return recipes.join(whole, ["range_id", "row"], "left").drop("range_id", "row").mapInArrow(rebuild, "doc_id long, ids array<int>")


def op3(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = new_path(spark, "token-store")
    write_store(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_digests(spark, path)

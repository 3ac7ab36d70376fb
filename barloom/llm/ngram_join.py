"""N-gram Jaccard join: documents whose sets of five-word runs overlap by 0.8 or more.

1. Each document becomes its set of n-gram hashes (52 bits), its MinHash signature and its bands.
   Documents with equal sets (told by 128 bits) are one *node*; copies cost no pairs.
2. Nodes that share a band hash meet.  24 bands of 5 rows find a pair of similarity 0.8 with
   probability 1 - (1 - 0.8**5)**24 = 0.9999, more similar ones more surely.  Where they meet, the
   signatures' agreement must reach ``ESTIMATE`` (four standard deviations below 0.8), so that
   documents that merely share a passage don't chain.  What meets and agrees is joined into
   candidate groups by connected components; each bucket gives a spanning forest, not its pairs.
3. The full n-gram sets of a candidate group, read anew from its texts alone, are compared pair by pair
   in blocks.  Tasks return counts and spanning links, so a large group gives few rows.

Words are runs of letters, digits and underscores (any character beyond ASCII counts as a letter),
in lower case.  Cases: a text of one to four words has one n-gram, of all its words; null texts,
empty ones and ones without words link with nothing; a doc_id that occurs twice counts as two
documents; documents without a doc_id are linked like others, and count after all others where the smallest is asked for; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.llm.byte_bpe import text_slices
from barloom.llm.common import spread_join, table, written
from barloom.llm.graph import blocked, components, group_counts, link_report, local_labels, met, pair_chunks
from barloom.llm.words import mix, ngram_hashes, word_hashes

N, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 5
ESTIMATE = 0.65

_RNG = np.random.default_rng(5)
_XOR = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_TIMES = _RNG.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def gram_sets(texts: pa.Array, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """The different n-grams of each text (52-bit hashes, ascending) and each text's offsets in them."""
    words, at = word_hashes(texts)
    grams, ends = ngram_hashes(words, at, n)
    parts, sizes = [], []
    for lo in range(0, len(texts), 4096):  # 12 bits number the text, 52 are left for the hash
        hi = min(lo + 4096, len(texts))
        count = np.diff(ends[lo : hi + 1])
        keyed = np.repeat(np.arange(hi - lo, dtype=np.uint64) << np.uint64(52), count) | (grams[ends[lo] : ends[hi]] >> np.uint64(12))
        keyed.sort()
        keyed = keyed[np.concatenate([[True], keyed[1:] != keyed[:-1]])] if len(keyed) else keyed
        sizes.append(np.bincount((keyed >> np.uint64(52)).astype(np.int64), minlength=hi - lo))
        parts.append(keyed & np.uint64((1 << 52) - 1))
    offsets = np.zeros(len(texts) + 1, np.int64)
    if parts:
        np.cumsum(np.concatenate(sizes), out=offsets[1:])
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), offsets


def signatures(grams: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """MinHash signatures (a row for each text, 8 bits of each minimum) and band hashes; texts must have n-grams."""
    start = offsets[:-1]
    x = ((grams >> np.uint64(20)) ^ grams).astype(np.uint32)
    signature = np.empty((len(start), BANDS * ROWS), np.uint8)
    bands = np.empty((len(start), BANDS), np.uint64)
    work = np.empty_like(x)
    for band in range(BANDS):
        key = np.full(len(start), band + 1, np.uint64)
        for k in range(band * ROWS, band * ROWS + ROWS):
            np.bitwise_xor(x, _XOR[k], out=work)
            np.multiply(work, _TIMES[k], out=work)
            least = np.minimum.reduceat(work, start)
            key = mix(key * np.uint64(0xD6E8FEB86659FD93) + least)
            signature[:, k] = (mix(least.astype(np.uint64)) >> np.uint64(56)).astype(np.uint8)
        bands[:, band] = key
    return signature, bands


def set_names(grams: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 128-bit name of each text's set, as two numbers (texts must have n-grams)."""
    first, second = (mix(np.add.reduceat(mix(grams + np.uint64(salt)), offsets[:-1])).view(np.int64) for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
    return first, second


def sketch(docs: DataFrame, n: int = N) -> DataFrame:
    """doc_id, row, the name of the set (name, other: null without words), bands, signature of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for lo, hi in text_slices(texts):
                grams, offsets = gram_sets(texts.slice(lo, hi - lo), n)
                have = np.flatnonzero(np.diff(offsets))
                name = other = pa.nulls(hi - lo, pa.int64())
                bands = sign = pa.nulls(hi - lo, pa.binary())
                if len(have):
                    inner = np.append(offsets[have], offsets[-1])
                    signature, band = signatures(grams, inner)
                    place = np.full(hi - lo, -1)
                    place[have] = np.arange(len(have))
                    take = pa.array(place, mask=place < 0)
                    name, other = (pa.array(x).take(take) for x in set_names(grams, inner))
                    bands = pa.array([x.tobytes() for x in band], pa.binary()).take(take)
                    sign = pa.array([x.tobytes() for x in signature], pa.binary()).take(take)
                yield pa.record_batch([batch.column("doc_id").slice(lo, hi - lo), batch.column("row").slice(lo, hi - lo), name, other, bands, sign], names=["doc_id", "row", "name", "other", "bands", "signature"])

    return docs.select("doc_id", "row", "text").mapInArrow(run, "doc_id long, row long, name long, other long, bands binary, signature binary")


def _band_rows(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
            yield pa.record_batch([pa.array(keys), pa.array(np.repeat(batch.column("node").to_numpy(), BANDS))], names=["bucket", "node"])

    return nodes.select("node", "bands").mapInArrow(run, "bucket long, node long")


def _agreeing(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """A spanning forest of the rows that meet and whose signatures agree."""
    node = batch.column("node").to_numpy()
    sign = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint8).reshape(len(node), -1)
    least = int(np.ceil(ESTIMATE * sign.shape[1]))
    a, b = [], []
    for x, y in pair_chunks(*(batch.column(c).to_numpy() for c in ("group", "lo", "hi", "side"))):
        good = (sign[x] == sign[y]).sum(1) >= least
        a.append(x[good])
        b.append(y[good])
    if not a:
        return None
    label = local_labels(len(node), np.concatenate(a), np.concatenate(b))
    moved = np.flatnonzero(label != np.arange(len(node)))
    return pa.record_batch([pa.array(node[moved]), pa.array(node[label[moved]])], names=["a", "b"])


def overlaps(grams: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """n x n matrix of the sizes of intersections of sets given as (n-gram, row) entries."""
    order = np.argsort(grams, kind="stable")
    g, r = grams[order], row[order]
    new = np.concatenate([[True], g[1:] != g[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    r, column = r[shared], column[shared]
    out = np.zeros((n, n), np.float32)
    if not len(r):
        return out
    column = np.cumsum(np.concatenate([[True], column[1:] != column[:-1]])) - 1
    width = max(256, min(4096, (8 << 20) // n))
    for lo in range(0, int(column[-1]) + 1, width):
        a, b = np.searchsorted(column, [lo, lo + width])
        has = np.zeros((n, width), np.float32)
        has[r[a:b], column[a:b] - lo] = 1
        out += has @ has.T
    return out


def _verified(similarity: float):
    top = int(round(similarity * 1000))

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        group, lo, hi, side, node, copies = (batch.column(c).to_numpy() for c in ("group", "lo", "hi", "side", "node", "copies"))
        raw = batch.column("grams").to_pylist()
        out_node, out_label, out_links = [], [], []
        edge = np.append(np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])), len(group)).tolist()
        for x, y in zip(edge, edge[1:]):
            keep = x + np.unique(node[x:y], return_index=True)[1]  # a doc_id that occurs twice
            n = len(keep)
            if n < 2:
                continue
            sets = [np.frombuffer(raw[i], np.uint64) for i in keep.tolist()]
            size = np.array([len(s) for s in sets])
            if n == 2:
                both = np.intersect1d(*sets, assume_unique=True).size
                shared = np.array([[0, both], [both, 0]])
            else:
                shared = overlaps(np.concatenate(sets), np.repeat(np.arange(n), size), n).astype(np.int64)
            linked = shared * (1000 + top) >= top * (size[:, None] + size[None, :])
            np.fill_diagonal(linked, False)
            if lo[x] != hi[x]:
                linked &= side[keep][:, None] != side[keep][None, :]
            links = linked @ copies[keep]
            a, b = np.nonzero(np.triu(linked))
            label = local_labels(n, a, b)
            has = np.flatnonzero(links)
            out_node.append(node[keep][has])
            out_label.append(node[keep][label[has]])
            out_links.append(links[has])
        if not out_node:
            return None
        return pa.record_batch([pa.array(np.concatenate(out_node)), pa.array(np.concatenate(out_label)), pa.array(np.concatenate(out_links))], names=["node", "label", "links"])

    return kernel


def _gram_rows(texts: DataFrame, n: int) -> DataFrame:
    """The n-gram sets of texts (that have words): name, other, grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for lo, hi in text_slices(column):
                grams, offsets = gram_sets(column.slice(lo, hi - lo), n)
                have = np.flatnonzero(np.diff(offsets))
                if not len(have):
                    continue
                name, other = set_names(grams, np.append(offsets[have], offsets[-1]))
                bodies = [grams[offsets[i] : offsets[i + 1]].tobytes() for i in have.tolist()]
                yield pa.record_batch([pa.array(name), pa.array(other), pa.array(bodies, pa.binary())], names=["name", "other", "grams"])

    return texts.mapInArrow(run, "name long, other long, grams binary")


def _among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose doc_id may be one of ``ids`` (doc_id): all of those, and few others.

    A bitmap of 2**26 hashed ids, 8 MB however many there are, is broadcast; where it fills up, more documents pass.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 26)) + 1
    bits = ids.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("__bits"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("__bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return docs.join(F.broadcast(bits), F.bitmap_bucket_number(place) == F.col("__bucket")).where(F.getbit(byte, (at % 8).cast("int")) == 1).select(*docs.columns)


def _wanted_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """component, node, copies and grams of the wanted nodes (with name, other and ``first``).  A node's text is that of its first document; where none of its
    documents has a doc_id, those without one are read."""
    named = wanted.where("first.doc_id is not null")
    texts = _among(docs.where("doc_id is not null"), named.select("first.doc_id"))
    sets = _gram_rows(texts.join(named.select(F.col("first.doc_id").alias("doc_id")).distinct(), "doc_id").groupBy("doc_id", F.xxhash64("text")).agg(F.first("text").alias("text")), n)
    unnamed = wanted.where("first.doc_id is null")
    if not unnamed.isEmpty():
        sets = sets.unionByName(_gram_rows(docs.where("doc_id is null").groupBy(F.xxhash64("text")).agg(F.first("text").alias("text")), n))
    sets = sets.join(wanted.select("name", "other", "component", "node", "copies"), ["name", "other"])
    return sets.groupBy("component", "node", "copies").agg(F.first("grams").alias("grams"))  # a doc_id may have several texts with one set


def jaccard_join(docs: DataFrame, similarity: float = SIMILARITY, n: int = N, row: str | None = None) -> DataFrame:
    """A row for each document: doc_id, class_id (the smallest doc_id with the same n-grams),
    n_copies (documents of that class), n_links (other documents at the similarity or above),
    component_id (smallest doc_id reachable by links), kept (doc_id = component_id).

    ``row`` names a column of different numbers that tells repeated and null doc_ids apart: it is returned too (as ``row``), and ``kept`` is true for one
    row of each component then, the one with the smallest doc_id and, among these, the smallest number.

    Both steps find links above 0.8; for lower values of ``similarity`` the constants must be changed.
    """
    own = F.col(row).cast("long") if row else F.lit(None).cast("long")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), own.alias("row"), F.col("text").cast("string").alias("text"))
    sketched = written(sketch(docs, n), "ngram-sketch")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    nodes = sketched.where("name is not null").groupBy("name", "other").agg(F.count("*").alias("copies"), first, F.first("bands").alias("bands"), F.first("signature").alias("signature"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "ngram-nodes")
    in_buckets = _band_rows(nodes)
    counts = group_counts(in_buckets, "bucket", "ngram-buckets")
    met_in = blocked(in_buckets, "bucket", "node", counts).join(nodes.select("node", "signature"), "node")
    edges = met(met_in, "bucket", _agreeing, "a long, b long")
    group = components(edges, "ngram-candidates")
    wanted = written(group.join(nodes.select("node", "name", "other", "copies", "first"), "node"), "ngram-wanted")
    sets = written(_wanted_sets(docs, wanted, n), "ngram-sets")
    partial = met(blocked(sets, "component", "node", group_counts(wanted, "component", "ngram-groups")), "component", _verified(similarity), "node long, label long, links long")
    report = link_report(nodes.select("node", "name", "other", "copies", "first"), partial, "ngram")
    total = nodes.agg(F.sum("copies")).first()[0] or 0
    found = spread_join(sketched.select("doc_id", "row", "name", "other").where("name is not null"), report, ["name", "other"], F.col("copies"), total)
    kept = (F.col("row") == F.col("least.row")) if row else F.col("doc_id").eqNullSafe(F.col("least.doc_id"))
    out = found.select("doc_id", "row", F.col("first.doc_id").alias("class_id"), F.col("copies").alias("n_copies"), "n_links", F.col("least.doc_id").alias("component_id"), kept.alias("kept"))
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    alone = sketched.where("name is null").select("doc_id", "row", F.col("doc_id").alias("class_id"), one.alias("n_copies"), zero.alias("n_links"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    out = out.unionByName(alone)
    return out if row else out.drop("row")


def op1(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join(table(spark, folder, "documents"))


#: The links by counting shared n-grams, the components by a recursive walk.
ORACLE = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9A-Za-z_\x{80}-\x{10FFFF}]+') AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b, k = x.n AND k = y.n AS equal FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 9 * k >= 4 * (x.n + y.n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
whole AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n_links, count(*) FILTER (equal) AS copies, min(b) FILTER (equal) AS first_copy FROM links GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(first_copy, doc_id)) AS class_id, coalesce(copies, 0) + 1 AS n_copies, coalesce(n_links, 0) AS n_links, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN counted ON counted.a = doc_id JOIN whole ON whole.a = doc_id
"""

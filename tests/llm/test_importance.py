"""Importance resampling on literal rows and against a plain loop."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barloom.llm import importance
from tests.conftest import SMALL


def runs(text, order):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, order=1, buckets=10_000, least=20, percent=10, seed=2024):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text) rows, one by one."""
    place = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(place(f) for _, t in docs for f in runs(t, order)[1])
    t = Counter(place(f) for x in target for f in runs(x, order)[1])
    n, m = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n + buckets) / ((s[b] + 1) * (m + buckets))))
    rows, able = [], []
    for i, (doc_id, text) in enumerate(docs):
        words, found = runs(text, order)
        weight = sum(gain(place(f)) for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None])
        if len(words) >= least:
            able.append((-score, doc_id is None, doc_id or 0, i))
    for rank, (*_, i) in enumerate(sorted(able)[: percent * len(able) // 100], 1):
        rows[i][4] = rank
    return rows


def in_order(rows):
    return sorted(tuple("" if v is None else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("order", [1, 3])
def test_equals_a_plain_loop(spark, order):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    got = importance.resample(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/benchmark.parquet"), order=order).collect()
    assert in_order(got) == in_order(plain(docs, target, order)) and sum(r.rank is not None for r in got) > 10


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    target = ["alpha beta gamma", None, "", "word1 word2"]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(edge_docs, frame, order=2, least_words=1, percent=50).collect()
    assert in_order(got) == in_order(plain(edge_rows, target, 2, least=1, percent=50))
    assert importance.resample(no_docs, frame).count() == 0
    alone = importance.resample(edge_docs, no_docs, least_words=2).collect()
    assert in_order(alone) == in_order(plain(edge_rows, [], least=2))


def test_runs_stay_inside_their_document():
    known = importance._Buckets(10_000)
    texts = ["one two", "", None, "three", " four\nfive\x00six ", "Ünï ÉCOLE"]
    bucket, doc = importance.features(pa.array(texts), 2, known)
    want = sorted((k, zlib.crc32(f.encode()) % 10_000) for k, t in enumerate(texts) for f in runs(t, 2)[1])
    assert sorted(zip(doc.tolist(), bucket.tolist())) == want
    assert len(importance.features(pa.array([], pa.string()), 2, known)[0]) == 0


def test_ranks_over_many_ranges_with_ties(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 50 != 0, F.col("id")).alias("doc_id"), (F.col("id") % 7).alias("score"))
    got = importance.ranked(rows, range_rows=300).collect()
    want = sorted(((r.doc_id, r.score) for r in rows.collect()), key=lambda r: (-r[1], r[0] is None, r[0] or 0))
    assert [(r.doc_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 5001))


def test_crc_in_sql():
    sql = importance.ORACLE.replace("FROM documents", "FROM d").replace("FROM benchmark", "FROM b")
    con = duckdb.connect()
    con.sql("CREATE TABLE d AS SELECT * FROM (VALUES (1, 'Été 12 the THE'), (2, NULL)) t(doc_id, text)")
    con.sql("CREATE TABLE b AS SELECT 0 AS item_id, 'the' AS text")
    assert in_order(con.sql(sql.replace("documents d", "d d")).fetchall()) == in_order([[r[0], r[1], r[2], r[3], r[4]] for r in plain([(1, "Été 12 the THE"), (2, None)], ["the"])])

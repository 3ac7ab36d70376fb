"""Hard negatives on literal rows and against a plain search."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import hard_negatives as hn
from tests.conftest import SMALL

SCHEMA = "vec_id long, embedding array<double>, label int, row long, score long"
MOST = (1 << 63) - 1


def plain(rows, positives=5, negatives=10, low=30, high=90, scale=256, every=100):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), one by one; rows: (vec_id, vector, label)."""
    fine = lambda v: v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) and math.isfinite(x * scale) for x in v)
    good = [(k, i, [math.floor(x * scale) for x in v], label) for k, (i, v, label) in enumerate(rows) if i is not None and label is not None and fine(v)]
    out = []
    for k, i, a, label in good:
        if i % every:
            continue
        score = lambda v: min(MOST, max(-MOST, sum(p * q for p, q in zip(a, v))))  # noqa: B023, E731
        met = [(-score(v), j, m, lab) for m, j, v, lab in good if m != k and len(v) == len(a)]
        own = sorted(x for x in met if x[3] == label)[:positives]
        for p, j, *_ in own:
            some = sorted(x for x in met if x[3] != label and 30 * -p <= 100 * -x[0] <= high * -p)[:negatives]
            assert low == 30
            out += [(i, j, r, x[1], -p, -x[0]) for r, x in enumerate(some, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 7, 7) for i, v, label in rows], SCHEMA).repartition(3)


def mined(spark, rows, **more):
    return sorted(tuple(r) for r in hn.mine(frame(spark, rows), F.col("vec_id") % 100 == 0, **more).collect())


def test_query_equals_a_plain_search(spark):
    rows = [(r.vec_id, r.embedding, r.label if r.vec_id % 7 or r.label is None else (r.label + 1) % 10) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in hn.op11(spark, SMALL).collect())
    assert got == plain(rows) and len(got) > 50


@pytest.mark.parametrize("tile", [None, 64])
def test_many_blocks_tiles_and_ties(spark, monkeypatch, tile):
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-2, 3, 12).astype(float).tolist(), int(rng.integers(0, 3)) if i % 3 else 0) for i in range(0, 3000, 5)]  # few values: many ties
    if tile:  # small blocks, several groups of anchors and candidates
        monkeypatch.setattr(hn, "BLOCK", tile)
        monkeypatch.setattr(hn, "CANDIDATES", tile)
        monkeypatch.setattr(hn, "ANCHOR_BYTES", 12 * 8 * 4)
    assert mined(spark, rows, scale=1.0) == plain(rows, scale=1)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.5, 0.25, -0.125]
    rows = [
        (0, v, 1), (1, v, 1), (1, v, 1), (2, [0.4, 0.2, 0.0], 2), (3, [0.3, 0.2, 0.0], 2), (4, None, 1), (5, [0.1, None, 0.3], 1), (6, [nan, 1.0, 1.0], 1), (7, [inf, 1.0, 1.0], 2), (8, [], 1),
        (9, [0.0, 0.0, 0.0], 1), (10, v, None), (None, v, 1), (100, [0.0, 0.0, 0.0], 3), (101, [0.0, 0.0, 0.0], 3), (200, [1.0, 2.0], 4), (201, [1.0, 2.0], 4), (202, [0.5, 1.0], 5), (300, [-1.0, 0.0, 0.0], 6),
        (301, [1.0, 0.0, 0.0], 6), (400, [1e300, 1.0, 1.0], 7), (401, [1e300, 0.0, 0.0], 7), (402, [1e306, 0.0, 0.0], 8), (500, [3e4, 1.0, 2.0], 9), (501, [2e4, 1.0, 2.0], 9), (502, [1e4, 1.0, 2.0], 8), (0, v, 1)]
    got = mined(spark, rows)
    assert got == plain(rows)
    assert {r[0] for r in got} >= {0, 100, 200, 500} and (500, 501, 1, 502, (30000 * 20000 + 5) * 65536, (30000 * 10000 + 5) * 65536) in got
    assert hn.mine(frame(spark, []), F.col("vec_id") % 100 == 0).count() == 0


def test_bitmap_keeps_exactly_the_windows():
    rng = np.random.default_rng(5)
    x = rng.integers(-300, 300, (500, 40)).astype(float)
    block = hn._Block(np.arange(500), np.arange(500), np.zeros(500, np.int64), x)
    for _ in range(20):
        a, bitmap = rng.integers(-300, 300, 40).astype(float), rng.random(500) < 0.7
        exact = (x @ a).astype(np.int64)
        low, high = np.sort(rng.choice(exact, (2, 3)), axis=0)
        want = np.flatnonzero(bitmap & ((exact >= low[:, None]) & (exact <= high[:, None])).any(0))
        at, score = hn.scan(a, block, bitmap, low, high)
        assert at.tolist() == want.tolist() and score.tolist() == exact[want].tolist()

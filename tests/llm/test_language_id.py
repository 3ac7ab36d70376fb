"""Language identification: the network against slow forms, edge rows, held-out accuracy."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barloom.llm import language_id as li


def slow_scores(w, data):
    """Label scores of a window's bytes, one unit after the other."""
    sigmoid, hidden = lambda x: 1 / (1 + np.exp(-x)), w["state"].shape[1]
    out = np.tile(w["bias"].astype(float), (len(data), 1))
    for side in range(2):
        h = np.zeros(hidden)
        for t in range(len(data)) if side == 0 else range(len(data) - 1, -1, -1):
            pre, hu = w["byte"][side][data[t]].astype(float), h @ w["state"][side]
            z, r = sigmoid(pre[:hidden] + hu[:hidden]), sigmoid(pre[hidden : 2 * hidden] + hu[hidden : 2 * hidden])
            h = h + z * (np.tanh(pre[2 * hidden :] + r * hu[2 * hidden :]) - h)
            out[t] += h @ w["out"][side]
    return out


def test_windows_side_by_side_equal_the_slow_form():
    w = li.first_weights(3, hidden=5)
    texts = pa.array(["Été à la mer", None, "x", "", "ab " * 200])
    data, offsets = li.flat_bytes(texts)
    start, size = li.windows_of(offsets)
    assert size.max() == li.WINDOW and size.sum() == len(data)
    got = li.Reader(w).scores(data, start, size).T
    for a, n in zip(start.tolist(), size.tolist()):
        assert np.allclose(got[a : a + n], slow_scores(w, data[a : a + n]), atol=1e-4)


def test_gradient_equals_differences():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in li.first_weights(3, hidden=4).items()}
    data, label = rng.integers(60, 200, (3, 7)).astype(np.uint8), np.array([0, 2, 1])
    loss, grad = li.loss_and_gradient(w, data, label)
    want = np.mean([-np.log(li.softmax(slow_scores(w, d)))[li.LETTER[d], y].sum() for d, y in zip(data, label)]) * 3 / li.LETTER[data].sum()
    assert loss == pytest.approx(want, rel=1e-4)
    for name in w:
        for _ in range(6):
            at = tuple(int(rng.integers(0, n)) for n in w[name].shape)
            at = (at[0], int(data[rng.integers(0, 3), rng.integers(0, 7)]), at[2]) if name == "byte" else at
            old, both = w[name][at], []
            for step in (1e-3, -1e-3):
                w[name][at] = old + step
                both.append(li.loss_and_gradient(w, data, label)[0])
            w[name][at] = old
            assert (both[0] - both[1]) / 2e-3 == pytest.approx(float(grad[name][at]), abs=2e-5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = li.op12(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 200 and sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    learn = spark.createDataFrame([(k, t, lang) for k, (t, lang) in enumerate([("the cat and the dog", "en"), ("le chat et la souris", "fr"), (None, "de"), ("und der hund", None), ("12 !", "xx"), ("", "yy")] * 3)], "doc_id long, text string, lang string")
    langs, w = li.fit(learn, rounds=2)
    assert langs == ["en", "fr", "xx", "yy"]
    got = li.predict(edge_docs, (langs, w)).collect()
    assert len(got) == len(edge_rows)
    by_text = dict(zip(map(str, (r.doc_id for r in got)), got))
    assert all(by_text[str(i)].lang_pred == "und" and by_text[str(i)].score == 0 for i in (1, 2, 3, 13))
    assert all(by_text[str(i)].lang_pred in langs and 0 < by_text[str(i)].score <= 1 for i in (4, 6, 12, 15))
    assert li.predict(no_docs, (langs, w)).count() == 0
    nothing = li.fit(no_docs)
    assert nothing[0] == [] and {(r.lang_pred, r.score) for r in li.predict(edge_docs, nothing).collect()} == {("und", 0.0)}


def test_lone_letters_and_long_texts_whole():
    network = li.Reader(li.first_weights(2))
    label, score = li.label_texts(network, pa.array(["日本", "¿12?", "7 ́", "a", None]))
    assert (label >= 0).tolist() == [True, False, False, True, False] and score[1] == 0
    text = "the quick brown fox " * 150_000  # more than a stretch
    whole = li.label_texts(network, pa.array([text]))[1][0]
    part = li.label_texts(network, pa.array([text[: li.WINDOW * 500]]))[1][0]
    assert abs(whole - part) < 1e-3

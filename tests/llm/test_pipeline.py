"""The corpus pipeline on literal rows and against a brute-force version of its stages."""

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import ngram_join, packing, toxicity
from tests.conftest import SMALL


def test_stages_keep_columns_and_work_on_edge_cases(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        kept = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, SMALL)
            assert kept.columns == docs.columns, name
        pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SMALL)
        assert pieces.select("doc_id").distinct().count() == kept.select("doc_id").distinct().count()
    left = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, edge_docs, SMALL).collect()}
    assert {1, 2, 3, 4, 6, 8, None} <= left and not {5, 7, 9, 10} & left


def test_copies_without_a_doc_id_go_too(spark):
    words = "one of many words that stand in this text and in no other one at all so it is long enough to be told apart"
    rows = [(None, words), (None, words), (3, words.upper()), (3, words), (None, words + " more"), (None, "a text of its own"), (None, None), (None, None)]
    frame = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.drop_near_copies(spark, frame, SMALL).collect()
    assert sorted(r.text or "" for r in left) == sorted(["", "", "a text of its own", next(r.text for r in left if r.doc_id == 3)]) and len(left) == 4


def test_run_equals_the_decisions_one_by_one(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = toxicity.fit_on_folds(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score(docs, model).where(F.col("score") >= toxicity.THRESHOLD).collect()}
    clean = docs.where(~F.col("doc_id").isin(list(toxic)))
    copies = {r.doc_id for r in ngram_join.jaccard_join(clean).where("not kept").collect()}
    want = {r.doc_id for r in clean.collect()} - copies
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in rows} == want and copies
    whole = packing.digest(packing.pack(corpus_pipeline.cut_secrets(spark, clean.where(~F.col("doc_id").isin(list(copies))), SMALL), public_tokenizers.path("byte_bpe_50k.json")))
    assert sorted(map(tuple, rows)) == sorted(map(tuple, whole.collect()))


def test_secrets_are_cut_from_texts(spark):
    rows = [(1, 'token = "0641917ea4e9feb9cda83477b57ac2654884f485"', "en", "s", 50), (2, "nothing", "en", "s", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.cut_secrets(spark, docs, SMALL).collect()}
    assert got == {1: 'token = "[SECRET]"', 2: "nothing"}

"""The registered queries of the training-data operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from barloom.llm import chat_format, embedding_dedup, hard_negatives, importance, language_id, language_model, nearest, ngram_join, packing, piece_codec, secret_scan, token_store, toxicity
from barloom.llm.common import ship


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_ngram_jaccard_join": ngram_join.op1,
        "op2_packing": packing.op2,
        "op3_token_store": token_store.op3,
        "op4_chat_format": chat_format.op4,
        "op5_embedding_near_dedup": embedding_dedup.op5,
        "op6_language_model": language_model.op6,
        "op7_toxicity": toxicity.op7,
        "op8_secret_scan": secret_scan.op8,
        "op9_sentencepiece": piece_codec.op9,
        "op10_nearest_neighbours": nearest.op10,
        "op11_hard_negatives": hard_negatives.op11,
        "op12_language_id": language_id.op12,
        "op13_importance_resampling": importance.op13,
        "pipeline": corpus_pipeline.run,
    }
    return {name: _shipped(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_jaccard_join": ngram_join.ORACLE,
        "op4_chat_format": chat_format.ORACLE,
        "op5_embedding_near_dedup": embedding_dedup.ORACLE,
        "op8_secret_scan": secret_scan.ORACLE,
        "op11_hard_negatives": hard_negatives.ORACLE,
        "op13_importance_resampling": importance.ORACLE,
    }

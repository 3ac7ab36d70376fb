"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays, owned
secrets are cut out, and what is left is packed into token sequences.

Each stage is a function ``(spark, docs, folder) -> DataFrame`` on all documents that the one before
kept; ``run`` writes each stage's result as Parquet in the shared folder and reads it for the next.

Cases: each stage takes null and empty texts (neither toxic nor duplicates), repeated rows and null doc_ids (each row is judged by itself),
empty tables and extra columns, which it keeps; all stages but the last return the columns they got.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.llm import ngram_join, packing, secret_scan, toxicity
from barloom.llm.common import ship, table, written

ORACLE_SQL = None
#: A name that no document column has.
_ROW = "__pipeline_row"


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the toxicity model rejects (score at the threshold or above) go; those without any words stay.

    The model learns from the labelled rows of the learning folds, over all ``documents`` of the folder.
    """
    ship(spark)
    model = toxicity.fit_on_folds(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return toxicity.clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group linked by n-gram similarity stays, the one with the smallest doc_id (rows without a doc_id come after all others; repeated ones as they come)."""
    ship(spark)
    docs = written(docs.withColumn(_ROW, F.monotonically_increasing_id()), "pipeline-rows")  # the numbers stay the same
    gone = ngram_join.jaccard_join(docs, row=_ROW).where("not kept").select(F.col("row").alias(_ROW))
    return docs.join(gone, _ROW, "left_anti").drop(_ROW)


def cut_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Owner-specific, live-looking secrets are replaced in the texts; all documents stay."""
    return secret_scan.redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of token sequences, with the digests of their ids."""
    ship(spark)
    return packing.digest(packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("secrets", cut_secrets), ("packing", pack_sequences)]


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, folder), f"pipeline-{name}")
    return written(STAGES[-1][1](spark, docs, folder), f"pipeline-{STAGES[-1][0]}")

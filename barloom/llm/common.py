"""Tables, shared folders and small helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barloom.functions.package import send_package

_OWN_FOLDER: list[str] = []


#: Rows of an Arrow batch, unless the session has a value of its own: texts may be long.
BATCH_ROWS = "1000"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python may not have it on its path, and keep Arrow batches of texts small."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    send_package(spark)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share (``spark.checkpoint.dir``); a temporary one where it is unset and all run on one machine, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _OWN_FOLDER:
        _OWN_FOLDER.append(tempfile.mkdtemp(prefix="spark-shared-"))
    return _OWN_FOLDER[0]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, and its lineage ends there."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (0 for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


#: What a row counts beside its text where partitions are sized: rows without text are work too.
ROW_BYTES = 64
#: A key with more than one in HEAVY of all rows is heavy: there are fewer than HEAVY such keys, whatever the data.
HEAVY = 1000


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of text in the table and ``ROW_BYTES`` for each row: how many partitions a job gets follows from it."""
    return docs.agg(F.sum(F.coalesce(F.octet_length(column), F.lit(0)) + F.lit(ROW_BYTES).cast("long"))).first()[0] or 0


def parts_for(total_bytes: int, each: int, least: int = 1) -> int:
    return max(least, -(-total_bytes // each))


def in_order(docs: DataFrame, parts: int) -> DataFrame:
    """Documents (doc_id, text) in consecutive ranges of doc_id, null ones first.  Rows of one doc_id, or without one, may fill many
    ranges: they go by a hash of their text, and equal rows as they come."""
    tied = docs.withColumn("of_text", F.xxhash64("text")).withColumn("tie", F.monotonically_increasing_id())
    return tied.repartitionByRange(parts, "doc_id", "of_text", "tie").sortWithinPartitions("doc_id", "of_text", "text").drop("of_text", "tie")


def spread_join(rows: DataFrame, table: DataFrame, keys: list[str], weight: Column, total: Column | int) -> DataFrame:
    """Inner join of many ``rows`` with a ``table`` that has each key once, and tells by ``weight`` how many of ``total`` rows have it.

    Heavy keys, fewer than ``HEAVY``, are broadcast, so that their rows stay where they are; the others have a share of the rows that
    suits a task and are shuffled.
    """
    heavy = (weight * HEAVY > total) if isinstance(total, Column) else (weight > total // HEAVY + 1)
    few = F.broadcast(table.where(heavy))
    rest = rows.join(F.broadcast(table.where(heavy).select(*keys)), keys, "left_anti")
    return rows.join(few, keys).unionByName(rest.join(table.where(~heavy), keys))

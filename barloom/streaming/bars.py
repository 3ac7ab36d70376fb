"""Streams of bars on Structured Streaming: versioned ingest, watermarks, derivation, lag.

A table is a folder of versions ``v=<n>``.  A micro-batch of a stream reads what earlier ones left, writes version n, and is idempotent: a
batch that is run again after a failure overwrites the version it was writing.  Tables of bars are divided by day and a version has
only the days that its batch touched; ``<folder>-heads`` tells the newest version of each day, so a batch costs what its own days cost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from barloom.operators import bars as der, merge as m
from barloom.operators.calendar import session_date_of

HEADS = "bar_day date, v bigint"
MARKS = "instrument_key string, price_basis string, latest_seen_utc timestamp_ntz, latest_complete_utc timestamp_ntz, data_version bigint, run_id bigint"


def version_path(folder: str, batch: int) -> str:
    return f"{folder}/v={batch}"


def read_version(spark: SparkSession, folder: str, batch: int, schema: T.StructType | str) -> DataFrame:
    """Version ``batch`` of a table; version -1 is empty."""
    if batch < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(version_path(folder, batch))


def _dated(rows: DataFrame) -> DataFrame:
    """Bars with the day of their time."""
    return rows.withColumn("bar_day", F.coalesce(F.to_date("time_utc"), F.lit("1970-01-01").cast("date")))


def _session_dated(rows: DataFrame) -> DataFrame:
    """Bars, with asset_type, with the day of their session: all bars of a session share it."""
    return rows.withColumn("bar_day", F.coalesce(session_date_of(F.col("time_utc")), F.lit("1970-01-01").cast("date")))


def read_days(spark: SparkSession, folder: str, batch: int, schema: T.StructType, days: DataFrame | None = None) -> DataFrame:
    """A table of bars as ``batch`` left it, or those of its ``days``; the join on partition columns prunes the scan."""
    if batch < 0:
        return spark.createDataFrame([], schema)
    heads = read_version(spark, f"{folder}-heads", batch, HEADS)
    if days is not None:
        heads = heads.join(days, "bar_day", "left_semi")
    stored = T.StructType([*schema.fields, T.StructField("v", T.LongType()), T.StructField("bar_day", T.DateType())])
    # Later versions, as of a batch that runs again, aren't even listed as input.
    return spark.read.schema(stored).parquet(folder).where(F.col("v") <= batch).join(heads, ["v", "bar_day"], "left_semi").select(*schema.names)


def write_days(rows: DataFrame, folder: str, batch: int, days: DataFrame) -> None:
    """Replace ``days`` of a table by ``rows``, which have their bar_day."""
    spark = rows.sparkSession
    rows.hint("rebalance", "bar_day").write.mode("overwrite").partitionBy("bar_day").parquet(version_path(folder, batch))  # few files for each day
    others = read_version(spark, f"{folder}-heads", batch - 1, HEADS).join(days, "bar_day", "left_anti")
    heads = others.unionByName(days.withColumn("v", F.lit(batch).cast("long")))
    heads.write.mode("overwrite").parquet(version_path(f"{folder}-heads", batch))


def _run(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Run a stream's available data through ``step`` to the end."""
    query = stream.writeStream.outputMode(mode).foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def split_version_change(batch: DataFrame, marks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of series whose data_version is the known one (or that are new), and one warning for each series whose version has changed."""
    known = marks.select("instrument_key", "price_basis", F.col("data_version").alias("known_version"))
    joined = batch.join(known, ["instrument_key", "price_basis"], "left")
    changed = F.col("known_version").isNotNull() & (F.col("known_version") != F.col("data_version"))
    stopped = joined.where(changed).groupBy("instrument_key", "price_basis").agg(F.max("data_version").alias("observed_version"), F.max("known_version").alias("known_version"), F.count("*").alias("rows"))
    good = joined.join(stopped.select("instrument_key", "price_basis"), ["instrument_key", "price_basis"], "left_anti")
    return good.select(*batch.columns), stopped


def with_lookback(batch: DataFrame, current: DataFrame, attributes: DataFrame) -> DataFrame:
    """The batch with the last stored bars of its series (overlap_bars each), so late corrections meet what they correct."""
    w = Window.partitionBy("instrument_key").orderBy(F.col("time_utc").desc())
    recent = current.join(batch.select("instrument_key").distinct(), "instrument_key", "left_semi").withColumn("rank", F.row_number().over(w)).join(attributes.select("instrument_key", "overlap_bars"), "instrument_key")
    return batch.unionByName(recent.where("rank <= overlap_bars").select(*batch.columns))


def stream_ingest(stream: DataFrame, folder: str, checkpoint: str) -> None:
    """Ingest pages of bars: first seen of repeated samples, stop at a version change, upsert, advance watermarks; a batch is all or nothing.

    Leaves ``bars`` (by day), ``marks`` (versions) and ``warnings`` (appended by batch) under ``folder``; ``newest_days`` and ``newest`` read the last state.
    """
    spark, schema = stream.sparkSession, stream.schema

    def step(batch: DataFrame, n: int) -> None:
        marks = read_version(spark, f"{folder}/marks", n - 1, MARKS)
        good, stopped = split_version_change(m.merge_pages(batch).select(*batch.columns), marks)
        days = _dated(good).select("bar_day").distinct()
        write_days(_dated(m.upsert(read_days(spark, f"{folder}/bars", n - 1, schema, days), good)), f"{folder}/bars", n, days)
        m.advance_watermarks(marks, good).write.mode("overwrite").parquet(version_path(f"{folder}/marks", n))
        stopped.write.mode("overwrite").parquet(version_path(f"{folder}/warnings", n))

    _run(stream, step, checkpoint)


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """Number of the last finished batch of a stream, from its commit log; -1 before the first."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return max([-1, *(int(x) for x in names if x.isdigit())])


def newest(spark: SparkSession, folder: str, checkpoint: str, schema: T.StructType | str) -> DataFrame:
    return read_version(spark, folder, last_batch(spark, checkpoint), schema)


def newest_days(spark: SparkSession, folder: str, checkpoint: str, schema: T.StructType) -> DataFrame:
    return read_days(spark, folder, last_batch(spark, checkpoint), schema)


def stream_derive(stream: DataFrame, sessions: DataFrame, folder: str, checkpoint: str) -> None:
    """Keep four-hour bars up to date: each batch upserts its hourly bars and derives the days it touched anew (incomplete buckets come again)."""
    spark, schema = stream.sparkSession, stream.schema

    def step(batch: DataFrame, n: int) -> None:
        days = _session_dated(batch).select("bar_day").distinct()
        write_days(_session_dated(m.upsert(read_days(spark, f"{folder}/hours", n - 1, schema, days), batch)), f"{folder}/hours", n, days)
        hours = read_days(spark, f"{folder}/hours", n, schema, days)
        kinds = hours.groupBy("instrument_key").agg(F.min("asset_type").alias("asset_type"))
        anew = _session_dated(der.derive_4h(hours, sessions).join(kinds, "instrument_key")).drop("asset_type")
        write_days(anew, f"{folder}/bars_4h", n, days)

    _run(stream, step, checkpoint)


def stream_slot_lag(stream: DataFrame, slots: DataFrame, now: Column, folder: str, checkpoint: str) -> None:
    """Slots due at ``now`` that a stream has delivered: appended as they come, by a join of the stream with the static slots."""
    due = slots.where(F.col("slot_utc") <= now).select("instrument_key", F.col("slot_utc").alias("time_utc"))
    arrived = stream.where("is_complete").join(due, ["instrument_key", "time_utc"]).select("instrument_key", "time_utc")
    query = arrived.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def slot_lag(slots: DataFrame, arrived: DataFrame, now: Column) -> DataFrame:
    """Due slots, delivered ones, and DATA_NOT_READY for series whose last due slot hasn't come."""
    due = slots.where(F.col("slot_utc") <= now)
    have = arrived.select("instrument_key", F.col("time_utc").alias("slot_utc")).distinct().withColumn("here", F.lit(True))
    joined = due.join(have, ["instrument_key", "slot_utc"], "left")
    ready = F.max_by(F.coalesce("here", F.lit(False)), "slot_utc")
    return joined.groupBy("instrument_key").agg(F.count("*").alias("due_slots"), F.count("here").alias("delivered"), F.when(ready, "READY").otherwise("DATA_NOT_READY").alias("readiness"))

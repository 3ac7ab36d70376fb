"""Derived bars: four-hour and daily bars of hourly ones, anchored at session opens.

Hourly bars have instrument_key, asset_type, calendar_id, verification_status, time_utc, price_basis,
open, high, low, close, volume, is_complete, quality_status and run_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from barloom.functions.times import plus_hours, seconds_between
from barloom.operators.calendar import align_range


def grade_derived(actual: Column, expected: Column) -> Column:
    """NOT_EVALUATED on an unverified calendar (an unknown status counts as verified), PASS when all slots are there, else WARN."""
    return F.when(F.col("verification_status") != "VERIFIED", "NOT_EVALUATED").when(actual == expected, "PASS").otherwise("WARN")


def _eligible(bars: DataFrame, sessions: DataFrame, keys: list[str] | None) -> DataFrame:
    bars = bars.where("is_complete and quality_status = 'PASS'")
    if keys is not None:
        bars = bars.where(F.col("instrument_key").isin(keys))
    slots = F.ceil(seconds_between(F.col("open_utc"), F.col("close_utc")) / 3600)
    bucket = F.floor(seconds_between(F.col("open_utc"), F.col("time_utc")) / 14400)
    return align_range(bars, sessions).withColumn("session_slots", slots).withColumn("bucket", bucket)


def _measures() -> list[Column]:
    return [
        F.min_by("open", "time_utc").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "time_utc").alias("close"),
        F.sum("volume").cast("long").alias("volume"), F.count("*").alias("actual_slots"), F.min("run_id").alias("first_run"), F.max("run_id").alias("last_run"),
    ]


def derive_4h(bars: DataFrame, sessions: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Four-hour bars counted from each session's open; the last bucket of a session may expect fewer slots.

    ``keys``: None for all instruments, a list for a scoped rebuild (an empty one rebuilds nothing).
    """
    keyed = _eligible(bars, sessions, keys).groupBy("instrument_key", "price_basis", "verification_status", "open_utc", "bucket", "session_slots").agg(*_measures())
    expected = F.least(F.lit(4), F.col("session_slots") - F.col("bucket") * 4)
    return keyed.select(
        "instrument_key", plus_hours(F.col("open_utc"), F.col("bucket") * 4).alias("time_utc"), "price_basis", "open", "high", "low", "close", "volume",
        F.col("actual_slots").cast("long").alias("actual_slots"), expected.cast("long").alias("expected_slots"), (F.col("actual_slots") == expected).alias("is_complete"),
        "first_run", "last_run", grade_derived(F.col("actual_slots"), expected).alias("quality_status"))


def derive_1d(bars: DataFrame, sessions: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Daily bars by session date."""
    keyed = _eligible(bars, sessions, keys).groupBy("instrument_key", "price_basis", "verification_status", "session_date", "session_slots").agg(*_measures())
    return keyed.select(
        "instrument_key", "session_date", "price_basis", "open", "high", "low", "close", "volume", "actual_slots", F.col("session_slots").cast("long").alias("expected_slots"),
        (F.col("actual_slots") == F.col("session_slots")).alias("is_complete"), "first_run", "last_run", grade_derived(F.col("actual_slots"), F.col("session_slots")).alias("quality_status"))


# --- derivation versions ------------------------------------------------------------------------
# A folder holds derived bars of several derivation versions, divided by (derivation_version, instrument_key).

def write_derivation(derived: DataFrame, path: str, version: str, keys: DataFrame | None = None) -> None:
    """Put derived bars in place as ``version``; with ``keys`` (instrument_key) a scoped rebuild, which replaces those instruments' partitions alone, also where nothing is derived any more.

    Dynamic partition overwrite replaces what gets rows, so each instrument of the scope gets a row without values, which readers leave out.
    """
    scope = (derived if keys is None else keys).select("instrument_key").distinct()
    if keys is not None:
        derived = derived.join(scope, "instrument_key", "left_semi")
    marks = scope.select(*[(F.col(c) if c == "instrument_key" else F.lit(None).cast(t).alias(c)) for c, t in derived.dtypes])
    rows = derived.withColumn("is_mark", F.lit(False)).unionByName(marks.withColumn("is_mark", F.lit(True))).withColumn("derivation_version", F.lit(version))
    rows.hint("rebalance", "instrument_key").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("derivation_version", "instrument_key").parquet(path)


def read_derivation(spark, path: str, version: str) -> DataFrame:
    """The bars of one derivation version; other versions' partitions aren't read."""
    return spark.read.parquet(path).where(F.col("derivation_version") == version).where("not is_mark").drop("is_mark", "derivation_version")

"""Watermark states of series, kept in the stream's own state store.

A series' state is its watermarks, its accepted data version and its status; it lives in the state store between batches and across restarts from
the checkpoint.  Rows of a batch with an error leave the series BLOCKED_QUALITY, another data version leaves it STALE_DATA_VERSION; both leave the watermarks
where they are.  A good batch makes it ACTIVE again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from barloom.functions.package import send_package
from barloom.functions.times import micros_of, time_of
from barloom.streaming.bars import _run, last_batch, version_path

STATES = "instrument_key string, price_basis string, seen bigint, complete bigint, data_version bigint, run_id bigint, data_status string, status_code string"
_STATE = "seen bigint, complete bigint, data_version bigint, run_id bigint"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _greatest(*values: int | None) -> int | None:
    return max((v for v in values if v is not None), default=None)


class _Series(StatefulProcessor):
    """One series: its rows of a batch come once, in as many frames as they fill."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("series", _STATE)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        seen = complete = version = least = run = code = None
        for frame in rows:
            errors = frame["error_code"].dropna()
            code = min([*errors, *([code] if code else [])], default=None)
            good = frame[frame["error_code"].isna()]
            seen = _greatest(seen, *(int(v) for v in [good["micros"].max()] if pd.notna(v)))
            complete = _greatest(complete, *(int(v) for v in [good["micros"][good["is_complete"] == True].max()] if pd.notna(v)))  # noqa: E712
            version = _greatest(version, *(int(v) for v in [good["data_version"].max()] if pd.notna(v)))
            low = good["data_version"].min()
            least = int(low) if pd.notna(low) and (least is None or low < least) else least
            run = _greatest(run, *(int(v) for v in [frame["run_id"].max()] if pd.notna(v)))
        known = self.held.get() if self.held.exists() else (None, None, None, None)
        if code is None and least != version:
            code = "MULTIPLE_DATA_VERSIONS_IN_RUN"
        if code is not None:
            status, now = "BLOCKED_QUALITY", known
        elif known[2] is not None and version is not None and version != known[2]:
            status, code, now = "STALE_DATA_VERSION", "DATA_VERSION_CHANGED_REVIEW_PENDING", known
        else:
            status, now = "ACTIVE", (_greatest(known[0], seen), _greatest(known[1], complete), version if version is not None else known[2], _greatest(known[3], run))
            self.held.update(now)
        out = pd.DataFrame({"instrument_key": [key[0]], "price_basis": [key[1]]})
        for name, value in zip(("seen", "complete", "data_version", "run_id"), now):
            out[name] = pd.array([value], dtype="Int64")
        yield out.assign(data_status=status, status_code=pd.array([code], dtype="string"))

    def close(self) -> None:
        pass


@contextmanager
def _rocks(spark: SparkSession) -> Iterator[None]:
    """Keyed states need the RocksDB store; a query takes it over when it starts."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def stream_states(stream: DataFrame, folder: str, checkpoint: str) -> None:
    """Take all rows that are there (instrument_key, price_basis, time_utc, is_complete, data_version, run_id, error_code) and log each touched series' state under ``folder``."""
    spark = stream.sparkSession
    send_package(spark)
    rows = stream.select("instrument_key", "price_basis", micros_of(F.col("time_utc")).alias("micros"), "is_complete", F.col("data_version").cast("long").alias("data_version"), F.col("run_id").cast("long").alias("run_id"), "error_code")
    states = rows.groupBy("instrument_key", "price_basis").transformWithStateInPandas(_Series(), STATES, "Update", "None")

    def step(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(version_path(folder, n))

    with _rocks(spark):
        _run(states, step, checkpoint, "update")


def latest_states(spark: SparkSession, folder: str, checkpoint: str) -> DataFrame:
    """The newest state of each series: instrument_key, price_basis, latest_seen_utc, latest_complete_utc, data_version, run_id, data_status, status_code."""
    rows = spark.read.schema(f"{STATES}, v bigint").parquet(folder).where(F.col("v") <= last_batch(spark, checkpoint))
    newest = F.row_number().over(Window.partitionBy("instrument_key", "price_basis").orderBy(F.col("v").desc()))
    rows = rows.withColumn("rank", newest).where("rank = 1")
    return rows.select("instrument_key", "price_basis", time_of(F.col("seen")).alias("latest_seen_utc"), time_of(F.col("complete")).alias("latest_complete_utc"), "data_version", "run_id", "data_status", "status_code")

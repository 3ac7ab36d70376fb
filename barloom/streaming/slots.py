"""Due slots against arrivals, as outer joins of two streams.

A slot is expected at ``ready_utc`` and has to be there at ``deadline_utc``.  Each limit is one left outer join of the stream of slots with the stream of
arrivals, in event time: when the arrivals' clock (their watermark) has passed a limit, a slot without an arrival leaves the join's state as DATA_NOT_READY or
as MISS; an arrival in time leaves it at once as PASS, or as BLOCKED if its run didn't pass.  Slots whose limits lie ahead stay in the state.

The clock is the slower one of both streams, and a stream that has had no row since the start of a run holds it back.  So each run gets a tick in both: a row of the instrument
``TICK`` at the present time.  (A condition on it would be pushed below the watermarks, so its events are left out on reading.)
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.functions.times import micros_of

EVENTS = "instrument_key string, slot_utc timestamp_ntz, event string, arrived_utc timestamp_ntz"
TICK = ""
#: The longest time from a slot's start to its limit: how far arrivals are kept.
REACH = "1 day"
#: Slots and arrivals for each partition of the state.
ROWS_EACH = 100_000


def _against(slots: DataFrame, arrivals: DataFrame, limit: str, lateness: str) -> DataFrame:
    instant = lambda c: F.timestamp_micros(micros_of(F.col(c)))  # noqa: E731  watermarks stand on instants
    s = slots.select("instrument_key", "slot_utc", instant(limit).alias("limit_at")).withWatermark("limit_at", "0 seconds").alias("s")
    a = arrivals.select("instrument_key", "time_utc", "arrived_utc", "run_status", instant("arrived_utc").alias("arrived_at")).withWatermark("arrived_at", lateness).alias("a")
    same = (F.col("s.instrument_key") == F.col("a.instrument_key")) & (F.col("s.slot_utc") == F.col("a.time_utc"))
    timely = (F.col("a.arrived_at") <= F.col("s.limit_at")) & (F.col("a.arrived_at") >= F.col("s.limit_at") - F.expr(f"interval {REACH}"))
    return s.join(a, same & timely, "left").select("s.instrument_key", "s.slot_utc", "a.arrived_utc", "a.run_status")


@contextmanager
def _stores(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """Within it a stream that starts for the first time has that many partitions of its state, at most the session's; later its checkpoint names them."""
    name = "spark.sql.shuffle.partitions"
    most = spark.conf.get(name)
    if partitions is not None:
        spark.conf.set(name, str(max(1, min(partitions, int(most)))))
    try:
        yield
    finally:
        spark.conf.set(name, most)


def partitions_for(rows: int) -> int:
    return -(-rows // ROWS_EACH)


def stream_slot_events(slots: DataFrame, arrivals: DataFrame, folder: str, lateness: str = "0 seconds", partitions: int | None = None) -> None:
    """Take what is there of slots (instrument_key, slot_utc, ready_utc, deadline_utc) and arrivals (instrument_key, time_utc, arrived_utc, run_status); events are appended under ``folder``.

    Arrivals may be late by ``lateness`` against the newest one or the newest tick.  ``partitions``: those of the joins' state, fixed by the first run (None: the session's);
    each has four stores in each of both streams, which are written in every batch whatever they hold.
    """
    here = F.col("arrived_utc").isNotNull()
    ready = _against(slots, arrivals, "ready_utc", lateness).where(~here).withColumn("event", F.lit("DATA_NOT_READY"))
    due = _against(slots, arrivals, "deadline_utc", lateness).withColumn("event", F.when(~here, "MISS").when(F.col("run_status") == "PASS", "PASS").otherwise("BLOCKED"))
    for name, rows in (("ready", ready), ("deadline", due)):
        out = rows.select("instrument_key", "slot_utc", "event", "arrived_utc")
        with _stores(slots.sparkSession, partitions):
            query = out.writeStream.format("parquet").option("path", f"{folder}/{name}").option("checkpointLocation", f"{folder}/checkpoint-{name}").outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()


def slot_events(spark: SparkSession, folder: str) -> DataFrame:
    both = [spark.read.schema(EVENTS).parquet(f"{folder}/{name}") for name in ("ready", "deadline")]
    return both[0].unionByName(both[1]).where(F.col("instrument_key") != TICK)


def slot_states(slots: DataFrame, events: DataFrame) -> DataFrame:
    """Each slot with what is known of it: PASS, BLOCKED, MISS, DATA_NOT_READY or PENDING, whether it was late for its ready time, and its first arrival in time."""
    has = lambda e: F.bool_or(F.col("event") == e)
    found = events.groupBy("instrument_key", "slot_utc").agg(*[F.coalesce(has(e), F.lit(False)).alias(e) for e in ("PASS", "BLOCKED", "MISS", "DATA_NOT_READY")], F.min("arrived_utc").alias("arrived_utc"))
    joined = slots.select("instrument_key", "slot_utc").join(found, ["instrument_key", "slot_utc"], "left")
    state = F.when(F.col("PASS"), "PASS").when(F.col("BLOCKED"), "BLOCKED").when(F.col("MISS"), "MISS").when(F.col("DATA_NOT_READY"), "DATA_NOT_READY").otherwise("PENDING")
    return joined.select("instrument_key", "slot_utc", state.alias("sla_status"), F.coalesce("DATA_NOT_READY", F.lit(False)).alias("not_ready_in_time"), "arrived_utc")

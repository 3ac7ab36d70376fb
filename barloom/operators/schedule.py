"""Delivery schedules of bars, service levels, calendar assignment and receipt calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.functions.times import plus_hours, plus_seconds, seconds_between
from barloom.operators.calendar import EQUITY, FX, contained_hours, open_sessions

# Delays of delivery and deadline after the start of a bar (hourly lanes) or the close (daily lane), in seconds.
FX_DUE, FX_DEADLINE = 3600 + 180, 3600 + 600
CANDIDATE_DUE, CANDIDATE_DEADLINE = 3600 + 360, 3600 + 900
EQUITY_DUE, EQUITY_DEADLINE = 3600 + 15, 3600 + 180
DAILY_DUE, DAILY_DEADLINE = 45 * 60, 90 * 60
CATCH_UP_HOURS, PAST_HOURS, AHEAD_HOURS = 6, 7, 4
# Closed and short days of the receipt calendar of 2026.
CLOSED_2026 = ("2026-01-01", "2026-01-19", "2026-02-16", "2026-04-03", "2026-05-25", "2026-06-19", "2026-07-03", "2026-09-07", "2026-11-26", "2026-12-25")
SHORT_2026 = ("2026-11-27", "2026-12-24")


def schedule_slots(sessions: DataFrame, lanes: DataFrame, now: Column) -> DataFrame:
    """Delivery slots of all lanes: slot_id, kind, keys, due_utc, deadline_utc, expected_utc and expected_session (daily lane alone).

    ``lanes``: kind (fx, fx_candidate, equity or daily), lane (a name), keys.  FX lanes have slots around ``now``; sessions: equity and FX ones.
    """
    fx = contained_hours(sessions.where(F.col("calendar_id") == FX), True, 5, 1).select("session_date", F.col("hour_utc").alias("bar"))
    eq = contained_hours(sessions.where(F.col("calendar_id") == EQUITY), False).select("session_date", F.col("hour_utc").alias("bar"))
    end = open_sessions(sessions).where(F.col("calendar_id") == EQUITY)
    slots = F.ceil(seconds_between(F.col("open_utc"), F.col("close_utc")) / 3600)
    daily = end.select("session_date", "close_utc", plus_hours(F.col("open_utc"), F.greatest(slots, F.lit(1)) - 1).alias("bar"))

    def part(hours: DataFrame, kind: str, base: str, due: int, deadline: int) -> DataFrame:
        made = hours.select("session_date", "bar", plus_seconds(F.col(base), F.lit(due)).alias("due_utc"), plus_seconds(F.col(base), F.lit(deadline)).alias("deadline_utc"), F.lit(kind).alias("kind"))
        return made.join(F.broadcast(lanes), "kind")  # a handful of lanes

    near = (F.col("due_utc") >= plus_hours(now, -PAST_HOURS)) & (F.col("due_utc") <= plus_hours(now, AHEAD_HOURS))
    hourly_fx = part(fx, "fx", "bar", FX_DUE, FX_DEADLINE).where(near)
    near_bar = (plus_seconds(F.col("bar"), F.lit(FX_DUE)) >= plus_hours(now, -PAST_HOURS)) & (plus_seconds(F.col("bar"), F.lit(FX_DUE)) <= plus_hours(now, AHEAD_HOURS))
    candidates = part(fx, "fx_candidate", "bar", CANDIDATE_DUE, CANDIDATE_DEADLINE).where(near_bar)
    rows = hourly_fx.unionByName(candidates).unionByName(part(eq, "equity", "bar", EQUITY_DUE, EQUITY_DEADLINE)).unionByName(part(daily, "daily", "close_utc", DAILY_DUE, DAILY_DEADLINE))
    stamp = F.when(F.col("kind").startswith("fx"), F.date_format("due_utc", "yyyyMMdd'T'HHmmss'Z'")).when(F.col("kind") == "daily", F.col("session_date").cast("string")).otherwise(F.concat_ws("-", F.col("session_date").cast("string"), F.date_format("bar", "HHmm'Z'")))
    return rows.select(
        F.concat_ws("-", "lane", stamp).alias("slot_id"), "kind", "lane", "keys", "due_utc", "deadline_utc", F.col("bar").alias("expected_utc"), F.when(F.col("kind") == "daily", F.col("session_date")).alias("expected_session"))


def latest_due(slots: DataFrame, completed: DataFrame, now: Column) -> DataFrame:
    """The newest slot of each lane that is due at ``now``, not older than six hours and not completed (slot_id)."""
    due = slots.where((F.col("due_utc") <= now) & (seconds_between(F.col("due_utc"), now) <= CATCH_UP_HOURS * 3600)).join(completed.select("slot_id"), "slot_id", "left_anti")
    w = Window.partitionBy("kind", "keys").orderBy(F.col("due_utc").desc(), "slot_id")
    return due.withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank")


def slot_sla(slots: DataFrame, runs: DataFrame) -> DataFrame:
    """PASS for a passed run that started by the deadline, MISS for a late start, BLOCKED for a run in time that didn't pass (runs: slot_id, started_utc, run_status)."""
    joined = runs.join(slots.select("slot_id", "deadline_utc"), "slot_id")
    late = F.col("started_utc") > F.col("deadline_utc")
    return joined.select("slot_id", "started_utc", "run_status", F.when(late, "MISS").when(F.col("run_status") == "PASS", "PASS").otherwise("BLOCKED").alias("sla_status"))


def watermark_digest(keys: DataFrame, watermarks: DataFrame) -> DataFrame:
    """SHA-256 over the ordered states of the given keys, with a marker for missing ones, as one row (keys are a bounded list)."""
    joined = keys.select(F.lower("instrument_key").alias("instrument_key")).distinct().join(watermarks, "instrument_key", "left")
    state = F.when(F.col("data_status").isNull(), F.to_json(F.struct("instrument_key", F.lit(True).alias("missing")))).otherwise(
        F.to_json(F.struct("data_status", "data_version", "instrument_key", "latest_complete_utc", "run_id"), {"ignoreNullFields": "false"}))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("instrument_key", state.alias("state")))), lambda x: x["state"])
    return joined.agg(F.count("*").alias("keys"), F.count_if(F.col("data_status").isNull()).alias("missing"), F.sha2(F.concat_ws(",", listed), 256).alias("digest"))


def apply_calendars(stored: DataFrame, new: DataFrame, instruments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sessions with all of each new calendar's rows replaced, and instruments with a calendar by asset type."""
    kept = stored.join(new.select("calendar_id").distinct(), "calendar_id", "left_anti")
    assigned = instruments.withColumn("calendar_id", F.when(F.col("asset_type") == "FxSpot", FX).when(F.col("asset_type") == "Etf", EQUITY))
    return kept.unionByName(new.select(*kept.columns)), assigned


def receipt_calendar(days: DataFrame) -> DataFrame:
    """Sessions of the explicit calendar of 2026 for the weekdays of ``days`` (session_date): UTC times, state, venues."""
    from barloom.operators.calendar import _at

    d = F.col("session_date")
    text = d.cast("string")
    open_days = days.where((F.weekday(d) < 5) & ~text.isin(*CLOSED_2026)).distinct()
    early = text.isin(*SHORT_2026)
    return open_days.select(d, _at(d, 9, 30).alias("open_utc"), F.when(early, _at(d, 13)).otherwise(_at(d, 16)).alias("close_utc"), F.when(early, "SHORT_SESSION").otherwise("OPEN").alias("session_state"), F.lit("ARCX,XNAS").alias("venues"))

"""Bounded imputation: missing slots of verified sessions filled with the close before them, under strict limits.

Slots have instrument_key, session_date, slot_utc; bars have instrument_key, time_utc, close, data_version, is_complete.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from barloom.operators.calendar import terminal_slot
from barloom.operators.normalize import valid_digest, valid_path

MAX_CONSECUTIVE, MAX_PER_SESSION = 2, 2
IMPUTED, ACCEPTED = "IMPUTED_PREVIOUS_VALID", "PROVIDER_ACCEPTED"  # fixed values
SESSION = ["instrument_key", "session_date"]


def slot_states(slots: DataFrame, bars: DataFrame) -> DataFrame:
    """Each slot with its index in the session, its complete bar's close and version, and ``missing``."""
    have = bars.where("is_complete").select("instrument_key", F.col("time_utc").alias("slot_utc"), "close", "data_version", F.lit(True).alias("present"))
    w = Window.partitionBy(*SESSION).orderBy("slot_utc")
    return slots.join(have, ["instrument_key", "slot_utc"], "left").select(
        *SESSION, "slot_utc", "close", "data_version", F.col("present").isNull().alias("missing"), F.row_number().over(w).alias("index"))


def session_profile(states: DataFrame) -> DataFrame:
    """Expected, actual and missing slots of each session, its versions, and whether its last slot is there."""
    return states.groupBy(*SESSION).agg(
        F.count("*").alias("expected_slots"), F.count_if(~F.col("missing")).alias("actual_slots"), F.count_if("missing").alias("missing_slots"),
        F.count_distinct("data_version").alias("versions"), (~F.max_by("missing", "index")).alias("terminal_present"))


def missing_islands(states: DataFrame) -> DataFrame:
    """Missing slots with the run of consecutive ones that holds each: position in the run and length."""
    w = Window.partitionBy(*SESSION).orderBy("index")
    gone = states.where("missing").withColumn("run", F.col("index") - F.row_number().over(w))
    own = Window.partitionBy(*SESSION, "run")
    return gone.select(*SESSION, "slot_utc", "index", "run", F.row_number().over(own.orderBy("index")).alias("gap_index"), F.count("*").over(own).alias("gap_count"))


def anchored_fill(states: DataFrame, sessions: DataFrame, bars: DataFrame) -> DataFrame:
    """Missing slots that can be filled: the left anchor is the slot before the run, or the previous session's terminal bar for a run at
    the open; the slot after the run must be there; both and the session have one data_version; the last slot is never filled.

    ``sessions``: those of the instruments, as instrument_key, session_date, open_utc, close_utc.
    """
    islands = missing_islands(states)
    own = Window.partitionBy(*SESSION, "run")
    ends = islands.withColumn("first_index", F.min("index").over(own)).withColumn("last_index", F.max("index").over(own))
    at = states.where("not missing").select(*SESSION, F.col("index").alias("i"), F.col("slot_utc").alias("anchor_utc"), F.col("close").alias("anchor_close"), F.col("data_version").alias("anchor_version"))
    before = Window.partitionBy("instrument_key").orderBy("close_utc")
    previous = sessions.select(*SESSION, F.lag(terminal_slot()).over(before).alias("previous_utc"))
    terminal = bars.where("is_complete").select("instrument_key", F.col("time_utc").alias("previous_utc"), F.col("close").alias("previous_close"), F.col("data_version").alias("previous_version"))
    left = at.select(*SESSION, (F.col("i") + 1).alias("first_index"), F.col("anchor_utc").alias("l_utc"), F.col("anchor_close").alias("l_close"), F.col("anchor_version").alias("l_version"))
    right = at.select(*SESSION, (F.col("i") - 1).alias("last_index"), F.col("anchor_version").alias("r_version"))
    joined = (ends.join(left, [*SESSION, "first_index"], "left").join(right, [*SESSION, "last_index"], "left")
              .join(previous.join(terminal, ["instrument_key", "previous_utc"]), SESSION, "left"))
    opens = F.col("first_index") == 1
    source, close, version = (F.when(opens, F.col(f"previous_{c}")).otherwise(F.col(f"l_{c}")) for c in ("utc", "close", "version"))
    filled = joined.select(
        *SESSION, "slot_utc", close.alias("close"), source.alias("source_utc"), "gap_index", "gap_count", version.alias("source_version"), F.col("r_version").alias("right_version"),
        F.when(opens, "PROVIDER_SESSION_OPEN_ROWS_MISSING").otherwise("PROVIDER_INTERNAL_SESSION_ROWS_MISSING").alias("reason"))
    return filled.where("close is not null and right_version is not null and source_version = right_version").drop("right_version")


def imputation_plan(states: DataFrame, fills: DataFrame, instruments: DataFrame, approved: DataFrame | None = None) -> DataFrame:
    """Status of each session by the first blocker that applies.

    ``approved``: instrument_key, slot_utc that may be filled; None approves all.
    """
    profile = session_profile(states).join(instruments.select("instrument_key", "verification_status"), "instrument_key")
    longest = missing_islands(states).groupBy(*SESSION).agg(F.max("gap_count").alias("longest"))
    filled = fills.groupBy(*SESSION).agg(F.count("*").alias("fillable"))
    joined = profile.join(longest, SESSION, "left").join(filled, SESSION, "left")
    unapproved = F.lit(0)
    if approved is not None:
        outside = states.where("missing").join(approved.select("instrument_key", "slot_utc"), ["instrument_key", "slot_utc"], "left_anti").groupBy(*SESSION).agg(F.count("*").alias("outside"))
        joined = joined.join(outside, SESSION, "left")
        unapproved = F.coalesce("outside", F.lit(0))
    status = (
        F.when(F.coalesce(F.col("verification_status") != "VERIFIED", F.lit(True)), "BLOCKED_CALENDAR_NOT_VERIFIED").when(~F.col("terminal_present"), "BLOCKED_DAILY_CLOSE_SOURCE_MISSING")
        .when(F.col("missing_slots") == 0, "PASS_NO_IMPUTATION").when(F.col("missing_slots") > MAX_PER_SESSION, "BLOCKED_MISSING_PER_SESSION_LIMIT")
        .when(F.col("longest") > MAX_CONSECUTIVE, "BLOCKED_CONSECUTIVE_MISSING_LIMIT").when(unapproved > 0, "BLOCKED_UNAPPROVED_IMPUTATION_SCOPE")
        .when(F.col("versions") != 1, "BLOCKED_DATA_VERSION_IDENTITY").when(F.coalesce("fillable", F.lit(0)) < F.col("missing_slots"), "BLOCKED_ACTUAL_ANCHOR_MISSING")
        .otherwise("PASS_WITH_IMPUTATION_WARNING"))
    return joined.select(*SESSION, "expected_slots", "actual_slots", "missing_slots", status.alias("plan_status"))


def overlay_rows(plan: DataFrame, fills: DataFrame) -> DataFrame:
    """The filled slots of sessions that pass with imputation."""
    return fills.join(plan.where("plan_status = 'PASS_WITH_IMPUTATION_WARNING'").select(*SESSION), SESSION)


def recent_sessions(sessions: DataFrame, n: int, now) -> DataFrame:
    """The last n closed sessions of each instrument."""
    w = Window.partitionBy("instrument_key").orderBy(F.col("session_date").desc())
    return sessions.where(F.col("close_utc") <= now).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).drop("rank")


def overlay_bars(bars: DataFrame, overlay: DataFrame) -> DataFrame:
    """Accepted bars, and the newest imputed row of each key where there is no accepted bar."""
    accepted = bars.where("is_complete and quality_status = 'PASS'").select("instrument_key", "time_utc", "close", F.lit(ACCEPTED).alias("source_kind"), "run_id")
    w = Window.partitionBy("instrument_key", "slot_utc").orderBy(F.col("created").desc())
    newest = overlay.withColumn("rank", F.row_number().over(w)).where("rank = 1").select("instrument_key", F.col("slot_utc").alias("time_utc"), "close", F.lit(IMPUTED).alias("source_kind"), F.lit(None).cast("long").alias("run_id"))
    return accepted.unionByName(newest.join(accepted.select("instrument_key", "time_utc"), ["instrument_key", "time_utc"], "left_anti").select(*accepted.columns))


def daily_close(sessions: DataFrame, overlaid: DataFrame, expected) -> DataFrame:
    """Close of each session's terminal bar if it was accepted, with slot counts and a status.

    A session without any overlay row has no terminal flag at all (null), so it is BLOCKED_SESSION_COVERAGE.  ``sessions``: instrument_key,
    session_date, open_utc, close_utc, verification_status; ``expected``: the column of expected slots.
    """
    key = ["instrument_key", "session_date"]
    rows = overlaid.select("instrument_key", "time_utc", "source_kind", F.col("close").alias("bar_close"), F.to_date("time_utc").alias("day"))
    days = sessions.withColumn("day", F.explode(F.sequence(F.to_date("open_utc"), F.to_date("close_utc"))))  # the few days that a session touches
    inside = days.join(rows, ["instrument_key", "day"]).where("time_utc >= open_utc and time_utc < close_utc")
    inside = inside.withColumn("terminal", (F.col("time_utc") == terminal_slot()) & (F.col("source_kind") == ACCEPTED))
    found = inside.groupBy(*key).agg(
        F.count_distinct("time_utc").alias("observed_slots"), F.count_if(F.col("source_kind") == IMPUTED).alias("imputed_bars"), F.bool_or("terminal").alias("terminal_present"),
        F.max(F.when(F.col("terminal"), F.col("bar_close"))).alias("close"))
    zero = F.lit(0).cast("long")
    out = sessions.withColumn("expected_slots", expected).join(found, key, "left").withColumns({c: F.coalesce(c, zero) for c in ("observed_slots", "imputed_bars")})
    status = (
        F.when(F.col("verification_status") != "VERIFIED", "BLOCKED_CALENDAR_NOT_VERIFIED").when(~F.col("terminal_present"), "BLOCKED_DAILY_CLOSE_SOURCE_MISSING")
        .when(F.col("observed_slots") != F.col("expected_slots"), "BLOCKED_SESSION_COVERAGE").when(F.col("imputed_bars") > 0, "PASS_WITH_IMPUTATION_WARNING").otherwise("PASS"))
    return out.select("instrument_key", "session_date", "close", "expected_slots", "observed_slots", "imputed_bars", "terminal_present", status.alias("derivation_status"))


def latest_daily_close(bars_1d: DataFrame, overlay: DataFrame, bars: DataFrame) -> DataFrame:
    """The newest complete daily bar of each series, with the number of imputations that no accepted bar has replaced."""
    w = Window.partitionBy("instrument_key", "price_basis").orderBy(F.col("session_date").desc())
    newest = bars_1d.where("is_complete").withColumn("rank", F.row_number().over(w)).where("rank = 1")
    accepted = bars.where("is_complete and quality_status = 'PASS'").select("instrument_key", F.col("time_utc").alias("slot_utc"))
    active = overlay.join(accepted, ["instrument_key", "slot_utc"], "left_anti").groupBy("instrument_key").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    status = F.when(n > 0, "PASS_WITH_IMPUTATION_WARNING").when(F.col("quality_status") == "PASS", "PASS").otherwise("BLOCKED_DAILY_CLOSE_QUALITY")
    return newest.join(active, "instrument_key", "left").select("instrument_key", "price_basis", "session_date", "close", n.alias("imputed_bars"), status.alias("derivation_status"))


def daily_close_summary(latest: DataFrame, freshness: DataFrame, availability: DataFrame) -> DataFrame:
    """Counts of series by derivation, freshness and availability."""
    joined = freshness.select("instrument_key", "freshness_status").join(latest.select("instrument_key", "derivation_status"), "instrument_key", "left").join(availability.select("instrument_key", "availability"), "instrument_key", "left")
    return joined.groupBy(F.coalesce("derivation_status", F.lit("MISSING")).alias("derivation_status"), "freshness_status", "availability").agg(F.count("*").alias("series"))


def overlay_read(overlaid: DataFrame, key: str, start, end, limit: int) -> DataFrame:
    """Overlay rows of an instrument in [start, end) in order, one more than ``limit`` if there are more (so a reader sees the cut)."""
    return overlaid.where((F.col("instrument_key") == key) & (F.col("time_utc") >= start) & (F.col("time_utc") < end)).orderBy("time_utc").limit(limit + 1)


def provider_gap_warnings(approved: DataFrame, overlay: DataFrame, bars: DataFrame) -> DataFrame:
    """Approved slots that were filled; active while no accepted bar stands there."""
    accepted = bars.where("is_complete and quality_status = 'PASS'").select("instrument_key", F.col("time_utc").alias("slot_utc"), F.lit(True).alias("accepted"))
    joined = approved.join(overlay.select("instrument_key", "slot_utc", "source_utc", "reason"), ["instrument_key", "slot_utc"]).join(accepted, ["instrument_key", "slot_utc"], "left")
    return joined.select("instrument_key", "slot_utc", "source_utc", "reason", F.col("accepted").isNull().alias("active"))


# The blockers of a session, in order.
BLOCKERS = [
    "BLOCKED_IMPUTATION_SCOPE", "BLOCKED_CALENDAR_NOT_VERIFIED", "BLOCKED_EXPECTED_SESSION_INVALID", "BLOCKED_EXPECTED_SESSION_DUPLICATE", "BLOCKED_ACTUAL_TIME_INVALID", "BLOCKED_ACTUAL_DUPLICATE", "BLOCKED_ACTUAL_QUALITY",
    "BLOCKED_DAILY_CLOSE_SOURCE_MISSING", "BLOCKED_MISSING_PER_SESSION_LIMIT", "BLOCKED_CONSECUTIVE_MISSING_LIMIT", "BLOCKED_UNAPPROVED_IMPUTATION_SCOPE", "BLOCKED_DATA_VERSION_IDENTITY",
    "BLOCKED_UNAPPROVED_IMPUTATION_DATA_VERSION", "BLOCKED_RIGHT_ACTUAL_ANCHOR_MISSING", "BLOCKED_SESSION_START_WITHOUT_PREVIOUS_ACTUAL", "BLOCKED_LEFT_ACTUAL_ANCHOR_MISSING", "BLOCKED_UNAPPROVED_IMPUTATION_SOURCE",
    "BLOCKED_SOURCE_LINEAGE_MISSING"]


def strict_plan(slots: DataFrame, bars: DataFrame, instruments: DataFrame, previous: DataFrame, approved: DataFrame) -> DataFrame:
    """plan_status of each session by the whole list of blockers, for imputation that must be approved slot by slot.

    ``slots``: instrument_key, session_date, slot_utc; ``bars``: instrument_key, session_date, time_utc, open, high, low, close, is_complete, data_version, payload_sha256,
    artifact_relative_path; ``instruments``: instrument_key, in_scope, verification_status; ``previous``: instrument_key, session_date,
    previous_utc (the terminal slot of the session before); ``approved``: instrument_key, session_date, slots (array, in order), data_version, source_utc.
    Bars at other times than the expected ones don't count; an anchor at a session's open is the bar at previous_utc.
    """
    prices = [F.col(c) for c in ("open", "high", "low", "close")]
    valid = F.col("is_complete") & (F.least(*prices) > 0) & (F.col("high") >= F.greatest(*prices)) & (F.col("low") <= F.least(*prices)) & ~F.exists(F.array(*prices), lambda x: x.isNull())
    lineage = valid_digest(F.col("payload_sha256")) & valid_path(F.col("artifact_relative_path"))
    facts = bars.select(
        "instrument_key", "session_date", "time_utc", F.coalesce(valid, F.lit(False)).alias("valid"), F.coalesce(lineage, F.lit(False)).alias("lineage"), F.col("data_version").cast("long").alias("data_version"))
    at = facts.groupBy("instrument_key", "time_utc").agg(F.count("*").alias("n"), F.bool_and("valid").alias("valid"), F.bool_and("lineage").alias("lineage"), F.max("data_version").alias("version"))
    timeless = facts.where("time_utc is null").select(*SESSION).distinct().withColumn("timeless", F.lit(True))

    told = slots.groupBy(*SESSION).agg(F.count("*").alias("told"), F.count_distinct("slot_utc").alias("expected"), F.count_if(F.col("slot_utc").isNull()).alias("unknown"))
    each = slots.where("slot_utc is not null").select(*SESSION, "slot_utc").distinct().join(at.withColumnRenamed("time_utc", "slot_utc"), ["instrument_key", "slot_utc"], "left")
    order = Window.partitionBy(*SESSION).orderBy("slot_utc")
    each = each.withColumn("index", F.row_number().over(order)).withColumn("missing", F.col("n").isNull())
    one = each.groupBy(*SESSION).agg(
        F.count_if("missing").alias("missing"), F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.coalesce(F.bool_and("valid"), F.lit(True)).alias("all_valid"), F.max_by("missing", "index").alias("open_end"),
        F.count_distinct("version").alias("versions"), F.count_if(~F.col("missing") & F.col("version").isNull()).alias("unversioned"), F.max("version").alias("version"),
        F.array_sort(F.collect_list(F.when(F.col("missing"), F.col("slot_utc")))).alias("gaps"))  # a session's slots at most
    runs = each.where("missing").withColumn("run", F.col("index") - F.row_number().over(order)).groupBy(*SESSION, "run").agg(F.min("index").alias("first"), F.max("index").alias("last"), F.count("*").alias("length"))
    longest = runs.groupBy(*SESSION).agg(F.max("length").alias("longest"))

    there = each.where("not missing")
    left = there.select(*SESSION, (F.col("index") + 1).alias("first"), F.col("slot_utc").alias("l_utc"), F.col("valid").alias("l_valid"), F.col("version").alias("l_version"), F.col("lineage").alias("l_lineage"))
    right = there.select(*SESSION, (F.col("index") - 1).alias("last"), F.col("version").alias("r_version"), F.lit(True).alias("r_there"))
    before = previous.select(*SESSION, "previous_utc").join(at.withColumnRenamed("time_utc", "previous_utc"), ["instrument_key", "previous_utc"])
    before = before.select(*SESSION, F.col("previous_utc").alias("p_utc"), F.col("valid").alias("p_valid"), F.col("version").alias("p_version"), F.col("lineage").alias("p_lineage"))
    a = approved.select(*SESSION, F.col("slots").alias("a_slots"), F.col("data_version").cast("long").alias("a_version"), F.col("source_utc").alias("a_source"))
    ends = runs.join(left, [*SESSION, "first"], "left").join(right, [*SESSION, "last"], "left").join(before, SESSION, "left").join(a, SESSION, "left").join(one.select(*SESSION, "version"), SESSION)
    opens = F.col("first") == 1
    source = {c: F.when(opens, F.col(f"p_{c}")).otherwise(F.col(f"l_{c}")) for c in ("utc", "valid", "version", "lineage")}
    no = lambda c: ~F.coalesce(c, F.lit(False))
    code = (
        F.when(F.col("r_there").isNull(), BLOCKERS[13]).when(no(F.col("r_version") == F.col("version")), BLOCKERS[11]).when(opens & no(source["valid"]), BLOCKERS[14]).when(no(source["valid"]), BLOCKERS[15])
        .when(no(source["version"] == F.col("version")), BLOCKERS[11]).when(no(source["utc"] == F.col("a_source")), BLOCKERS[16]).when(no(source["lineage"]), BLOCKERS[17]))
    anchors = ends.withColumn("code", code).where("code is not null").groupBy(*SESSION).agg(F.min_by("code", "first").alias("anchor_code"))

    rows = told.join(one, SESSION, "left").join(longest, SESSION, "left").join(anchors, SESSION, "left").join(a, SESSION, "left").join(timeless, SESSION, "left").join(instruments.select("instrument_key", "in_scope", "verification_status"), "instrument_key", "left")
    missing = F.coalesce("missing", F.lit(0))
    status = (
        F.when(no(F.col("in_scope")), BLOCKERS[0]).when(no(F.col("verification_status") == "VERIFIED"), BLOCKERS[1]).when((F.col("unknown") > 0) | (F.col("expected") == 0), BLOCKERS[2]).when(F.col("told") != F.col("expected"), BLOCKERS[3])
        .when(F.col("timeless"), BLOCKERS[4]).when(F.col("most") > 1, BLOCKERS[5]).when(~F.col("all_valid"), BLOCKERS[6]).when(F.col("open_end"), BLOCKERS[7]).when(missing == 0, "PASS_NO_IMPUTATION").when(missing > MAX_PER_SESSION, BLOCKERS[8])
        .when(F.col("longest") > MAX_CONSECUTIVE, BLOCKERS[9]).when(no(F.col("a_slots") == F.col("gaps")), BLOCKERS[10]).when((F.col("unversioned") > 0) | (F.col("versions") != 1), BLOCKERS[11]).when(no(F.col("version") == F.col("a_version")), BLOCKERS[12])
        .when(F.col("anchor_code").isNotNull(), F.col("anchor_code")).otherwise("PASS_WITH_IMPUTATION_WARNING"))
    return rows.select(*SESSION, F.col("told").alias("expected_slots"), (F.col("expected") - missing).alias("actual_slots"), missing.alias("missing_slots"), status.alias("plan_status"))

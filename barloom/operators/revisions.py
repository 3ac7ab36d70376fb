"""Comparison of a provider's bars with the stored ones, and what to do about differences.

Both sides have instrument_key, time_utc, data_version and the content columns; one provider batch has one version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.operators.merge import CONTENT, numbered, with_content

# The limits of a bounded revision.
WINDOWS, ANCHOR_ROWS, MAX_REMOVED, MAX_AFFECTED, WHOLE_HISTORY_RATIO = (96, 384, 1200), 16, 64, 240, 0.80


def _content(side: str) -> Column:
    return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in CONTENT])


def _paired(provider: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of the provider and the stored rows inside the provider's range, with what happened to each, by ``keys`` of the provider."""
    ends = provider.groupBy(*keys).agg(F.min("time_utc").alias("lower"), F.max("time_utc").alias("upper"))
    inside = with_content(stored).join(ends, "instrument_key").where("time_utc between lower and upper").drop("lower", "upper")
    p, s = with_content(provider).alias("p"), inside.alias("s")
    joined = p.join(s, [F.col(f"p.{k}") == F.col(f"s.{k}") for k in (*keys, "time_utc")], "full")
    new, gone = F.col("s.time_utc").isNull(), F.col("p.time_utc").isNull()
    same = _content("p").eqNullSafe(_content("s"))
    kind = F.when(new, "new").when(gone, "removed").when(~same, "content").when(~F.col("p.data_version").eqNullSafe(F.col("s.data_version")), "version").otherwise("equal")
    return joined.select(
        *[F.coalesce(f"p.{k}", f"s.{k}").alias(k) for k in (*keys, "time_utc")], kind.alias("kind"),
        F.coalesce("p.is_complete", F.lit(False)).alias("complete"), (~gone).alias("provided"))


def compare_sample(provider: DataFrame, stored: DataFrame) -> DataFrame:
    """By series: rows of each kind and the provider's latest complete time."""
    kinds = [F.count_if(F.col("kind") == k).alias(f"{name}_rows") for k, name in (("content", "content_difference"), ("version", "version_only"), ("new", "new"), ("removed", "removed"))]
    return _paired(provider, stored, ["instrument_key"]).groupBy("instrument_key").agg(
        F.count_if("provided").alias("provider_rows"), F.count_if(F.col("kind").isin("content", "version", "equal")).alias("matched_rows"), *kinds, F.max(F.when(F.col("complete"), F.col("time_utc"))).alias("latest_complete_utc"))


def compare_window(provider: DataFrame, stored: DataFrame, keys: tuple[str, ...] = ("instrument_key",)) -> DataFrame:
    """The sample's counts with the affected range, the change ratio, the affected span and the stable anchor before the range, by ``keys`` of the provider."""
    rows = _paired(provider, stored, list(keys))
    w = Window.partitionBy(*keys)
    affected = F.col("kind").isin("content", "new", "removed")
    rows = rows.withColumn("affected_from", F.min(F.when(affected, F.col("time_utc"))).over(w)).withColumn("affected_to", F.max(F.when(affected, F.col("time_utc"))).over(w))
    before = F.col("provided") & (F.col("affected_from").isNull() | (F.col("time_utc") < F.col("affected_from")))
    stable = F.col("complete") & F.col("kind").isin("equal", "version")
    order = Window.partitionBy(*keys, "before").orderBy(F.col("time_utc").desc())
    rows = rows.withColumn("before", before).withColumn("rank", F.row_number().over(order)).withColumn("breaks", F.when(F.col("before") & ~stable, F.col("rank")))
    matched = F.col("kind").isin("content", "version", "equal")
    out = rows.groupBy(*keys, "affected_from", "affected_to").agg(
        F.count_if("provided").alias("provider_rows"), F.count_if(matched).alias("matched_rows"), F.count_if(matched & F.col("complete")).alias("matched_complete"),
        F.count_if(F.col("kind") == "content").alias("content_difference_rows"), F.count_if(F.col("kind") == "version").alias("version_only_rows"), F.count_if(F.col("kind") == "new").alias("new_rows"),
        F.count_if(F.col("kind") == "removed").alias("removed_rows"), F.count_if((F.col("kind") == "content") & F.col("complete")).alias("changed_complete"),
        (F.count_if(F.col("provided") & F.col("time_utc").between(F.col("affected_from"), F.col("affected_to"))) + F.count_if(F.col("kind") == "removed")).alias("affected_span_rows"),
        (F.coalesce(F.min("breaks"), F.count_if("before") + 1) - 1).alias("stable_anchor_rows"), F.min(F.when(F.col("provided"), F.col("time_utc"))).alias("lower"))
    at_boundary = F.coalesce(F.col("affected_from") == F.col("lower"), F.lit(False))
    return out.withColumn("at_window_boundary", at_boundary).drop("lower")


def decide(compared: DataFrame, requested: Column, maximum: int = WINDOWS[-1]) -> DataFrame:
    """READY_TO_APPLY, EXPAND or BLOCKED_FULL_REFETCH; the order of the rules matters."""
    ratio = F.col("changed_complete") >= F.lit(WHOLE_HISTORY_RATIO) * F.col("matched_complete")
    decision = (
        F.when(F.col("removed_rows") > MAX_REMOVED, "BLOCKED_FULL_REFETCH").when(F.col("affected_span_rows") > MAX_AFFECTED, "BLOCKED_FULL_REFETCH")
        .when((F.col("matched_complete") >= ANCHOR_ROWS) & ratio, "BLOCKED_FULL_REFETCH")
        .when((F.col("stable_anchor_rows") < ANCHOR_ROWS) | F.col("at_window_boundary"), F.when(requested < maximum, "EXPAND").otherwise("BLOCKED_FULL_REFETCH")).otherwise("READY_TO_APPLY"))
    return compared.withColumn("decision", decision)


def escalate_windows(provider: DataFrame, stored: DataFrame, counts: tuple[int, ...] = WINDOWS) -> DataFrame:
    """For each series the first window (of its newest rows) whose decision isn't EXPAND; all windows are compared in one job."""
    w = Window.partitionBy("instrument_key").orderBy(F.col("time_utc").desc())
    ranked = with_content(provider).withColumn("rank", F.row_number().over(w)).withColumn("window", F.explode(F.array(*map(F.lit, counts)))).where("rank <= window")
    columns = ["instrument_key", "time_utc", "data_version", *CONTENT]
    compared = compare_window(ranked.select(*columns, "window"), with_content(stored).select(*columns), ("instrument_key", "window"))
    decided = decide(compared, F.col("window"), counts[-1])
    return decided.where("decision <> 'EXPAND'").groupBy("instrument_key").agg(F.min_by("decision", "window").alias("decision"), F.min("window").alias("window"))


def apply_bounded(current: DataFrame, staged: DataFrame, compared: DataFrame) -> DataFrame:
    """The stored rows of each series' affected range replaced by the staged ones; where versions alone differ, the range is the newest staged
    time, so that one boundary row carries the new version."""
    newest = staged.groupBy("instrument_key").agg(F.max("time_utc").alias("newest"))
    ranges = compared.where("affected_from is not null or version_only_rows > 0").join(newest, "instrument_key", "left")
    ranges = ranges.select("instrument_key", F.coalesce("affected_from", "newest").alias("affected_from"), F.coalesce("affected_to", "newest").alias("affected_to"))
    inside = "time_utc between affected_from and affected_to"
    kept = current.join(ranges, "instrument_key", "left").where(f"affected_from is null or not ({inside})").drop("affected_from", "affected_to")
    return kept.unionByName(staged.join(ranges, "instrument_key").where(inside).drop("affected_from", "affected_to"))


def field_diff(provider: DataFrame, stored: DataFrame) -> DataFrame:
    """A row for each changed column of each matched bar."""
    p, s = with_content(provider).alias("p"), with_content(stored).alias("s")
    joined = p.join(s, (F.col("p.instrument_key") == F.col("s.instrument_key")) & (F.col("p.time_utc") == F.col("s.time_utc")))
    each = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"s.{c}").cast("string").alias("accepted"), F.col(f"p.{c}").cast("string").alias("provider")) for c in CONTENT])
    changed = F.explode(F.filter(each, lambda x: ~x["accepted"].eqNullSafe(x["provider"])))
    return joined.select(F.col("p.instrument_key").alias("instrument_key"), F.col("p.time_utc").alias("time_utc"), changed.alias("d")).select("instrument_key", "time_utc", "d.*")


def version_watch(rows: DataFrame) -> DataFrame:
    """Status of observed_version against the quarantined, last observed and accepted versions, in this order."""
    seen = F.col("observed_version")
    # The statuses.
    status = (
        F.when(seen == F.col("quarantined_version"), "NO_CHANGE_QUARANTINE_MAINTAINED").when(seen == F.col("last_observed_version"), "NO_CHANGE_REVISION_REVIEW_PENDING")
        .when(seen == F.col("accepted_version"), "PROVIDER_VERSION_REVERSION_REVIEW_REQUIRED").otherwise("NEW_PROVIDER_DATA_VERSION_REVIEW_REQUIRED"))
    return rows.withColumn("watch_status", status)


def series_availability(watermarks: DataFrame, states: DataFrame) -> DataFrame:
    """A series' availability: of its newest revision state, else by its data status."""
    default = F.when(F.col("data_status") == "ACTIVE", "AVAILABLE").otherwise("BLOCKED")
    return watermarks.join(states, "instrument_key", "left").select("instrument_key", "price_basis", F.coalesce("state", default).alias("availability"))


def revision_state(events: DataFrame, steps: DataFrame) -> DataFrame:
    """The newest event of each instrument with its newest step."""
    newest = events.groupBy("instrument_key").agg(F.max_by(F.struct("event_id", "event_status"), "event_id").alias("e")).select("instrument_key", "e.*")
    step = steps.groupBy("event_id").agg(F.max_by("step_result", "step_number").alias("step_result"), F.max("step_number").alias("step_number"))
    return newest.join(step, "event_id", "left")


def service_status(availability: DataFrame) -> DataFrame:
    """PASS, PARTIALLY_DEGRADED or BLOCKED over all series."""
    degraded = F.count_if(F.col("availability") == "BLOCKED")
    total = F.count("*")
    return availability.agg(total.alias("series"), degraded.alias("degraded"), F.when(degraded == 0, "PASS").when(degraded < total, "PARTIALLY_DEGRADED").otherwise("BLOCKED").alias("service_status"))


def stale_series(watermarks: DataFrame) -> DataFrame:
    return watermarks.where("data_status = 'STALE_DATA_VERSION'").select("instrument_key", "price_basis", "data_version").orderBy("instrument_key")


def simulate_sessions(provider: DataFrame, stored: DataFrame, slots: DataFrame) -> DataFrame:
    """By session: expected slots, slots complete after laying the provider's bars over the stored ones, and the status that would follow."""
    p = provider.select("instrument_key", F.col("time_utc").alias("slot_utc"), F.col("is_complete").alias("p"))
    s = stored.select("instrument_key", F.col("time_utc").alias("slot_utc"), F.col("is_complete").alias("s"))
    joined = slots.join(p, ["instrument_key", "slot_utc"], "left").join(s, ["instrument_key", "slot_utc"], "left")
    done = F.coalesce("p", "s", F.lit(False))
    return joined.groupBy("instrument_key", "session_date").agg(F.count("*").alias("expected_slots"), F.count_if(done).alias("complete_slots")).withColumn(
        "would_be", F.when(F.col("expected_slots") == F.col("complete_slots"), "PASS").otherwise("WARN"))


def record_warnings(events: DataFrame, steps: DataFrame, detections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A first event for each (instrument_key, new_version) without an open one, and a step for each detection.

    ``events``: event_id, instrument_key, new_version, event_status; ``steps``: event_id, step_number, step_result; ``detections``: instrument_key, new_version,
    detected_utc, step_result.  Gives all events and all steps; step numbers go on from the greatest of their event.
    """
    open_ = events.where("event_status = 'REVIEW_PENDING'").groupBy("instrument_key", "new_version").agg(F.max("event_id").alias("event_id"))
    keys = detections.select("instrument_key", "new_version").distinct()
    top = events.agg(F.coalesce(F.max("event_id"), F.lit(0)).alias("top"))
    fresh = keys.join(open_, ["instrument_key", "new_version"], "left_anti").crossJoin(F.broadcast(top))
    new = numbered(fresh, ["instrument_key", "new_version"], "number").select((F.col("top") + F.col("number")).alias("event_id"), "instrument_key", "new_version", F.lit("REVIEW_PENDING").alias("event_status"))
    owner = open_.select("event_id", "instrument_key", "new_version").unionByName(new.select("event_id", "instrument_key", "new_version"))
    last = steps.groupBy("event_id").agg(F.max("step_number").alias("last"))
    found = detections.join(owner, ["instrument_key", "new_version"]).join(last, "event_id", "left")
    order = F.row_number().over(Window.partitionBy("event_id").orderBy("detected_utc", "step_result"))
    added = found.select("event_id", (F.coalesce("last", F.lit(0)) + order).cast("long").alias("step_number"), "step_result")
    return events.unionByName(new), steps.unionByName(added)


def review(events: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events after KEEP_CURRENT and APPROVE_APPLY decisions on pending ones, and the decisions that are refused.

    ``events``: event_id, event_status, review_status; ``decisions``: event_id, decision, reviewer, note (both between 1 and 128, 2000 characters).
    """
    joined = decisions.join(events.select("event_id", "event_status", "review_status"), "event_id", "left")
    named = F.length(F.trim("reviewer")).between(1, 128) & F.length(F.trim("note")).between(1, 2000)
    ok = F.coalesce(F.col("decision").isin("KEEP_CURRENT", "APPROVE_APPLY") & named & (F.col("event_status") == "REVIEW_PENDING") & F.col("review_status").isin("PENDING_REVIEW", "REVIEWED_KEEP_CURRENT"), F.lit(False))
    made = joined.where(ok).groupBy("event_id").agg(F.min(F.when(F.col("decision") == "KEEP_CURRENT", "REVIEWED_KEEP_CURRENT").otherwise("APPLY_APPROVED")).alias("made"))
    return events.join(made, "event_id", "left").withColumn("review_status", F.coalesce("made", "review_status")).drop("made"), joined.where(~ok).select(*decisions.columns)


def audit_recorded(recorded: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Whether the recorded counts of each series equal the recomputed ones."""
    names = ["provider_rows", "content_difference_rows", "version_only_rows", "new_rows", "removed_rows"]
    a, b = recorded.alias("a"), recomputed.alias("b")
    joined = a.join(b, F.col("a.instrument_key") == F.col("b.instrument_key"), "left")
    same = F.forall(F.array(*[F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) for n in names]), lambda x: x)
    return joined.select(F.col("a.instrument_key").alias("instrument_key"), same.alias("counts_match"))

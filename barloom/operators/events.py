"""Quality events: defaults, status, supersession, transitions.  Histories are append-only; the newest entry counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

OPEN = ("OPEN", "ACKNOWLEDGED")
BLOCKING = ("ERROR", "CRITICAL")


def _newest(rows: DataFrame, key: str, *order: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return rows.withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank")


def event_defaults(events: DataFrame, policies: DataFrame, run_datasets: DataFrame) -> DataFrame:
    """Scope and applicability of each event by its rule's policy; unknown rules are UNKNOWN.  The dataset is the run's, if it has exactly one."""
    one = run_datasets.groupBy("run_id").agg(F.when(F.count_distinct("dataset_id") == 1, F.min("dataset_id")).alias("dataset_id"))
    joined = events.join(policies, "rule_id", "left").join(one, "run_id", "left")
    return joined.select("event_id", "rule_id", F.coalesce("default_scope", F.lit("UNKNOWN")).alias("scope_kind"), F.coalesce("default_applicability", F.lit("UNKNOWN")).alias("applicability"), "dataset_id")


def event_basis(events: DataFrame, policies: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Price basis of each event: of its policy, else the single basis of its instrument's watermarks."""
    single = watermarks.groupBy("instrument_key").agg(F.when(F.count_distinct("price_basis") == 1, F.min("price_basis")).alias("series_basis"))
    joined = events.join(policies.select("rule_id", "price_basis"), "rule_id", "left").join(single, "instrument_key", "left")
    return joined.select("event_id", F.coalesce("price_basis", "series_basis").alias("price_basis"))


def event_status(events: DataFrame, scopes: DataFrame, reviews: DataFrame) -> DataFrame:
    """Each event with its newest scope and newest review, and whether it blocks now."""
    s, r = _newest(scopes, "event_id", "recorded_utc", "scope_id").select("event_id", "scope_kind"), _newest(reviews, "event_id", "reviewed_utc", "review_id").select("event_id", "applicability")
    joined = events.join(s, "event_id", "left").join(r, "event_id", "left")
    known = F.coalesce("applicability", F.lit("UNKNOWN"))
    return joined.select(
        "event_id", "instrument_key", "run_id", "rule_id", "severity", "status", "time_utc", F.coalesce("scope_kind", F.lit("UNKNOWN")).alias("scope_kind"), known.alias("applicability"),
        (F.col("status").isin(*OPEN) & F.col("severity").isin(*BLOCKING) & known.isin("CURRENT", "UNKNOWN")).alias("current_blocker"))


def open_events(status: DataFrame) -> DataFrame:
    return status.where(F.col("status").isin(*OPEN))


def high_watermark(events: DataFrame) -> DataFrame:
    """The greatest event_id, or 0."""
    return events.agg(F.coalesce(F.max("event_id"), F.lit(0)).alias("high_watermark"))


def first_later(points: DataFrame, marks: DataFrame, key: str, order: str, name: str, each: int = 4096) -> DataFrame:
    """Each different point (key, order: a whole number) with the first mark of its key after it, as ``name``; points without one are left out.

    An as-of join without pairs: both sides stand in blocks of ``each`` numbers, a window inside the block finds the next mark there, and one over
    the key's blocks the first mark of the next block that has any.
    """
    block = F.floor(F.col(order) / each).alias("block")
    points = points.select(F.col(key).alias("key"), F.col(order).cast("long").alias("at"), block, F.lit(None).cast("long").alias("mark")).distinct()
    marks = marks.select(F.col(key).alias("key"), F.col(order).cast("long").alias("at"), block, F.col(order).cast("long").alias("mark")).distinct()
    inside = Window.partitionBy("key", "block").orderBy("at").rangeBetween(1, Window.unboundedFollowing)
    near = points.unionByName(marks).withColumn("near", F.min("mark").over(inside)).where("mark is null").drop("mark")
    blocks = points.select("key", "block", "mark").unionByName(marks.select("key", "block", "mark")).groupBy("key", "block").agg(F.min("mark").alias("mark"))
    beyond = Window.partitionBy("key").orderBy("block").rangeBetween(1, Window.unboundedFollowing)
    far = blocks.select("key", "block", F.min("mark").over(beyond).alias("far"))
    found = near.join(far, ["key", "block"]).select("key", "at", F.coalesce("near", "far").alias(name))
    return found.where(F.col(name).isNotNull()).select(F.col("key").alias(key), F.col("at").alias(order), name)


def _failures(status: DataFrame) -> DataFrame:
    """Open atomic failures that count now."""
    return status.where(F.col("status").isin(*OPEN) & F.col("applicability").isin("CURRENT", "UNKNOWN") & (F.col("rule_id") == "atomic_run_gate"))


def _historical(found: DataFrame) -> DataFrame:
    """One review for each event, by the first run that supersedes it."""
    return found.groupBy("event_id").agg(F.min("pass_run").alias("superseded_by")).select("event_id", F.lit("HISTORICAL").alias("applicability"), "superseded_by")


def supersede(status: DataFrame, run_scope: DataFrame, passed: DataFrame) -> DataFrame:
    """HISTORICAL reviews for open atomic failures, by the first later PASS run that shares an instrument: with the event, or with its run's scope
    where the event is of its RUN.  Runs follow each other by run_id; once reviewed an event isn't open to later runs any more."""
    open_ = _failures(status)
    scope = passed.select("run_id").distinct().join(run_scope.select("run_id", "instrument_key"), "run_id")
    own = open_.where("instrument_key is not null").select("event_id", "run_id", "instrument_key")
    of_run = open_.where("instrument_key is null and scope_kind = 'RUN'").select("event_id", "run_id").join(run_scope.select("run_id", "instrument_key").distinct(), "run_id")
    asked = own.unionByName(of_run.select(*own.columns))
    later = first_later(asked, scope, "instrument_key", "run_id", "pass_run")
    return _historical(asked.join(later, ["instrument_key", "run_id"]))


def event_run_scope(events: DataFrame, run_scope: DataFrame) -> DataFrame:
    """INSTRUMENT where the instrument is known, else RUN with the run's keys."""
    keys = run_scope.groupBy("run_id").agg(F.array_join(F.array_sort(F.collect_set("instrument_key")), ",").alias("keys"))
    joined = events.join(keys, "run_id", "left")
    known = F.col("instrument_key").isNotNull()
    return joined.select("event_id", F.when(known, "INSTRUMENT").otherwise("RUN").alias("scope_kind"), F.when(known, F.col("instrument_key")).otherwise(F.col("keys")).alias("instrument_keys"))


def series_blockers(status: DataFrame, revision_runs: DataFrame, run_scope: DataFrame, key: str) -> DataFrame:
    """Current blockers of one instrument: its own, global ones, and those of runs whose scope has it; not those of revision runs."""
    held = run_scope.where(F.col("instrument_key") == key).select("run_id").distinct().withColumn("in_scope", F.lit(True))
    rows = status.where("current_blocker").join(revision_runs.select("run_id").distinct(), "run_id", "left_anti").join(held, "run_id", "left")
    applies = F.col("instrument_key").eqNullSafe(F.lit(key)) | (F.col("scope_kind") == "GLOBAL") | ((F.col("scope_kind") == "RUN") & F.col("in_scope"))
    return rows.where(applies).select("event_id", "rule_id", "severity", "scope_kind")


def quality_matrix(coverage: DataFrame, freshness: DataFrame, status: DataFrame) -> DataFrame:
    """Coverage and freshness of each series with its blockers (global ones count for all): FAIL with any, else the worse of both."""
    from barloom.operators.reports import status_priority

    own = status.where("current_blocker and instrument_key is not null").groupBy("instrument_key").agg(F.count("*").alias("own"))
    everywhere = status.where("current_blocker and scope_kind = 'GLOBAL' and instrument_key is null").agg(F.count("*").alias("everywhere"))
    joined = coverage.select("instrument_key", "coverage_status").join(freshness.select("instrument_key", "freshness_status"), "instrument_key", "full").join(own, "instrument_key", "left").crossJoin(F.broadcast(everywhere))
    blockers = F.coalesce("own", F.lit(0)) + F.col("everywhere")
    c, f = F.col("coverage_status"), F.col("freshness_status")
    worst = F.when(f.isNull() | (status_priority(c) >= status_priority(f)), c).otherwise(f)
    return joined.select("instrument_key", "coverage_status", "freshness_status", blockers.alias("blockers"), F.when(blockers > 0, "FAIL").otherwise(worst).alias("quality_status"))


def transition(events: DataFrame, actions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events after ACKNOWLEDGE (from OPEN) and RESOLVE (from OPEN or ACKNOWLEDGED) actions with label and note; and the rejected actions."""
    joined = actions.join(events.select("event_id", "status"), "event_id", "left")
    named = (F.coalesce(F.trim("label"), F.lit("")) != "") & (F.coalesce(F.trim("note"), F.lit("")) != "")
    allowed = named & (((F.col("action") == "ACKNOWLEDGE") & (F.col("status") == "OPEN")) | ((F.col("action") == "RESOLVE") & F.col("status").isin(*OPEN)))
    allowed = F.coalesce(allowed, F.lit(False))
    good = joined.where(allowed).groupBy("event_id").agg(F.max(F.when(F.col("action") == "RESOLVE", "RESOLVED").otherwise("ACKNOWLEDGED")).alias("new_status"))
    after = events.join(good, "event_id", "left").withColumn("status", F.coalesce("new_status", "status")).drop("new_status")
    return after, joined.where(~allowed).drop("status")


def append_reviews(reviews: DataFrame, inputs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reviews with the valid inputs appended, and the invalid ones: unknown applicability, or a CURRENT one that supersedes."""
    valid = F.col("applicability").isin("CURRENT", "HISTORICAL", "UNKNOWN") & ~((F.col("applicability") == "CURRENT") & F.col("superseded_by").isNotNull())
    valid = F.coalesce(valid, F.lit(False))
    return reviews.unionByName(inputs.where(valid).select(*reviews.columns)), inputs.where(~valid)


def failure_events(failures: DataFrame) -> DataFrame:
    """An event for each failed instrument whose code is about content quality."""
    from barloom.operators.normalize import records_quality_event

    rows = failures.where(records_quality_event(F.col("error_code"))).select("run_id", F.explode("keys").alias("instrument_key"), "error_code")
    return rows.select("run_id", "instrument_key", F.lit("ERROR").alias("severity"), F.lit("OPEN").alias("status"), F.col("error_code").alias("rule_id"))


def supersede_legacy(status: DataFrame, runs: DataFrame, raw: DataFrame) -> DataFrame:
    """HISTORICAL reviews by the rule before run scopes: a single-series refetch supersedes the earlier failures of its one instrument, a
    full normal run all earlier ones; of several such runs the first one counts.

    ``runs``: PASS runs as run_id, trigger_kind (refetch or normal), successful_series, all_series; ``raw``: run_id, instrument_key.
    """
    open_ = _failures(status).select("event_id", "run_id", "instrument_key")
    single = raw.groupBy("run_id").agg(F.count_distinct("instrument_key").alias("n"), F.min("instrument_key").alias("instrument_key")).where("n = 1").select("run_id", "instrument_key")
    refetch = runs.where("trigger_kind = 'refetch' and successful_series = 1").select("run_id").join(single, "run_id")
    own = open_.where("instrument_key is not null")
    own = own.join(first_later(own, refetch, "instrument_key", "run_id", "pass_run"), ["instrument_key", "run_id"])
    normal = runs.where("trigger_kind = 'normal' and successful_series = all_series").select("run_id", F.lit(0).alias("every"))
    every = open_.withColumn("every", F.lit(0))
    every = every.join(first_later(every, normal, "every", "run_id", "pass_run"), ["every", "run_id"])
    return _historical(own.select("event_id", "pass_run").union(every.select("event_id", "pass_run")))

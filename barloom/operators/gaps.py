"""Gap evidence: which expected slots have no complete bar, and why."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barloom.functions.times import new_york

SLOT = ["instrument_key", "slot_utc"]


def missing_slots(bars: DataFrame, slots: DataFrame) -> DataFrame:
    """Expected slots between a series' first and last complete bar that have none."""
    complete = bars.where("is_complete").select("instrument_key", F.col("time_utc").alias("slot_utc"))
    ends = complete.groupBy("instrument_key").agg(F.min("slot_utc").alias("first"), F.max("slot_utc").alias("last"))
    inside = slots.join(ends, "instrument_key").where("slot_utc between first and last").drop("first", "last")
    return inside.join(complete, SLOT, "left_anti")


def latest_raw(missing: DataFrame, raw: DataFrame) -> DataFrame:
    """The newest run with a raw row at each slot (null where none has)."""
    newest = raw.groupBy("instrument_key", F.col("time_utc").alias("slot_utc")).agg(F.max("run_id").alias("raw_run_id"))
    return missing.join(newest, SLOT, "left")


def latest_quarantine(missing: DataFrame, events: DataFrame) -> DataFrame:
    newest = events.groupBy("instrument_key", F.col("time_utc").alias("slot_utc")).agg(F.max("event_id").alias("quarantine_event_id"))
    return missing.join(newest, SLOT, "left")


def covering_run(missing: DataFrame, raw: DataFrame, runs: DataFrame) -> DataFrame:
    """The newest PASS run whose raw rows of the instrument reach from before the slot to after it."""
    bounds = raw.join(runs.where("run_status = 'PASS'").select("run_id").distinct(), "run_id").groupBy("instrument_key", "run_id").agg(F.min("time_utc").alias("first"), F.max("time_utc").alias("last"))
    # By day: of the runs that reach over a whole day the newest is enough; those that begin or end on it are compared one by one.
    day = F.col("day")
    days = bounds.withColumn("day", F.explode(F.sequence(F.to_date("first"), F.to_date("last"))))
    whole = (day > F.to_date("first")) & (day < F.to_date("last"))
    over = days.where(whole).groupBy("instrument_key", "day").agg(F.max("run_id").alias("over"))
    slots = missing.select(*SLOT).withColumn("day", F.to_date("slot_utc"))
    edge = slots.join(days.where(~whole), ["instrument_key", "day"]).where("slot_utc between first and last").groupBy(*SLOT).agg(F.max("run_id").alias("edge"))
    covering = slots.join(over, ["instrument_key", "day"], "left").join(edge, SLOT, "left").select(*SLOT, F.greatest("over", "edge").alias("covering_run_id"))
    return missing.join(covering.distinct(), SLOT, "left")


def curated_present(missing: DataFrame, bars: DataFrame) -> DataFrame:
    """Adds curated_rejected: a bar (an incomplete one) stands at the slot."""
    present = bars.select("instrument_key", F.col("time_utc").alias("slot_utc")).distinct().withColumn("curated_rejected", F.lit(True))
    return missing.join(present, SLOT, "left").withColumn("curated_rejected", F.coalesce("curated_rejected", F.lit(False)))


def classify_gap(evidence: DataFrame) -> DataFrame:
    """The cause by precedence: quarantine, raw or curated row (raw only if not older than the covering run), calendar error, closed session, maintenance, covered without a sample, missed."""
    current = F.col("raw_run_id").isNotNull() & (F.col("covering_run_id").isNull() | (F.col("raw_run_id") >= F.col("covering_run_id")))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)) if c in evidence.columns else F.lit(False)
    # The cause codes.
    cause = (
        F.when(F.col("quarantine_event_id").isNotNull(), "QUARANTINED_VALUE_ANOMALY").when(current | flag("curated_rejected"), "RAW_PRESENT_CURATED_REJECTED")
        .when(flag("calendar_false_positive"), "CALENDAR_EXPECTATION_FALSE_POSITIVE").when(flag("closed_session"), "WEEKEND_OR_HOLIDAY_CLOSURE")
        .when(flag("maintenance_boundary"), "DAILY_MAINTENANCE_BOUNDARY").when(F.col("covering_run_id").isNotNull(), "PROVIDER_RAW_NO_SAMPLE").otherwise("ACQUISITION_RUN_MISSED"))
    return evidence.withColumn("cause", F.when(F.col("slot_utc").isNull(), "UNCLASSIFIED").otherwise(cause))


# Days of large market moves, as (label, first day, last day) in New York; labels never change a gap's cause.
MARKET_EVENTS = [
    ("SNB_EURCHF_FLOOR_REMOVAL", "2015-01-15", "2015-01-15"), ("BREXIT_REFERENDUM_RESULT", "2016-06-24", "2016-06-24"), ("COVID_MARKET_DISLOCATION", "2020-03-09", "2020-03-09"),
    ("COVID_MARKET_DISLOCATION", "2020-03-12", "2020-03-12"), ("COVID_MARKET_DISLOCATION", "2020-03-16", "2020-03-16"), ("RUSSIA_UKRAINE_INVASION", "2022-02-24", "2022-02-24")]
DIMENSIONS = ["cause", "year", "month", "weekday", "utc_hour", "ny_hour", "market_event"]


def market_days(events: DataFrame) -> DataFrame:
    """local_date and market_event: the labels of all events (label, first_day, last_day) that hold a day, in order, joined by commas."""
    days = events.select("label", F.explode(F.sequence("first_day", "last_day")).alias("local_date"))
    return days.groupBy("local_date").agg(F.array_join(F.array_sort(F.collect_set("label")), ",").alias("market_event"))


def enrich_gaps(gaps: DataFrame, events: DataFrame) -> DataFrame:
    """Local time in New York, calendar parts, the labels of market events on the local day, whether the gap blocks, whose it is, what evidence it
    needs, and the run that supersedes an older raw sample.  ``events``: label, first_day, last_day."""
    local = new_york(F.col("slot_utc"))
    blocking = F.col("cause").isin("ACQUISITION_RUN_MISSED", "RAW_PRESENT_CURATED_REJECTED", "UNCLASSIFIED")
    rows = gaps.select(
        "*", local.alias("ny_time"), F.year("slot_utc").alias("year"), F.month("slot_utc").alias("month"), F.weekday("slot_utc").alias("weekday"), F.hour("slot_utc").alias("utc_hour"), F.hour(local).alias("ny_hour"),
        blocking.alias("blocking"), F.when(blocking, "ENGINE").otherwise("PROVIDER").alias("owner"),
        F.when(F.col("cause").isin("ACQUISITION_RUN_MISSED", "UNCLASSIFIED"), "PROVIDER_RESPONSE_OR_RUN_OVER_SLOT").alias("required_evidence"),
        F.when(F.col("raw_run_id") < F.col("covering_run_id"), F.col("covering_run_id")).alias("superseding_run_id"), local.cast("date").alias("local_date"))
    return rows.join(market_days(events), "local_date", "left").drop("local_date")


def gap_histograms(gaps: DataFrame) -> DataFrame:
    """Counts by instrument and each value of each dimension (gaps without a market event aren't counted there), and the ``total`` of missing, blocking and unclassified rows."""
    dims = [F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"), F.lit(1).alias("n")) for d in DIMENSIONS]
    total = lambda name, when: F.struct(F.lit("total").alias("dimension"), F.lit(name).alias("value"), when.cast("int").alias("n"))
    each = F.explode(F.array(*dims, total("missing_rows", F.lit(True)), total("blocking_rows", F.col("blocking")), total("unclassified_rows", F.col("cause") == "UNCLASSIFIED")))
    rows = gaps.select("instrument_key", each.alias("e")).where("e.dimension <> 'market_event' or e.value is not null")
    return rows.groupBy("instrument_key", "e.dimension", "e.value").agg(F.sum("e.n").alias("gaps"))


def gap_overlap(gaps: DataFrame, keys: list[str]) -> DataFrame:
    """Slots missing in all the given instruments, and in exactly one of them, by that one."""
    held = gaps.where(F.col("instrument_key").isin(keys)).groupBy("slot_utc").agg(F.count_distinct("instrument_key").alias("n"), F.min("instrument_key").alias("only"))
    kind = F.when(F.col("n") == len(keys), "ALL").when(F.col("n") == 1, F.col("only"))
    return held.withColumn("missing_in", kind).where("missing_in is not null").groupBy("missing_in").agg(F.count("*").alias("slots"))


def gap_verdict(gaps: DataFrame) -> DataFrame:
    return gaps.agg(
        F.count("*").alias("gaps"), F.count_if("blocking").alias("blocking"), F.count_if(F.col("cause") == "UNCLASSIFIED").alias("unclassified")
    ).withColumn("verdict", F.when((F.col("blocking") == 0) & (F.col("unclassified") == 0), "PASS").otherwise("BLOCKED"))


def exact_scope_gate(missing: DataFrame, approved: DataFrame) -> DataFrame:
    """By instrument of ``approved``: passes if all its missing slots are approved and there are as many."""
    a = approved.withColumn("approved", F.lit(True))
    both = missing.withColumn("missing", F.lit(True)).join(a, SLOT, "full")
    return both.groupBy("instrument_key").agg(
        F.count("missing").alias("missing_slots"), F.count("approved").alias("approved_slots"), F.count_if(F.col("missing") & F.col("approved").isNull()).alias("unapproved")
    ).withColumn("passes", (F.col("unapproved") == 0) & (F.col("missing_slots") == F.col("approved_slots")))

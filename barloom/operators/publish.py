"""The publication gate: profiles of candidate series, named checks, streaks, state rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

FIELDS = ("open", "high", "low", "close")


def candidate_profile(quotes: DataFrame, now) -> DataFrame:
    """Counts of null, nonpositive, crossed, side- and mid-violating, future complete and duplicate rows of each series, with versions and times.

    ``quotes``: bid_* and ask_* of the four fields, mid prices, is_complete, data_version, time_utc.
    """
    sides = [F.col(f"{s}_{f}") for s in ("bid", "ask") for f in FIELDS]
    any_of = lambda conditions: F.exists(F.array(*conditions), lambda x: x)
    bad = lambda p: (F.col(f"{p}high") < F.greatest(*[F.col(f"{p}{f}") for f in FIELDS])) | (F.col(f"{p}low") > F.least(*[F.col(f"{p}{f}") for f in FIELDS]))
    return quotes.groupBy("instrument_key").agg(
        F.count("*").alias("rows"), F.count_if(any_of([s.isNull() for s in sides])).alias("null_rows"), F.count_if(F.least(*sides) <= 0).alias("nonpositive_rows"),
        F.count_if(any_of([F.col(f"bid_{f}") > F.col(f"ask_{f}") for f in FIELDS])).alias("crossed_rows"), F.count_if(bad("bid_") | bad("ask_")).alias("side_violations"), F.count_if(bad("")).alias("mid_violations"),
        F.count_if(F.col("is_complete") & (F.col("time_utc") > now)).alias("future_rows"), (F.count("*") - F.count_distinct("time_utc")).alias("duplicate_rows"), F.count_distinct("data_version").alias("versions"), F.count_if(F.col("data_version").isNull()).alias("null_version_rows"),
        F.min("time_utc").alias("first_utc"), F.max("time_utc").alias("latest_seen_utc"), F.max(F.when(F.col("is_complete"), F.col("time_utc"))).alias("latest_complete_utc"))


def candidate_gate(profile: DataFrame, checks: dict[str, object]) -> DataFrame:
    """The names of the checks that fail (an unknown outcome fails), in order, and PASS or BLOCKED."""
    each = F.array(*[F.struct(F.lit(name).alias("name"), F.coalesce(ok, F.lit(False)).alias("ok")) for name, ok in checks.items()])
    failed = F.transform(F.filter(each, lambda x: ~x["ok"]), lambda x: x["name"])
    return profile.select("instrument_key", F.array_join(failed, ",").alias("failed_checks"), F.when(F.size(failed) == 0, "PASS").otherwise("BLOCKED").alias("gate_status"))


def standard_checks(start) -> dict[str, object]:
    """The checks of a profile by name; ``start``: the time by which history must begin."""
    zero = lambda c: F.col(c) == 0
    return {
        "data_version_single": F.col("versions") == 1, "effective_coverage_start_reached": F.col("first_utc") <= start, "curated_duplicate_zero": zero("duplicate_rows"), "null_zero": zero("null_rows"),
        "nonpositive_zero": zero("nonpositive_rows"), "side_ohlc_valid": zero("side_violations"), "midpoint_ohlc_valid": zero("mid_violations"), "bid_ask_valid": zero("crossed_rows"),
        "future_complete_zero": zero("future_rows"), "latest_sample_forming": F.col("latest_complete_utc") < F.col("latest_seen_utc"),
    }


def whole_profile(profile: DataFrame, coverage: DataFrame, freshness: DataFrame, runs: DataFrame, watermarks: DataFrame, blockers: DataFrame, gaps: DataFrame, audit: DataFrame) -> DataFrame:
    """A candidate's profile with what else its gate looks at; what a table lacks is null, which fails.

    ``coverage``: coverage_status; ``freshness``: freshness_status; ``runs``: run_id, run_status of the last run; ``watermarks``: data_status; ``blockers``: current_blockers, unknown_blockers;
    ``gaps``: gap_verdict, gap_blocking, gap_unclassified; ``audit``: inclusive_boundary_duplicates, conflicting_boundary_rows; each by instrument_key.
    """
    parts = [
        (coverage, ["coverage_status"]), (freshness, ["freshness_status"]), (runs, ["run_id", "run_status"]), (watermarks, ["data_status"]), (blockers, ["current_blockers", "unknown_blockers"]),
        (gaps, ["gap_verdict", "gap_blocking", "gap_unclassified"]), (audit, ["inclusive_boundary_duplicates", "conflicting_boundary_rows"])]
    for rows, columns in parts:
        profile = profile.join(rows.select("instrument_key", *columns), "instrument_key", "left")
    return profile


def whole_checks(start, run_id) -> dict[str, object]:
    """All checks of a ``whole_profile`` by name, in order.  ``run_id``: the run that asks for the gate; a profile without ``null_version_rows`` fails data_version_single."""
    some = standard_checks(start)
    zero = lambda c: F.col(c) == 0
    twice, differing = F.col("inclusive_boundary_duplicates"), F.col("conflicting_boundary_rows")
    return {
        "run_pass": (F.col("run_status") == "PASS") & (F.col("run_id") == run_id), "watermark_active": F.col("data_status") == "ACTIVE", "data_version_single": some["data_version_single"] & zero("null_version_rows"),
        "coverage_accounted": F.col("coverage_status").isin("PASS", "WARN") & (F.col("gap_verdict") == "PASS") & zero("gap_blocking") & zero("gap_unclassified"),
        "effective_coverage_start_reached": some["effective_coverage_start_reached"], "freshness_pass": F.col("freshness_status") == "PASS", "curated_duplicate_zero": some["curated_duplicate_zero"],
        "page_boundary_duplicates_audited": (twice >= 0) & (differing >= 0) & (differing <= twice), "null_zero": some["null_zero"], "nonpositive_zero": some["nonpositive_zero"], "side_ohlc_valid": some["side_ohlc_valid"],
        "midpoint_ohlc_valid": some["midpoint_ohlc_valid"], "bid_ask_valid": some["bid_ask_valid"], "future_complete_zero": some["future_complete_zero"], "current_blockers_zero": zero("current_blockers"),
        "unknown_blockers_zero": zero("unknown_blockers"), "latest_sample_forming": some["latest_sample_forming"]}


def history_boundary(observed: DataFrame, contract: DataFrame) -> DataFrame:
    """Whether the advertised start is the contract's and the observed start is not later than the effective one."""
    joined = observed.join(contract, "instrument_key")
    return joined.select("instrument_key", (F.col("advertised_start").eqNullSafe(F.col("contract_start")) & (F.col("observed_start") <= F.col("effective_start"))).alias("boundary_ok"))


def publication_violations(states: DataFrame) -> DataFrame:
    """Rules that a publication row breaks: complete PASS or WARN evidence for STAGING and PUBLISHED, two passes for PUBLISHED, approval for WARN."""
    shown = F.col("publication_status").isin("STAGING", "PUBLISHED")
    rules = F.array_compact(F.array(
        F.when(shown & ~F.coalesce(F.col("quality_status").isin("PASS", "WARN"), F.lit(False)), "EVIDENCE_INCOMPLETE"),
        F.when((F.col("publication_status") == "PUBLISHED") & (F.coalesce("consecutive_passes", F.lit(0)) < 2), "PASSES_MISSING"),
        F.when(shown & (F.col("quality_status") == "WARN") & F.col("approved_by").isNull(), "APPROVAL_MISSING")))
    return states.select("instrument_key", F.explode(rules).alias("violation"))


def acceptance_streak(runs: DataFrame, required: int = 2) -> DataFrame:
    """Consecutive passes up to each run (0 after a failure, at most ``required``) and the publication status that follows."""
    w = Window.partitionBy("instrument_key").orderBy("run_order")
    failed = F.when(F.col("run_status") != "PASS", 1).otherwise(0)
    rows = runs.withColumn("stretch", F.sum(failed).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    own = Window.partitionBy("instrument_key", "stretch").orderBy("run_order").rowsBetween(Window.unboundedPreceding, 0)
    n = F.least(F.sum(1 - failed).over(own), F.lit(required))
    return rows.select("instrument_key", "run_order", "run_status", n.cast("long").alias("consecutive_passes"), F.when(n >= required, "PUBLISHED").when(n > 0, "STAGING").otherwise("CANDIDATE").alias("publication_status"))


def published_only(bars: DataFrame, publication: DataFrame) -> DataFrame:
    """Bars without those of series that have a publication row in another state than STAGING or PUBLISHED; no row means visible."""
    return bars.join(publication.where("publication_status not in ('STAGING', 'PUBLISHED')").select("instrument_key"), "instrument_key", "left_anti")


def quarantine_metadata(rejected: DataFrame) -> DataFrame:
    """Rows, first and last time and different fields of the quarantined rows of each series."""
    fields = rejected.select("instrument_key", "time_utc", F.explode("violations.field").alias("field"))
    return fields.groupBy("instrument_key").agg(F.count_distinct("time_utc").alias("rows"), F.min("time_utc").alias("first_utc"), F.max("time_utc").alias("last_utc"), F.array_join(F.array_sort(F.collect_set("field")), ",").alias("fields"))

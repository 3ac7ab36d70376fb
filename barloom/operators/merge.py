"""Deduplication, change detection and versioned upserts.

Plain Parquet tables have no MERGE: upserts give the new table version as a frame, which the caller writes to a new path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SERIES = ["instrument_key", "price_basis"]
KEY = ["instrument_key", "time_utc", "price_basis"]
# What makes two bars of one time equal.
CONTENT = ["open", "high", "low", "close", "open_bid", "high_bid", "low_bid", "close_bid", "open_ask", "high_ask", "low_ask", "close_ask", "volume", "market_trading_state", "is_complete"]


def with_content(rows: DataFrame) -> DataFrame:
    """The rows with all content columns; those that they lack are null."""
    lacking = [c for c in CONTENT if c not in rows.columns]
    return rows.withColumns({c: F.lit(None).cast("string" if c == "market_trading_state" else "decimal(24,12)") for c in lacking}) if lacking else rows


def merge_pages(samples: DataFrame) -> DataFrame:
    """The first sample of each (series, time) by page and position; later boundary repeats never replace it."""
    w = Window.partitionBy("instrument_key", "time_utc").orderBy("page_number", "position")
    return samples.withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank")


def duplicate_audit(samples: DataFrame, content: list[str]) -> DataFrame:
    """By series: occurrences, different times, boundary repeats, and repeats whose content differs from the first seen."""
    w = Window.partitionBy("instrument_key", "time_utc").orderBy("page_number", "position")
    rows = samples.withColumn("this", F.struct(*content)).withColumn("first", F.first("this").over(w)).withColumn("rank", F.row_number().over(w))
    return rows.groupBy("instrument_key").agg(
        F.count("*").alias("raw_occurrences"), F.count_if(F.col("rank") == 1).alias("unique_timestamps"), F.count_if(F.col("rank") > 1).alias("inclusive_boundary_duplicates"),
        F.count_if(~F.col("this").eqNullSafe(F.col("first"))).alias("conflicting_boundary_rows"))


def overlap_start(bars: DataFrame, n: int) -> DataFrame:
    """The n-th newest complete PASS bar of each series (series with fewer give no row)."""
    w = Window.partitionBy(*SERIES).orderBy(F.col("time_utc").desc())
    rows = bars.where("is_complete and quality_status = 'PASS'").withColumn("rank", F.row_number().over(w))
    return rows.where(F.col("rank") == n).select(*SERIES, F.col("time_utc").alias("overlap_start_utc"))


def _content(columns: list[str], side: str) -> Column:
    return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in columns])


def _paired(staged: DataFrame, current: DataFrame, how: str) -> DataFrame:
    return with_content(staged).alias("s").join(with_content(current).alias("c"), [F.col(f"s.{k}") == F.col(f"c.{k}") for k in KEY], how)


def diff_counts(staged: DataFrame, current: DataFrame) -> DataFrame:
    """Inserted and updated rows by series; content and data_version are compared null-safely."""
    compared = [*CONTENT, "data_version"]
    absent = F.col("c.instrument_key").isNull()
    changed = ~_content(compared, "s").eqNullSafe(_content(compared, "c"))
    return _paired(staged, current, "left").groupBy(F.col("s.instrument_key").alias("instrument_key")).agg(
        F.count_if(absent).alias("inserted"), F.count_if(~absent & changed).alias("updated"))


def revision_audit(staged: DataFrame, current: DataFrame) -> DataFrame:
    """A resolved INFO event with old and new content for each changed row."""
    changed = ~_content(CONTENT, "s").eqNullSafe(_content(CONTENT, "c"))
    return _paired(staged, current, "inner").where(changed).select(
        *[F.col(f"s.{k}").alias(k) for k in KEY], F.lit("INFO").alias("severity"), F.lit("RESOLVED").alias("status"),
        F.to_json(F.struct(_content(CONTENT, "c").alias("old"), _content(CONTENT, "s").alias("new"))).alias("observed_value"))


def removed_rows(current: DataFrame, staged: DataFrame) -> DataFrame:
    """Current rows, by series, that the full answer lacks."""
    return current.join(staged.select(*KEY), KEY, "left_anti").groupBy("instrument_key").agg(F.count("*").alias("removed"))


def upsert(current: DataFrame, staged: DataFrame) -> DataFrame:
    """The newest staged row of each key, else the current one."""
    both = current.withColumn("priority", F.lit(0)).unionByName(staged.withColumn("priority", F.lit(1)))
    w = Window.partitionBy(*KEY).orderBy(F.col("priority").desc(), F.col("run_id").desc())
    return both.withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank", "priority")


def full_replace(current: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """All rows of one instrument replaced."""
    return current.where(F.col("instrument_key") != key).unionByName(staged.where(F.col("instrument_key") == key))


def bounded_replace(current: DataFrame, staged: DataFrame, key: str, start: Column, end: Column) -> DataFrame:
    """The rows of one instrument between two times (both included) replaced."""
    inside = (F.col("instrument_key") == key) & F.col("time_utc").between(start, end)
    return current.where(~inside).unionByName(staged.where(inside))


def init_watermarks(bars: DataFrame, existing: DataFrame) -> DataFrame:
    """Watermarks of series that have none yet, and the existing ones."""
    new = bars.groupBy(*SERIES).agg(
        F.max("time_utc").alias("latest_seen_utc"), F.max(F.when(F.col("is_complete"), F.col("time_utc"))).alias("latest_complete_utc"), F.max("data_version").alias("data_version"), F.max("run_id").alias("run_id"))
    return existing.select(*new.columns).unionByName(new.join(existing, SERIES, "left_anti"))


def advance_watermarks(watermarks: DataFrame, batch: DataFrame) -> DataFrame:
    """Watermarks after a batch; they never go back."""
    new = batch.groupBy(*SERIES).agg(
        F.max("time_utc").alias("seen"), F.max(F.when(F.col("is_complete"), F.col("time_utc"))).alias("complete"), F.max("data_version").alias("version"), F.max("run_id").alias("run"))
    joined = watermarks.join(new, SERIES, "full")
    return joined.select(
        *SERIES, F.greatest("latest_seen_utc", "seen").alias("latest_seen_utc"), F.greatest("latest_complete_utc", "complete").alias("latest_complete_utc"),
        F.coalesce("version", "data_version").alias("data_version"), F.greatest("run_id", "run").alias("run_id"))


def run_scope(requests: DataFrame, instruments: DataFrame, watermarks: DataFrame) -> DataFrame:
    """One row for each requested series: run_id, instrument_key, horizon (60 by default) and basis (of the request, else of the watermark)."""
    shape = "array<struct<instrument_key:string,horizon:int,price_basis:string>>"
    asked = requests.select("run_id", F.explode(F.from_json("requested_series", shape)).alias("r")).select("run_id", "r.*")
    marks = watermarks.select("instrument_key", F.col("price_basis").alias("known_basis"))
    joined = asked.join(instruments.select("instrument_key"), "instrument_key").join(marks, "instrument_key", "left")
    basis = F.coalesce("price_basis", "known_basis")
    return joined.select("run_id", "instrument_key", F.coalesce("horizon", F.lit(60)).alias("horizon_minutes"), basis.alias("price_basis")).where("price_basis is not null").distinct()


def run_scope_summary(scope: DataFrame) -> DataFrame:
    """Ordered keys of each run, and its basis if there is one only."""
    return scope.groupBy("run_id").agg(
        F.array_join(F.array_sort(F.collect_set("instrument_key")), ",").alias("instrument_keys"), F.when(F.count_distinct("price_basis") == 1, F.min("price_basis")).alias("price_basis"))


def run_summary(diff: DataFrame, removed: DataFrame, rejected: DataFrame) -> DataFrame:
    """Totals over the series of a run: series, inserted, updated, revisions (changed or removed), rejected."""
    joined = diff.join(removed, "instrument_key", "left").join(rejected, "instrument_key", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return joined.agg(
        F.count("*").alias("successful_series"), F.sum("inserted").alias("inserted"), F.sum("updated").alias("updated"),
        F.sum(F.col("updated") + zero("removed")).alias("revisions"), F.sum(zero("rejected")).alias("rejected"))


def insert_if_absent(table: DataFrame, new: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """The new table version, and the rows that were inserted."""
    w = Window.partitionBy(*key).orderBy(*[F.col(c) for c in new.columns if c not in key] or [F.lit(1)])
    once = new.withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank")
    added = once.join(table.select(*key), key, "left_anti").select(*table.columns)
    return table.unionByName(added), added


def quarantine_admission(accepted: DataFrame, rejected: DataFrame, max_rows: int = 10, max_rate: str = "0.0001") -> DataFrame:
    """By series: why its quarantined rows can't be admitted, or null.

    In order: a time both accepted and rejected, different rejected rows of one time, the newest time rejected, more rows than allowed, or a larger
    share of all different times than allowed.
    """
    r = rejected.groupBy("instrument_key", "time_utc").agg(F.count_distinct(F.struct(*[c for c in rejected.columns if c in ("open", "high", "low", "close")])).alias("kinds"))
    a = accepted.select("instrument_key", "time_utc").distinct().withColumn("ok", F.lit(True))
    both = a.join(r, ["instrument_key", "time_utc"], "full")
    counted = both.groupBy("instrument_key").agg(
        F.count_if(F.col("ok") & F.col("kinds").isNotNull()).alias("overlap"), F.count_if(F.col("kinds") > 1).alias("conflicts"), F.count("kinds").alias("rejected_times"), F.count("*").alias("times"),
        F.max("time_utc").alias("newest"), F.max(F.when(F.col("kinds").isNotNull(), F.col("time_utc"))).alias("newest_rejected"))
    code = (
        F.when(F.col("overlap") > 0, "QUARANTINE_OVERLAP").when(F.col("conflicts") > 0, "QUARANTINE_CONFLICTING_DUPLICATE").when(F.col("newest") == F.col("newest_rejected"), "QUARANTINE_NEWEST_SAMPLE")
        .when(F.col("rejected_times") > max_rows, "QUARANTINE_ROW_LIMIT").when(F.col("rejected_times") > F.lit(max_rate).cast("decimal(10,6)") * F.col("times"), "QUARANTINE_RATE_LIMIT"))
    return counted.where("rejected_times > 0").select("instrument_key", "rejected_times", "times", code.alias("error_code"))


def quarantine_digest(rejected: DataFrame) -> DataFrame:
    """Evidence of each series' rejected rows: how many times, which fields, the first and last time, and a digest of all violations that doesn't depend on their order."""
    from barloom.operators.digests import multiset_digest

    each = rejected.dropDuplicates(["instrument_key", "time_utc"]).select("instrument_key", "time_utc", F.explode("violations").alias("v"))
    rows = each.select("instrument_key", "time_utc", "v.field", "v.bid", "v.ask")
    return rows.groupBy("instrument_key").agg(
        F.count_distinct("time_utc").alias("rejected_times"), F.array_join(F.array_sort(F.collect_set("field")), ",").alias("fields"), F.min("time_utc").alias("first_utc"), F.max("time_utc").alias("last_utc"),
        multiset_digest(["time_utc", "field", "bid", "ask"]).alias("content_digest"))


def approved_exceptions(evidence: DataFrame, exceptions: DataFrame) -> DataFrame:
    """The evidence (``quarantine_digest``) of series with an approved exception, and QUARANTINE_EXCEPTION_MISMATCH unless all of it is exactly what was approved.

    ``exceptions``: instrument_key, unique_rows, allowed_fields (array), first_utc, last_utc, content_digest.  An exception without any rejected row doesn't match.  Series
    with a matching exception aren't held to the limits of rows and rate.
    """
    e = exceptions.select("instrument_key", "unique_rows", "allowed_fields", F.col("first_utc").alias("approved_first"), F.col("last_utc").alias("approved_last"), F.col("content_digest").alias("approved_digest"))
    joined = e.join(evidence, "instrument_key", "left")
    fields = F.split("fields", ",")
    same = (
        (F.col("unique_rows") == F.col("rejected_times")) & (F.size(F.array_except(fields, F.col("allowed_fields"))) == 0) & (F.col("approved_first") == F.col("first_utc"))
        & (F.col("approved_last") == F.col("last_utc")) & (F.col("approved_digest") == F.col("content_digest")))
    return joined.select(*evidence.columns, F.when(~F.coalesce(same, F.lit(False)), "QUARANTINE_EXCEPTION_MISMATCH").alias("error_code"))


def quarantine_events(rejected: DataFrame, policy: str) -> DataFrame:
    """A resolved WARN event with the violations of each rejected row, as canonical JSON with its digest."""
    from barloom.functions.canonical import json_text

    fields = F.array_join(F.transform("violations", lambda v: v["field"]), ",")
    text = lambda v, f: F.concat(F.lit(f'"{f}":'), json_text(v[f].cast("string")))
    each = F.transform("violations", lambda v: F.concat(F.lit("{"), F.concat_ws(",", text(v, "ask"), text(v, "bid"), text(v, "field")), F.lit("}")))
    listed = F.concat(F.lit("["), F.array_join(each, ","), F.lit("]"))
    return rejected.select("instrument_key", "time_utc", F.lit("WARN").alias("severity"), F.lit("RESOLVED").alias("status"), F.lit(policy).alias("policy"), fields.alias("fields"), listed.alias("violations"), F.sha2(listed, 256).alias("content_sha256"))


def numbered(rows: DataFrame, order: list[str], name: str, each: int = 100_000) -> DataFrame:
    """Adds the number of each row, from 1, in the order of some columns.

    Rows are cut into ranges of about ``each`` rows, at most 1,000 of them, by bounds taken from a sample; a range is numbered in one task and starts after the sizes of those before it.
    """
    n = rows.count()
    parts = min(1000, n // each + 1)
    key = F.struct(*order)
    bounds = []
    if parts > 1:
        some = sorted(tuple(r) for r in rows.select(*order).sample(min(1.0, 20 * parts / n), seed=1).dropna().collect())  # about 20 for each range
        bounds = [some[len(some) * k // parts] for k in range(1, parts)] if some else []
    types = [rows.schema[c].dataType for c in order]
    below = [F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(bound, types, order)]) <= key for bound in bounds]
    ranged = rows.withColumn("__range", sum((c.cast("int") for c in below), F.lit(0)))
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("__size"))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    starts = sizes.select("__range", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__start"))
    within = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return ranged.join(F.broadcast(starts), "__range").withColumn(name, F.col("__start") + within).drop("__range", "__start")

"""Reports on stored bars: coverage, freshness, inventories, lineage, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from barloom.functions.times import plus_hours, seconds_between
from barloom.operators.calendar import align_date, expected_rows, expected_slot_at, first_slot, last_slot, open_sessions

STATUS_PRIORITY = {"FAIL": 5, "STALE": 4, "WARN": 3, "NOT_EVALUATED": 2, "PASS": 1}


def status_priority(status: Column) -> Column:
    out = F.when(F.lit(False), F.lit(0))
    for name, p in STATUS_PRIORITY.items():
        out = out.when(status == name, F.lit(p))
    return out


def worst_status(rows: DataFrame, keys: list[str], status: str) -> DataFrame:
    """The status of highest priority of each group; unknown values are ignored."""
    return rows.groupBy(*keys).agg(F.max_by(F.col(status), status_priority(F.col(status))).alias("worst_status"))


def coverage_actual(bars: DataFrame) -> DataFrame:
    """Counts of all, complete, incomplete and duplicate bars and the first and last time of each series."""
    return bars.groupBy("instrument_key", "asset_type", "calendar_id", "verification_status", "price_basis").agg(
        F.count("*").alias("actual_rows"), F.count_if("is_complete").alias("complete_rows"), F.count_if(~F.col("is_complete")).alias("incomplete_rows"),
        (F.count("*") - F.count_distinct("time_utc")).alias("duplicate_rows"), F.min("time_utc").alias("min_time_utc"), F.max("time_utc").alias("max_time_utc"))


def coverage(bars: DataFrame, sessions: DataFrame) -> DataFrame:
    """Expected, aligned, missing and out-of-session bars of each series, and a status."""
    series = ["instrument_key", "price_basis"]
    actual = coverage_actual(bars)
    aligned = align_date(bars, sessions).groupBy(*series).agg(F.count("*").alias("aligned_rows"))
    joined = actual.join(expected_rows(actual, sessions), series, "left").join(aligned, series, "left")
    have, want = F.coalesce("aligned_rows", F.lit(0)), F.col("expected_rows")
    status = (
        F.when(F.col("calendar_id").isNull() | (F.col("verification_status") != "VERIFIED"), "NOT_EVALUATED").when(want.isNull(), "NOT_EVALUATED")
        .when((F.col("duplicate_rows") > 0) | (have > want), "FAIL").when((have < want) | (F.col("actual_rows") > have), "WARN").otherwise("PASS"))
    return joined.select(
        *series, "expected_rows", "actual_rows", "complete_rows", "incomplete_rows", "duplicate_rows", F.when(want.isNotNull(), F.greatest(want - have, F.lit(0))).alias("missing_rows"),
        F.greatest(F.col("actual_rows") - have, F.lit(0)).alias("out_of_session_rows"), have.alias("aligned_rows"), status.alias("coverage_status"))


def freshness(watermarks: DataFrame, instruments: DataFrame, sessions: DataFrame, now: Column) -> DataFrame:
    """Each series' latest complete bar against the latest slot that is due at ``now``."""
    due = expected_slot_at(instruments, sessions, now)
    joined = watermarks.join(instruments, "instrument_key").join(due, "instrument_key", "left")
    latest, expected = F.col("latest_complete_utc"), F.col("latest_expected_utc")
    status = (
        F.when(F.col("data_status") != "ACTIVE", "FAIL")
        .when(F.col("calendar_id").isNull() | (F.col("verification_status") != "VERIFIED") | latest.isNull() | expected.isNull(), "NOT_EVALUATED")
        .when(latest >= expected, "PASS").otherwise("STALE"))
    return joined.select(
        "instrument_key", "price_basis", "latest_seen_utc", "latest_complete_utc", "data_version", "data_status",
        F.greatest(F.lit(0), seconds_between(latest, now)).alias("freshness_seconds"), "latest_expected_utc", "next_expected_utc", status.alias("freshness_status"))


def freshness_grace(watermarks: DataFrame, instruments: DataFrame, sessions: DataFrame, now: Column, grace_hours: int = 2) -> DataFrame:
    """The rule with a grace time: PASS until two hours after the first slot later than the latest complete bar.  The slot is computed from each session's
    first and last one; slots aren't expanded."""
    ends = open_sessions(sessions).where("close_utc is not null")
    held = instruments.select("instrument_key", "asset_type", "calendar_id")
    joined = watermarks.join(held, "instrument_key").join(ends, "calendar_id", "left").withColumn("a", first_slot()).withColumn("raw", last_slot())
    a, c = F.col("a"), F.col("latest_complete_utc")
    last = plus_hours(a, F.floor(seconds_between(a, F.col("raw")) / 3600))
    following = F.when(F.col("raw") >= a, F.when(c < a, a).when(c < last, plus_hours(a, F.floor(seconds_between(a, c) / 3600) + 1)))
    later = joined.groupBy("instrument_key", "price_basis", "latest_complete_utc", "data_status").agg(F.min(following).alias("next_slot_utc"))
    status = F.when(F.col("data_status") != "ACTIVE", "FAIL").when(F.col("next_slot_utc").isNull(), "NOT_EVALUATED").when(
        now <= F.timestamp_add("HOUR", F.lit(grace_hours), F.col("next_slot_utc")), "PASS").otherwise("STALE")
    return later.select("instrument_key", "price_basis", "latest_complete_utc", "next_slot_utc", status.alias("freshness_status"))


def inventory_raw(raw: DataFrame) -> DataFrame:
    """Row count, first and last time, last complete time and last run by dataset, series and horizon."""
    return raw.groupBy("dataset_id", "instrument_key", "price_basis", "horizon_minutes").agg(
        F.count("*").alias("row_count"), F.min("time_utc").alias("min_time_utc"), F.max("time_utc").alias("max_time_utc"),
        F.max(F.when(F.col("is_complete"), F.col("time_utc"))).alias("latest_complete_utc"), F.max("run_id").alias("latest_run"))


def inventory_curated(bars: DataFrame, raw: DataFrame) -> DataFrame:
    """As the raw inventory, with lineage from the exact raw row, and the worst row status (FAIL, WARN, NOT_EVALUATED, PASS)."""
    key = ["run_id", "instrument_key", "horizon_minutes", "time_utc", "price_basis"]
    joined = bars.drop("dataset_id").join(raw.select(*key, "dataset_id"), key, "left")
    status = F.col("quality_status")
    worst = F.when(F.bool_or(status == "FAIL"), "FAIL").when(F.bool_or(status == "WARN"), "WARN").when(F.bool_or(status == "NOT_EVALUATED"), "NOT_EVALUATED").otherwise("PASS")
    return joined.groupBy("dataset_id", "instrument_key", "price_basis", "horizon_minutes").agg(
        F.count("*").alias("row_count"), F.min("time_utc").alias("min_time_utc"), F.max("time_utc").alias("max_time_utc"),
        F.max(F.when(F.col("is_complete"), F.col("time_utc"))).alias("latest_complete_utc"), worst.alias("quality_status"))


def inventory_total_return(rows: DataFrame) -> DataFrame:
    """A series for each dataset and ticker; dates are midnights in UTC."""
    return rows.groupBy("dataset_id", "ticker").agg(
        F.count("*").alias("row_count"), F.min("date").cast("timestamp_ntz").alias("min_time_utc"), F.max("date").cast("timestamp_ntz").alias("max_time_utc"),
        F.lit("etf_total_return").alias("price_basis"), F.lit(1440).alias("horizon_minutes"))


def inventory_derived(bars_4h: DataFrame, bars_1d: DataFrame) -> DataFrame:
    """Row counts and times of both derived layers."""
    layers = bars_4h.select(F.lit("4h").alias("layer"), "instrument_key", "time_utc", "is_complete").unionByName(
        bars_1d.select(F.lit("1d").alias("layer"), "instrument_key", F.col("session_date").cast("timestamp_ntz").alias("time_utc"), "is_complete"))
    return layers.groupBy("layer", "instrument_key").agg(
        F.count("*").alias("row_count"), F.min("time_utc").alias("min_time_utc"), F.max("time_utc").alias("max_time_utc"), F.max(F.when(F.col("is_complete"), F.col("time_utc"))).alias("latest_complete_utc"))


def inventory_reference(rows: DataFrame) -> DataFrame:
    """Counts and times by dataset, key, layer and kind; an empty key falls back to the dataset."""
    key = F.coalesce(F.nullif(F.col("reference_key"), F.lit("")), F.col("dataset_id"))
    return rows.groupBy("dataset_id", key.alias("series_key"), "layer", "reference_kind").agg(
        F.count("*").alias("row_count"), F.min("observed_utc").alias("min_time_utc"), F.max("observed_utc").alias("max_time_utc"))


def inventory(parts: list[DataFrame], now: Column, interval_seconds: int, grace_seconds: int) -> DataFrame:
    """The union of inventories (series_key, layer, row_count, latest_utc) with age and freshness."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    age = F.greatest(F.lit(0), seconds_between(F.col("latest_utc"), now))
    status = F.when(F.col("latest_utc").isNull(), "NOT_EVALUATED").when(seconds_between(F.col("latest_utc"), now) <= interval_seconds + grace_seconds, "PASS").otherwise("STALE")
    return rows.select("series_key", "layer", "row_count", "latest_utc", age.alias("freshness_seconds"), status.alias("freshness_status"))


def layer_counts(bars: DataFrame, bars_4h: DataFrame, bars_1d: DataFrame) -> DataFrame:
    parts = [rows.agg(F.count("*").alias("rows")).select(F.lit(layer).alias("layer"), "rows") for layer, rows in (("1h", bars), ("4h", bars_4h), ("1d", bars_1d))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def lineage(files: DataFrame, raw: DataFrame, curated: DataFrame) -> DataFrame:
    """Raw and curated rows of each source file; a curated bar counts for the file of its exact raw row."""
    key = ["run_id", "instrument_key", "time_utc"]
    of_raw = raw.groupBy("source_file_id").agg(F.count("*").alias("raw_rows"))
    of_curated = curated.join(raw.select(*key, "source_file_id"), key).groupBy("source_file_id").agg(F.count("*").alias("curated_rows"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return files.join(of_raw, "source_file_id", "left").join(of_curated, "source_file_id", "left").select(*files.columns, zero("raw_rows"), zero("curated_rows"))


def lineage_mismatches(lineages: DataFrame) -> DataFrame:
    """Files whose stored rows differ from their row count (total-return files count as curated, others as raw)."""
    tr = F.col("file_class") == "curated_total_return"
    wrong = F.when(tr, (F.col("curated_rows") != F.col("row_count")) | (F.col("raw_rows") != 0)).otherwise(F.col("raw_rows") != F.col("row_count"))
    return lineages.where(wrong).select("source_file_id", "row_count", "raw_rows", "curated_rows")


def ingestion_status(runs: DataFrame, watermarks: DataFrame, now: Column) -> DataFrame:
    """All runs with the one latest complete time over all series, and its age."""
    latest = watermarks.agg(F.max("latest_complete_utc").alias("latest_complete_utc"))
    return runs.crossJoin(F.broadcast(latest)).withColumn("watermark_age_seconds", seconds_between(F.col("latest_complete_utc"), now))


def overview(series: DataFrame) -> DataFrame:
    """Series, rows and series that need attention by role."""
    return series.groupBy("role").agg(F.count("*").alias("series"), F.sum("row_count").alias("rows"), F.count_if(F.col("status").isin("FAIL", "STALE", "WARN")).alias("attention"), F.count_distinct("instrument_key").alias("instruments"))


def series_summary(series: DataFrame) -> DataFrame:
    """By instrument: roles and layers (sorted, joined), number of series, earliest and latest time, and the default series (by role order, then id)."""
    return series.groupBy("instrument_key").agg(
        F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles"), F.array_join(F.array_sort(F.collect_set("layer")), ",").alias("layers"), F.count("*").alias("series"),
        F.min("min_time_utc").alias("earliest_utc"), F.max("max_time_utc").alias("latest_utc"), F.min_by("series_id", F.struct("role_order", "series_id")).alias("default_series"))


def histograms(rows: DataFrame) -> DataFrame:
    """Rows and complete rows by horizon and quality status."""
    return rows.groupBy("horizon_minutes", "quality_status").agg(F.count("*").alias("rows"), F.count_if("is_complete").alias("complete_rows"))


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys and rows beyond the first of their key."""
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    return counted.agg(F.sum("n").alias("rows"), F.count("*").alias("distinct_keys"), (F.sum("n") - F.count("*")).alias("duplicate_rows"))


def derived_rollup(bars_4h: DataFrame, bars_1d: DataFrame) -> DataFrame:
    def part(layer: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.count("*").alias("rows"), F.count_if(F.col("quality_status") == "FAIL").alias("fail_rows"), F.count_if(F.col("is_complete") & (F.col("quality_status") == "PASS")).alias("eligible_rows")).withColumn("layer", F.lit(layer))

    return part("4h", bars_4h).unionByName(part("1d", bars_1d))


def status_rollup(coverages: DataFrame) -> DataFrame:
    return coverages.groupBy("coverage_status").agg(F.count("*").alias("instruments"), F.sum("missing_rows").alias("missing_rows"), F.sum("out_of_session_rows").alias("out_of_session_rows"))


def cutoff_leaks(tables: dict[str, tuple[DataFrame, str]], cutoff: Column) -> DataFrame:
    """Rows of each table later than the cutoff."""
    parts = [rows.agg(F.count_if(F.col(time) > cutoff).alias("rows_after")).withColumn("relation", F.lit(name)) for name, (rows, time) in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("relation", "rows_after")


def count_baseline(tables: dict[str, DataFrame], expected: dict[str, int]) -> DataFrame:
    """Expected against actual row count of each table."""
    out = None
    for name, rows in tables.items():
        n = F.lit(expected[name]).cast("long")
        part = rows.agg(F.count("*").alias("actual_rows")).select(F.lit(name).alias("relation"), n.alias("expected_rows"), "actual_rows", (F.col("actual_rows") == n).alias("matches"))
        out = part if out is None else out.unionByName(part)
    return out


def storage_usage(files: DataFrame, review_bytes: int = 8 << 30) -> DataFrame:
    """Bytes by relation, REVIEW from 8 GiB on."""
    total = F.sum("bytes")
    return files.groupBy("relation").agg(total.alias("total_bytes"), F.when(total >= review_bytes, "REVIEW").otherwise("OK").alias("review"))

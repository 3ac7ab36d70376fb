"""Read queries: ranges, keyset pages, snapshots, charts, listings, series status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from barloom.operators.publish import published_only
from barloom.operators.reports import status_priority


def bar_range(bars: DataFrame, publication: DataFrame, key: str, start: Column, end: Column, limit: int) -> DataFrame:
    """Complete PASS bars of a visible instrument in [start, end), ordered; one more than the limit shows a cut."""
    rows = bars.where((F.col("instrument_key") == key) & (F.col("time_utc") >= start) & (F.col("time_utc") < end) & F.col("is_complete") & (F.col("quality_status") == "PASS"))
    return published_only(rows, publication).orderBy("time_utc").limit(limit + 1)


def keyset_page(rows: DataFrame, keys: list[str], after: tuple | None, limit: int) -> DataFrame:
    """The next page in key order after the given key tuple; one row more than the limit shows a cut."""
    if after is not None:
        rows = rows.where(F.struct(*keys) > F.struct(*[F.lit(v).cast(rows.schema[k].dataType).alias(k) for k, v in zip(keys, after)]))
    return rows.orderBy(*keys).limit(limit + 1)


def _after(rows: DataFrame, keys: list[str], after: tuple) -> Column:
    return F.struct(*keys) > F.struct(*[F.lit(v).cast(rows.schema[k].dataType).alias(k) for k, v in zip(keys, after)])


def paged(rows: DataFrame, keys: list[str], after: tuple | None, limit: int) -> DataFrame:
    """A page of at most ``limit`` rows with ``truncated`` (more rows follow) and, if so, ``next_key``: the last row's key, from which the next page goes on."""
    n = F.row_number().over(Window.orderBy(*keys))  # of limit + 1 rows
    page = keyset_page(rows, keys, after, limit).withColumn("__n", n).withColumn("truncated", F.max("__n").over(Window.partitionBy()) > limit)
    last = F.max(F.when(F.col("__n") == limit, F.struct(*keys))).over(Window.partitionBy())
    return page.withColumn("next_key", F.when(F.col("truncated"), last)).where(F.col("__n") <= limit).drop("__n").orderBy(*keys)


def write_clustered(rows: DataFrame, path: str, keys: list[str], range_rows: int = 1_000_000) -> None:
    """Rows in ranges of their keys, each a folder ``range_id=<n>`` of its own, and under ``<path>-bounds`` the first and last key and the rows of each."""
    parts = max(1, -(-rows.count() // range_rows))
    ranged = rows.repartitionByRange(parts, *keys).withColumn("range_id", F.spark_partition_id())
    ranged.sortWithinPartitions("range_id", *keys).write.partitionBy("range_id").parquet(path)
    written = rows.sparkSession.read.schema(ranged.schema).parquet(path)
    written.groupBy("range_id").agg(F.min(F.struct(*keys)).alias("first"), F.max(F.struct(*keys)).alias("last"), F.count("*").alias("rows")).write.parquet(f"{path}-bounds")


def clustered_page(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], after: tuple | None, limit: int) -> DataFrame:
    """``paged`` over a table that ``write_clustered`` wrote: only ranges that the page can reach into are read."""
    bounds = spark.read.parquet(f"{path}-bounds")
    if after is not None:
        key = F.struct(*[F.lit(v).cast(schema[k].dataType).alias(k) for k, v in zip(keys, after)])
        bounds = bounds.where(F.col("last") > key)
    reached, ahead = [], 0
    for r in bounds.orderBy("first").limit(limit + 2).collect():  # each has a row of the page at least
        reached.append(r["range_id"])
        ahead += r["rows"] if len(reached) > 1 or after is None else 1  # the first may lie before the key but for its last row
        if ahead > limit:
            break
    paths = [f"{path}/range_id={k}" for k in reached]
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return paged(rows, keys, after, limit)


def snapshot_bars(bars: DataFrame, snapshots: DataFrame, snapshot_id: str) -> DataFrame:
    """Bars not later than a snapshot's cutoff."""
    cutoff = snapshots.where(F.col("snapshot_id") == snapshot_id).select("cutoff_utc").limit(1)
    return bars.crossJoin(F.broadcast(cutoff)).where("time_utc <= cutoff_utc").drop("cutoff_utc")


def snapshot_integrity(bars: DataFrame, cutoff: Column, manifest: DataFrame) -> DataFrame:
    """Counts and ends of a snapshot's bars against its manifest (rows, min_time_utc, max_time_utc)."""
    have = bars.agg(F.count("*").alias("n"), F.min("time_utc").alias("lo"), F.max("time_utc").alias("hi"), F.count_if(F.col("time_utc") > cutoff).alias("rows_after"))
    joined = have.crossJoin(F.broadcast(manifest.limit(1)))
    ok = (F.col("n") == F.col("rows")) & (F.col("lo") == F.col("min_time_utc")) & (F.col("hi") == F.col("max_time_utc")) & (F.col("rows_after") == 0)
    return joined.select("n", "rows", "rows_after", F.when(ok, "PASS").otherwise("FAIL").alias("integrity"))


def chart_rows(bars: DataFrame, key: str, start: Column, end: Column, limit: int) -> DataFrame:
    """The newest bars of a range, in ascending order."""
    newest = bars.where((F.col("instrument_key") == key) & (F.col("time_utc") >= start) & (F.col("time_utc") < end)).orderBy(F.col("time_utc").desc()).limit(limit)
    return newest.orderBy("time_utc")


def chart_marks(open_events: DataFrame, key: str, start: Column, end: Column, limit: int) -> DataFrame:
    return open_events.where((F.col("instrument_key") == key) & (F.col("time_utc") >= start) & (F.col("time_utc") < end)).orderBy("time_utc", "event_id").limit(limit)


def list_series(series: DataFrame, text: str, offset: int, limit: int) -> DataFrame:
    """Series whose key contains the text (case-folded), worst status first, with an id hash and the total."""
    found = series.where(F.lower("series_id").contains(text.lower()))
    rows = found.select(F.sha2(F.concat_ws("\u001f", "layer", "series_id"), 256).alias("id_hash"), "series_id", "layer", "status").crossJoin(F.broadcast(found.agg(F.count("*").alias("total"))))
    return rows.orderBy(status_priority(F.col("status")).desc_nulls_last(), "series_id").offset(offset).limit(limit)


def series_status(coverage: DataFrame, freshness: DataFrame, blockers: DataFrame, publication: DataFrame, availability: DataFrame) -> DataFrame:
    """ELIGIBLE, ELIGIBLE_WITH_WARNINGS or BLOCKED for each series, with reasons and warnings joined.

    ``blockers``: instrument_key, blockers (a count).
    """
    key = "instrument_key"
    joined = (coverage.select(key, "coverage_status").join(freshness.select(key, "freshness_status"), key, "left").join(blockers.select(key, "blockers"), key, "left")
              .join(publication.select(key, "publication_status"), key, "left").join(availability.select(key, "availability"), key, "left"))
    reasons = F.array_compact(F.array(
        F.when(F.col("coverage_status") == "FAIL", "COVERAGE_FAIL"), F.when(F.col("freshness_status") == "FAIL", "FRESHNESS_FAIL"), F.when(F.coalesce("blockers", F.lit(0)) > 0, "CURRENT_BLOCKER"),
        F.when(~F.col("publication_status").isin("STAGING", "PUBLISHED"), "NOT_PUBLISHED"), F.when(F.col("availability") == "BLOCKED", "REVISION_BLOCKED")))
    warnings = F.array_compact(F.array(
        F.when(F.col("coverage_status").isin("WARN", "NOT_EVALUATED"), F.concat(F.lit("COVERAGE_"), "coverage_status")), F.when(F.col("freshness_status").isin("STALE", "NOT_EVALUATED"), F.concat(F.lit("FRESHNESS_"), "freshness_status")),
        F.when(F.col("availability") == "WARNING", "REVISION_WARNING")))
    verdict = F.when(F.size(reasons) > 0, "BLOCKED").when(F.size(warnings) > 0, "ELIGIBLE_WITH_WARNINGS").otherwise("ELIGIBLE")
    return joined.select(key, verdict.alias("eligibility"), F.array_join(reasons, ",").alias("reasons"), F.array_join(warnings, ",").alias("warnings"))


def operations(view: DataFrame, order: list[Column], alert: Column, limit: int) -> DataFrame:
    """The first rows of a view in its order, each with whether any row of the whole view alerts."""
    flag = view.agg(F.coalesce(F.bool_or(alert), F.lit(False)).alias("alert"))
    return view.orderBy(*order).limit(limit).crossJoin(F.broadcast(flag))


def instrument_catalog(instruments: DataFrame, summaries: DataFrame) -> DataFrame:
    """Instruments with their series summary, by key, or for ETFs by the root of a symbol."""
    by_key = instruments.join(summaries, "instrument_key", "left")
    root = F.split("symbol", ":")[0]
    by_root = instruments.where("asset_type = 'Etf'").withColumn("root", root).join(summaries.withColumnRenamed("instrument_key", "root"), "root")
    value = [c for c in summaries.columns if c != "instrument_key"]
    both = by_key.select("instrument_key", "asset_type", *value).unionByName(by_root.where("root <> instrument_key").select("instrument_key", "asset_type", *value))
    w = Window.partitionBy("instrument_key").orderBy(F.col(value[0]).isNull(), *value)
    return both.withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank")


def series_detail(series: DataFrame, coverage: DataFrame, freshness: DataFrame, key: str) -> DataFrame:
    """One instrument's series with its coverage and freshness; the filter comes before the joins."""
    only = F.col("instrument_key") == key
    return series.where(only).join(coverage.where(only), "instrument_key", "left").join(freshness.where(only).select("instrument_key", "freshness_status", "freshness_seconds"), "instrument_key", "left")

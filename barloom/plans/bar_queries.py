"""Queries on calendars, derived bars and reports."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from barloom.operators import bars as der, calendar as cal, reports as rep
from barloom.plans import bindings as b
from barloom.plans.bindings import CTE, NOW, sql
from barloom.plans.registry import query

_YEARS = "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders"
_HOLIDAYS = f"""
years AS ({_YEARS}),
days AS (SELECT y, CAST(unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d FROM years),
numbered AS (SELECT y, d, month(d) AS m, isodow(d) AS w, row_number() OVER (PARTITION BY y, month(d), isodow(d) ORDER BY d) AS n, row_number() OVER (PARTITION BY y, month(d), isodow(d) ORDER BY d DESC) AS back FROM days),
easters AS (SELECT unnest([DATE '1992-04-19', DATE '1993-04-11', DATE '1994-04-03', DATE '1995-04-16', DATE '1996-04-07', DATE '1997-03-30', DATE '1998-04-12', DATE '1999-04-04', DATE '2000-04-23', DATE '2001-04-15', DATE '2002-03-31', DATE '2003-04-20']) AS e),
fixed AS (SELECT make_date(y, 1, 1) AS f FROM years UNION ALL SELECT make_date(y, 7, 4) FROM years UNION ALL SELECT make_date(y, 12, 25) FROM years UNION ALL SELECT make_date(y, 6, 19) FROM years WHERE y >= 2022),
observed AS (SELECT f, CASE isodow(f) WHEN 6 THEN f - 1 WHEN 7 THEN f + 1 ELSE f END AS o FROM fixed),
holidays AS (
  SELECT d FROM numbered WHERE (m = 1 AND w = 1 AND n = 3) OR (m = 2 AND w = 1 AND n = 3) OR (m = 5 AND w = 1 AND back = 1) OR (m = 9 AND w = 1 AND n = 1) OR (m = 11 AND w = 4 AND n = 4)
  UNION SELECT o FROM observed UNION SELECT e - 2 FROM easters WHERE year(e) IN (SELECT y FROM years))
"""


def _years(spark, folder):
    return b.table(spark, folder, "orders").select(F.year("o_orderdate").alias("year")).distinct()


@query("c01_equity_holidays", f"WITH {_HOLIDAYS} SELECT DISTINCT d AS holiday_date FROM holidays")
def c01(spark, folder):
    return cal.equity_holidays(_years(spark, folder))


@query("c02_equity_short_sessions", f"""WITH {_HOLIDAYS},
short AS (SELECT d + 1 AS d FROM numbered WHERE m = 11 AND w = 4 AND n = 4
  UNION SELECT o - CASE isodow(o) WHEN 1 THEN 3 WHEN 7 THEN 2 ELSE 1 END FROM observed WHERE month(f) IN (7, 12))
SELECT DISTINCT d AS short_date FROM short WHERE isodow(d) < 6 AND d NOT IN (SELECT d FROM holidays)""")
def c02(spark, folder):
    return cal.equity_short_sessions(_years(spark, folder))


@query("c03_equity_sessions", sql("SELECT * FROM sessions WHERE calendar_id = 'us_equity'"))
def c03(spark, folder):
    return cal.equity_sessions(b.bounds(spark, folder))


@query("c04_fx_sessions", sql("SELECT * FROM sessions WHERE calendar_id = 'fx'"))
def c04(spark, folder):
    return cal.fx_sessions(b.bounds(spark, folder))


_SESSION = """'{"session_date":"' || CAST(session_date AS VARCHAR) || '"' || CASE WHEN open_utc IS NOT NULL THEN ',"open_utc":"' || strftime(open_utc, '%Y-%m-%dT%H:%M:%S.000') || '","close_utc":"' || strftime(close_utc, '%Y-%m-%dT%H:%M:%S.000') || '"' ELSE '' END || ',"status":"' || status || '"}'"""


@query("c05_calendar_digest", sql(f"SELECT calendar_id, sha256('[' || string_agg({_SESSION}, ',' ORDER BY session_date) || ']') AS digest FROM sessions GROUP BY 1"))
def c05(spark, folder):
    return cal.calendar_digest(b.sessions(spark, folder))


@query("c06_calendar_status", sql("""SELECT s.calendar_id, count(DISTINCT session_date) AS intervals, (SELECT count(*) FROM instruments i WHERE i.calendar_id = s.calendar_id) AS instruments FROM sessions s GROUP BY s.calendar_id"""))
def c06(spark, folder):
    return cal.calendar_status(b.sessions(spark, folder), b.instruments(spark, folder))


@query("c08_expected_slots", sql("SELECT calendar_id, session_date, unnest(generate_series(open_utc, close_utc - INTERVAL 1 MINUTE, INTERVAL 1 HOUR)) AS slot_utc FROM open_sessions"))
def c08(spark, folder):
    return cal.expected_slots(b.sessions(spark, folder))


@query("c09_complete_slots", sql("SELECT * FROM slots"))
def c09(spark, folder):
    return cal.complete_slots(b.instruments(spark, folder), b.sessions(spark, folder))


_EXPECTED = """SELECT b.instrument_key, b.price_basis, count(s.slot_utc) AS expected_rows FROM
  (SELECT instrument_key, price_basis, min(time_utc) AS lo, max(time_utc) AS hi FROM bars GROUP BY ALL) b JOIN slots s ON s.instrument_key = b.instrument_key AND s.slot_utc BETWEEN lo AND hi GROUP BY ALL"""


@query("c10_expected_rows", sql(_EXPECTED))
def c10(spark, folder):
    return cal.expected_rows(rep.coverage_actual(b.bars(spark, folder)), b.sessions(spark, folder))


@query("c11_align_range", sql("SELECT instrument_key, time_utc, session_date, open_utc FROM in_session"))
def c11(spark, folder):
    return cal.align_range(b.bars(spark, folder), b.sessions(spark, folder)).select("instrument_key", "time_utc", "session_date", "open_utc")


@query("c12_align_date", sql("SELECT instrument_key, time_utc, session_date FROM aligned"))
def c12(spark, folder):
    return cal.align_date(b.bars(spark, folder), b.sessions(spark, folder)).select("instrument_key", "time_utc", "session_date")


_DUE = f"""WITH cut AS (SELECT instrument_key, slot_utc, TIMESTAMP '{NOW}' - INTERVAL 1 HOUR - CASE WHEN asset_type = 'FxSpot' THEN INTERVAL 10 MINUTE ELSE INTERVAL 3 MINUTE END AS cutoff FROM slots JOIN instruments USING (instrument_key)),
due AS (SELECT instrument_key, max(slot_utc) FILTER (slot_utc <= cutoff) AS latest_expected_utc, min(slot_utc) FILTER (slot_utc > cutoff) AS next_expected_utc FROM cut GROUP BY instrument_key)"""


@query("c13_expected_slot_at", sql(_DUE + " SELECT * FROM due"))
def c13(spark, folder):
    return cal.expected_slot_at(b.instruments(spark, folder), b.sessions(spark, folder), b.now())


@query("c14_contained_hours", sql("""SELECT calendar_id, session_date, unnest(generate_series(date_trunc('hour', open_utc + INTERVAL 64 MINUTE + INTERVAL '59.999999 seconds'), close_utc - INTERVAL 61 MINUTE, INTERVAL 1 HOUR)) AS hour_utc
  FROM open_sessions WHERE calendar_id = 'fx'"""))
def c14(spark, folder):
    return cal.contained_hours(b.sessions(spark, folder).where(F.col("calendar_id") == cal.FX), True, 5, 1)


@query("c20_lagging", sql(_DUE + " SELECT d.instrument_key, latest_expected_utc AS expected_utc, latest_complete_utc AS observed_utc, CASE WHEN latest_complete_utc IS NULL OR latest_complete_utc < latest_expected_utc THEN 'DATA_NOT_READY' ELSE 'READY' END AS readiness FROM due d LEFT JOIN watermarks w USING (instrument_key)"))
def c20(spark, folder):
    expected = c13(spark, folder).select("instrument_key", F.col("latest_expected_utc").alias("expected_utc"))
    return cal.lagging(expected, b.watermarks(spark, folder).select("instrument_key", F.col("latest_complete_utc").alias("observed_utc")))


@query("c22_completed_sessions", sql(f"SELECT calendar_id, count(*) AS sessions, max(session_date) AS latest_session_date FROM open_sessions WHERE close_utc <= TIMESTAMP '{NOW}' GROUP BY calendar_id"))
def c22(spark, folder):
    return cal.completed_sessions(b.sessions(spark, folder), b.now())


@query("c23_previous_terminal", sql("SELECT calendar_id, session_date, lag(open_utc + INTERVAL (CAST(floor((epoch(close_utc) - epoch(open_utc) - 1) / 3600) AS BIGINT)) HOUR) OVER (PARTITION BY calendar_id ORDER BY close_utc) AS previous_terminal_utc FROM open_sessions"))
def c23(spark, folder):
    return cal.previous_terminal(b.sessions(spark, folder))


@query("a01_derive_4h", sql("SELECT * FROM bars_4h"))
def a01(spark, folder):
    return der.derive_4h(b.bars(spark, folder), b.sessions(spark, folder))


@query("a02_derive_1d", sql("SELECT * FROM bars_1d"))
def a02(spark, folder):
    return der.derive_1d(b.bars(spark, folder), b.sessions(spark, folder))


@query("a03_grade_derived", sql("SELECT quality_status, is_complete, count(*) AS bars FROM bars_4h GROUP BY ALL"))
def a03(spark, folder):
    return a01(spark, folder).groupBy("quality_status", "is_complete").agg(F.count("*").alias("bars"))


@query("a04_scoped_rebuild", sql("SELECT * FROM bars_4h WHERE instrument_key IN ('view', 'error')"))
def a04(spark, folder):
    return der.derive_4h(b.bars(spark, folder), b.sessions(spark, folder), ["view", "error"])


# Bars of two derivation versions: v1 of all bars; v2 too, and then 'view' and 'error' anew from the bars of events that aren't divisible by three ('error' from none).
_AGAIN = "in_session AS" + CTE.split("in_session AS")[1].split("watermarks AS")[0].replace("FROM bars b JOIN", "FROM (SELECT * FROM bars WHERE instrument_key = 'view' AND last_event % 3 <> 0) b JOIN")
for _name in ("in_session", "aligned", "eligible", "bars_4h", "bars_1d"):
    _AGAIN = re.sub(rf"\b{_name}\b", f"{_name}_again", _AGAIN)
_VERSIONS = f"WITH {_AGAIN.strip().rstrip(',')}, v4 AS (SELECT 'v1' AS version, * FROM bars_4h UNION ALL SELECT 'v2', * FROM bars_4h WHERE instrument_key NOT IN ('view', 'error') UNION ALL SELECT 'v2', * FROM bars_4h_again)"


def _derivations(spark, folder):
    """A folder with both versions of four-hour bars."""
    path, rows, times = b.fresh_folder(spark, "derivations"), b.bars(spark, folder), b.sessions(spark, folder)
    for version in ("v1", "v2"):
        der.write_derivation(der.derive_4h(rows, times), path, version)
    scope = spark.createDataFrame([("view",), ("error",)], "instrument_key string")
    der.write_derivation(der.derive_4h(rows.where("instrument_key = 'view' and last_event % 3 <> 0"), times, ["view", "error"]), path, "v2", scope)
    return path


@query("a04_derivation_versions", sql(_VERSIONS + " SELECT * FROM v4"), shared=True)
def a04_versions(spark, folder):
    path = _derivations(spark, folder)
    both = [der.read_derivation(spark, path, v).withColumn("version", F.lit(v)) for v in ("v1", "v2")]
    return both[0].unionByName(both[1])


@query("a26_pinned_rollup", sql(_VERSIONS + ", one AS (SELECT * FROM v4 WHERE version = 'v2') SELECT 'v2' AS version, (SELECT count(*) FROM bars) AS rows_1h, count(*) AS rows_4h, count(*) FILTER (quality_status = 'FAIL') AS fail_rows, count(*) FILTER (is_complete AND quality_status = 'PASS') AS eligible_rows FROM one"), shared=True)
def a26_pinned(spark, folder):
    """Layer counts and eligibility of one derivation version."""
    bars_4h = der.read_derivation(spark, _derivations(spark, folder), "v2")
    counts = rep.layer_counts(b.bars(spark, folder), bars_4h, bars_4h.limit(0)).where("layer <> '1d'").groupBy(F.lit("v2").alias("version")).agg(F.max(F.when(F.col("layer") == "1h", F.col("rows"))).alias("rows_1h"), F.max(F.when(F.col("layer") == "4h", F.col("rows"))).alias("rows_4h"))
    rolled = rep.derived_rollup(bars_4h, bars_4h.limit(0)).where("layer = '4h'").select(F.lit("v2").alias("version"), "fail_rows", "eligible_rows")
    return counts.join(rolled, "version")


def _raw(spark, folder):
    """Both versions of the bars as raw revisions; a run is (version, day)."""
    both = b.bars(spark, folder, 1).unionByName(b.bars(spark, folder, 2))
    return both.withColumn("run_id", F.col("data_version") * 100 + F.col("run_id")).withColumn("dataset_id", F.concat(F.lit("set"), F.col("data_version").cast("string"))).withColumn("source_file_id", F.col("run_id"))


def _curated(spark, folder):
    rows = b.bars(spark, folder, 2)
    return rows.withColumn("run_id", F.col("data_version") * 100 + F.col("run_id"))


_RAW = """raw AS (SELECT * REPLACE (data_version * 100 + run_id AS run_id), 'set' || data_version AS dataset_id, data_version * 100 + run_id AS source_file_id FROM (SELECT * FROM bars UNION ALL BY NAME SELECT * FROM bars2)),
curated AS (SELECT * REPLACE (data_version * 100 + run_id AS run_id) FROM bars2)"""


@query("a05_inventory_raw", sql(f"WITH {_RAW} SELECT dataset_id, instrument_key, price_basis, horizon_minutes, count(*) AS row_count, min(time_utc) AS min_time_utc, max(time_utc) AS max_time_utc, max(time_utc) FILTER (is_complete) AS latest_complete_utc, max(run_id) AS latest_run FROM raw GROUP BY ALL"))
def a05(spark, folder):
    return rep.inventory_raw(_raw(spark, folder))


@query("a06_inventory_curated", sql(f"""WITH {_RAW} SELECT r.dataset_id, c.instrument_key, c.price_basis, c.horizon_minutes, count(*) AS row_count, min(c.time_utc) AS min_time_utc, max(c.time_utc) AS max_time_utc, max(c.time_utc) FILTER (c.is_complete) AS latest_complete_utc,
  CASE WHEN bool_or(c.quality_status = 'FAIL') THEN 'FAIL' WHEN bool_or(c.quality_status = 'WARN') THEN 'WARN' WHEN bool_or(c.quality_status = 'NOT_EVALUATED') THEN 'NOT_EVALUATED' ELSE 'PASS' END AS quality_status
  FROM curated c LEFT JOIN raw r ON r.run_id = c.run_id AND r.instrument_key = c.instrument_key AND r.time_utc = c.time_utc AND r.price_basis = c.price_basis GROUP BY r.dataset_id, c.instrument_key, c.price_basis, c.horizon_minutes"""))
def a06(spark, folder):
    return rep.inventory_curated(_curated(spark, folder), _raw(spark, folder))


@query("a07_inventory_total_return", "SELECT 'orders' AS dataset_id, o_orderpriority AS ticker, count(*) AS row_count, CAST(min(d) AS TIMESTAMP) AS min_time_utc, CAST(max(d) AS TIMESTAMP) AS max_time_utc, 'etf_total_return' AS price_basis, 1440 AS horizon_minutes FROM (SELECT DISTINCT o_orderpriority, CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY o_orderpriority")
def a07(spark, folder):
    rows = b.table(spark, folder, "orders").select(F.lit("orders").alias("dataset_id"), F.col("o_orderpriority").alias("ticker"), F.col("o_orderdate").cast("date").alias("date")).distinct()
    return rep.inventory_total_return(rows)


@query("a08_inventory_derived", sql("""SELECT layer, instrument_key, count(*) AS row_count, min(t) AS min_time_utc, max(t) AS max_time_utc, max(t) FILTER (is_complete) AS latest_complete_utc FROM
  (SELECT '4h' AS layer, instrument_key, time_utc AS t, is_complete FROM bars_4h UNION ALL SELECT '1d', instrument_key, CAST(session_date AS TIMESTAMP), is_complete FROM bars_1d) GROUP BY layer, instrument_key"""))
def a08(spark, folder):
    return rep.inventory_derived(a01(spark, folder), a02(spark, folder))


@query("a09_inventory_reference", "SELECT 'events' AS dataset_id, CASE WHEN event_type = 'view' THEN 'events' ELSE event_type END AS series_key, 'raw' AS layer, CASE WHEN value < 50 THEN 'small' ELSE 'large' END AS reference_kind, count(*) AS row_count, min(ts) AS min_time_utc, max(ts) AS max_time_utc FROM events GROUP BY ALL")
def a09(spark, folder):
    key = F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type"))
    rows = b.table(spark, folder, "events").select(F.lit("events").alias("dataset_id"), key.alias("reference_key"), F.lit("raw").alias("layer"), F.when(F.col("value") < 50, "small").otherwise("large").alias("reference_kind"), F.col("ts").alias("observed_utc"))
    return rep.inventory_reference(rows)


_INVENTORY = f"""WITH {_RAW}, parts AS (
  SELECT dataset_id || '/' || instrument_key AS series_key, 'raw' AS layer, count(*) AS row_count, max(time_utc) AS latest_utc FROM raw GROUP BY dataset_id, instrument_key
  UNION ALL SELECT instrument_key, '4h', count(*), max(time_utc) FILTER (is_complete) FROM bars_4h GROUP BY instrument_key
  UNION ALL SELECT instrument_key, '1d', count(*), max(CAST(session_date AS TIMESTAMP)) FILTER (is_complete) FROM bars_1d GROUP BY instrument_key),
inv AS (SELECT series_key, layer, row_count, latest_utc, greatest(0, CAST(epoch(TIMESTAMP '{NOW}') - epoch(latest_utc) AS BIGINT)) AS freshness_seconds,
  CASE WHEN latest_utc IS NULL THEN 'NOT_EVALUATED' WHEN epoch(TIMESTAMP '{NOW}') - epoch(latest_utc) <= 3600 + 7200 THEN 'PASS' ELSE 'STALE' END AS freshness_status FROM parts)"""


@query("a10_inventory", sql(_INVENTORY + " SELECT * REPLACE (CASE WHEN latest_utc IS NULL THEN 0 ELSE freshness_seconds END AS freshness_seconds) FROM inv"))
def a10(spark, folder):
    raw = a05(spark, folder).groupBy(F.concat_ws("/", "dataset_id", "instrument_key").alias("series_key")).agg(F.sum("row_count").alias("row_count"), F.max("max_time_utc").alias("latest_utc")).withColumn("layer", F.lit("raw"))
    derived = a08(spark, folder).select(F.col("instrument_key").alias("series_key"), "row_count", F.col("latest_complete_utc").alias("latest_utc"), "layer")
    return rep.inventory([raw, derived], b.now(), 3600, 7200)


@query("a11_layer_counts", sql("SELECT '1h' AS layer, count(*) AS rows FROM bars UNION ALL SELECT '4h', count(*) FROM bars_4h UNION ALL SELECT '1d', count(*) FROM bars_1d"))
def a11(spark, folder):
    return rep.layer_counts(b.bars(spark, folder), a01(spark, folder), a02(spark, folder))


_FILES = f"""WITH {_RAW}, files AS (SELECT source_file_id, 'raw_market_bar' AS file_class, count(*) + CASE WHEN source_file_id % 7 = 0 THEN 1 ELSE 0 END AS row_count FROM raw GROUP BY source_file_id),
lin AS (SELECT f.*, coalesce(r.n, 0) AS raw_rows, coalesce(c.n, 0) AS curated_rows FROM files f LEFT JOIN (SELECT source_file_id, count(*) AS n FROM raw GROUP BY 1) r USING (source_file_id)
  LEFT JOIN (SELECT r.source_file_id, count(*) AS n FROM curated c JOIN raw r ON r.run_id = c.run_id AND r.instrument_key = c.instrument_key AND r.time_utc = c.time_utc GROUP BY 1) c USING (source_file_id))"""


def _lineage(spark, folder):
    raw = _raw(spark, folder)
    files = raw.groupBy("source_file_id").agg(F.count("*").alias("n")).select("source_file_id", F.lit("raw_market_bar").alias("file_class"), (F.col("n") + F.when(F.col("source_file_id") % 7 == 0, 1).otherwise(0)).alias("row_count"))
    return rep.lineage(files, raw, _curated(spark, folder))


@query("a12_lineage", sql(_FILES + " SELECT * FROM lin"))
def a12(spark, folder):
    return _lineage(spark, folder)


@query("a13_coverage_actual", sql("SELECT instrument_key, asset_type, calendar_id, verification_status, price_basis, count(*) AS actual_rows, count(*) FILTER (is_complete) AS complete_rows, count(*) FILTER (NOT is_complete) AS incomplete_rows, count(*) - count(DISTINCT time_utc) AS duplicate_rows, min(time_utc) AS min_time_utc, max(time_utc) AS max_time_utc FROM bars GROUP BY ALL"))
def a13(spark, folder):
    return rep.coverage_actual(b.bars(spark, folder))


COVERAGE = f"""WITH exp AS ({_EXPECTED}),
act AS (SELECT instrument_key, price_basis, verification_status, count(*) AS actual_rows, count(*) FILTER (is_complete) AS complete_rows, count(*) FILTER (NOT is_complete) AS incomplete_rows, count(*) - count(DISTINCT time_utc) AS duplicate_rows FROM bars GROUP BY ALL),
ali AS (SELECT instrument_key, price_basis, count(*) AS n FROM aligned GROUP BY ALL),
cov AS (SELECT instrument_key, price_basis, expected_rows, actual_rows, complete_rows, incomplete_rows, duplicate_rows, greatest(expected_rows - coalesce(n, 0), 0) AS missing_rows, greatest(actual_rows - coalesce(n, 0), 0) AS out_of_session_rows, coalesce(n, 0) AS aligned_rows,
  CASE WHEN verification_status <> 'VERIFIED' THEN 'NOT_EVALUATED' WHEN expected_rows IS NULL THEN 'NOT_EVALUATED' WHEN duplicate_rows > 0 OR coalesce(n, 0) > expected_rows THEN 'FAIL'
    WHEN coalesce(n, 0) < expected_rows OR actual_rows > coalesce(n, 0) THEN 'WARN' ELSE 'PASS' END AS coverage_status
  FROM act LEFT JOIN exp USING (instrument_key, price_basis) LEFT JOIN ali USING (instrument_key, price_basis))"""


@query("a14_coverage", sql(COVERAGE + " SELECT * FROM cov"), shared=True)
def a14(spark, folder):
    return rep.coverage(b.bars(spark, folder), b.sessions(spark, folder))


FRESHNESS = _DUE + f""", fresh AS (SELECT w.instrument_key, price_basis, latest_seen_utc, latest_complete_utc, data_version, data_status, greatest(0, CAST(epoch(TIMESTAMP '{NOW}') - epoch(latest_complete_utc) AS BIGINT)) AS freshness_seconds, latest_expected_utc, next_expected_utc,
  CASE WHEN data_status <> 'ACTIVE' THEN 'FAIL' WHEN verification_status <> 'VERIFIED' OR latest_complete_utc IS NULL OR latest_expected_utc IS NULL THEN 'NOT_EVALUATED' WHEN latest_complete_utc >= latest_expected_utc THEN 'PASS' ELSE 'STALE' END AS freshness_status
  FROM watermarks w JOIN instruments USING (instrument_key) LEFT JOIN due USING (instrument_key))"""


@query("a15_freshness", sql(FRESHNESS + " SELECT * FROM fresh"))
def a15(spark, folder):
    return rep.freshness(b.watermarks(spark, folder), b.instruments(spark, folder), b.sessions(spark, folder), b.now())


@query("a16_freshness_grace", sql(f"""WITH later AS (SELECT w.instrument_key, price_basis, latest_complete_utc, data_status, (SELECT min(slot_utc) FROM slots s WHERE s.instrument_key = w.instrument_key AND slot_utc > latest_complete_utc) AS next_slot_utc FROM watermarks w)
SELECT instrument_key, price_basis, latest_complete_utc, next_slot_utc, CASE WHEN data_status <> 'ACTIVE' THEN 'FAIL' WHEN next_slot_utc IS NULL THEN 'NOT_EVALUATED' WHEN TIMESTAMP '{NOW}' <= next_slot_utc + INTERVAL 2 HOUR THEN 'PASS' ELSE 'STALE' END AS freshness_status FROM later"""))
def a16(spark, folder):
    return rep.freshness_grace(b.watermarks(spark, folder), b.instruments(spark, folder), b.sessions(spark, folder), b.now())


def _runs(spark, folder):
    t = b.table(spark, folder, "events").groupBy(F.col("event_type").alias("instrument_key"), F.dayofmonth("ts").cast("long").alias("run_day")).agg(F.count("*").alias("n"), F.min("ts").alias("started_utc"), F.max("ts").alias("finished_utc"))
    return t.select("instrument_key", "run_day", F.when(F.col("n") % 11 == 0, "FAIL").when(F.col("n") % 11 == 5, "RUNNING").otherwise("PASS").alias("run_status"), "started_utc", "finished_utc")


RUNS = "runs AS (SELECT event_type AS instrument_key, CAST(day(ts) AS BIGINT) AS run_day, CASE WHEN count(*) % 11 = 0 THEN 'FAIL' WHEN count(*) % 11 = 5 THEN 'RUNNING' ELSE 'PASS' END AS run_status, min(ts) AS started_utc, max(ts) AS finished_utc FROM events GROUP BY 1, 2)"


@query("a17_ingestion_status", sql(f"WITH {RUNS} SELECT r.*, m AS latest_complete_utc, CAST(epoch(TIMESTAMP '{NOW}') - epoch(m) AS BIGINT) AS watermark_age_seconds FROM runs r, (SELECT max(latest_complete_utc) AS m FROM watermarks)"))
def a17(spark, folder):
    return rep.ingestion_status(_runs(spark, folder), b.watermarks(spark, folder), b.now())


@query("a18_storage_usage", "SELECT l_returnflag AS relation, CAST(sum(l_partkey) AS BIGINT) * 1000 AS total_bytes, CASE WHEN CAST(sum(l_partkey) AS BIGINT) * 1000 >= 8589934592 THEN 'REVIEW' ELSE 'OK' END AS review FROM lineitem GROUP BY l_returnflag")
def a18(spark, folder):
    return rep.storage_usage(b.table(spark, folder, "lineitem").select(F.col("l_returnflag").alias("relation"), (F.col("l_partkey") * 1000).cast("long").alias("bytes")))


def _series(spark, folder):
    inv = a10(spark, folder).withColumn("instrument_key", F.element_at(F.split("series_key", "/"), -1))
    return inv.select("instrument_key", F.concat_ws("|", "layer", "series_key").alias("series_id"), "layer", F.when(F.col("layer") == "raw", "source").otherwise("analysis").alias("role"), F.when(F.col("layer") == "raw", 2).otherwise(1).alias("role_order"), "row_count", F.col("freshness_status").alias("status"), F.col("latest_utc").alias("min_time_utc"), F.col("latest_utc").alias("max_time_utc"))


_SERIES = _INVENTORY + """, series AS (SELECT split_part(series_key, '/', CASE WHEN layer = 'raw' THEN 2 ELSE 1 END) AS instrument_key, layer || '|' || series_key AS series_id, layer, CASE WHEN layer = 'raw' THEN 'source' ELSE 'analysis' END AS role, CASE WHEN layer = 'raw' THEN 2 ELSE 1 END AS role_order, row_count, freshness_status AS status, latest_utc FROM inv)"""


@query("a19_overview", sql(_SERIES + " SELECT role, count(*) AS series, CAST(sum(row_count) AS BIGINT) AS rows, count(*) FILTER (status IN ('FAIL', 'STALE', 'WARN')) AS attention, count(DISTINCT instrument_key) AS instruments FROM series GROUP BY role"), shared=True)
def a19(spark, folder):
    return rep.overview(_series(spark, folder))


@query("a20_worst_status", sql(_SERIES + """ SELECT instrument_key, CASE max(CASE status WHEN 'FAIL' THEN 5 WHEN 'STALE' THEN 4 WHEN 'WARN' THEN 3 WHEN 'NOT_EVALUATED' THEN 2 WHEN 'PASS' THEN 1 END) WHEN 5 THEN 'FAIL' WHEN 4 THEN 'STALE' WHEN 3 THEN 'WARN' WHEN 2 THEN 'NOT_EVALUATED' WHEN 1 THEN 'PASS' END AS worst_status FROM series GROUP BY instrument_key"""), shared=True)
def a20(spark, folder):
    return rep.worst_status(_series(spark, folder), ["instrument_key"], "status")


@query("a21_series_summary", sql(_SERIES + """ SELECT instrument_key, string_agg(DISTINCT role, ',' ORDER BY role) AS roles, string_agg(DISTINCT layer, ',' ORDER BY layer) AS layers, count(*) AS series, min(latest_utc) AS earliest_utc, max(latest_utc) AS latest_utc, arg_min(series_id, (role_order, series_id)) AS default_series FROM series GROUP BY instrument_key"""), shared=True)
def a21(spark, folder):
    return rep.series_summary(_series(spark, folder))


@query("a23_histograms", sql("SELECT horizon_minutes, quality_status, count(*) AS rows, count(*) FILTER (is_complete) AS complete_rows FROM bars GROUP BY ALL"))
def a23(spark, folder):
    return rep.histograms(b.bars(spark, folder))


@query("a24_duplicate_keys", "SELECT count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_rows FROM lineitem")
def a24(spark, folder):
    return rep.duplicate_keys(b.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("a25_lineage_mismatches", sql(_FILES + " SELECT source_file_id, row_count, raw_rows, curated_rows FROM lin WHERE raw_rows <> row_count"))
def a25(spark, folder):
    return rep.lineage_mismatches(_lineage(spark, folder))


@query("a26_derived_rollup", sql("SELECT count(*) AS rows, count(*) FILTER (quality_status = 'FAIL') AS fail_rows, count(*) FILTER (is_complete AND quality_status = 'PASS') AS eligible_rows, '4h' AS layer FROM bars_4h UNION ALL SELECT count(*), count(*) FILTER (quality_status = 'FAIL'), count(*) FILTER (is_complete AND quality_status = 'PASS'), '1d' FROM bars_1d"))
def a26(spark, folder):
    return rep.derived_rollup(a01(spark, folder), a02(spark, folder))


@query("a27_status_rollup", sql(COVERAGE + " SELECT coverage_status, count(*) AS instruments, CAST(sum(missing_rows) AS BIGINT) AS missing_rows, CAST(sum(out_of_session_rows) AS BIGINT) AS out_of_session_rows FROM cov GROUP BY coverage_status"))
def a27(spark, folder):
    return rep.status_rollup(a14(spark, folder))


@query("a28_cutoff_leaks", sql("SELECT 'bars' AS relation, count(*) FILTER (time_utc > TIMESTAMP '2024-01-20') AS rows_after FROM bars UNION ALL SELECT 'bars_4h', count(*) FILTER (time_utc > TIMESTAMP '2024-01-20') FROM bars_4h"))
def a28(spark, folder):
    return rep.cutoff_leaks({"bars": (b.bars(spark, folder), "time_utc"), "bars_4h": (a01(spark, folder), "time_utc")}, F.lit("2024-01-20").cast("timestamp_ntz"))


@query("a29_count_baseline", "SELECT 'nation' AS relation, CAST(25 AS BIGINT) AS expected_rows, count(*) AS actual_rows, count(*) = 25 AS matches FROM nation UNION ALL SELECT 'supplier', 100, count(*), count(*) = 100 FROM supplier")
def a29(spark, folder):
    return rep.count_baseline({"nation": b.table(spark, folder, "nation"), "supplier": b.table(spark, folder, "supplier")}, {"nation": 25, "supplier": 100})

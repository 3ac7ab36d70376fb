"""Queries on schedules, calendar assignment, reviews and the remaining audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions.times import ntz
from barloom.operators import calendar as cal, events as ev, impute as im, merge as m, revisions as rv, schedule as sc, total_return as tr
from barloom.plans import bindings as b
from barloom.plans.bindings import sql, tree_hash
from barloom.plans.change_queries import _PAGES, _PAIRS, _revision_sides
from barloom.plans.registry import query
from barloom.plans.source_queries import _json_pages
from barloom.plans.state_queries import _QE, _STATES, _TR, _own_sessions, _status, _tr
from barloom.sources.files import explode_chart_pages

_LANES = """lanes AS (SELECT CASE event_type WHEN 'click' THEN 'fx' WHEN 'view' THEN 'fx_candidate' WHEN 'error' THEN 'daily' ELSE 'equity' END AS kind, 'lane-' || event_type AS lane, event_type AS keys FROM (SELECT DISTINCT event_type FROM events)),
fxh AS (SELECT session_date, unnest(generate_series(open_utc + INTERVAL 1 HOUR, close_utc - INTERVAL 2 HOUR, INTERVAL 1 HOUR)) AS bar FROM open_sessions WHERE calendar_id = 'fx'),
eqh AS (SELECT session_date, unnest(generate_series(open_utc, close_utc - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS bar FROM open_sessions WHERE calendar_id = 'us_equity'),
parts AS (SELECT 'fx' AS kind, session_date, bar, bar + INTERVAL 63 MINUTE AS due_utc, bar + INTERVAL 70 MINUTE AS deadline_utc FROM fxh WHERE bar + INTERVAL 63 MINUTE BETWEEN TIMESTAMP '2024-01-24 12:00:00' - INTERVAL 7 HOUR AND TIMESTAMP '2024-01-24 12:00:00' + INTERVAL 4 HOUR
  UNION ALL SELECT 'fx_candidate', session_date, bar, bar + INTERVAL 66 MINUTE, bar + INTERVAL 75 MINUTE FROM fxh WHERE bar + INTERVAL 63 MINUTE BETWEEN TIMESTAMP '2024-01-24 12:00:00' - INTERVAL 7 HOUR AND TIMESTAMP '2024-01-24 12:00:00' + INTERVAL 4 HOUR
  UNION ALL SELECT 'equity', session_date, bar, bar + INTERVAL 3615 SECOND, bar + INTERVAL 63 MINUTE FROM eqh
  UNION ALL SELECT 'daily', session_date, open_utc + INTERVAL 6 HOUR, close_utc + INTERVAL 45 MINUTE, close_utc + INTERVAL 90 MINUTE FROM open_sessions WHERE calendar_id = 'us_equity'),
sched AS (SELECT lane || '-' || CASE WHEN kind LIKE 'fx%' THEN strftime(due_utc, '%Y%m%dT%H%M%SZ') WHEN kind = 'daily' THEN CAST(session_date AS VARCHAR) ELSE CAST(session_date AS VARCHAR) || '-' || strftime(bar, '%H%MZ') END AS slot_id, kind, lane, keys, due_utc, deadline_utc, bar AS expected_utc, CASE WHEN kind = 'daily' THEN session_date END AS expected_session FROM parts JOIN lanes USING (kind))"""


def _at_noon():
    return F.lit("2024-01-24 12:00:00").cast("timestamp_ntz")


def _slots(spark, folder):
    k = F.col("instrument_key")
    lanes = b.instruments(spark, folder).select(F.when(k == "click", "fx").when(k == "view", "fx_candidate").when(k == "error", "daily").otherwise("equity").alias("kind"), F.concat(F.lit("lane-"), k).alias("lane"), k.alias("keys"))
    return sc.schedule_slots(b.sessions(spark, folder), lanes, _at_noon())


@query("c07_apply_calendars", sql("SELECT calendar_id, count(*) AS intervals, min(session_date) AS first_date FROM (SELECT calendar_id, session_date FROM sessions WHERE calendar_id = 'fx' UNION ALL SELECT calendar_id, session_date FROM sessions WHERE calendar_id = 'us_equity' AND session_date >= DATE '2024-01-10') GROUP BY 1"))
def c07(spark, folder):
    stored = b.sessions(spark, folder)
    new = stored.where("calendar_id = 'us_equity' and session_date >= date '2024-01-10'")
    return sc.apply_calendars(stored, new, b.instruments(spark, folder))[0].groupBy("calendar_id").agg(F.count("*").alias("intervals"), F.min("session_date").alias("first_date"))


@query("c15_schedule_slots", sql(f"WITH {_LANES} SELECT * FROM sched"))
def c15(spark, folder):
    return _slots(spark, folder)


@query("c16_latest_due", sql(f"WITH {_LANES} SELECT slot_id, kind, keys, due_utc FROM sched WHERE due_utc <= TIMESTAMP '2024-01-24 12:00:00' AND due_utc >= TIMESTAMP '2024-01-24 06:00:00' AND NOT (kind = 'fx' AND hour(due_utc) = 11) QUALIFY row_number() OVER (PARTITION BY kind, keys ORDER BY due_utc DESC, slot_id) = 1"))
def c16(spark, folder):
    slots = _slots(spark, folder)
    return sc.latest_due(slots, slots.where("kind = 'fx' and hour(due_utc) = 11"), _at_noon()).select("slot_id", "kind", "keys", "due_utc")


@query("c19_slot_sla", sql(f"WITH {_LANES}, r AS (SELECT slot_id, deadline_utc, due_utc + INTERVAL (minute(due_utc) % 2 * 20) MINUTE AS started_utc, CASE WHEN day(due_utc) % 3 = 0 THEN 'FAIL' ELSE 'PASS' END AS run_status FROM sched) SELECT slot_id, started_utc, run_status, CASE WHEN started_utc > deadline_utc THEN 'MISS' WHEN run_status = 'PASS' THEN 'PASS' ELSE 'BLOCKED' END AS sla_status FROM r"))
def c19(spark, folder):
    slots = _slots(spark, folder)
    due = F.col("due_utc")
    runs = slots.select("slot_id", ntz(F.timestamp_add("MINUTE", (F.minute(due) % 2 * 20).cast("long"), due)).alias("started_utc"), F.when(F.dayofmonth(due) % 3 == 0, "FAIL").otherwise("PASS").alias("run_status"))
    return sc.slot_sla(slots, runs)


_STATE = """CASE WHEN w.instrument_key IS NULL THEN '{"instrument_key":"' || i.instrument_key || '","missing":true}'
  ELSE '{"data_status":"' || data_status || '","data_version":' || data_version || ',"instrument_key":"' || i.instrument_key || '","latest_complete_utc":' || coalesce('"' || strftime(latest_complete_utc, '%Y-%m-%dT%H:%M:%S.000') || '"', 'null') || ',"run_id":' || run_id || '}' END"""


@query("c21_watermark_digest", sql(f"""SELECT count(*) AS keys, count(*) FILTER (w.instrument_key IS NULL) AS missing, sha256(string_agg({_STATE}, ',' ORDER BY i.instrument_key)) AS digest
  FROM instruments i LEFT JOIN (SELECT * FROM watermarks WHERE instrument_key <> 'view') w ON w.instrument_key = i.instrument_key"""))
def c21(spark, folder):
    keys = b.instruments(spark, folder).select("instrument_key")
    return sc.watermark_digest(keys, b.watermarks(spark, folder).where("instrument_key <> 'view'"))


@query("c24_receipt_calendar", f"""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) + CAST((2026 - year(o_orderdate)) * 365 AS INTEGER) AS session_date FROM orders) SELECT session_date,
  CAST(session_date AS TIMESTAMP) + CASE WHEN session_date BETWEEN DATE '2026-03-08' AND DATE '2026-10-31' THEN INTERVAL 810 MINUTE ELSE INTERVAL 870 MINUTE END AS open_utc,
  CAST(session_date AS TIMESTAMP) + CASE WHEN session_date BETWEEN DATE '2026-03-08' AND DATE '2026-10-31' THEN INTERVAL 20 HOUR WHEN session_date IN (DATE '2026-11-27', DATE '2026-12-24') THEN INTERVAL 18 HOUR ELSE INTERVAL 21 HOUR END AS close_utc,
  CASE WHEN session_date IN (DATE '2026-11-27', DATE '2026-12-24') THEN 'SHORT_SESSION' ELSE 'OPEN' END AS session_state, 'ARCX,XNAS' AS venues
FROM d WHERE year(session_date) = 2026 AND isodow(session_date) < 6 AND session_date NOT IN ({', '.join(f"DATE '{x}'" for x in sc.CLOSED_2026)})""")
def c24(spark, folder):
    o = F.col("o_orderdate").cast("date")
    days = b.table(spark, folder, "orders").select(F.date_add(o, (2026 - F.year(o)) * 365).alias("session_date")).where(F.year("session_date") == 2026)
    return sc.receipt_calendar(days)


_CHART = """chart AS (SELECT *, time_utc < max(time_utc) OVER (PARTITION BY instrument_key) AS is_complete FROM (SELECT instrument_key, time_utc, close, 1 AS data_version, CAST(NULL AS BIGINT) AS run_id
  FROM paged WHERE page_number <> 1 QUALIFY row_number() OVER (PARTITION BY instrument_key, time_utc ORDER BY page_number, position) = 1))"""


@query("i14_review_candidates", sql(f"WITH {_PAGES}, {_CHART}, {_STATES.replace('FROM bars WHERE', 'FROM chart WHERE')} SELECT instrument_key, plan_status, count(*) AS sessions FROM plan GROUP BY 1, 2"), shared=True)
def i14(spark, folder):
    """The imputation plan of retained chart pages: explode, keep first seen, mark the newest, profile, plan."""
    samples = explode_chart_pages(_json_pages(spark, folder)).where("error_code is null")
    samples = samples.withColumn("close", F.coalesce("close", ((F.col("close_bid") + F.col("close_ask")) / 2).cast("decimal(24,12)")))
    merged = m.merge_pages(samples)
    newest = merged.groupBy("instrument_key").agg(F.max("time_utc").alias("newest"))
    bars = merged.join(newest, "instrument_key").withColumn("is_complete", F.col("time_utc") < F.col("newest"))
    states = im.slot_states(cal.complete_slots(b.instruments(spark, folder), b.sessions(spark, folder)), bars)
    plan = im.imputation_plan(states, im.anchored_fill(states, _own_sessions(spark, folder), bars), b.instruments(spark, folder))
    return plan.groupBy("instrument_key", "plan_status").agg(F.count("*").alias("sessions"))


@query("q06_supersede_legacy", sql(f"""WITH {_QE}, o AS (SELECT * FROM status WHERE status IN ('OPEN', 'ACKNOWLEDGED') AND applicability IN ('CURRENT', 'UNKNOWN') AND rule_id = 'atomic_run_gate')
SELECT event_id, 'HISTORICAL' AS applicability, min(d.run_id) AS superseded_by FROM o JOIN (SELECT DISTINCT CAST(day(ts) AS BIGINT) AS run_id FROM events) d ON o.run_id < d.run_id
  WHERE d.run_id % 5 = 2 OR (d.run_id % 5 = 0 AND d.run_id % 2 = 0 AND instrument_key = 'view') GROUP BY event_id"""))
def q06(spark, folder):
    days = b.table(spark, folder, "events").select(F.dayofmonth("ts").cast("long").alias("run_id")).distinct()
    normal = F.col("run_id") % 5 == 2
    runs = days.where("run_id % 5 in (0, 2)").select("run_id", F.when(normal, "normal").otherwise("refetch").alias("trigger_kind"), F.when(normal, 13).otherwise(1).alias("successful_series"), F.lit(13).alias("all_series"))
    raw = b.table(spark, folder, "events").select(F.dayofmonth("ts").cast("long").alias("run_id"), F.col("event_type").alias("instrument_key")).where("run_id % 10 <> 0 or instrument_key = 'view'")
    return ev.supersede_legacy(_status(spark, folder), runs, raw)


_WARN = """old AS (SELECT event_id, event_type || user_id % 30 AS instrument_key, user_id % 2 AS new_version, CASE WHEN event_id % 4 = 0 THEN 'REVIEW_PENDING' ELSE 'APPLIED' END AS event_status FROM events WHERE event_id % 7 = 0),
det AS (SELECT event_type || user_id % 30 AS instrument_key, user_id % 2 AS new_version, event_id FROM events WHERE event_id % 7 <> 0),
op AS (SELECT instrument_key, new_version, max(event_id) AS event_id FROM old WHERE event_status = 'REVIEW_PENDING' GROUP BY 1, 2),
neu AS (SELECT (SELECT max(event_id) FROM old) + row_number() OVER (ORDER BY instrument_key, new_version) AS event_id, instrument_key, new_version FROM (SELECT DISTINCT instrument_key, new_version FROM det) d ANTI JOIN op USING (instrument_key, new_version)),
own AS (SELECT event_id, instrument_key, new_version FROM op UNION ALL SELECT event_id, instrument_key, new_version FROM neu)"""


@query("r11_record_warnings", f"WITH {_WARN} SELECT own.event_id, count(*) + coalesce(any_value(CASE WHEN own.event_id <= (SELECT max(event_id) FROM old) THEN 1 END), 0) AS last_step FROM det JOIN own USING (instrument_key, new_version) GROUP BY 1 UNION ALL SELECT event_id, 1 FROM old WHERE event_id NOT IN (SELECT own.event_id FROM det JOIN own USING (instrument_key, new_version))")
def r11(spark, folder):
    e = b.table(spark, folder, "events").select("event_id", F.concat("event_type", (F.col("user_id") % 30).cast("string")).alias("instrument_key"), (F.col("user_id") % 2).alias("new_version"), ntz(F.col("ts")).alias("detected_utc"))
    old = e.where("event_id % 7 = 0").select("event_id", "instrument_key", "new_version", F.when(F.col("event_id") % 4 == 0, "REVIEW_PENDING").otherwise("APPLIED").alias("event_status"))
    steps = old.select("event_id", F.lit(1).cast("long").alias("step_number"), F.lit("DETECTED").alias("step_result"))
    detections = e.where("event_id % 7 <> 0").select("instrument_key", "new_version", "detected_utc", F.lit("AGAIN").alias("step_result"))
    return rv.record_warnings(old, steps, detections)[1].groupBy("event_id").agg(F.max("step_number").alias("last_step"))


@query("r12_review", "SELECT CASE WHEN event_id % 3 = 0 AND event_id % 5 <> 0 AND event_id % 2 = 0 THEN 'REVIEWED_KEEP_CURRENT' WHEN event_id % 3 = 0 AND event_id % 5 <> 0 THEN 'APPLY_APPROVED' ELSE 'PENDING_REVIEW' END AS review_status, count(*) AS events FROM events GROUP BY 1")
def r12(spark, folder):
    i = F.col("event_id")
    e = b.table(spark, folder, "events").select("event_id", F.when(i % 3 == 0, "REVIEW_PENDING").otherwise("APPLIED").alias("event_status"), F.lit("PENDING_REVIEW").alias("review_status"))
    decisions = e.select("event_id", F.when(i % 2 == 0, "KEEP_CURRENT").otherwise("APPROVE_APPLY").alias("decision"), F.when(i % 5 == 0, " ").otherwise("someone").alias("reviewer"), F.lit("checked").alias("note"))
    return rv.review(e, decisions)[0].groupBy("review_status").agg(F.count("*").alias("events"))


@query("r13_audit_recorded", sql(f"WITH {_PAIRS} SELECT DISTINCT instrument_key, instrument_key <> 'view' AS counts_match FROM pairs"))
def r13(spark, folder):
    computed = rv.compare_sample(*_revision_sides(spark, folder))
    recorded = computed.withColumn("new_rows", F.col("new_rows") + F.when(F.col("instrument_key") == "view", 1).otherwise(0))
    return rv.audit_recorded(recorded, computed)


_TR_JSON = """'{"adjusted_close":"' || adjusted_close || '","date":"' || date || '","quality_status":"' || quality_status || '"}'"""
_T10 = f"""WITH {_TR}, w AS (SELECT ticker, date, quality_status, adjusted_close FROM trr WHERE date >= (SELECT min(date) FROM trr t WHERE t.ticker = trr.ticker) + 30),
{tree_hash("w", "ticker", "date", _TR_JSON, 1024, 256, 2)}
SELECT ticker, count(*) AS row_count, min(date) AS first_date, max(date) AS last_date, count(*) FILTER (quality_status = 'WARN') AS warn_rows,
  CASE WHEN ticker = '2-HIGH' THEN 'COVERAGE_FAILED' WHEN min(date) <> (SELECT min(date) FROM trr t WHERE t.ticker = w.ticker) + 30 THEN 'COVERAGE_FAILED' WHEN ticker = '5-LOW' THEN 'QUALITY_FAILED' ELSE 'PASS' END AS history_status,
  any_value(content_sha256) AS content_sha256 FROM w JOIN tree USING (ticker) GROUP BY 1"""


@query("t10_full_history", _T10)
def t10(spark, folder):
    rows = _tr(spark, folder)
    start = rows.groupBy("ticker").agg(F.date_add(F.min("date"), 30).alias("window_start"), F.max("date").alias("window_end"))
    inside = rows.join(start, "ticker").where("date >= window_start").groupBy("ticker", "window_start", "window_end").agg(F.count("*").alias("n"), F.count_if(F.col("quality_status") == "WARN").alias("w"))
    contract = inside.select("ticker", "window_start", "window_end", (F.col("n") + F.when(F.col("ticker") == "2-HIGH", 1).otherwise(0)).alias("expected_rows"), (F.col("w") + F.when(F.col("ticker") == "5-LOW", 1).otherwise(0)).alias("expected_warn"))
    return tr.full_history(rows, contract)

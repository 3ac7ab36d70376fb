"""Queries on validation, merging, gaps and revisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import calendar as cal, gaps as g, merge as m, normalize as nz, revisions as rv
from barloom.plans import bindings as b
from barloom.plans.bar_queries import RUNS, _runs
from barloom.plans.bindings import NOW, sql
from barloom.plans.registry import query

# --- validation ---------------------------------------------------------------------------------

_TEXTS = "SELECT event_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'n/a' ELSE CAST(user_id AS VARCHAR) || '.5' END AS price_text, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE event_id % 3 WHEN 0 THEN 'Z' WHEN 1 THEN '+00:00' ELSE '' END AS time_text FROM events"


def _texts(spark, folder):
    e, i = b.table(spark, folder, "events"), F.col("event_id")
    price = F.when(i % 5 == 0, F.lit(None)).when(i % 5 == 1, "n/a").otherwise(F.concat(F.col("user_id").cast("string"), F.lit(".5")))
    time = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(i % 3 == 0, "Z").when(i % 3 == 1, "+00:00").otherwise(""))
    return e.select("event_id", price.alias("price_text"), time.alias("time_text"), "ts")


@query("p01_decimal_value", f"SELECT event_id, TRY_CAST(price_text AS DECIMAL(24,12)) AS price, CASE WHEN price_text IS NULL OR TRY_CAST(price_text AS DECIMAL(24,12)) IS NULL THEN 'INVALID_CLOSE' END AS error_code FROM ({_TEXTS})")
def p01(spark, folder):
    value, code = nz.decimal_value(F.col("price_text"), "close")
    return _texts(spark, folder).select("event_id", value.alias("price"), code.alias("error_code"))


@query("p02_parse_utc", "SELECT event_id, CASE WHEN event_id % 3 < 2 THEN date_trunc('second', ts) END AS time_utc, CASE WHEN event_id % 3 = 2 THEN 'TIME_NOT_UTC' END AS error_code FROM events")
def p02(spark, folder):
    value, code = nz.parse_utc(F.col("time_text"))
    return _texts(spark, folder).select("event_id", value.alias("time_utc"), code.alias("error_code"))


@query("p03_validate_ohlc", sql("""SELECT instrument_key, time_utc, CASE WHEN h IS NULL THEN 'INVALID_HIGH' WHEN least(open, h, l, close) <= 0 THEN 'NONPOSITIVE_OHLC' WHEN h < greatest(open, l, close) OR l > least(open, h, close) THEN 'OHLC_VIOLATION' END AS error_code
  FROM (SELECT *, CASE WHEN last_event % 10 <> 2 THEN high END - CASE WHEN last_event % 10 = 0 THEN 5 ELSE 0 END AS h, low - CASE WHEN last_event % 10 = 1 THEN 1 ELSE 0 END AS l FROM bars)"""))
def p03(spark, folder):
    e = F.col("last_event") % 10
    rows = b.bars(spark, folder).withColumn("h", F.when(e != 2, F.col("high")) - F.when(e == 0, 5).otherwise(0)).withColumn("l", F.col("low") - F.when(e == 1, 1).otherwise(0))
    return rows.select("instrument_key", "time_utc", nz.validate_ohlc(F.col("open"), F.col("h"), F.col("l"), F.col("close")).alias("error_code"))


def _quotes(spark, folder):
    rows = b.bars(spark, folder).where("asset_type = 'FxSpot'")
    cent = F.lit("0.01").cast("decimal(4,2)")
    sides = []
    for k, f in enumerate(nz.FIELDS):
        sides.append((F.col(f) - cent * ((F.col("last_event") + k) % 3)).cast(nz.PRICE).alias(f"bid_{f}"))
        sides.append((F.col(f) + cent * ((F.col("last_event") + 2 * k) % 7 - 1)).cast(nz.PRICE).alias(f"ask_{f}"))
    return rows.select("instrument_key", "time_utc", "is_complete", "data_version", *sides)


_Q = "quotes AS (SELECT instrument_key, time_utc, is_complete, " + ", ".join(
    f"CAST({f} - 0.01 * ((last_event + {k}) % 3) AS DECIMAL(24,12)) AS bid_{f}, CAST({f} + 0.01 * ((last_event + {2 * k}) % 7 - 1) AS DECIMAL(24,12)) AS ask_{f}" for k, f in enumerate(nz.FIELDS)) + " FROM bars WHERE asset_type = 'FxSpot')"
_MID = _Q + ", mids AS (SELECT *, " + ", ".join(f"CAST((bid_{f} + ask_{f}) / 2 AS DECIMAL(24,12)) AS {f}" for f in nz.FIELDS) + " FROM quotes)"


def _ohlc(p):
    o, h, l, c = (f"{p}{f}" for f in nz.FIELDS)  # noqa: E741
    return f"CASE WHEN least({o}, {h}, {l}, {c}) <= 0 THEN 'NONPOSITIVE_OHLC' WHEN {h} < greatest({o}, {l}, {c}) OR {l} > least({o}, {h}, {c}) THEN 'OHLC_VIOLATION' END"


@query("p04_fx_mid", sql(f"WITH {_MID} SELECT instrument_key, time_utc, open, high, low, close, coalesce({_ohlc('bid_')}, {_ohlc('ask_')}, {_ohlc('')}) AS error_code FROM mids"))
def p04(spark, folder):
    return nz.fx_mid(_quotes(spark, folder)).select("instrument_key", "time_utc", *nz.FIELDS, "error_code")


_CROSSED = " || ".join(f"CASE WHEN bid_{f} > ask_{f} THEN '{f},' ELSE '' END" for f in nz.FIELDS)


@query("p05_crossed_quotes", sql(f"WITH {_Q} SELECT instrument_key, time_utc, rtrim({_CROSSED}, ',') AS fields FROM quotes WHERE rtrim({_CROSSED}, ',') <> ''"))
def p05(spark, folder):
    rows = nz.crossed_quotes(_quotes(spark, folder)).where(F.size("violations") > 0)
    return rows.select("instrument_key", "time_utc", F.array_join(F.transform("violations", lambda v: v["field"]), ",").alias("fields"))


@query("p06_split_quarantine", sql(f"WITH {_Q} SELECT instrument_key, CASE WHEN bid_open > ask_open OR bid_close > ask_close THEN 'fatal' WHEN bid_high > ask_high OR bid_low > ask_low THEN 'rejected' ELSE 'accepted' END AS part, count(*) AS n FROM quotes GROUP BY ALL"))
def p06(spark, folder):
    parts = [rows.select("instrument_key", F.lit(name).alias("part")) for name, rows in zip(("accepted", "rejected", "fatal"), nz.split_quarantine(_quotes(spark, folder)))]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("instrument_key", "part").agg(F.count("*").alias("n"))


@query("p07_mark_incomplete", sql("SELECT instrument_key, time_utc, is_complete FROM bars"))
def p07(spark, folder):
    return nz.mark_incomplete(b.hourly(spark, folder)).select("instrument_key", "time_utc", "is_complete")


@query("p08_finalize_terminal", sql("""SELECT b.instrument_key, b.time_utc, b.is_complete OR coalesce(b.time_utc = s.open_utc + INTERVAL (CAST(floor((epoch(s.close_utc) - epoch(s.open_utc) - 1) / 3600) AS BIGINT)) HOUR AND asset_type = 'Etf' AND verification_status = 'VERIFIED' AND TIMESTAMP '2024-01-20 00:00:00' >= s.close_utc + INTERVAL 5 MINUTE, false) AS is_complete
  FROM (SELECT * EXCLUDE (is_complete), time_utc <> max(time_utc) OVER (PARTITION BY instrument_key, session_date) AS is_complete FROM in_session) b LEFT JOIN open_sessions s USING (calendar_id, session_date)"""))
def p08(spark, folder):
    from pyspark.sql import Window
    rows = cal.align_range(b.bars(spark, folder), b.sessions(spark, folder)).drop("open_utc", "close_utc", "status")
    newest = F.max("time_utc").over(Window.partitionBy("instrument_key", "session_date"))
    rows = rows.withColumn("is_complete", F.col("time_utc") != newest)
    return nz.finalize_terminal(rows, b.sessions(spark, folder), F.lit("2024-01-20").cast("timestamp_ntz"), F.lit(5)).select("instrument_key", "time_utc", "is_complete")


@query("p09_admit", sql(f"""SELECT instrument_key, CASE WHEN count(*) < 2 OR count(*) FILTER (is_complete) < 1 THEN 'INSUFFICIENT_INCREMENTAL_CHART_DATA' WHEN count(DISTINCT dv) > 1 THEN 'MULTIPLE_DATA_VERSIONS_IN_RUN' WHEN max(time_utc) FILTER (is_complete) > TIMESTAMP '2024-01-30 22:30:00' THEN 'FUTURE_COMPLETED_BAR' END AS error_code
  FROM (SELECT *, CASE WHEN instrument_key = 'click' AND volume = 3 THEN 2 ELSE 1 END AS dv FROM bars WHERE instrument_key <> 'signup' OR NOT is_complete) GROUP BY instrument_key"""))
def p09(spark, folder):
    rows = b.bars(spark, folder).where("instrument_key <> 'signup' or not is_complete").withColumn("data_version", F.when((F.col("instrument_key") == "click") & (F.col("volume") == 3), 2).otherwise(1))
    return nz.admit(rows, F.lit("2024-01-30 22:30:00").cast("timestamp_ntz"))


PAGE = 50


def _pages(spark, folder):
    """The bars in pages of 50 whose last row comes again as the first of the next page."""
    from pyspark.sql import Window
    w = Window.partitionBy("instrument_key").orderBy("time_utc")
    rows = b.bars(spark, folder).withColumn("n", F.row_number().over(w) - 1)
    page = F.floor(F.col("n") / PAGE)
    repeat = F.when((F.col("n") % PAGE == 0) & (F.col("n") > 0), F.array(page, page - 1)).otherwise(F.array(page))
    rows = rows.withColumn("page_number", F.explode(repeat))
    shift = F.when((F.col("page_number") < page) & (F.col("n") % 100 == 0), F.lit("0.5").cast(nz.PRICE)).otherwise(F.lit("0").cast(nz.PRICE))
    return rows.withColumn("position", F.col("n")).withColumn("close", (F.col("close") + shift).cast(nz.PRICE))


_PAGES = f"""pages0 AS (SELECT *, row_number() OVER (PARTITION BY instrument_key ORDER BY time_utc) - 1 AS position FROM bars),
paged AS (SELECT * EXCLUDE (close), close, CAST(floor(position / {PAGE}) AS BIGINT) AS page_number FROM pages0
  UNION ALL SELECT * EXCLUDE (close), CAST(close + CASE WHEN position % 100 = 0 THEN 0.5 ELSE 0 END AS DECIMAL(24,12)), CAST(floor(position / {PAGE}) AS BIGINT) - 1 FROM pages0 WHERE position % {PAGE} = 0 AND position > 0)"""


@query("p10_page_monotonic", sql(f"WITH {_PAGES} SELECT DISTINCT instrument_key, page_number, true AS monotonic FROM paged"))
def p10(spark, folder):
    return nz.page_monotonic(_pages(spark, folder))


@query("p11_page_chain", sql(f"""WITH {_PAGES}, p AS (SELECT instrument_key, page_number, min(time_utc) AS a, max(time_utc) AS z, count(*) AS n FROM paged GROUP BY ALL)
SELECT instrument_key, page_number, coalesce(a = lag(z) OVER w, true) AS linked, coalesce(z > lag(z) OVER w, true) AS advances, n < {PAGE} AS ends FROM p WINDOW w AS (PARTITION BY instrument_key ORDER BY page_number)"""))
def p11(spark, folder):
    pages = _pages(spark, folder).groupBy("instrument_key", "page_number").agg(F.min("time_utc").alias("first_utc"), F.max("time_utc").alias("last_utc"), F.count("*").alias("rows"))
    return nz.page_chain(pages, PAGE)


@query("p12_identity_drift", """SELECT 'S' || s_suppkey AS instrument_key, rtrim(CASE WHEN s_suppkey % 5 = 0 THEN 'uic,' ELSE '' END || CASE WHEN s_suppkey % 7 = 0 THEN 'symbol,' ELSE '' END || CASE WHEN s_suppkey % 11 = 0 THEN 'currency,' ELSE '' END, ',') AS mismatches FROM supplier WHERE s_suppkey % 5 = 0 OR s_suppkey % 7 = 0 OR s_suppkey % 11 = 0""")
def p12(spark, folder):
    s, k = b.table(spark, folder, "supplier"), F.col("s_suppkey")
    key = F.concat(F.lit("S"), k.cast("string"))
    registry = s.select(key.alias("instrument_key"), k.alias("uic"), F.lit("Etf").alias("asset_type"), key.alias("symbol"), F.lit("usd").alias("currency"))
    observed = s.select(key.alias("instrument_key"), F.when(k % 5 == 0, k + 1).when(k % 2 == 0, k).alias("uic"), F.lit("Etf").alias("asset_type"), F.when(k % 7 == 0, "other").otherwise(F.lower(key)).alias("symbol"), F.when(k % 11 == 0, "EUR").otherwise("USD").alias("currency"))
    return nz.identity_drift(observed, registry)


@query("p13_select_instruments", sql("SELECT instrument_key, asset_type FROM instruments WHERE instrument_key IN ('view', 'error')"))
def p13(spark, folder):
    return nz.select_instruments(b.instruments(spark, folder), [" View", "error "]).select("instrument_key", "asset_type")


@query("p14_series_attributes", sql("SELECT instrument_key, CASE WHEN asset_type = 'FxSpot' THEN 'bid_ask_mid' ELSE 'native_ohlc' END AS price_basis, CAST(CASE WHEN asset_type = 'FxSpot' THEN 72 ELSE 20 END AS BIGINT) AS overlap_bars FROM instruments"))
def p14(spark, folder):
    return nz.series_attributes(b.instruments(spark, folder))


@query("p15_grade_rows", sql("SELECT quality_status, count(*) AS n FROM bars GROUP BY ALL"))
def p15(spark, folder):
    return nz.grade_rows(b.bars(spark, folder)).groupBy("quality_status").agg(F.count("*").alias("n"))


_PATHS = "SELECT page_id, CASE page_id % 4 WHEN 0 THEN '/' || page_id || '.html' WHEN 1 THEN 'a/../' || page_id WHEN 2 THEN 'C:' || page_id ELSE 'raw/' || page_id || '.html' END AS path, CASE WHEN page_id % 5 = 0 THEN upper(sha256(html)) ELSE sha256(html) END AS digest FROM pages"


@query("p16_valid_path_digest", f"SELECT page_id, page_id % 4 = 3 AS path_ok, regexp_full_match(digest, '[0-9a-f]{{64}}') AS digest_ok FROM ({_PATHS})")
def p16(spark, folder):
    i = F.col("page_id")
    path = F.when(i % 4 == 0, F.concat(F.lit("/"), i.cast("string"))).when(i % 4 == 1, F.concat(F.lit("a/../"), i.cast("string"))).when(i % 4 == 2, F.concat(F.lit("C:"), i.cast("string"))).otherwise(F.concat(F.lit("raw/"), i.cast("string")))
    digest = F.when(i % 5 == 0, F.upper(F.sha2("html", 256))).otherwise(F.sha2("html", 256))
    return b.table(spark, folder, "pages").select("page_id", nz.valid_path(path).alias("path_ok"), nz.valid_digest(digest).alias("digest_ok"))


CODES = ["AUTH_EXPIRED", "FAILED_HTTP_500", "RETRY_EXHAUSTED:FAILED_NETWORK", "DATA_NOT_READY", "BLOCKED_FULL_REFETCH_REQUIRED", "OHLC_VIOLATION", "", "FAILED_HTTP_429", "BLOCKED_REVISION_SCOPE"]


@query("p17_error_taxonomy", "SELECT code, domain, records_event, retry, n FROM (SELECT event_id % 9 AS k, count(*) AS n FROM events GROUP BY 1) JOIN (VALUES (0, 'AUTH_EXPIRED', 'interface_auth', false, 'OPERATOR_ACTION_REQUIRED'), (1, 'FAILED_HTTP_500', 'interface_operational', false, 'OPERATOR_ACTION_REQUIRED'), (2, 'RETRY_EXHAUSTED:FAILED_NETWORK', 'interface_operational', true, 'OPERATOR_ACTION_REQUIRED'), (3, 'DATA_NOT_READY', 'data_not_ready', true, 'TRANSIENT_RETRY'), (4, 'BLOCKED_FULL_REFETCH_REQUIRED', 'source_revision', false, 'OPERATOR_ACTION_REQUIRED'), (5, 'OHLC_VIOLATION', 'data_quality', true, 'OPERATOR_ACTION_REQUIRED'), (6, '', 'none', true, 'OPERATOR_ACTION_REQUIRED'), (7, 'FAILED_HTTP_429', 'interface_operational', false, 'TRANSIENT_RETRY'), (8, 'BLOCKED_REVISION_SCOPE', 'data_quality', false, 'OPERATOR_ACTION_REQUIRED')) t(k, code, domain, records_event, retry) USING (k)")
def p17(spark, folder):
    code = F.element_at(F.array(*map(F.lit, CODES)), (F.col("event_id") % 9 + 1).cast("int"))
    rows = b.table(spark, folder, "events").groupBy(code.alias("code")).agg(F.count("*").alias("n"))
    c = F.col("code")
    return rows.select("code", nz.error_domain(c).alias("domain"), nz.records_quality_event(c).alias("records_event"), nz.retry_disposition(c).alias("retry"), "n")


@query("p19_summary_events", sql("SELECT instrument_key || '/' || CAST(run_id AS VARCHAR) AS series_key, 'ERROR' AS severity, '{\"rows\":' || count(*) || CASE WHEN min(volume) > 1 THEN ',\"least\":' || min(volume) ELSE '' END || '}' AS observed_value FROM bars GROUP BY instrument_key, run_id HAVING count(*) % 3 = 0"))
def p19(spark, folder):
    rows = b.bars(spark, folder).groupBy(F.concat_ws("/", "instrument_key", F.col("run_id").cast("string")).alias("series_key")).agg(F.count("*").alias("rows"), F.when(F.min("volume") > 1, F.min("volume")).alias("least"))
    return nz.summary_events(rows.withColumn("quality_status", F.when(F.col("rows") % 3 == 0, "FAIL").otherwise("PASS")), ["rows", "least"])


# --- merging ------------------------------------------------------------------------------------

@query("m01_merge_pages", sql(f"WITH {_PAGES} SELECT instrument_key, time_utc, close FROM paged QUALIFY row_number() OVER (PARTITION BY instrument_key, time_utc ORDER BY page_number, position) = 1"))
def m01(spark, folder):
    return m.merge_pages(_pages(spark, folder)).select("instrument_key", "time_utc", "close")


@query("m02_duplicate_audit", sql(f"""WITH {_PAGES}, r AS (SELECT instrument_key, close, row_number() OVER w AS n, first_value(close) OVER w AS f FROM paged WINDOW w AS (PARTITION BY instrument_key, time_utc ORDER BY page_number, position))
SELECT instrument_key, count(*) AS raw_occurrences, count(*) FILTER (n = 1) AS unique_timestamps, count(*) FILTER (n > 1) AS inclusive_boundary_duplicates, count(*) FILTER (close <> f) AS conflicting_boundary_rows FROM r GROUP BY 1"""))
def m02(spark, folder):
    return m.duplicate_audit(_pages(spark, folder), ["open", "high", "low", "close"])


@query("m03_overlap_start", sql("SELECT instrument_key, price_basis, time_utc AS overlap_start_utc FROM bars WHERE is_complete QUALIFY row_number() OVER (PARTITION BY instrument_key ORDER BY time_utc DESC) = 20"))
def m03(spark, folder):
    return m.overlap_start(b.bars(spark, folder), 20)


_SAME = " AND ".join(f"s.{c} IS NOT DISTINCT FROM c.{c}" for c in m.CONTENT)
_STAGED = "staged AS (SELECT * FROM bars2 WHERE last_event % 4 <> 0), current AS (SELECT * FROM bars WHERE last_event % 5 <> 0)"


def _sides(spark, folder):
    return b.bars(spark, folder, 2).where("last_event % 4 <> 0"), b.bars(spark, folder, 1).where("last_event % 5 <> 0")


@query("m04_diff_counts", sql(f"WITH {_STAGED} SELECT s.instrument_key, count(*) FILTER (c.instrument_key IS NULL) AS inserted, count(*) FILTER (c.instrument_key IS NOT NULL AND (NOT ({_SAME}) OR s.data_version <> c.data_version)) AS updated FROM staged s LEFT JOIN current c ON c.instrument_key = s.instrument_key AND c.time_utc = s.time_utc GROUP BY 1"))
def m04(spark, folder):
    return m.diff_counts(*_sides(spark, folder))


@query("m05_revision_audit", sql(f"WITH {_STAGED} SELECT s.instrument_key, s.time_utc, s.price_basis, 'INFO' AS severity, 'RESOLVED' AS status FROM staged s JOIN current c ON c.instrument_key = s.instrument_key AND c.time_utc = s.time_utc WHERE NOT ({_SAME})"))
def m05(spark, folder):
    return m.revision_audit(*_sides(spark, folder)).drop("observed_value")


@query("m06_removed_rows", sql(f"WITH {_STAGED} SELECT c.instrument_key, count(*) AS removed FROM current c ANTI JOIN staged s ON c.instrument_key = s.instrument_key AND c.time_utc = s.time_utc GROUP BY 1"))
def m06(spark, folder):
    staged, current = _sides(spark, folder)
    return m.removed_rows(current, staged)


_OUT = "instrument_key, time_utc, data_version, close, volume"


@query("m07_append_raw", sql(f"SELECT {_OUT} FROM bars UNION ALL SELECT {_OUT} FROM bars2"))
def m07(spark, folder):
    cols = _OUT.split(", ")
    return b.bars(spark, folder, 1).select(*cols).unionByName(b.bars(spark, folder, 2).select(*cols))


@query("m08_upsert", sql(f"WITH {_STAGED} SELECT {_OUT} FROM staged UNION ALL SELECT {_OUT} FROM current c ANTI JOIN staged s ON c.instrument_key = s.instrument_key AND c.time_utc = s.time_utc"))
def m08(spark, folder):
    staged, current = _sides(spark, folder)
    return m.upsert(current, staged).select(*_OUT.split(", "))


@query("m09_full_replace", sql(f"WITH {_STAGED} SELECT {_OUT} FROM staged WHERE instrument_key = 'view' UNION ALL SELECT {_OUT} FROM current WHERE instrument_key <> 'view'"))
def m09(spark, folder):
    staged, current = _sides(spark, folder)
    return m.full_replace(current, staged, "view").select(*_OUT.split(", "))


@query("m10_bounded_replace", sql(f"WITH {_STAGED} SELECT {_OUT} FROM staged WHERE instrument_key = 'view' AND time_utc BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12' UNION ALL SELECT {_OUT} FROM current WHERE NOT (instrument_key = 'view' AND time_utc BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12')"))
def m10(spark, folder):
    staged, current = _sides(spark, folder)
    day = lambda d: F.lit(d).cast("timestamp_ntz")
    return m.bounded_replace(current, staged, "view", day("2024-01-10"), day("2024-01-12")).select(*_OUT.split(", "))


@query("m11_init_watermarks", sql("SELECT instrument_key, price_basis, latest_seen_utc, latest_complete_utc, data_version, run_id FROM watermarks"))
def m11(spark, folder):
    existing = b.watermarks(spark, folder).where("instrument_key in ('view', 'click')").drop("data_status")
    return m.init_watermarks(b.bars(spark, folder), existing)


@query("m12_advance_watermarks", sql("""WITH w AS (SELECT instrument_key, price_basis, max(time_utc) AS s, max(time_utc) FILTER (is_complete) AS c, max(run_id) AS r FROM bars WHERE time_utc < TIMESTAMP '2024-01-20' GROUP BY ALL),
n AS (SELECT instrument_key, price_basis, max(time_utc) AS s, max(time_utc) FILTER (is_complete) AS c, max(run_id) AS r FROM bars2 WHERE instrument_key <> 'view' GROUP BY ALL)
SELECT instrument_key, price_basis, greatest(w.s, n.s) AS latest_seen_utc, greatest(w.c, n.c) AS latest_complete_utc, CAST(CASE WHEN n.s IS NULL THEN 1 ELSE 2 END AS BIGINT) AS data_version, greatest(w.r, n.r) AS run_id FROM w FULL JOIN n USING (instrument_key, price_basis)"""))
def m12(spark, folder):
    old = b.bars(spark, folder).where("time_utc < timestamp_ntz '2024-01-20'")
    marks = m.init_watermarks(old, b.watermarks(spark, folder).drop("data_status").limit(0))
    return m.advance_watermarks(marks, b.bars(spark, folder, 2).where("instrument_key <> 'view'"))


@query("m13_quarantine_admission", sql(f"""WITH {_Q}, parts AS (SELECT *, CASE WHEN bid_open > ask_open OR bid_close > ask_close THEN 'fatal' WHEN bid_high > ask_high OR bid_low > ask_low THEN 'rejected' ELSE 'accepted' END AS part FROM quotes)
SELECT instrument_key, count(*) FILTER (part = 'rejected') AS rejected_times, count(*) AS times, CASE WHEN max(time_utc) = max(time_utc) FILTER (part = 'rejected') THEN 'QUARANTINE_NEWEST_SAMPLE' WHEN count(*) FILTER (part = 'rejected') > 10 THEN 'QUARANTINE_ROW_LIMIT' WHEN count(*) FILTER (part = 'rejected') > 0.0001 * count(*) THEN 'QUARANTINE_RATE_LIMIT' END AS error_code
FROM parts WHERE part <> 'fatal' GROUP BY 1 HAVING count(*) FILTER (part = 'rejected') > 0"""))
def m13(spark, folder):
    accepted, rejected, _ = nz.split_quarantine(nz.fx_mid(_quotes(spark, folder)))
    return m.quarantine_admission(accepted, rejected)


_HIGH_LOW = f"WITH {_Q}, rej AS (SELECT * FROM quotes WHERE (bid_high > ask_high OR bid_low > ask_low) AND NOT (bid_open > ask_open OR bid_close > ask_close)), " + (
    "viol AS (SELECT instrument_key, time_utc, 'high' AS field, bid_high AS bid, ask_high AS ask FROM rej WHERE bid_high > ask_high UNION ALL SELECT instrument_key, time_utc, 'low', bid_low, ask_low FROM rej WHERE bid_low > ask_low)")
_VIOLATIONS = """string_agg('{"ask":"' || ask || '","bid":"' || bid || '","field":"' || field || '"}', ',' ORDER BY field)"""


@query("m14_quarantine_events", sql(f"""{_HIGH_LOW}
SELECT instrument_key, time_utc, 'WARN' AS severity, 'RESOLVED' AS status, 'bounded' AS policy, string_agg(field, ',' ORDER BY field) AS fields, '[' || {_VIOLATIONS} || ']' AS violations, sha256('[' || {_VIOLATIONS} || ']') AS content_sha256
FROM viol GROUP BY instrument_key, time_utc"""))
def m14(spark, folder):
    return m.quarantine_events(nz.split_quarantine(_quotes(spark, folder))[1], "bounded")


# The multiset digest: rows, and the sums of the quarters of each one's SHA-256.
_QUARTERS = " || ':' || ".join(f"CAST(sum(CAST('0x' || substr(h, {16 * k + 1}, 16) AS UBIGINT)) AS VARCHAR)" for k in range(4))


@query("m13_approved_exceptions", sql(f"""{_HIGH_LOW},
hashed AS (SELECT *, sha256('{{"ask":"' || ask || '","bid":"' || bid || '","field":"' || field || '","time_utc":"' || strftime(time_utc, '%Y-%m-%d %H:%M:%S') || '"}}') AS h FROM viol),
told AS (SELECT instrument_key, count(DISTINCT time_utc) AS rejected_times, string_agg(DISTINCT field, ',' ORDER BY field) AS fields, min(time_utc) AS first_utc, max(time_utc) AS last_utc, count(*) || ':' || {_QUARTERS} AS content_digest FROM hashed GROUP BY 1)
SELECT *, CASE WHEN instrument_key = 'click' THEN NULL ELSE 'QUARANTINE_EXCEPTION_MISMATCH' END AS error_code FROM told"""))
def m13_exceptions(spark, folder):
    """Exceptions with the exact evidence of one instrument, and with one row too many of the others; the newest sample is left out of the rows."""
    rows = nz.fx_mid(_quotes(spark, folder))
    rejected = nz.split_quarantine(rows)[1]
    told = m.quarantine_digest(rejected)
    approved = told.select("instrument_key", (F.col("rejected_times") + F.when(F.col("instrument_key") == "click", 0).otherwise(1)).alias("unique_rows"), F.array(F.lit("high"), F.lit("low")).alias("allowed_fields"), "first_utc", "last_utc", "content_digest")
    return m.approved_exceptions(told, approved)


def _requests(spark, folder):
    e = b.table(spark, folder, "events").groupBy(F.dayofmonth("ts").cast("long").alias("run_id")).agg(F.array_sort(F.collect_set("event_type")).alias("keys"))
    one = lambda k: F.struct(k.alias("instrument_key"), F.when(k == "view", F.lit(60)).alias("horizon"), F.when(k == "click", F.lit("bid_ask_mid")).alias("price_basis"))
    return e.select("run_id", F.to_json(F.transform("keys", one)).alias("requested_series"))


_SCOPE = "scope AS (SELECT DISTINCT CAST(day(ts) AS BIGINT) AS run_id, event_type AS instrument_key, 60 AS horizon_minutes, CASE WHEN event_type IN ('click', 'view') THEN 'bid_ask_mid' ELSE 'native_ohlc' END AS price_basis FROM events WHERE event_type <> 'purchase')"


def _scope(spark, folder):
    return m.run_scope(_requests(spark, folder), b.instruments(spark, folder), b.watermarks(spark, folder).where("instrument_key <> 'purchase'"))


@query("m15_run_scope", sql(f"WITH {_SCOPE} SELECT * FROM scope"))
def m15(spark, folder):
    return _scope(spark, folder)


@query("m16_run_scope_summary", sql(f"WITH {_SCOPE} SELECT run_id, string_agg(DISTINCT instrument_key, ',' ORDER BY instrument_key) AS instrument_keys, CASE WHEN count(DISTINCT price_basis) = 1 THEN min(price_basis) END AS price_basis FROM scope GROUP BY 1"))
def m16(spark, folder):
    return m.run_scope_summary(_scope(spark, folder))


@query("m17_run_summary", sql(f"""WITH {_STAGED}, d AS (SELECT s.instrument_key, count(*) FILTER (c.instrument_key IS NULL) AS i, count(*) FILTER (c.instrument_key IS NOT NULL AND (NOT ({_SAME}) OR s.data_version <> c.data_version)) AS u FROM staged s LEFT JOIN current c ON c.instrument_key = s.instrument_key AND c.time_utc = s.time_utc GROUP BY 1),
r AS (SELECT c.instrument_key, count(*) AS n FROM current c ANTI JOIN staged s ON c.instrument_key = s.instrument_key AND c.time_utc = s.time_utc GROUP BY 1)
SELECT count(*) AS successful_series, CAST(sum(i) AS BIGINT) AS inserted, CAST(sum(u) AS BIGINT) AS updated, CAST(sum(u + coalesce(n, 0)) AS BIGINT) AS revisions, CAST(0 AS BIGINT) AS rejected FROM d LEFT JOIN r USING (instrument_key)"""))
def m17(spark, folder):
    staged, current = _sides(spark, folder)
    none = b.instruments(spark, folder).limit(0).select("instrument_key", F.lit(0).cast("long").alias("rejected"))
    return m.run_summary(m.diff_counts(staged, current), m.removed_rows(current, staged), none)


@query("m18_insert_if_absent", sql(f"WITH {_STAGED} SELECT instrument_key, count(*) AS added FROM staged s ANTI JOIN current c ON c.instrument_key = s.instrument_key AND c.time_utc = s.time_utc GROUP BY 1"))
def m18(spark, folder):
    staged, current = _sides(spark, folder)
    return m.insert_if_absent(current, staged.select(*current.columns), ["instrument_key", "time_utc"])[1].groupBy("instrument_key").agg(F.count("*").alias("added"))


# --- gaps ---------------------------------------------------------------------------------------

_MISSING = """miss AS (SELECT s.* FROM slots s JOIN (SELECT instrument_key, min(time_utc) AS a, max(time_utc) AS z FROM bars WHERE is_complete GROUP BY 1) e ON e.instrument_key = s.instrument_key AND slot_utc BETWEEN a AND z
  ANTI JOIN (SELECT * FROM bars WHERE is_complete) b ON b.instrument_key = s.instrument_key AND b.time_utc = s.slot_utc),
revisions AS (SELECT instrument_key, time_utc, 100 + run_id AS run_id FROM bars UNION ALL SELECT instrument_key, time_utc + INTERVAL 1 HOUR, 200 + run_id FROM bars WHERE last_event % 2 = 0),
errs AS (SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'view' ELSE 'click' END AS instrument_key, date_trunc('hour', ts) AS time_utc FROM events WHERE event_type = 'error')"""


def _missing(spark, folder):
    return g.missing_slots(b.bars(spark, folder), cal.complete_slots(b.instruments(spark, folder), b.sessions(spark, folder)))


def _revisions(spark, folder):
    rows = b.bars(spark, folder).select("instrument_key", "time_utc", "run_id", "last_event")
    late = rows.where("last_event % 2 = 0").select("instrument_key", (F.col("time_utc") + F.expr("interval 1 hour")).alias("time_utc"), (F.col("run_id") + 200).alias("run_id"))
    return rows.select("instrument_key", "time_utc", (F.col("run_id") + 100).alias("run_id")).unionByName(late)


def _errors(spark, folder):
    from barloom.functions.times import hour_of, ntz
    return b.table(spark, folder, "events").where("event_type = 'error'").select("event_id", F.when(F.col("user_id") % 2 == 0, "view").otherwise("click").alias("instrument_key"), hour_of(ntz(F.col("ts"))).alias("time_utc"))


def _pass_runs(spark, folder):
    return _revisions(spark, folder).select("run_id").distinct().select("run_id", F.when(F.col("run_id") % 5 == 0, "FAIL").otherwise("PASS").alias("run_status"))


@query("g01_missing_slots", sql(f"WITH {_MISSING} SELECT * FROM miss"))
def g01(spark, folder):
    return _missing(spark, folder)


@query("g02_latest_raw", sql(f"WITH {_MISSING} SELECT m.*, max(r.run_id) AS raw_run_id FROM miss m LEFT JOIN revisions r ON r.instrument_key = m.instrument_key AND r.time_utc = slot_utc GROUP BY ALL"))
def g02(spark, folder):
    return g.latest_raw(_missing(spark, folder), _revisions(spark, folder))


@query("g03_latest_quarantine", sql(f"WITH {_MISSING} SELECT m.*, max(e.event_id) AS quarantine_event_id FROM miss m LEFT JOIN errs e ON e.instrument_key = m.instrument_key AND e.time_utc = slot_utc GROUP BY ALL"))
def g03(spark, folder):
    return g.latest_quarantine(_missing(spark, folder), _errors(spark, folder))


_COVER = "bounds AS (SELECT instrument_key, run_id, min(time_utc) AS a, max(time_utc) AS z FROM revisions WHERE run_id % 5 <> 0 GROUP BY ALL)"


@query("g04_covering_run", sql(f"WITH {_MISSING}, {_COVER} SELECT m.*, max(r.run_id) AS covering_run_id FROM miss m LEFT JOIN bounds r ON r.instrument_key = m.instrument_key AND slot_utc BETWEEN a AND z GROUP BY ALL"))
def g04(spark, folder):
    return g.covering_run(_missing(spark, folder), _revisions(spark, folder), _pass_runs(spark, folder))


@query("g05_curated_present", sql(f"WITH {_MISSING} SELECT m.*, EXISTS (SELECT 1 FROM bars b WHERE b.instrument_key = m.instrument_key AND b.time_utc = m.slot_utc) AS curated_rejected FROM miss m"))
def g05(spark, folder):
    return g.curated_present(_missing(spark, folder), b.bars(spark, folder))


# Beside the fixed days of large moves, some of the time that the given events cover.
_EVENTS = [*g.MARKET_EVENTS, ("LONG_WEEKEND", "2024-01-13", "2024-01-15"), ("THIRD_WEEK", "2024-01-15", "2024-01-19")]
_GAPS = f"""{_MISSING}, {_COVER}, ev AS (SELECT m.*, (SELECT max(run_id) FROM revisions r WHERE r.instrument_key = m.instrument_key AND r.time_utc = m.slot_utc) AS raw_run_id, (SELECT max(event_id) FROM errs e WHERE e.instrument_key = m.instrument_key AND e.time_utc = m.slot_utc) AS quarantine_event_id,
  (SELECT max(run_id) FROM bounds r WHERE r.instrument_key = m.instrument_key AND m.slot_utc BETWEEN a AND z) AS covering_run_id FROM miss m),
gaps AS (SELECT *, CASE WHEN quarantine_event_id IS NOT NULL THEN 'QUARANTINED_VALUE_ANOMALY' WHEN raw_run_id IS NOT NULL AND (covering_run_id IS NULL OR raw_run_id >= covering_run_id) THEN 'RAW_PRESENT_CURATED_REJECTED' WHEN covering_run_id IS NOT NULL THEN 'PROVIDER_RAW_NO_SAMPLE' ELSE 'ACQUISITION_RUN_MISSED' END AS cause FROM ev),
rich AS (SELECT instrument_key, session_date, slot_utc, cause, slot_utc - INTERVAL 5 HOUR AS ny_time, year(slot_utc) AS year, month(slot_utc) AS month, isodow(slot_utc) - 1 AS weekday, hour(slot_utc) AS utc_hour, hour(slot_utc - INTERVAL 5 HOUR) AS ny_hour, cause IN ('ACQUISITION_RUN_MISSED', 'RAW_PRESENT_CURATED_REJECTED') AS blocking,
  CASE WHEN cause IN ('ACQUISITION_RUN_MISSED', 'RAW_PRESENT_CURATED_REJECTED') THEN 'ENGINE' ELSE 'PROVIDER' END AS owner, CASE WHEN cause = 'ACQUISITION_RUN_MISSED' THEN 'PROVIDER_RESPONSE_OR_RUN_OVER_SLOT' END AS required_evidence,
  CASE WHEN raw_run_id < covering_run_id THEN covering_run_id END AS superseding_run_id,
  (SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM (VALUES {", ".join(f"('{n}', DATE '{a}', DATE '{z}')" for n, a, z in _EVENTS)}) v(label, a, z) WHERE CAST(slot_utc - INTERVAL 5 HOUR AS DATE) BETWEEN a AND z) AS market_event FROM gaps)"""


def _gaps(spark, folder):
    rows = g.latest_raw(_missing(spark, folder), _revisions(spark, folder))
    rows = g.latest_quarantine(rows, _errors(spark, folder))
    rows = g.covering_run(rows, _revisions(spark, folder), _pass_runs(spark, folder))
    return g.classify_gap(g.curated_present(rows, b.bars(spark, folder)))


@query("g06_classify_gap", sql(f"WITH {_GAPS} SELECT instrument_key, slot_utc, cause FROM gaps"), shared=True)
def g06(spark, folder):
    return _gaps(spark, folder).select("instrument_key", "slot_utc", "cause")


def _rich(spark, folder):
    events = spark.createDataFrame(_EVENTS, "label string, first_day string, last_day string").select("label", F.col("first_day").cast("date").alias("first_day"), F.col("last_day").cast("date").alias("last_day"))
    return g.enrich_gaps(_gaps(spark, folder), events).drop("raw_run_id", "quarantine_event_id", "covering_run_id", "curated_rejected")


@query("g07_enrich_gaps", sql(f"WITH {_GAPS} SELECT * FROM rich"), shared=True)
def g07(spark, folder):
    return _rich(spark, folder)


@query("g08_gap_histograms", sql(f"WITH {_GAPS} SELECT instrument_key, dimension, value, count(*) AS gaps FROM (" + " UNION ALL ".join(f"SELECT instrument_key, '{d}' AS dimension, CAST({d} AS VARCHAR) AS value FROM rich" for d in g.DIMENSIONS) + ") WHERE dimension <> 'market_event' OR value IS NOT NULL GROUP BY ALL"
  " UNION ALL SELECT instrument_key, 'total', 'missing_rows', count(*) FROM rich GROUP BY 1 UNION ALL SELECT instrument_key, 'total', 'blocking_rows', count(*) FILTER (blocking) FROM rich GROUP BY 1 UNION ALL SELECT instrument_key, 'total', 'unclassified_rows', 0 FROM rich GROUP BY 1"), shared=True)
def g08(spark, folder):
    return g.gap_histograms(_rich(spark, folder))


@query("g09_gap_overlap", sql(f"WITH {_GAPS}, h AS (SELECT slot_utc, count(DISTINCT instrument_key) AS n, min(instrument_key) AS o FROM gaps WHERE instrument_key IN ('click', 'view') GROUP BY 1) SELECT CASE WHEN n = 2 THEN 'ALL' ELSE o END AS missing_in, count(*) AS slots FROM h GROUP BY 1"), shared=True)
def g09(spark, folder):
    return g.gap_overlap(_gaps(spark, folder), ["click", "view"])


@query("g10_gap_verdict", sql(f"WITH {_GAPS} SELECT count(*) AS gaps, count(*) FILTER (blocking) AS blocking, CAST(0 AS BIGINT) AS unclassified, CASE WHEN count(*) FILTER (blocking) = 0 THEN 'PASS' ELSE 'BLOCKED' END AS verdict FROM rich"), shared=True)
def g10(spark, folder):
    return g.gap_verdict(_rich(spark, folder))


@query("g11_exact_scope_gate", sql(f"""WITH {_MISSING}, ok AS (SELECT instrument_key, slot_utc FROM miss WHERE instrument_key <> 'error' OR hour(slot_utc) < 18)
SELECT instrument_key, count(*) AS missing_slots, count(ok.slot_utc) AS approved_slots, count(*) - count(ok.slot_utc) AS unapproved, count(*) = count(ok.slot_utc) AS passes FROM miss LEFT JOIN ok USING (instrument_key, slot_utc) GROUP BY 1"""))
def g11(spark, folder):
    missing = _missing(spark, folder)
    return g.exact_scope_gate(missing, missing.where((F.col("instrument_key") != "error") | (F.hour("slot_utc") < 18)).select("instrument_key", "slot_utc"))


# --- revisions ----------------------------------------------------------------------------------

_PROVIDER = "provider AS (SELECT * FROM bars2 WHERE time_utc >= TIMESTAMP '2024-01-15'), stored AS (SELECT * FROM bars WHERE last_event % 50 <> 0)"
_PAIRS = f"""{_PROVIDER}, ends AS (SELECT instrument_key, min(time_utc) AS lower, max(time_utc) AS upper FROM provider GROUP BY 1),
inside AS (SELECT s.* FROM stored s JOIN ends e ON e.instrument_key = s.instrument_key AND s.time_utc BETWEEN lower AND upper),
pairs AS (SELECT coalesce(s.instrument_key, c.instrument_key) AS instrument_key, coalesce(s.time_utc, c.time_utc) AS time_utc, CASE WHEN c.time_utc IS NULL THEN 'new' WHEN s.time_utc IS NULL THEN 'removed' WHEN NOT ({_SAME}) THEN 'content' ELSE 'version' END AS kind, coalesce(s.is_complete, false) AS complete, s.time_utc IS NOT NULL AS provided
  FROM provider s FULL JOIN inside c ON c.instrument_key = s.instrument_key AND c.time_utc = s.time_utc)"""


def _revision_sides(spark, folder):
    return b.bars(spark, folder, 2).where("time_utc >= timestamp_ntz '2024-01-15'"), b.bars(spark, folder, 1).where("last_event % 50 <> 0")


@query("r01_compare_sample", sql(f"WITH {_PAIRS} SELECT instrument_key, count(*) FILTER (provided) AS provider_rows, count(*) FILTER (kind IN ('content', 'version')) AS matched_rows, count(*) FILTER (kind = 'content') AS content_difference_rows, count(*) FILTER (kind = 'version') AS version_only_rows, count(*) FILTER (kind = 'new') AS new_rows, count(*) FILTER (kind = 'removed') AS removed_rows, max(time_utc) FILTER (complete) AS latest_complete_utc FROM pairs GROUP BY 1"))
def r01(spark, folder):
    return rv.compare_sample(*_revision_sides(spark, folder))


_WINDOW = f"""{_PAIRS}, rng AS (SELECT instrument_key, min(time_utc) FILTER (kind <> 'version') AS affected_from, max(time_utc) FILTER (kind <> 'version') AS affected_to, min(time_utc) FILTER (provided) AS lower FROM pairs GROUP BY 1),
pre AS (SELECT p.*, row_number() OVER (PARTITION BY p.instrument_key ORDER BY time_utc DESC) AS n FROM pairs p JOIN rng r USING (instrument_key) WHERE provided AND (affected_from IS NULL OR time_utc < affected_from)),
anchor AS (SELECT instrument_key, coalesce(min(n) FILTER (NOT complete OR kind <> 'version'), count(*) + 1) - 1 AS stable FROM pre GROUP BY 1),
cmp AS (SELECT p.instrument_key, affected_from, affected_to, count(*) FILTER (provided) AS provider_rows, count(*) FILTER (kind IN ('content', 'version')) AS matched_rows, count(*) FILTER (kind IN ('content', 'version') AND complete) AS matched_complete, count(*) FILTER (kind = 'content') AS content_difference_rows, count(*) FILTER (kind = 'version') AS version_only_rows, count(*) FILTER (kind = 'new') AS new_rows, count(*) FILTER (kind = 'removed') AS removed_rows, count(*) FILTER (kind = 'content' AND complete) AS changed_complete,
  count(*) FILTER (provided AND time_utc BETWEEN affected_from AND affected_to) + count(*) FILTER (kind = 'removed') AS affected_span_rows, coalesce(any_value(stable), 0) AS stable_anchor_rows, coalesce(any_value(affected_from = lower), false) AS at_window_boundary
  FROM pairs p JOIN rng r USING (instrument_key) LEFT JOIN anchor a USING (instrument_key) GROUP BY ALL)"""


@query("r02_compare_window", sql(f"WITH {_WINDOW} SELECT * FROM cmp"), shared=True)
def r02(spark, folder):
    return rv.compare_window(*_revision_sides(spark, folder))


@query("r03_stable_anchor", sql(f"WITH {_WINDOW} SELECT instrument_key, stable_anchor_rows FROM cmp"))
def r03(spark, folder):
    return r02(spark, folder).select("instrument_key", "stable_anchor_rows")


@query("r04_revision_decision", sql(f"WITH {_WINDOW} SELECT instrument_key, CASE WHEN removed_rows > 64 OR affected_span_rows > 240 OR (matched_complete >= 16 AND changed_complete >= 0.8 * matched_complete) THEN 'BLOCKED_FULL_REFETCH' WHEN stable_anchor_rows < 16 OR at_window_boundary THEN 'EXPAND' ELSE 'READY_TO_APPLY' END AS decision FROM cmp"))
def r04(spark, folder):
    return rv.decide(r02(spark, folder), F.lit(96)).select("instrument_key", "decision")


_ESCALATE = f"""WITH wins AS (SELECT unnest([96, 384, 1200]) AS win),
provider AS (SELECT p.*, win FROM (SELECT *, row_number() OVER (PARTITION BY instrument_key ORDER BY time_utc DESC) AS newest FROM bars2) p JOIN wins ON newest <= win),
ends AS (SELECT instrument_key, win, min(time_utc) AS lower, max(time_utc) AS upper FROM provider GROUP BY ALL),
inside AS (SELECT s.*, win FROM bars s JOIN ends e ON e.instrument_key = s.instrument_key AND s.time_utc BETWEEN lower AND upper),
pairs AS (SELECT coalesce(s.instrument_key, c.instrument_key) AS instrument_key, coalesce(s.win, c.win) AS win, coalesce(s.time_utc, c.time_utc) AS time_utc,
  CASE WHEN c.time_utc IS NULL THEN 'new' WHEN s.time_utc IS NULL THEN 'removed' WHEN NOT ({_SAME}) THEN 'content' ELSE 'version' END AS kind, coalesce(s.is_complete, false) AS complete, s.time_utc IS NOT NULL AS provided
  FROM provider s FULL JOIN inside c ON c.instrument_key = s.instrument_key AND c.time_utc = s.time_utc AND c.win = s.win),
rng AS (SELECT instrument_key, win, min(time_utc) FILTER (kind <> 'version') AS a, max(time_utc) FILTER (kind <> 'version') AS z, min(time_utc) FILTER (provided) AS lower FROM pairs GROUP BY ALL),
pre AS (SELECT p.*, row_number() OVER (PARTITION BY p.instrument_key, p.win ORDER BY time_utc DESC) AS n FROM pairs p JOIN rng r USING (instrument_key, win) WHERE provided AND (a IS NULL OR time_utc < a)),
anchor AS (SELECT instrument_key, win, coalesce(min(n) FILTER (NOT complete OR kind <> 'version'), count(*) + 1) - 1 AS stable FROM pre GROUP BY ALL),
cmp AS (SELECT p.instrument_key, p.win, count(*) FILTER (kind IN ('content', 'version') AND complete) AS matched, count(*) FILTER (kind = 'removed') AS removed, count(*) FILTER (kind = 'content' AND complete) AS changed,
  count(*) FILTER (provided AND time_utc BETWEEN a AND z) + count(*) FILTER (kind = 'removed') AS span, coalesce(any_value(stable), 0) AS stable, coalesce(any_value(a = lower), false) AS edge
  FROM pairs p JOIN rng r USING (instrument_key, win) LEFT JOIN anchor USING (instrument_key, win) GROUP BY ALL),
decided AS (SELECT instrument_key, win, CASE WHEN removed > 64 OR span > 240 OR (matched >= 16 AND changed >= 0.8 * matched) THEN 'BLOCKED_FULL_REFETCH'
  WHEN stable < 16 OR edge THEN CASE WHEN win < 1200 THEN 'EXPAND' ELSE 'BLOCKED_FULL_REFETCH' END ELSE 'READY_TO_APPLY' END AS decision FROM cmp)
SELECT instrument_key, arg_min(decision, win) AS decision, CAST(min(win) AS INTEGER) AS "window" FROM decided WHERE decision <> 'EXPAND' GROUP BY 1"""


@query("r05_escalate_windows", sql(_ESCALATE), shared=True)
def r05(spark, folder):
    return rv.escalate_windows(b.bars(spark, folder, 2), b.bars(spark, folder, 1))


# In r06 the rows of 'purchase' differ in their version alone.
_R06 = """src AS (SELECT * FROM bars WHERE last_event % 50 <> 0),
stored AS (SELECT * FROM src),
provider AS (
  SELECT * FROM bars2 WHERE time_utc >= TIMESTAMP '2024-01-15' AND instrument_key <> 'purchase'
  UNION ALL SELECT * REPLACE (CAST(2 AS BIGINT) AS data_version) FROM src WHERE time_utc >= TIMESTAMP '2024-01-15' AND instrument_key = 'purchase')"""
_RANGES = """ranges AS (
  SELECT instrument_key, coalesce(affected_from, upper) AS affected_from, coalesce(affected_to, upper) AS affected_to
  FROM cmp JOIN (SELECT instrument_key, max(time_utc) AS upper FROM provider GROUP BY 1) USING (instrument_key) WHERE affected_from IS NOT NULL OR version_only_rows > 0)"""


@query("r06_apply_bounded", sql(f"""WITH {_WINDOW.replace(_PROVIDER, _R06)}, {_RANGES}
SELECT {_OUT} FROM stored s WHERE NOT EXISTS (SELECT 1 FROM ranges c WHERE c.instrument_key = s.instrument_key AND s.time_utc BETWEEN affected_from AND affected_to)
UNION ALL SELECT {_OUT} FROM provider p WHERE EXISTS (SELECT 1 FROM ranges c WHERE c.instrument_key = p.instrument_key AND p.time_utc BETWEEN affected_from AND affected_to)"""))
def r06(spark, folder):
    provider, stored = _revision_sides(spark, folder)
    own = F.col("instrument_key") == "purchase"
    versions = stored.where(own & (F.col("time_utc") >= F.lit("2024-01-15").cast("timestamp_ntz"))).withColumn("data_version", F.lit(2).cast("long"))
    provider = provider.where(~own).unionByName(versions)
    return rv.apply_bounded(stored, provider, rv.compare_window(provider, stored)).select(*_OUT.split(", "))


def _revision_events(spark, folder):
    return b.table(spark, folder, "events").where("event_type = 'error'").select((F.col("user_id") % 7).alias("instrument_key"), "event_id", F.when(F.col("value") > 100, "REVIEW_PENDING").otherwise("APPLIED").alias("event_status"))


def _revision_steps(spark, folder):
    return b.table(spark, folder, "events").select((F.col("event_id") - F.col("event_id") % 3).alias("event_id"), (F.col("event_id") % 3).alias("step_number"), F.col("event_type").alias("step_result"))


_STATE = "state AS (SELECT instrument_key, event_id, event_status FROM (SELECT user_id % 7 AS instrument_key, event_id, CASE WHEN value > 100 THEN 'REVIEW_PENDING' ELSE 'APPLIED' END AS event_status FROM events WHERE event_type = 'error') QUALIFY row_number() OVER (PARTITION BY instrument_key ORDER BY event_id DESC) = 1)"


@query("r07_revision_state", f"WITH {_STATE}, steps AS (SELECT event_id - event_id % 3 AS event_id, arg_max(event_type, event_id) AS step_result, max(event_id % 3) AS step_number FROM events GROUP BY 1) SELECT state.*, step_result, step_number FROM state LEFT JOIN steps USING (event_id)")
def r07(spark, folder):
    return rv.revision_state(_revision_events(spark, folder), _revision_steps(spark, folder)).select("instrument_key", "event_id", "event_status", "step_result", "step_number")


_AVAIL = "avail AS (SELECT instrument_key, price_basis, CASE WHEN instrument_key = 'view' THEN 'WARNING' WHEN data_status = 'ACTIVE' THEN 'AVAILABLE' ELSE 'BLOCKED' END AS availability FROM watermarks)"


def _availability(spark, folder):
    states = b.instruments(spark, folder).where("instrument_key = 'view'").select("instrument_key", F.lit("WARNING").alias("state"))
    return rv.series_availability(b.watermarks(spark, folder), states)


@query("r08_series_availability", sql(f"WITH {_AVAIL} SELECT * FROM avail"))
def r08(spark, folder):
    return _availability(spark, folder)


@query("r09_service_status", sql(f"WITH {_AVAIL} SELECT count(*) AS series, count(*) FILTER (availability = 'BLOCKED') AS degraded, CASE WHEN count(*) FILTER (availability = 'BLOCKED') = 0 THEN 'PASS' WHEN count(*) FILTER (availability = 'BLOCKED') < count(*) THEN 'PARTIALLY_DEGRADED' ELSE 'BLOCKED' END AS service_status FROM avail"))
def r09(spark, folder):
    return rv.service_status(_availability(spark, folder))


@query("r10_version_watch", "SELECT event_id, CASE WHEN user_id % 5 = 3 THEN 'NO_CHANGE_QUARANTINE_MAINTAINED' WHEN user_id % 5 = event_id % 4 THEN 'NO_CHANGE_REVISION_REVIEW_PENDING' WHEN user_id % 5 = 1 THEN 'PROVIDER_VERSION_REVERSION_REVIEW_REQUIRED' ELSE 'NEW_PROVIDER_DATA_VERSION_REVIEW_REQUIRED' END AS watch_status FROM events")
def r10(spark, folder):
    rows = b.table(spark, folder, "events").select("event_id", (F.col("user_id") % 5).alias("observed_version"), F.lit(3).alias("quarantined_version"), (F.col("event_id") % 4).alias("last_observed_version"), F.lit(1).alias("accepted_version"))
    return rv.version_watch(rows).select("event_id", "watch_status")


@query("r14_stale_series", sql("SELECT instrument_key, price_basis, data_version FROM watermarks WHERE data_status = 'STALE_DATA_VERSION'"))
def r14(spark, folder):
    return rv.stale_series(b.watermarks(spark, folder))


@query("r15_field_diff", sql(f"WITH {_PROVIDER} " + " UNION ALL ".join(f"SELECT p.instrument_key, p.time_utc, '{f}' AS field, CAST(s.{f} AS VARCHAR) AS accepted, CAST(p.{f} AS VARCHAR) AS provider FROM provider p JOIN stored s ON s.instrument_key = p.instrument_key AND s.time_utc = p.time_utc WHERE s.{f} IS DISTINCT FROM p.{f}" for f in m.CONTENT)))
def r15(spark, folder):
    return rv.field_diff(*_revision_sides(spark, folder))


@query("r16_simulate_sessions", sql(f"""WITH {_PROVIDER} SELECT s.instrument_key, s.session_date, count(*) AS expected_slots, count(*) FILTER (coalesce(p.is_complete, c.is_complete, false)) AS complete_slots, CASE WHEN count(*) = count(*) FILTER (coalesce(p.is_complete, c.is_complete, false)) THEN 'PASS' ELSE 'WARN' END AS would_be
FROM slots s LEFT JOIN provider p ON p.instrument_key = s.instrument_key AND p.time_utc = s.slot_utc LEFT JOIN stored c ON c.instrument_key = s.instrument_key AND c.time_utc = s.slot_utc GROUP BY 1, 2"""))
def r16(spark, folder):
    provider, stored = _revision_sides(spark, folder)
    return rv.simulate_sessions(provider, stored, cal.complete_slots(b.instruments(spark, folder), b.sessions(spark, folder)))

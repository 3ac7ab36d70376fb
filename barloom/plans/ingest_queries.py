"""Streams over the given events: the page ingest with all tables that it leaves, watermark states, slots against arrivals, forward samples.

The page ingest takes three batches.  The first batch has the bars before T1.  The second goes on to T2; it sends the last twelve hours again with other closes and highs, very old
bars of one instrument, and FX lows that are crossed.  In the third, one instrument comes with another data version and one with a price of zero.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions.times import plus_hours, plus_seconds
from barloom.operators import calendar as cal
from barloom.plans import bindings as b
from barloom.plans.bindings import NOW, fresh_folder, sql
from barloom.plans.registry import query
from barloom.plans.source_queries import chart_bodies
from barloom.streaming import forward, slots as sl, states as st
from barloom.streaming.ingest import PageIngest, feed

T1, T2, OLD = "2024-01-16 21:00:00", "2024-01-24 21:00:00", "2024-01-05 00:00:00"
PAGE = 50
PRICES = [*(f for f in ("open", "high", "low", "close")), *(f"{f}_{s}" for s in ("bid", "ask") for f in ("open", "high", "low", "close"))]
LIMITS = (100_000, "0.5")


def scenario(spark, folder):
    """Samples with their batch (part), page and position."""
    t, time = F.col("time_utc"), lambda s: F.lit(s).cast("timestamp_ntz")
    rows = b.bars(spark, folder).withColumns({c: (F.col(c) + 10).cast("decimal(24,12)") for c in PRICES})
    again = t >= time(T1) - F.expr("interval 12 hours")
    second = (again & (t < time(T2))) | ((F.col("instrument_key") == "error") & (t < time(OLD)))
    third = t >= time(T2) - F.expr("interval 9 hours")
    parts = F.filter(F.array(F.when(t < time(T1), 1), F.when(second, 2), F.when(third, 3)), lambda x: x.isNotNull())
    rows = rows.withColumn("part", F.explode(parts))
    half = F.when((F.col("part") == 2) & (t < time(T1)), F.lit("0.5")).otherwise(F.lit("0")).cast("decimal(4,2)")
    rows = rows.withColumns({c: (F.col(c) + half).cast("decimal(24,12)") for c in PRICES if c.split("_")[0] in ("high", "close")})
    crossed = (F.col("part") == 2) & (F.col("instrument_key") == "click") & (F.col("last_event") % 50 == 7) & (t >= time(T1)) & (t < time(T2) - F.expr("interval 1 day"))
    zero = (F.col("part") == 3) & (F.col("instrument_key") == "purchase") & (F.col("last_event") % 10 == 3)
    rows = rows.withColumns({
        "low_ask": F.when(crossed, F.col("low_ask") - F.lit("0.04").cast("decimal(4,2)")).otherwise(F.col("low_ask")).cast("decimal(24,12)"), "high": F.when(~zero, F.col("high")).otherwise(F.lit(0).cast("decimal(24,12)")),
        "data_version": F.when((F.col("part") == 3) & (F.col("instrument_key") == "view"), 2).otherwise(1).cast("long")})
    from pyspark.sql import Window
    n = F.row_number().over(Window.partitionBy("part", "instrument_key").orderBy("time_utc")) - 1
    rows = rows.withColumn("position", n).withColumn("page", F.floor(F.col("position") / PAGE))
    repeats = F.when((F.col("position") % PAGE == 0) & (F.col("position") > 0), F.array(F.col("page"), F.col("page") - 1)).otherwise(F.array("page"))
    rows = rows.withColumn("page_number", F.explode(repeats))
    # A row that its page repeats is partial the second time.
    second_time = (F.col("position") % PAGE == 0) & (F.col("position") > 0) & (F.col("page_number") == F.col("page"))
    return rows.withColumn("volume", F.when(second_time, 1).otherwise(F.col("volume")))


def ingested(spark, folder):
    """The ingest after all three batches; the stream starts anew from its checkpoint for each."""
    pages = chart_bodies(scenario(spark, folder), F.lit(60)).withColumns({
        "retrieved_utc": F.lit(NOW).cast("timestamp_ntz"), "artifact_relative_path": F.concat_ws("/", "instrument_key", F.col("part").cast("string"), F.col("page_number").cast("string"))})
    base = fresh_folder(spark, "pages-ingest")
    pages.write.parquet(f"{base}/all")
    pages = spark.read.schema(pages.schema).parquet(f"{base}/all")
    ingest = PageIngest(spark, base, b.instruments(spark, folder), b.sessions(spark, folder), *LIMITS)
    for _ in feed(pages, f"{base}/pages", F.col("part"), [1, 2, 3]):
        ingest.run(spark.readStream.schema(pages.schema).parquet(f"{base}/pages"))
    return ingest


def tables(ingest: PageIngest):
    """All tables in one shape."""
    price, text = "decimal(24,12)", lambda *c: F.concat_ws("|", *[F.coalesce(F.col(x).cast("string"), F.lit("-")) for x in c])
    null = lambda kind: F.lit(None).cast(kind)

    def shape(rows, name, v, time, note, **has):
        kinds = {"price_basis": "string", "open": price, "high": price, "low": price, "close": price, "low_bid": price, "low_ask": price, "volume": "bigint", "is_complete": "boolean"}
        have = {c: (F.col(c).cast(k) if c in rows.columns else null(k)).alias(c) for c, k in kinds.items()}
        return rows.select(F.lit(name).alias("table_name"), v.cast("bigint").alias("v"), "instrument_key", time.cast("timestamp_ntz").alias("time_utc"), *have.values(), note.alias("note"))

    none = null("bigint")
    fields = F.array_join(F.transform("violations", lambda x: x["field"]), ",")
    parts = [
        shape(ingest.appended("raw"), "raw", F.col("v"), F.col("time_utc"), text("data_version", "market_trading_state", "delayed_by_minutes")),
        shape(ingest.appended("late"), "late", F.col("v"), F.col("time_utc"), text("data_version")),
        shape(ingest.appended("quarantine"), "quarantine", F.col("v"), F.col("time_utc"), F.concat_ws("|", "error_code", fields)),
        shape(ingest.appended("outcomes"), "outcomes", F.col("v"), F.col("overlap_start_utc"), text("data_status", "status_code", "known_version", "observed_version")),
        shape(ingest.days("curated"), "curated", none, F.col("time_utc"), text("run_id", "quality_status", "data_version")),
        shape(ingest.states(), "states", F.col("run_id"), F.col("latest_complete_utc"), F.concat_ws("|", text("data_status", "status_code", "data_version"), F.date_format("latest_seen_utc", "yyyy-MM-dd HH:mm"), F.size("recent").cast("string"))),
        shape(ingest.days("bars_4h"), "bars_4h", none, F.col("time_utc"), text("actual_slots", "expected_slots", "quality_status", "first_run", "last_run")),
        shape(ingest.days("bars_1d"), "bars_1d", none, F.col("session_date"), text("actual_slots", "expected_slots", "quality_status", "first_run", "last_run"))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


_PLUS = ", ".join(f"CAST({c} + 10 AS DECIMAL(24,12)) AS {c}" for c in PRICES)
_HALF = ", ".join(f"CAST({c} + CASE WHEN time_utc < TIMESTAMP '{T1}' THEN 0.5 ELSE 0 END AS DECIMAL(24,12)) AS {c}" for c in PRICES if c.split("_")[0] in ("high", "close"))
_COLUMNS = "instrument_key, asset_type, calendar_id, verification_status, price_basis, time_utc, " + ", ".join(PRICES) + ", volume, market_trading_state, data_version, is_complete"


def _marked(rows: str) -> str:
    """Rows of a batch with is_complete: not the newest of their series, or an ETF's at the terminal slot of its session on a verified calendar."""
    return f"""(SELECT r.* EXCLUDE (is_complete), time_utc < newest OR (asset_type = 'Etf' AND verification_status = 'VERIFIED' AND EXISTS (SELECT 1 FROM open_sessions s WHERE s.calendar_id = r.calendar_id
    AND r.time_utc = s.open_utc + INTERVAL (CAST(floor((epoch(s.close_utc) - epoch(s.open_utc) - 1) / 3600) AS BIGINT)) HOUR)) AS is_complete
    FROM (SELECT *, max(time_utc) OVER (PARTITION BY instrument_key) AS newest FROM {rows}) r)"""


def _start(rows: str) -> str:
    return f"""(SELECT instrument_key, time_utc AS start FROM (SELECT instrument_key, asset_type, time_utc, row_number() OVER (PARTITION BY instrument_key ORDER BY time_utc DESC) AS n FROM {rows} WHERE is_complete)
    WHERE n = CASE WHEN asset_type = 'FxSpot' THEN 72 ELSE 20 END)"""


def _derived(name: str, bucket: str, time: str, expected: str) -> str:
    return f"""SELECT '{name}' AS table_name, CAST(NULL AS BIGINT) AS v, instrument_key, {time} AS time_utc, price_basis, open, high, low, close, CAST(NULL AS DECIMAL(24,12)) AS low_bid, CAST(NULL AS DECIMAL(24,12)) AS low_ask, volume,
  actual = {expected} AS is_complete, actual || '|' || {expected} || '|' || CASE WHEN verification_status <> 'VERIFIED' THEN 'NOT_EVALUATED' WHEN actual = {expected} THEN 'PASS' ELSE 'WARN' END || '|' || first_run || '|' || last_run AS note
FROM (SELECT instrument_key, price_basis, verification_status, session_date, open_utc, {bucket} AS bucket, any_value(slots) AS slots, arg_min(open, time_utc) AS open, max(high) AS high, min(low) AS low, arg_max(close, time_utc) AS close,
  CAST(sum(volume) AS BIGINT) AS volume, count(*) AS actual, min(run_id) AS first_run, max(run_id) AS last_run FROM held GROUP BY ALL)"""


_PLAIN = "instrument_key, time_utc, price_basis, open, high, low, close, low_bid, low_ask, volume, is_complete"
_NONE = "NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL"
_X01 = f"""WITH base AS (SELECT * REPLACE ({_PLUS}) FROM bars),
a1 AS (SELECT {_COLUMNS} FROM {_marked(f"(SELECT * FROM base WHERE time_utc < TIMESTAMP '{T1}')")}),
q2 AS (SELECT * REPLACE ({_HALF}) FROM base WHERE (time_utc >= TIMESTAMP '{T1}' - INTERVAL 12 HOUR AND time_utc < TIMESTAMP '{T2}') OR (instrument_key = 'error' AND time_utc < TIMESTAMP '{OLD}')),
x2 AS (SELECT * FROM q2 WHERE instrument_key = 'click' AND last_event % 50 = 7 AND time_utc >= TIMESTAMP '{T1}' AND time_utc < TIMESTAMP '{T2}' - INTERVAL 1 DAY),
m2 AS (SELECT {_COLUMNS} FROM {_marked("(SELECT * FROM q2 ANTI JOIN x2 USING (instrument_key, time_utc))")}),
s2 AS {_start("a1")},
a2 AS (SELECT m2.* FROM m2 LEFT JOIN s2 USING (instrument_key) WHERE start IS NULL OR time_utc >= start),
after2 AS (SELECT *, 1 AS run_id FROM a2 UNION ALL SELECT *, 0 FROM a1 ANTI JOIN a2 USING (instrument_key, time_utc)),
q3 AS (SELECT * FROM base WHERE time_utc >= TIMESTAMP '{T2}' - INTERVAL 9 HOUR),
bad AS (SELECT DISTINCT instrument_key FROM q3 WHERE instrument_key = 'purchase' AND last_event % 10 = 3),
m3 AS (SELECT {_COLUMNS} FROM {_marked("q3")} WHERE instrument_key <> 'view' AND instrument_key NOT IN (FROM bad)),
s3 AS {_start("after2")},
a3 AS (SELECT m3.* FROM m3 LEFT JOIN s3 USING (instrument_key) WHERE start IS NULL OR time_utc >= start),
taken AS (SELECT *, 0 AS v FROM a1 UNION ALL SELECT *, 1 FROM a2 UNION ALL SELECT *, 2 FROM a3),
cur AS (SELECT *, 2 AS run_id FROM a3 UNION ALL SELECT * FROM after2 ANTI JOIN a3 USING (instrument_key, time_utc)),
held AS (SELECT c.*, s.session_date, s.open_utc, CAST(ceil((epoch(s.close_utc) - epoch(s.open_utc)) / 3600) AS BIGINT) AS slots FROM cur c JOIN open_sessions s ON s.calendar_id = c.calendar_id
  AND time_utc >= open_utc AND time_utc < close_utc AND CAST(epoch(time_utc) - epoch(open_utc) AS BIGINT) % 3600 = 0 WHERE c.is_complete),
told AS (SELECT 0 AS v, instrument_key, 'ACTIVE|-|-|1' AS note, CAST(NULL AS TIMESTAMP) AS start FROM a1 GROUP BY 2
  UNION ALL SELECT 1, instrument_key, 'ACTIVE|-|1|1', any_value(start) FROM q2 LEFT JOIN s2 USING (instrument_key) GROUP BY 2
  UNION ALL SELECT 2, instrument_key, CASE WHEN instrument_key = 'view' THEN 'STALE_DATA_VERSION|DATA_VERSION_CHANGED_REVIEW_PENDING|1|2' WHEN instrument_key IN (FROM bad) THEN 'BLOCKED_QUALITY|NONPOSITIVE_OHLC|1|1' ELSE 'ACTIVE|-|1|1' END, any_value(start)
    FROM q3 LEFT JOIN s3 USING (instrument_key) GROUP BY 2),
marks AS (SELECT instrument_key, price_basis, max(v) AS run_id, max(time_utc) AS seen, max(time_utc) FILTER (is_complete) AS complete FROM taken GROUP BY ALL),
recents AS (SELECT instrument_key, least(72, count(*)) AS n FROM cur WHERE is_complete GROUP BY 1)
SELECT 'raw' AS table_name, CAST(v AS BIGINT) AS v, {_PLAIN}, '1|Open|15' AS note FROM taken
UNION ALL SELECT 'late', 1, {_PLAIN}, '1' FROM m2 JOIN s2 USING (instrument_key) WHERE time_utc < start
UNION ALL SELECT 'late', 2, {_PLAIN}, '1' FROM m3 JOIN s3 USING (instrument_key) WHERE time_utc < start
UNION ALL SELECT 'quarantine', 1, instrument_key, time_utc, {_NONE}, 'FX_BID_ABOVE_ASK|low' FROM x2
UNION ALL SELECT 'outcomes', v, instrument_key, start, CASE WHEN instrument_key IN ('click', 'view') THEN 'bid_ask_mid' ELSE 'native_ohlc' END, {_NONE[6:]}, note FROM told
UNION ALL SELECT 'curated', NULL, {_PLAIN}, run_id || '|' || CASE WHEN is_complete THEN 'PASS' ELSE 'NOT_EVALUATED' END || '|1' FROM cur
UNION ALL SELECT 'states', run_id, m.instrument_key, complete, price_basis, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, regexp_extract(note, '^([^|]*[|][^|]*)', 1) || '|1|' || strftime(seen, '%Y-%m-%d %H:%M') || '|' || coalesce(n, 0)
  FROM marks m JOIN told ON told.instrument_key = m.instrument_key AND told.v = 2 LEFT JOIN recents ON recents.instrument_key = m.instrument_key
UNION ALL {_derived("bars_4h", "CAST(floor((epoch(time_utc) - epoch(open_utc)) / 14400) AS BIGINT)", "open_utc + INTERVAL (bucket * 4) HOUR", "least(4, slots - bucket * 4)")}
UNION ALL {_derived("bars_1d", "0", "CAST(session_date AS TIMESTAMP)", "slots")}"""


@query("x01_stream_ingest", sql(_X01), shared=True)
def x01(spark, folder):
    return tables(ingested(spark, folder))


# --- watermark states ---------------------------------------------------------------------------

_X03 = f"""WITH q AS (
  SELECT 1 AS part, * FROM bars WHERE time_utc < TIMESTAMP '{T1}'
  UNION ALL SELECT 2, * FROM bars WHERE (time_utc >= TIMESTAMP '{T1}' - INTERVAL 12 HOUR AND time_utc < TIMESTAMP '{T2}') OR (instrument_key = 'error' AND time_utc < TIMESTAMP '{OLD}')
  UNION ALL SELECT 3, * FROM bars WHERE time_utc >= TIMESTAMP '{T2}' - INTERVAL 9 HOUR),
bad AS (SELECT DISTINCT part, instrument_key FROM q WHERE part = 3 AND instrument_key = 'purchase' AND last_event % 10 = 3),
good AS (SELECT * FROM q ANTI JOIN bad USING (part, instrument_key) WHERE part < 3 OR instrument_key <> 'view')
SELECT instrument_key, price_basis, max(time_utc) AS latest_seen_utc, max(time_utc) FILTER (is_complete) AS latest_complete_utc, CAST(1 AS BIGINT) AS data_version, max(run_id) AS run_id,
  CASE WHEN instrument_key = 'view' THEN 'STALE_DATA_VERSION' WHEN instrument_key IN (SELECT instrument_key FROM bad) THEN 'BLOCKED_QUALITY' ELSE 'ACTIVE' END AS data_status,
  CASE WHEN instrument_key = 'view' THEN 'DATA_VERSION_CHANGED_REVIEW_PENDING' WHEN instrument_key IN (SELECT instrument_key FROM bad) THEN 'NONPOSITIVE_OHLC' END AS status_code
FROM good GROUP BY 1, 2"""


@query("x03_watermark_state", sql(_X03))
def x03(spark, folder):
    """The scenario's samples, a page's repeats apart; the stream starts anew from its checkpoint for each part."""
    from barloom.operators.normalize import validate_ohlc
    rows = scenario(spark, folder).where("page_number = page").withColumn("error_code", validate_ohlc(*(F.col(c) for c in ("open", "high", "low", "close"))))
    rows = rows.select("part", "instrument_key", "price_basis", "time_utc", "is_complete", "data_version", "run_id", "error_code")
    base = fresh_folder(spark, "states")
    rows.write.parquet(f"{base}/all")
    rows = spark.read.schema(rows.schema).parquet(f"{base}/all")
    for _ in feed(rows, f"{base}/in", F.col("part"), [1, 2, 3]):
        st.stream_states(spark.readStream.schema(rows.schema).parquet(f"{base}/in"), f"{base}/states", f"{base}/checkpoint")
    return st.latest_states(spark, f"{base}/states", f"{base}/checkpoint")


# --- slots --------------------------------------------------------------------------------------

#: The present at the end of each run.
TICKS = ["2024-01-11 00:00:00", "2024-01-21 00:00:00", "2024-01-29 12:00:00"]
_DELAY = "CASE WHEN asset_type = 'FxSpot' THEN 10 ELSE 3 END"
_X06 = f"""WITH due AS (
  SELECT s.instrument_key, slot_utc, slot_utc + INTERVAL 1 HOUR + INTERVAL ({_DELAY}) MINUTE AS ready_utc, slot_utc + INTERVAL 3 HOUR + INTERVAL ({_DELAY}) MINUTE AS deadline_utc FROM slots s JOIN instruments i USING (instrument_key)),
arrived AS (
  SELECT instrument_key, time_utc, time_utc + INTERVAL 1 HOUR + INTERVAL (CASE last_event % 5 WHEN 1 THEN 31 WHEN 2 THEN 241 ELSE 2 END) MINUTE AS arrived_utc, CASE WHEN last_event % 5 = 3 THEN 'FAILED' ELSE 'PASS' END AS run_status
  FROM bars WHERE is_complete),
clock AS (SELECT TIMESTAMP '{TICKS[-1]}' AS now),
met AS (
  SELECT d.*, a.run_status, a.arrived_utc, coalesce(a.arrived_utc <= ready_utc, false) AS ready, coalesce(a.arrived_utc <= deadline_utc, false) AS timely, now
  FROM due d LEFT JOIN arrived a ON a.instrument_key = d.instrument_key AND a.time_utc = d.slot_utc AND arrived_utc < TIMESTAMP '{TICKS[-1]}', clock)
SELECT instrument_key, slot_utc, CASE WHEN timely AND run_status = 'PASS' THEN 'PASS' WHEN timely THEN 'BLOCKED' WHEN deadline_utc < now THEN 'MISS' WHEN ready_utc < now THEN 'DATA_NOT_READY' ELSE 'PENDING' END AS sla_status,
  NOT ready AND ready_utc < now AS not_ready_in_time, CASE WHEN timely THEN arrived_utc END AS arrived_utc FROM met"""


@query("x06_slot_sla", sql(_X06), shared=True)
def x06_sla(spark, folder):
    """Slots with their limits, and bars that arrive after 2, 31 or 241 minutes, some days at a time; the last run has ticks alone."""
    delay = F.when(F.col("asset_type") == "FxSpot", 60 * cal.FX_DELAY_MINUTES).otherwise(60 * cal.EQUITY_DELAY_MINUTES)
    kinds = b.instruments(spark, folder).select("instrument_key", "asset_type")
    due = cal.complete_slots(b.instruments(spark, folder), b.sessions(spark, folder)).join(kinds, "instrument_key")
    due = due.select("instrument_key", "slot_utc", plus_seconds(plus_hours(F.col("slot_utc"), 1), delay).alias("ready_utc"), plus_seconds(plus_hours(F.col("slot_utc"), 3), delay).alias("deadline_utc"))
    e = F.col("last_event") % 5
    after = F.when(e == 1, 31).when(e == 2, 241).otherwise(2) * 60
    rows = b.bars(spark, folder).where("is_complete").select("instrument_key", "time_utc", plus_seconds(plus_hours(F.col("time_utc"), 1), after).alias("arrived_utc"), F.when(e == 3, "FAILED").otherwise("PASS").alias("run_status"))
    base = fresh_folder(spark, "slots")
    due.write.parquet(f"{base}/due")
    rows.write.parquet(f"{base}/all")
    rows = spark.read.schema(rows.schema).parquet(f"{base}/all")
    partitions = sl.partitions_for(rows.count() + spark.read.schema(due.schema).parquet(f"{base}/due").count())
    time, clock = lambda text: F.lit(text).cast("timestamp_ntz"), F.lit(sl.TICK).alias("instrument_key")
    for before, now in zip([None, *TICKS], [*TICKS, TICKS[-1]]):
        arrived = rows.where((F.col("arrived_utc") < time(now)) & (F.lit(True) if before is None else F.col("arrived_utc") >= time(before)))
        tick = spark.range(1)
        arrived.unionByName(tick.select(clock, time(now).alias("time_utc"), time(now).alias("arrived_utc"), F.lit("PASS").alias("run_status"))).write.mode("append").parquet(f"{base}/in")
        tick.select(clock, time(now).alias("slot_utc"), time(now).alias("ready_utc"), time(now).alias("deadline_utc")).write.mode("append").parquet(f"{base}/due")
        sl.stream_slot_events(spark.readStream.schema(due.schema).parquet(f"{base}/due"), spark.readStream.schema(rows.schema).parquet(f"{base}/in"), f"{base}/events", partitions=partitions)
    return sl.slot_states(spark.read.schema(due.schema).parquet(f"{base}/due").where(F.col("instrument_key") != sl.TICK), sl.slot_events(spark, f"{base}/events"))


# --- forward samples ----------------------------------------------------------------------------

_CODES = """CASE WHEN last_event % 23 = 4 THEN 'HORIZON_NOT_60' WHEN NOT is_complete THEN 'INCOMPLETE_BAR' WHEN last_event % 31 = 5 THEN 'INVALID_CLOSE' WHEN last_event % 37 = 6 THEN 'INVALID_VOLUME'
  WHEN last_event % 41 = 7 THEN 'INVALID_PAYLOAD_SHA256' END"""
_X07 = f"""WITH q AS (SELECT *, {_CODES} AS error_code FROM bars), ok AS (SELECT * FROM q WHERE error_code IS NULL),
twice AS (SELECT * FROM ok WHERE last_event % 2 = 0 OR time_utc < TIMESTAMP '2024-01-20')
SELECT instrument_key, time_utc, open, close, close_bid, CASE WHEN last_event % 11 <> 3 THEN CAST(volume AS DECIMAL(30,8)) END AS volume, data_version, CAST(NULL AS VARCHAR) AS error_code FROM ok
UNION ALL SELECT instrument_key, time_utc, NULL, NULL, NULL, NULL, NULL, error_code FROM q WHERE error_code IS NOT NULL
UNION ALL SELECT instrument_key, time_utc, NULL, NULL, NULL, NULL, NULL, error_code FROM q WHERE error_code IS NOT NULL AND (last_event % 2 = 0 OR time_utc < TIMESTAMP '2024-01-20')
UNION ALL SELECT instrument_key, time_utc, NULL, NULL, NULL, NULL, NULL, 'DUPLICATE_KEY' FROM twice"""


@query("x07_stream_forward_append", sql(_X07))
def x07(spark, folder):
    """Bars as JSON payloads: first those from the 20th on and then all earlier ones; half of the first come again in the second part, and the earlier ones in a third."""
    rows, e = b.bars(spark, folder), F.col("last_event")
    text = lambda c: F.col(c).cast("string").alias(c)
    payload = F.struct(
        F.col("is_complete").cast("string").alias("is_complete"), *[text(c) for c in ("open", "high", "low")], F.when(e % 31 == 5, "n/a").otherwise(F.col("close").cast("string")).alias("close"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in forward._QUOTES],
        F.when(e % 37 == 6, "many").when(e % 11 == 3, "").otherwise(F.col("volume").cast("string")).alias("volume"), "market_trading_state", text("data_version"), F.lit("").alias("delayed_by_minutes"), F.lit("2024-02-01T00:00:00Z").alias("retrieved_at_utc"),
        F.when(e % 41 == 7, "no digest").otherwise(F.sha2(e.cast("string"), 256)).alias("payload_sha256"))
    late = F.col("time_utc") < F.lit("2024-01-20").cast("timestamp_ntz")
    parts = F.when(late, F.array(F.lit(2), F.lit(3))).when(e % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = rows.select("run_id", F.lit(1).cast("long").alias("source_file_id"), "instrument_key", F.when(e % 23 == 4, 240).otherwise(60).alias("horizon_minutes"), "time_utc", "price_basis", F.to_json(payload).alias("payload"), F.explode(parts).alias("part"))
    base = fresh_folder(spark, "forward")
    rows.write.parquet(f"{base}/all")
    rows = spark.read.schema(rows.schema).parquet(f"{base}/all")
    for _ in feed(rows, f"{base}/in", F.col("part"), [1, 2, 3]):
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in").drop("part")
        forward.stream_forward_append(stream, f"{base}/rows", f"{base}/checkpoint", f"{base}/rejects")
    columns = ["instrument_key", "time_utc", "open", "close", "close_bid", "volume", "data_version"]
    types = "instrument_key string, time_utc timestamp_ntz, open decimal(24,12), close decimal(24,12), close_bid decimal(24,12), volume decimal(30,8), data_version bigint"
    kept = forward.forward_rows(spark, f"{base}/rows", types).select(*columns, F.lit(None).cast("string").alias("error_code"))
    refused = spark.read.schema("instrument_key string, time_utc timestamp_ntz, error_code string").parquet(f"{base}/rejects").drop("v")
    return kept.unionByName(refused, allowMissingColumns=True)

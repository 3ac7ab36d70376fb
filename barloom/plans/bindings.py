"""The driver's tables as inputs of the operators, in Spark and (``CTE``) in SQL.

``events`` give hourly bars: the instrument is event_type, a bar's prices are the values of its
events, its volume is their number, its run the day of the month.  FX instruments have bars on the
hour, the others at half past, so that they fit their sessions.  ``NOW`` is a literal.
"""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barloom.functions.times import hour_of, ntz
from barloom.operators import calendar as cal

FX_KEYS = ("click", "view")
NOW = "2024-01-31 00:00:00"


def now() -> Column:
    return F.lit(NOW).cast("timestamp_ntz")


_OWN: list[str] = []
_SHARED: ContextVar[dict | None] = ContextVar("shared", default=None)
_ONLY: ContextVar[str | None] = ContextVar("only", default=None)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, or a temporary one where that is unset, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="spark-bars-"))
        base = _OWN[0]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shared_inputs() -> Iterator[None]:
    """Within it each binding is written once, as Parquet, and read by all parts of a query that need it."""
    token = _SHARED.set({})
    try:
        yield
    finally:
        _SHARED.reset(token)


@contextmanager
def only(key: str) -> Iterator[None]:
    """Within it bars are those of one instrument: the filter stands below everything that is made of them."""
    token = _ONLY.set(key)
    try:
        yield
    finally:
        _ONLY.reset(token)


def _once(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    @functools.wraps(build)
    def rows(spark: SparkSession, folder: str, *args) -> DataFrame:
        written = _SHARED.get()
        if written is None:
            return build(spark, folder, *args)
        key = (build.__name__, folder, _ONLY.get(), *args)
        if key not in written:
            frame, path = build(spark, folder, *args), fresh_folder(spark, build.__name__)
            frame.write.parquet(path)
            written[key] = frame.schema, path
        schema, path = written[key]
        return spark.read.schema(schema).parquet(path)

    return rows


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _attributes() -> dict[str, Column]:
    """What an instrument's name tells of it."""
    fx = F.col("instrument_key").isin(*FX_KEYS)
    return {
        "instrument_id": F.length("instrument_key").cast("long"), "asset_type": F.when(fx, "FxSpot").otherwise("Etf"), "calendar_id": F.when(fx, cal.FX).otherwise(cal.EQUITY),
        "verification_status": F.when(F.col("instrument_key") == "signup", "PENDING").otherwise("VERIFIED")}


def instruments(spark: SparkSession, folder: str) -> DataFrame:
    """One instrument for each event type, numbered by name; where bars are written anyway, their names are those of the events."""
    if _SHARED.get() is None:
        keys = table(spark, folder, "events").select(F.col("event_type").alias("instrument_key"))
    else:
        keys = bars(spark, folder).select("instrument_key")
    return keys.distinct().withColumns(_attributes())


def _placed(spark: SparkSession, folder: str, version: int) -> DataFrame:
    """Events with the instrument and the hour of their bar.  Version 2 has changed values and lacks some events."""
    events = table(spark, folder, "events")
    if (key := _ONLY.get()) is not None:
        events = events.where(F.col("event_type") == key)
    value = F.col("value")
    if version == 2:
        events = events.where("event_id % 101 <> 0")
        value = F.when(F.col("event_id") % 97 == 0, value + 1).otherwise(value)
    half = F.expr("interval 30 minutes")
    ts = ntz(F.col("ts"))
    at = F.when(F.col("event_type").isin(*FX_KEYS), hour_of(ts)).otherwise(hour_of(ts - half) + half)
    return events.select(F.col("event_type").alias("instrument_key"), at.alias("time_utc"), value.alias("value"), "event_id", F.dayofmonth(ts).cast("long").alias("day"))


def hourly(spark: SparkSession, folder: str, version: int = 1) -> DataFrame:
    """Bars without instrument attributes."""
    price = lambda c: c.cast("decimal(24,12)")
    bars = _placed(spark, folder, version).groupBy("instrument_key", "time_utc").agg(
        price(F.min_by("value", "event_id")).alias("open"), price(F.max("value")).alias("high"), price(F.min("value")).alias("low"), price(F.max_by("value", "event_id")).alias("close"),
        F.count("*").alias("volume"), F.min("day").alias("run_id"), F.max("event_id").alias("last_event"))
    return bars.withColumn("data_version", F.lit(version).cast("long"))


@_once
def bars(spark: SparkSession, folder: str, version: int = 1) -> DataFrame:
    """Curated bars: instrument attributes, basis, completeness (all but the newest of a series) and row status."""
    newest = _placed(spark, folder, version).groupBy("instrument_key").agg(F.max("time_utc").alias("newest"))
    fx = F.col("asset_type") == "FxSpot"
    joined = hourly(spark, folder, version).join(newest, "instrument_key").withColumns(_attributes())
    complete = F.col("time_utc") != F.col("newest")
    cents = lambda n: F.lit(n).cast("decimal(4,2)")
    spread, state = cents("0.01"), F.lit("Open")
    if version == 2:
        spread = F.when(F.col("last_event") % 7 == 0, cents("0.02")).otherwise(spread)  # the mid stays
        state = F.when(F.col("last_event") % 13 == 0, "Closed").otherwise(state)
    side = lambda f, s: F.when(fx, (F.col(f) - spread if s == "bid" else F.col(f) + spread).cast("decimal(24,12)")).alias(f"{f}_{s}")
    quotes = [side(f, s) for s in ("bid", "ask") for f in ("open", "high", "low", "close")]
    return joined.select(
        *[c for c in joined.columns if c != "newest"], *quotes, state.alias("market_trading_state"), F.when(fx, "bid_ask_mid").otherwise("native_ohlc").alias("price_basis"), F.lit(60).alias("horizon_minutes"),
        complete.alias("is_complete"), F.when(complete, "PASS").otherwise("NOT_EVALUATED").alias("quality_status"))


def bounds(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").agg(F.min("ts").cast("date").alias("first_date"), F.max("ts").cast("date").alias("last_date"))


@_once
def sessions(spark: SparkSession, folder: str) -> DataFrame:
    days = bounds(spark, folder)
    return cal.equity_sessions(days).unionByName(cal.fx_sessions(days))


def watermarks(spark: SparkSession, folder: str) -> DataFrame:
    rows = bars(spark, folder).groupBy("instrument_key", "price_basis").agg(
        F.max("time_utc").alias("latest_seen_utc"), F.max(F.when(F.col("is_complete"), F.col("time_utc"))).alias("latest_complete_utc"), F.max("data_version").alias("data_version"), F.max("run_id").alias("run_id"))
    return rows.withColumn("data_status", F.when(F.col("instrument_key") == "error", "STALE_DATA_VERSION").otherwise("ACTIVE"))


def _quotes(spread: str) -> str:
    return ", ".join(f"CASE WHEN asset_type = 'FxSpot' THEN CAST({f} {sign} {spread} AS DECIMAL(24,12)) END AS {f}_{s}" for s, sign in (("bid", "-"), ("ask", "+")) for f in ("open", "high", "low", "close"))


# In SQL, January 2024 is five hours behind UTC in New York throughout.
CTE = f"""
instruments AS (
  SELECT DISTINCT event_type AS instrument_key, CAST(length(event_type) AS BIGINT) AS instrument_id,
    CASE WHEN event_type IN ('click', 'view') THEN 'FxSpot' ELSE 'Etf' END AS asset_type,
    CASE WHEN event_type IN ('click', 'view') THEN 'fx' ELSE 'us_equity' END AS calendar_id,
    CASE WHEN event_type = 'signup' THEN 'PENDING' ELSE 'VERIFIED' END AS verification_status
  FROM events),
hourly_events AS (
  SELECT event_type AS instrument_key, value, event_id, CAST(day(ts) AS BIGINT) AS day,
    CASE WHEN event_type IN ('click', 'view') THEN date_trunc('hour', ts)
      ELSE date_trunc('hour', ts - INTERVAL 30 MINUTE) + INTERVAL 30 MINUTE END AS time_utc
  FROM events),
hourly AS (
  SELECT instrument_key, time_utc, CAST(arg_min(value, event_id) AS DECIMAL(24,12)) AS open, CAST(max(value) AS DECIMAL(24,12)) AS high,
    CAST(min(value) AS DECIMAL(24,12)) AS low, CAST(arg_max(value, event_id) AS DECIMAL(24,12)) AS close,
    count(*) AS volume, min(day) AS run_id, max(event_id) AS last_event, CAST(1 AS BIGINT) AS data_version
  FROM hourly_events GROUP BY ALL),
hourly2 AS (
  SELECT instrument_key, time_utc, CAST(arg_min(v, event_id) AS DECIMAL(24,12)) AS open, CAST(max(v) AS DECIMAL(24,12)) AS high,
    CAST(min(v) AS DECIMAL(24,12)) AS low, CAST(arg_max(v, event_id) AS DECIMAL(24,12)) AS close,
    count(*) AS volume, min(day) AS run_id, max(event_id) AS last_event, CAST(2 AS BIGINT) AS data_version
  FROM (SELECT *, CASE WHEN event_id % 97 = 0 THEN value + 1 ELSE value END AS v FROM hourly_events WHERE event_id % 101 <> 0)
  GROUP BY instrument_key, time_utc),
bars AS (
  SELECT h.*, i.* EXCLUDE (instrument_key), {_quotes("0.01")}, 'Open' AS market_trading_state, CASE WHEN asset_type = 'FxSpot' THEN 'bid_ask_mid' ELSE 'native_ohlc' END AS price_basis, 60 AS horizon_minutes,
    time_utc <> max(time_utc) OVER (PARTITION BY h.instrument_key) AS is_complete,
    CASE WHEN time_utc <> max(time_utc) OVER (PARTITION BY h.instrument_key) THEN 'PASS' ELSE 'NOT_EVALUATED' END AS quality_status
  FROM hourly h JOIN instruments i USING (instrument_key)),
bars2 AS (
  SELECT h.*, i.* EXCLUDE (instrument_key), {_quotes("CASE WHEN last_event % 7 = 0 THEN 0.02 ELSE 0.01 END")}, CASE WHEN last_event % 13 = 0 THEN 'Closed' ELSE 'Open' END AS market_trading_state, CASE WHEN asset_type = 'FxSpot' THEN 'bid_ask_mid' ELSE 'native_ohlc' END AS price_basis, 60 AS horizon_minutes,
    time_utc <> max(time_utc) OVER (PARTITION BY h.instrument_key) AS is_complete,
    CASE WHEN time_utc <> max(time_utc) OVER (PARTITION BY h.instrument_key) THEN 'PASS' ELSE 'NOT_EVALUATED' END AS quality_status
  FROM hourly2 h JOIN instruments i USING (instrument_key)),
weekdays AS (
  SELECT CAST(d AS DATE) AS session_date FROM (SELECT unnest(generate_series((SELECT date_trunc('day', min(ts)) FROM events), (SELECT date_trunc('day', max(ts)) FROM events), INTERVAL 1 DAY)) AS d)
  WHERE isodow(d) < 6),
sessions AS (
  SELECT 'us_equity' AS calendar_id, session_date,
    CASE WHEN session_date NOT IN (DATE '2024-01-01', DATE '2024-01-15') THEN CAST(session_date AS TIMESTAMP) + INTERVAL '870 minutes' END AS open_utc,
    CASE WHEN session_date NOT IN (DATE '2024-01-01', DATE '2024-01-15') THEN CAST(session_date AS TIMESTAMP) + INTERVAL 21 HOUR END AS close_utc,
    CASE WHEN session_date NOT IN (DATE '2024-01-01', DATE '2024-01-15') THEN 'OPEN' ELSE 'HOLIDAY' END AS status FROM weekdays
  UNION ALL SELECT 'fx', session_date, CAST(session_date AS TIMESTAMP) - INTERVAL 2 HOUR, CAST(session_date AS TIMESTAMP) + INTERVAL 22 HOUR, 'OPEN' FROM weekdays),
open_sessions AS (SELECT * FROM sessions WHERE status <> 'HOLIDAY'),
slot_bounds AS (
  SELECT i.*, s.* EXCLUDE (calendar_id), CASE WHEN asset_type = 'FxSpot' THEN open_utc + INTERVAL 1 HOUR ELSE open_utc END AS first_slot,
    CASE WHEN asset_type = 'FxSpot' THEN close_utc - INTERVAL 2 HOUR ELSE close_utc - INTERVAL 1 HOUR END AS raw_last
  FROM instruments i JOIN open_sessions s USING (calendar_id)),
slots AS (
  SELECT instrument_key, session_date, unnest(generate_series(first_slot, raw_last, INTERVAL 1 HOUR)) AS slot_utc FROM slot_bounds),
in_session AS (
  SELECT b.*, s.session_date, s.open_utc, s.close_utc FROM bars b JOIN open_sessions s ON s.calendar_id = b.calendar_id
    AND time_utc >= open_utc AND time_utc < close_utc AND CAST(epoch(time_utc) - epoch(open_utc) AS BIGINT) % 3600 = 0),
aligned AS (
  SELECT b.*, s.session_date FROM bars b JOIN slots s ON s.instrument_key = b.instrument_key AND s.slot_utc = b.time_utc WHERE b.is_complete),
eligible AS (
  SELECT *, CAST(floor((epoch(time_utc) - epoch(open_utc)) / 14400) AS BIGINT) AS bucket, CAST(ceil((epoch(close_utc) - epoch(open_utc)) / 3600) AS BIGINT) AS session_slots
  FROM in_session WHERE is_complete AND quality_status = 'PASS'),
bars_4h AS (
  SELECT instrument_key, time_utc, price_basis, open, high, low, close, volume, actual_slots, expected_slots, actual_slots = expected_slots AS is_complete, first_run, last_run,
    CASE WHEN verification_status <> 'VERIFIED' THEN 'NOT_EVALUATED' WHEN actual_slots = expected_slots THEN 'PASS' ELSE 'WARN' END AS quality_status
  FROM (SELECT instrument_key, price_basis, verification_status, open_utc + INTERVAL (bucket * 4) HOUR AS time_utc, arg_min(open, time_utc) AS open, max(high) AS high, min(low) AS low,
      arg_max(close, time_utc) AS close, CAST(sum(volume) AS BIGINT) AS volume, count(*) AS actual_slots, least(4, session_slots - bucket * 4) AS expected_slots, min(run_id) AS first_run, max(run_id) AS last_run
    FROM eligible GROUP BY instrument_key, price_basis, verification_status, open_utc, bucket, session_slots)),
bars_1d AS (
  SELECT instrument_key, session_date, price_basis, open, high, low, close, volume, actual_slots, expected_slots, actual_slots = expected_slots AS is_complete, first_run, last_run,
    CASE WHEN verification_status <> 'VERIFIED' THEN 'NOT_EVALUATED' WHEN actual_slots = expected_slots THEN 'PASS' ELSE 'WARN' END AS quality_status
  FROM (SELECT instrument_key, price_basis, verification_status, session_date, arg_min(open, time_utc) AS open, max(high) AS high, min(low) AS low,
      arg_max(close, time_utc) AS close, CAST(sum(volume) AS BIGINT) AS volume, count(*) AS actual_slots, session_slots AS expected_slots, min(run_id) AS first_run, max(run_id) AS last_run
    FROM eligible GROUP BY instrument_key, price_basis, verification_status, session_date, session_slots)),
watermarks AS (
  SELECT instrument_key, price_basis, max(time_utc) AS latest_seen_utc, max(time_utc) FILTER (is_complete) AS latest_complete_utc, max(data_version) AS data_version, max(run_id) AS run_id,
    CASE WHEN instrument_key = 'error' THEN 'STALE_DATA_VERSION' ELSE 'ACTIVE' END AS data_status
  FROM bars GROUP BY instrument_key, price_basis)
"""


def sql(text: str) -> str:
    """A query over the bindings' names."""
    text = text.strip()
    return f"WITH {CTE.strip()}{', ' + text[5:] if text.upper().startswith('WITH ') else ' ' + text}"


def tree_hash(rows: str, group: str, order: str, row: str, each: int, fanout: int, levels: int = 4) -> str:
    """CTEs whose last, ``tree``, has the group, its rows and the root of its tree of hashes (``operators.digests``)."""
    out = [f"""ordered_rows AS (SELECT {group} AS g, {row} AS j, row_number() OVER (PARTITION BY {group} ORDER BY {order}) - 1 AS n FROM {rows})""",
           f"""level0 AS (SELECT g, n // {each} AS place, sha256('[' || string_agg(j, ',' ORDER BY n) || ']') AS d FROM ordered_rows GROUP BY 1, 2)"""]
    for k in range(1, levels + 1):
        out.append(f"level{k} AS (SELECT g, place // {fanout} AS place, sha256(string_agg(d, ',' ORDER BY place)) AS d FROM level{k - 1} GROUP BY 1, 2)")
    alone = " UNION ALL ".join(f"SELECT g, {k} AS level, any_value(d) AS d FROM level{k} GROUP BY g HAVING count(*) = 1" for k in range(1, levels + 1))
    out.append(f"tree AS (SELECT g AS {group}, rows, d AS content_sha256 FROM (SELECT g, arg_min(d, level) AS d FROM ({alone}) GROUP BY g) JOIN (SELECT g, count(*) AS rows FROM ordered_rows GROUP BY g) USING (g))")
    return ", ".join(out)

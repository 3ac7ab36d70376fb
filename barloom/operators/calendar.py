"""Trading calendars: holidays, sessions, slots and schedules as column expressions.

Session tables have calendar_id, session_date, open_utc, close_utc and status (HOLIDAY rows have no times).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.functions.times import from_new_york, hour_of, new_york, ntz, plus_hours, plus_seconds, seconds_between

EQUITY, FX = "us_equity", "fx"
# Closures outside the yearly rules.
EXCEPTIONAL_CLOSURES = ("2012-10-29", "2012-10-30", "2018-12-05", "2025-01-09")
JUNETEENTH_FROM = 2022
#: Minutes after the end of a slot at which its bar is due.
FX_DELAY_MINUTES, EQUITY_DELAY_MINUTES = 10, 3


def _weekday(d: Column) -> Column:
    """0 for Monday to 6 for Sunday."""
    return F.weekday(d)


def _observed(d: Column) -> Column:
    return F.when(_weekday(d) == 5, F.date_sub(d, 1)).when(_weekday(d) == 6, F.date_add(d, 1)).otherwise(d)


def _nth(year: Column, month: int, weekday: int, n: int) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    return F.date_add(first, F.pmod(F.lit(weekday) - _weekday(first), F.lit(7)) + 7 * (n - 1))


def _last(year: Column, month: int, weekday: int) -> Column:
    end = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    return F.date_sub(end, F.pmod(_weekday(end) - weekday, F.lit(7)))


def easter(year: str) -> Column:
    """Easter Sunday by Oudin's rule, in integer arithmetic."""
    y, c, g = year, f"({year} div 100)", f"({year} % 19)"
    h = f"(({c} - {c} div 4 - (8 * {c} + 13) div 25 + 19 * {g} + 15) % 30)"
    i = f"({h} - ({h} div 28) * (1 - ({h} div 28) * (29 div ({h} + 1)) * ((21 - {g}) div 11)))"
    j = f"(({y} + {y} div 4 + {i} + 2 - {c} + {c} div 4) % 7)"
    return F.expr(f"date_add(make_date({y}, 3, 28), cast({i} - {j} as int))")


def _closed() -> Column:
    """Holiday dates of all rules for the column ``year``."""
    y = F.col("year")
    rules = [
        _observed(F.make_date(y, F.lit(1), F.lit(1))), _nth(y, 1, 0, 3), _nth(y, 2, 0, 3), F.date_sub(easter("year"), 2), _last(y, 5, 0),
        F.when(y >= JUNETEENTH_FROM, _observed(F.make_date(y, F.lit(6), F.lit(19)))), _observed(F.make_date(y, F.lit(7), F.lit(4))),
        _nth(y, 9, 0, 1), _nth(y, 11, 3, 4), _observed(F.make_date(y, F.lit(12), F.lit(25))),
    ]
    extra = [F.when(F.year(F.lit(d).cast("date")) == y, F.lit(d).cast("date")) for d in EXCEPTIONAL_CLOSURES]
    return F.array_compact(F.array(*rules, *extra))


def equity_holidays(years: DataFrame) -> DataFrame:
    """holiday_date of every rule for the distinct values of ``year``; a New Year's Day may be observed in the year before."""
    return years.select(F.col("year").cast("int")).distinct().select(F.explode(_closed()).alias("holiday_date")).distinct()


def _weekday_before(d: Column) -> Column:
    return F.date_sub(d, F.when(_weekday(d) == 0, 3).when(_weekday(d) == 6, 2).otherwise(1))


def _short() -> Column:
    """Candidates of short days for the column ``year``; weekends and holidays among them don't count."""
    y = F.col("year")
    return F.array(F.date_add(_nth(y, 11, 3, 4), 1), *[_weekday_before(_observed(F.make_date(y, F.lit(m), F.lit(d)))) for m, d in ((12, 25), (7, 4))])


def equity_short_sessions(years: DataFrame) -> DataFrame:
    """short_date: the day after Thanksgiving and the weekdays before observed Christmas and Independence Day, unless holidays."""
    y = F.col("year")
    wanted = years.select(F.col("year").cast("int")).distinct().select(F.explode(_short()).alias("short_date")).distinct()
    around = years.select(F.explode(F.array(y - 1, y, y + 1)).alias("year"))
    return wanted.where(_weekday(F.col("short_date")) < 5).join(equity_holidays(around), F.col("short_date") == F.col("holiday_date"), "left_anti")


def weekdays(bounds: DataFrame) -> DataFrame:
    """session_date of all weekdays from first_date to last_date of a one-row frame."""
    days = bounds.select(F.explode(F.expr("sequence(first_date, last_date, interval 1 day)")).alias("session_date"))
    return days.where(_weekday(F.col("session_date")) < 5)


def _at(d: Column, hour: int, minute: int = 0) -> Column:
    return from_new_york(ntz(d) + F.expr(f"interval {hour} hours {minute} minutes"))


def equity_sessions(bounds: DataFrame) -> DataFrame:
    """Sessions 09:30-16:00 in New York (13:00 on short days) for the weekdays of ``bounds`` (one row)."""
    years = bounds.select(F.explode(F.sequence(F.year("first_date") - 1, F.year("last_date") + 1)).alias("year"))
    rules = years.select(_closed().alias("c"), _short().alias("s")).agg(F.flatten(F.collect_list("c")).alias("closed"), F.flatten(F.collect_list("s")).alias("short"))
    marked = weekdays(bounds).crossJoin(F.broadcast(rules))  # one row: the dates of a few years
    d = F.col("session_date")
    holiday = F.array_contains("closed", d)
    early = F.array_contains("short", d) & ~holiday
    return marked.select(
        F.lit(EQUITY).alias("calendar_id"), d, F.when(~holiday, _at(d, 9, 30)).alias("open_utc"),
        F.when(~holiday, F.when(early, _at(d, 13)).otherwise(_at(d, 16))).alias("close_utc"),
        F.when(holiday, "HOLIDAY").when(early, "SHORT_SESSION").otherwise("OPEN").alias("status"))


def fx_sessions(bounds: DataFrame) -> DataFrame:
    """Sessions from 17:00 New York of the day before to 17:00 of each weekday (the session's date)."""
    d = F.col("session_date")
    return weekdays(bounds).select(F.lit(FX).alias("calendar_id"), d, _at(F.date_sub(d, 1), 17).alias("open_utc"), _at(d, 17).alias("close_utc"), F.lit("OPEN").alias("status"))


def _is_fx() -> Column:
    return F.col("asset_type") == "FxSpot"


def first_slot() -> Column:
    return F.when(_is_fx(), plus_hours(hour_of(F.col("open_utc")), 1)).otherwise(F.col("open_utc"))


def last_slot() -> Column:
    return F.when(_is_fx(), plus_hours(hour_of(F.col("close_utc")), -2)).otherwise(plus_hours(F.col("close_utc"), -1))


def open_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.where("status <> 'HOLIDAY'")


def expected_slots(sessions: DataFrame) -> DataFrame:
    """calendar_id, session_date, slot_utc: each hour from the open to a minute before the close."""
    return open_sessions(sessions).select("calendar_id", "session_date", F.explode(F.expr("sequence(open_utc, close_utc - interval 1 minute, interval 60 minutes)")).alias("slot_utc"))


def complete_slots(instruments: DataFrame, sessions: DataFrame) -> DataFrame:
    """instrument_key, session_date, slot_utc of all whole-hour slots (FX without the hours at both ends)."""
    joined = instruments.join(open_sessions(sessions), "calendar_id").select("instrument_key", "session_date", first_slot().alias("a"), last_slot().alias("b"))
    return joined.where("b >= a").select("instrument_key", "session_date", F.explode(F.expr("sequence(a, b, interval 1 hour)")).alias("slot_utc"))


def expected_rows(actual: DataFrame, sessions: DataFrame) -> DataFrame:
    """instrument_key, price_basis, expected_rows: slots between the first and last bar, counted without expanding them."""
    a, b, lo, hi = first_slot(), last_slot(), F.col("min_time_utc"), F.col("max_time_utc")
    last = F.floor(F.least(seconds_between(a, b), seconds_between(a, hi)) / 3600)
    begin = F.greatest(F.lit(0), F.ceil(seconds_between(a, lo) / 3600))
    joined = actual.join(open_sessions(sessions), "calendar_id").where((b >= lo) & (a <= hi))
    return joined.groupBy("instrument_key", "price_basis").agg(F.sum(F.greatest(last - begin + 1, F.lit(0))).cast("long").alias("expected_rows"))


def session_date_of(time: Column) -> Column:
    """Equity: the local date in New York.  FX: local time less 17 hours, and the next day."""
    local = new_york(time)
    return F.when(_is_fx(), F.date_add((local - F.expr("interval 17 hours")).cast("date"), 1)).otherwise(local.cast("date"))


def align_range(bars: DataFrame, sessions: DataFrame) -> DataFrame:
    """Bars with the session that holds them: open <= time < close, a whole number of hours after the open.

    A session holds only times of its own session date, so dates are the join's key and the range is a residual.
    """
    keyed = bars.withColumn("session_date", session_date_of(F.col("time_utc")))
    joined = keyed.join(open_sessions(sessions), ["calendar_id", "session_date"])
    t = F.col("time_utc")
    return joined.where((t >= F.col("open_utc")) & (t < F.col("close_utc")) & (seconds_between(F.col("open_utc"), t) % 3600 == 0))


def align_date(bars: DataFrame, sessions: DataFrame) -> DataFrame:
    """Complete bars whose whole hour lies in the trimmed session of their date."""
    keyed = bars.where("is_complete").withColumn("session_date", session_date_of(F.col("time_utc")))
    joined = keyed.join(open_sessions(sessions), ["calendar_id", "session_date"])
    t = F.col("time_utc")
    fx = (t >= first_slot()) & (t <= last_slot()) & (t == hour_of(t))
    other = (t >= F.col("open_utc")) & (plus_hours(t, 1) <= F.col("close_utc")) & (seconds_between(F.col("open_utc"), t) % 3600 == 0)
    return joined.where(F.when(_is_fx(), fx).otherwise(other))


def expected_slot_at(instruments: DataFrame, sessions: DataFrame, now: Column) -> DataFrame:
    """instrument_key, latest_expected_utc and next_expected_utc at the time ``now``."""
    joined = instruments.join(open_sessions(sessions), "calendar_id").withColumn("a", first_slot()).withColumn("raw", last_slot())
    cutoff = F.when(_is_fx(), plus_seconds(now, F.lit(-3600 - 60 * FX_DELAY_MINUTES))).otherwise(plus_seconds(now, F.lit(-3600 - 60 * EQUITY_DELAY_MINUTES)))
    joined = joined.withColumn("cutoff", cutoff).withColumn("b", plus_hours(F.col("a"), F.floor(seconds_between(F.col("a"), F.col("raw")) / 3600)))
    a, b, c = F.col("a"), F.col("b"), F.col("cutoff")
    at = plus_hours(a, F.floor(seconds_between(a, c) / 3600))
    latest = F.when(c >= a, F.least(b, at))
    following = F.when(c < a, a).when(c < b, plus_hours(at, 1))
    return joined.groupBy("instrument_key").agg(F.max(latest).alias("latest_expected_utc"), F.min(following).alias("next_expected_utc"))


def contained_hours(sessions: DataFrame, align_hour: bool, delay_minutes: int = 0, lead_minutes: int = 0) -> DataFrame:
    """Hour starts whose whole hour fits in a session, from its open plus a delay to its close less a lead."""
    begin = plus_seconds(F.col("open_utc"), F.lit(60 * delay_minutes))
    if align_hour:
        begin = F.when(begin == hour_of(begin), begin).otherwise(plus_hours(hour_of(begin), 1))
    stop = plus_seconds(F.col("close_utc"), F.lit(-3600 - 60 * lead_minutes))
    some = open_sessions(sessions).select("calendar_id", "session_date", begin.alias("a"), stop.alias("b")).where("b >= a")
    return some.select("calendar_id", "session_date", F.explode(F.expr("sequence(a, b, interval 1 hour)")).alias("hour_utc"))


def completed_sessions(sessions: DataFrame, now: Column) -> DataFrame:
    """calendar_id, sessions, latest_session_date of the sessions closed at ``now``."""
    closed = open_sessions(sessions).where(F.col("close_utc") <= now)
    return closed.groupBy("calendar_id").agg(F.count("*").alias("sessions"), F.max("session_date").alias("latest_session_date"))


def terminal_slot() -> Column:
    return plus_hours(F.col("open_utc"), F.floor((seconds_between(F.col("open_utc"), F.col("close_utc")) - 1) / 3600))


def previous_terminal(sessions: DataFrame) -> DataFrame:
    """calendar_id, session_date, previous_terminal_utc: the last slot of the session before."""
    w = Window.partitionBy("calendar_id").orderBy("close_utc")
    return open_sessions(sessions).select("calendar_id", "session_date", F.lag(terminal_slot()).over(w).alias("previous_terminal_utc"))


def calendar_status(sessions: DataFrame, instruments: DataFrame) -> DataFrame:
    """calendar_id, intervals and instruments of each calendar."""
    held = instruments.groupBy("calendar_id").agg(F.count_distinct("instrument_key").alias("instruments"))
    return sessions.groupBy("calendar_id").agg(F.count_distinct("session_date").alias("intervals")).join(held, "calendar_id", "left").select(
        "calendar_id", "intervals", F.coalesce("instruments", F.lit(0)).alias("instruments"))


def calendar_digest(sessions: DataFrame) -> DataFrame:
    """calendar_id and the SHA-256 of its ordered sessions as JSON (a calendar's sessions are few)."""
    rows = F.array_sort(F.collect_list(F.struct("session_date", "open_utc", "close_utc", "status")))
    return sessions.groupBy("calendar_id").agg(F.sha2(F.to_json(rows), 256).alias("digest"))


def lagging(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Series of ``expected`` (instrument_key, expected_utc) with their observed_utc and DATA_NOT_READY or READY."""
    joined = expected.join(observed, "instrument_key", "left")
    late = F.col("observed_utc").isNull() | (F.col("observed_utc") < F.col("expected_utc"))
    return joined.select("instrument_key", "expected_utc", "observed_utc", F.when(late, "DATA_NOT_READY").otherwise("READY").alias("readiness"))

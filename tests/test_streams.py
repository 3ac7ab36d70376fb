"""Streams on literal rows: replays, restarts, late data, what a batch reads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.operators import events as ev, normalize as nz
from barloom.plans import ingest_queries as iq
from barloom.streaming import forward, slots as sl, states as st
from tests.conftest import SMALL


def at(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def ingest(spark):
    return iq.ingested(spark, SMALL)


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def test_ingest_fills_every_table(ingest):
    kinds = {(r.table_name, r.v) for r in iq.tables(ingest).select("table_name", "v").distinct().collect()}
    assert {"raw", "late", "quarantine", "outcomes", "curated", "states", "bars_4h", "bars_1d"} == {k for k, _ in kinds}
    assert {r.data_status for r in ingest.states().collect()} == {"ACTIVE", "STALE_DATA_VERSION", "BLOCKED_QUALITY"}
    assert {r.v for r in ingest.appended("raw").select("v").distinct().collect()} == {0, 1, 2}


def test_a_batch_that_runs_again_changes_nothing(spark, ingest):
    before = rows_of(iq.tables(ingest))
    pages = spark.read.parquet(f"{ingest.folder}/pages").where("part = 3")
    ingest.step(pages, 2)
    assert rows_of(iq.tables(ingest)) == before


def test_an_uncommitted_batch_is_not_read(spark, ingest):
    before = rows_of(iq.tables(ingest))
    ingest.step(spark.read.parquet(f"{ingest.folder}/pages").where("part = 2"), 3)
    assert rows_of(iq.tables(ingest)) == before


SAMPLE = "instrument_key string, page_number int, position int, time_utc timestamp_ntz, time_text string, volume decimal(30,8), volume_text string, error_code string, " + ", ".join(
    f"{f} decimal(24,12)" for f in (*nz.FIELDS, *(f"{f}_{s}" for s in ("bid", "ask") for f in nz.FIELDS)))


def sample(key, quotes, time="2024-01-01T10:00:00Z", volume="1", native=None):
    from decimal import Decimal

    price = lambda v: None if v is None else Decimal(str(v))
    return (key, 1, 0, None, time, price(volume) if volume and volume.isdigit() else None, volume, None, *map(price, native or [None] * 4), *map(price, quotes or [None] * 8))


@pytest.mark.parametrize("row,code", [
    (sample("fx", [1, 3, 1, 2, 2, 4, 2, 3]), None), (sample("fx", [1, 3, 1, 2, 2, 4, 2, None]), "INVALID_CLOSEASK"), (sample("fx", [1, 5, 1, 2, 2, 4, 2, 3]), "FX_BID_ABOVE_ASK"), (sample("fx", [0, 3, 0, 2, 2, 4, 2, 3]), "NONPOSITIVE_OHLC"),
    (sample("fx", None, native=[1, 2, 1, 2]), "INVALID_OPENBID"), (sample("etf", None, native=[1, 2, 1, 2]), None), (sample("etf", [1] * 8), "INVALID_OPEN"), (sample("etf", None, native=[1, 2, 1, 3]), "OHLC_VIOLATION"),
    (sample("etf", None, native=[1, 2, 1, 2], time="2024-01-01T10:00:00"), "TIME_NOT_UTC"), (sample("etf", None, native=[1, 2, 1, 2], volume="x"), "INVALID_VOLUME"), (sample("etf", None, native=[1, 2, 1, 2], volume=None), None), (sample("other", None), "UNKNOWN_INSTRUMENT")])
def test_samples(spark, row, code):
    known = spark.createDataFrame([("fx", "FxSpot"), ("etf", "Etf")], "instrument_key string, asset_type string")
    got = nz.normalize_samples(spark.createDataFrame([row], SAMPLE), known).first()
    assert got.error_code == code
    if code is None:
        assert (got.open_bid is None) == (row[0] == "etf") and float(got.close) == (2.5 if row[0] == "fx" else 2.0)


def test_crossed_opens_are_never_set_aside(spark):
    known = spark.createDataFrame([("fx", "FxSpot")], "instrument_key string, asset_type string")
    rows = spark.createDataFrame([sample("fx", [1, 5, 1, 2, 2, 4, 2, 3]), sample("fx", [3, 5, 1, 2, 2, 5, 2, 3])], SAMPLE)
    got = nz.normalize_samples(rows, known).select(F.array_join(F.transform("violations", lambda v: v["field"]), ",").alias("f"), nz.quarantinable().alias("q")).collect()
    assert {(r.f, r.q) for r in got} == {("high", True), ("open", False)}


def test_fx_terminal_bar_stays_incomplete(spark):
    sessions = spark.createDataFrame([("c", dt.date(2024, 1, 10), at("2024-01-10 14:30:00"), at("2024-01-10 21:00:00"), "OPEN")], "calendar_id string, session_date date, open_utc timestamp_ntz, close_utc timestamp_ntz, status string")
    rows = spark.createDataFrame([(k, kind, "c", dt.date(2024, 1, 10), at(t), False, "VERIFIED") for k, kind, t in (("a", "Etf", "2024-01-10 20:30:00"), ("b", "FxSpot", "2024-01-10 20:30:00"), ("c", "Etf", "2024-01-10 19:30:00"))],
                                 "instrument_key string, asset_type string, calendar_id string, session_date date, time_utc timestamp_ntz, is_complete boolean, verification_status string")
    got = nz.finalize_terminal(rows, sessions, F.lit("2024-01-10 21:15:00").cast("timestamp_ntz"), F.lit(15)).collect()
    assert {r.instrument_key: r.is_complete for r in got} == {"a": True, "b": False, "c": False}


def test_first_later_mark_over_blocks(spark):
    points = [("a", n) for n in (0, 3, 9, 10, 250, 251, 1000)] + [("b", 5), ("c", 1)]
    marks = [("a", n) for n in (3, 10, 251, 252)] + [("b", 5), ("b", 900)]
    frame = lambda rows: spark.createDataFrame(rows, "k string, n long")
    want = {(k, n): min((m for j, m in marks if j == k and m > n), default=None) for k, n in points}
    for each in (1, 10, 4096):
        got = {(r.k, r.n): r.next for r in ev.first_later(frame(points), frame(marks), "k", "n", "next", each).collect()}
        assert got == {k: v for k, v in want.items() if v is not None}


def test_an_event_is_reviewed_once(spark):
    status = spark.createDataFrame([(1, "a", 1, "atomic_run_gate", "OPEN", "CURRENT", "INSTRUMENT"), (2, None, 2, "atomic_run_gate", "OPEN", "UNKNOWN", "RUN"), (3, "b", 7, "atomic_run_gate", "OPEN", "CURRENT", "INSTRUMENT")],
                                   "event_id long, instrument_key string, run_id long, rule_id string, status string, applicability string, scope_kind string")
    scope = spark.createDataFrame([(2, "b"), (2, "c"), (4, "a"), (5, "b"), (6, "a"), (6, "c"), (7, "b")], "run_id long, instrument_key string")
    passed = spark.createDataFrame([(4,), (5,), (6,), (7,)], "run_id long")
    assert sorted((r.event_id, r.superseded_by) for r in ev.supersede(status, scope, passed).collect()) == [(1, 4), (2, 5)]


def test_states_outlive_a_restart(spark, tmp_path):
    schema = "instrument_key string, price_basis string, time_utc timestamp_ntz, is_complete boolean, data_version long, run_id long, error_code string"
    row = lambda key, day, version=1, error=None, run=1: (key, "native_ohlc", at(f"2024-01-{day:02} 10:00:00"), True, version, run, error)
    batches = [
        [row("a", 1), row("a", 2), row("b", 2)], [row("a", 3, error="OHLC_VIOLATION"), row("b", 3, version=2)], [row("c", 3)], [row("a", 4, run=9), row("b", 4)], [row("b", 5), row("b", 6, version=3)]]
    want = [("ACTIVE", 2, 1), ("BLOCKED_QUALITY", 2, 1), ("BLOCKED_QUALITY", 2, 1), ("ACTIVE", 4, 9), ("ACTIVE", 4, 9)]
    other = [("ACTIVE", 2), ("STALE_DATA_VERSION", 2), ("STALE_DATA_VERSION", 2), ("ACTIVE", 4), ("BLOCKED_QUALITY", 4)]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
        st.stream_states(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        got = {r.instrument_key: r for r in st.latest_states(spark, str(tmp_path / "out"), str(tmp_path / "checkpoint")).collect()}
        assert (got["a"].data_status, got["a"].latest_seen_utc.day, got["a"].run_id) == want[k]
        assert (got["b"].data_status, got["b"].latest_complete_utc.day) == other[k]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "HDFS").find("Rocks") < 0


def test_slots_timely_late_missing_and_ahead(spark, tmp_path):
    due = "instrument_key string, slot_utc timestamp_ntz, ready_utc timestamp_ntz, deadline_utc timestamp_ntz"
    came = "instrument_key string, time_utc timestamp_ntz, arrived_utc timestamp_ntz, run_status string"
    hour = lambda h, m=0: at(f"2024-01-01 {h:02}:{m:02}:00")
    slots = [(k, hour(h), hour(h + 1, 10), hour(h + 3)) for k, h in (("timely", 1), ("slow", 1), ("late", 1), ("failed", 1), ("missing", 1), ("waiting", 8), ("ahead", 12))]
    batches = [
        (slots, [("timely", hour(1), hour(2, 5), "PASS"), ("slow", hour(1), hour(3, 5), "PASS"), ("failed", hour(1), hour(2, 1), "FAILED")], hour(3, 30)),
        ([], [("late", hour(1), hour(5), "PASS")], hour(6)), ([], [], hour(10))]
    batches.append(([], [], hour(10)))
    for some, arrived, now in batches:
        spark.createDataFrame([*some, (sl.TICK, now, now, now)], due).write.mode("append").parquet(str(tmp_path / "due"))
        spark.createDataFrame([*arrived, (sl.TICK, now, now, "PASS")], came).write.mode("append").parquet(str(tmp_path / "in"))
        sl.stream_slot_events(spark.readStream.schema(due).parquet(str(tmp_path / "due")), spark.readStream.schema(came).parquet(str(tmp_path / "in")), str(tmp_path / "events"))
    got = {r.instrument_key: (r.sla_status, r.not_ready_in_time) for r in sl.slot_states(spark.createDataFrame(slots, due), sl.slot_events(spark, str(tmp_path / "events"))).collect()}
    assert got == {"timely": ("PASS", False), "slow": ("PASS", True), "late": ("MISS", True), "failed": ("BLOCKED", False), "missing": ("MISS", True), "waiting": ("DATA_NOT_READY", True), "ahead": ("PENDING", False)}


def test_forward_reads_only_days_that_may_hold_its_keys(spark, tmp_path):
    schema = "run_id bigint, instrument_key string, time_utc timestamp_ntz, price_basis string, horizon_minutes int, is_complete boolean, close int"
    row = lambda key, day, hour: (1, key, at(f"2024-01-{day:02} {hour:02}:00:00"), "b", 60, True, hour)
    out = str(tmp_path / "rows")
    batches = [[row(k, day, h) for k in "abc" for day in (1, 2, 3) for h in range(24)], [row("d", 2, h) for h in range(24)], [row("a", 2, 5), row("e", 3, 1), row("e", 9, 1)]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
        if k == 2:
            new = spark.createDataFrame(rows, schema).withColumn("bar_day", F.to_date("time_utc"))
            found = forward.stored_keys(new, out, 2)
            assert {f.split("rows/")[1].rsplit("/", 1)[0] for f in found.inputFiles()} == {"v=0/bar_day=2024-01-02"}  # of six days in two versions
        forward.stream_forward_append(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), out, str(tmp_path / "checkpoint"), str(tmp_path / "rejects"))
    assert forward.forward_rows(spark, out, schema).count() == 3 * 3 * 24 + 24 + 2
    again = forward.may_hold(new, spark.read.schema(forward.FILTERS).parquet(f"{out}-keys"))
    assert {(r.v, str(r.bar_day)) for r in again.collect()} >= {(0, "2024-01-02"), (2, "2024-01-03"), (2, "2024-01-09")}


@pytest.mark.parametrize("payload,code", [
    ('{"is_complete":"true"}', "INVALID_OPEN"), ('{"is_complete":"false"}', "INCOMPLETE_BAR"), ("no json", "INVALID_PAYLOAD"), ("{}", "INVALID_PAYLOAD"), ('{"is_complete":true,"open":1,"high":"2","low":1,"close":"1e0","retrieved_at_utc":"2024-01-01T00:00:00Z","payload_sha256":"%s"}' % ("a" * 64), None),
    ('{"is_complete":true,"open":1,"high":2,"low":1,"close":1,"volume":"","open_bid":"x","retrieved_at_utc":"2024-01-01","payload_sha256":"%s"}' % ("a" * 64), "INVALID_OPEN_BID"),
    ('{"is_complete":true,"open":1,"high":2,"low":1,"close":1,"retrieved_at_utc":"2024-01-01","payload_sha256":"A"}', "INVALID_PAYLOAD_SHA256")])
def test_payload_casts(spark, payload, code):
    rows = spark.createDataFrame([(1, 1, "a", 60, at("2024-01-01 00:00:00"), "b", payload)], "run_id long, source_file_id long, instrument_key string, horizon_minutes int, time_utc timestamp_ntz, price_basis string, payload string")
    got = forward.parse_payload(rows).first()
    assert got.error_code == code
    if code is None:
        assert float(got.close) == 1.0 and got.volume is None and got.retrieved_at_utc == at("2024-01-01 00:00:00")

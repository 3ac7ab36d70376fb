"""Decision tables and edge cases of the bar engine on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.operators import calendar as cal, events as ev, gaps, impute, merge, normalize as nz, publish, receipts, reports, revisions, total_return
from barloom.sources import files
from barloom.streaming import bars as st, forward


def at(text):
    return dt.datetime.fromisoformat(text)


def sessions_of(spark, first, last, make):
    bounds = spark.createDataFrame([(dt.date.fromisoformat(first), dt.date.fromisoformat(last))], "first_date date, last_date date")
    return {r.session_date.isoformat(): r for r in make(bounds).collect()}


def test_sessions_follow_daylight_saving(spark):
    fx = sessions_of(spark, "2026-03-06", "2026-03-09", cal.fx_sessions)
    assert fx["2026-03-06"].close_utc == at("2026-03-06 22:00:00")
    assert fx["2026-03-09"].open_utc == at("2026-03-08 21:00:00") and fx["2026-03-09"].close_utc == at("2026-03-09 21:00:00")
    us = sessions_of(spark, "2026-03-06", "2026-03-09", cal.equity_sessions)
    assert us["2026-03-06"].open_utc == at("2026-03-06 14:30:00") and us["2026-03-09"].open_utc == at("2026-03-09 13:30:00")


@pytest.mark.parametrize("day,status", [("2021-12-31", "HOLIDAY"), ("2022-06-20", "HOLIDAY"), ("2021-06-18", "OPEN"), ("2018-12-05", "HOLIDAY"), ("2024-11-29", "SHORT_SESSION"), ("2024-03-29", "HOLIDAY"), ("2023-07-03", "SHORT_SESSION"), ("2024-12-24", "SHORT_SESSION")])
def test_holidays_and_short_days(spark, day, status):
    row = sessions_of(spark, day, day, cal.equity_sessions)[day]
    assert row.status == status
    assert (row.open_utc is None) == (status == "HOLIDAY")
    if status == "SHORT_SESSION":
        assert (row.close_utc - row.open_utc) == dt.timedelta(hours=3, minutes=30)


def test_closed_form_counts_as_the_slots_do(spark):
    sessions = cal.equity_sessions(spark.createDataFrame([(dt.date(2024, 11, 25), dt.date(2024, 12, 5))], "first_date date, last_date date"))
    series = spark.createDataFrame([("a", "Etf", cal.EQUITY, "native_ohlc", at("2024-11-26 15:40:00"), at("2024-12-04 16:30:00"))], "instrument_key string, asset_type string, calendar_id string, price_basis string, min_time_utc timestamp_ntz, max_time_utc timestamp_ntz")
    expanded = cal.complete_slots(series, sessions).where("slot_utc between timestamp_ntz '2024-11-26 15:40:00' and timestamp_ntz '2024-12-04 16:30:00'").count()
    assert cal.expected_rows(series, sessions).first().expected_rows == expanded > 0


def test_unknown_verification_is_not_unverified(spark):
    from barloom.operators.bars import grade_derived

    rows = spark.createDataFrame([(None, 4, 4), (None, 3, 4), ("PENDING", 4, 4)], "verification_status string, a int, e int")
    assert [r[0] for r in rows.select(grade_derived(F.col("a"), F.col("e"))).collect()] == ["PASS", "WARN", "NOT_EVALUATED"]


def test_first_seen_wins(spark):
    rows = spark.createDataFrame([("a", at("2024-01-01 10:00:00"), 2, 0, 9.0), ("a", at("2024-01-01 10:00:00"), 1, 5, 1.0)], "instrument_key string, time_utc timestamp_ntz, page_number int, position int, close double")
    assert [r.close for r in merge.merge_pages(rows).collect()] == [1.0]


@pytest.mark.parametrize("o,h,l,c,code", [(1, 2, 1, 2, None), (0, 2, 0, 1, "NONPOSITIVE_OHLC"), (2, 1, 1, 1, "OHLC_VIOLATION"), (1, 2, 1.5, 2, "OHLC_VIOLATION")])
def test_ohlc(spark, o, h, l, c, code):  # noqa: E741
    row = spark.createDataFrame([(float(o), float(h), float(l), float(c))], "o double, h double, l double, c double")
    assert row.select(nz.validate_ohlc(*map(F.col, "ohlc"))).first()[0] == code


@pytest.mark.parametrize("text,value,code", [("1.5", "1.500000000000", None), ("NaN", None, "INVALID_OPEN"), ("x", None, "INVALID_OPEN"), (None, None, "INVALID_OPEN")])
def test_decimal(spark, text, value, code):
    row = spark.createDataFrame([(text,)], "t string").select(*nz.decimal_value(F.col("t"), "open")).first()
    assert (row[0] and format(row[0], "f"), row[1]) == (value, code)


GAPS = "instrument_key string, slot_utc timestamp_ntz, quarantine_event_id long, raw_run_id long, covering_run_id long, curated_rejected boolean"


@pytest.mark.parametrize("quarantine,raw,covering,curated,cause", [
    (1, 5, 9, True, "QUARANTINED_VALUE_ANOMALY"), (None, 9, 5, False, "RAW_PRESENT_CURATED_REJECTED"), (None, 5, 9, False, "PROVIDER_RAW_NO_SAMPLE"),
    (None, 5, None, False, "RAW_PRESENT_CURATED_REJECTED"), (None, None, None, True, "RAW_PRESENT_CURATED_REJECTED"), (None, None, None, False, "ACQUISITION_RUN_MISSED")])
def test_gap_causes(spark, quarantine, raw, covering, curated, cause):
    rows = spark.createDataFrame([("a", at("2024-01-02 10:00:00"), quarantine, raw, covering, curated)], GAPS)
    assert gaps.classify_gap(rows).first().cause == cause


def bars_of(spark, n, version, change=(), drop=()):
    rows = [("a", at("2024-01-01 00:00:00") + dt.timedelta(hours=i), version, 1.0 + (i in change), 2.0 + (i in change), 1.0, 1.5, 10, i < n - 1) for i in range(n) if i not in drop]
    return spark.createDataFrame(rows, "instrument_key string, time_utc timestamp_ntz, data_version long, open double, high double, low double, close double, volume long, is_complete boolean")


@pytest.mark.parametrize("change,drop,decision", [((), (), "EXPAND"), ((80, 81), (), "READY_TO_APPLY"), ((3,), (), "EXPAND"), (range(96), (), "BLOCKED_FULL_REFETCH"), ((), range(20, 90), "BLOCKED_FULL_REFETCH")])
def test_revision_decisions(spark, change, drop, decision):
    compared = revisions.compare_window(bars_of(spark, 96, 2, change, drop), bars_of(spark, 96, 1))
    assert revisions.decide(compared, F.lit(96)).first().decision == decision


def test_windows_escalate_to_the_first_that_decides(spark):
    row = revisions.escalate_windows(bars_of(spark, 500, 2, change=range(410, 415)), bars_of(spark, 500, 1)).first()
    assert (row.window, row.decision) == (384, "READY_TO_APPLY")


def test_version_watch_order(spark):
    rows = spark.createDataFrame([(3, 3, 3, 3), (4, 3, 4, 4), (4, 3, 5, 4), (9, 3, 5, 4)], "observed_version int, quarantined_version int, last_observed_version int, accepted_version int")
    assert [r.watch_status.split("_")[0] for r in revisions.version_watch(rows).collect()] == ["NO", "NO", "PROVIDER", "NEW"]


def plan_of(spark, missing, previous=True, verified="VERIFIED"):
    day = at("2024-01-03 14:30:00")
    slots = spark.createDataFrame([("a", day.date(), day + dt.timedelta(hours=i)) for i in range(6)], "instrument_key string, session_date date, slot_utc timestamp_ntz")
    have = [("a", day + dt.timedelta(hours=i), 5.0 + i, 1, True) for i in range(6) if i not in missing]
    if previous:
        have.append(("a", at("2024-01-02 20:30:00"), 4.0, 1, True))
    bars = spark.createDataFrame(have, "instrument_key string, time_utc timestamp_ntz, close double, data_version long, is_complete boolean")
    sessions = spark.createDataFrame([("a", dt.date(2024, 1, d), at(f"2024-01-0{d} 14:30:00"), at(f"2024-01-0{d} 21:00:00")) for d in (2, 3)], "instrument_key string, session_date date, open_utc timestamp_ntz, close_utc timestamp_ntz")
    states = impute.slot_states(slots, bars)
    fills = impute.anchored_fill(states, sessions, bars)
    instruments = spark.createDataFrame([("a", verified)], "instrument_key string, verification_status string")
    return impute.imputation_plan(states, fills, instruments).first().plan_status, {r.slot_utc: r.close for r in fills.collect()}


@pytest.mark.parametrize("missing,previous,verified,status", [
    ((), True, "VERIFIED", "PASS_NO_IMPUTATION"), ((2, 3), True, "VERIFIED", "PASS_WITH_IMPUTATION_WARNING"), ((1, 3, 4), True, "VERIFIED", "BLOCKED_MISSING_PER_SESSION_LIMIT"),
    ((5,), True, "VERIFIED", "BLOCKED_DAILY_CLOSE_SOURCE_MISSING"), ((0,), True, "VERIFIED", "PASS_WITH_IMPUTATION_WARNING"), ((0,), False, "VERIFIED", "BLOCKED_ACTUAL_ANCHOR_MISSING"), ((1,), True, "PENDING", "BLOCKED_CALENDAR_NOT_VERIFIED")])
def test_imputation_plans(spark, missing, previous, verified, status):
    assert plan_of(spark, missing, previous, verified)[0] == status


def test_fill_takes_the_close_before_the_run(spark):
    _, fills = plan_of(spark, (2, 3))
    assert set(fills.values()) == {6.0}
    assert plan_of(spark, (0,))[1] == {at("2024-01-03 14:30:00"): 4.0}


def test_date_reversal_compares_with_the_last_valid_row(spark):
    days = ["2024-01-05", "2024-01-05", "2024-01-03", None, "2024-01-04"]
    rows = spark.createDataFrame([(i, "T", d and dt.date.fromisoformat(d), 1.0, 1.0, 0.0, 1.0) for i, d in enumerate(days)], "arrival int, ticker string, date date, close_unadjusted double, adjusted_close double, dividend_cash double, split_factor double")
    found = {(r.arrival, r.error_code) for r in total_return.validate_batch(rows, ["T"]).collect()}
    assert found == {(1, "DUPLICATE_DATE"), (2, "DATE_REVERSAL"), (3, "INVALID_DATE")}


def test_streak_resets(spark):
    runs = spark.createDataFrame([("a", i, s) for i, s in enumerate(["PASS", "FAIL", "PASS", "PASS", "PASS"])], "instrument_key string, run_order int, run_status string")
    assert [r.consecutive_passes for r in publish.acceptance_streak(runs).orderBy("run_order").collect()] == [1, 0, 1, 2, 2]


def test_series_without_a_publication_row_is_visible(spark):
    bars = spark.createDataFrame([("a",), ("b",), ("c",)], "instrument_key string")
    states = spark.createDataFrame([("a", "PUBLISHED"), ("b", "WITHDRAWN")], "instrument_key string, publication_status string")
    assert {r.instrument_key for r in publish.published_only(bars, states).collect()} == {"a", "c"}


def test_worst_status_ignores_unknown_values(spark):
    rows = spark.createDataFrame([("a", "WARN"), ("a", "STALE"), ("a", "odd")], "k string, s string")
    assert reports.worst_status(rows, ["k"], "s").first().worst_status == "STALE"


def test_transitions_need_label_and_note(spark):
    events = spark.createDataFrame([(1, "OPEN"), (2, "RESOLVED"), (3, "OPEN")], "event_id int, status string")
    actions = spark.createDataFrame([(1, "RESOLVE", "x", "y"), (2, "ACKNOWLEDGE", "x", "y"), (3, "RESOLVE", "", "y")], "event_id int, action string, label string, note string")
    after, rejected = ev.transition(events, actions)
    assert {r.event_id: r.status for r in after.collect()} == {1: "RESOLVED", 2: "RESOLVED", 3: "OPEN"}
    assert {r.event_id for r in rejected.collect()} == {2, 3}


def test_bundle_is_blocked_by_one_role(spark):
    rows = spark.createDataFrame([("AVAILABLE",), ("BLOCKED",)], "availability_state string")
    assert receipts.bundle_status(rows).first().overall == "BLOCKED_EXTERNAL_CONTRACT"


def test_archives_with_blank_fields_and_a_byte_order_mark(spark, tmp_path):
    import hashlib
    import json

    path = tmp_path / "bars.csv"
    base = dict.fromkeys(files.BAR_COLUMNS, "") | {"instrument_key": "é", "uic": "1", "asset_type": "Etf", "time_utc": "2024-01-01 10:00:00", "open": "1", "high": "2", "low": "1", "close": "1.5", "retrieved_at_utc": "2024-01-02 00:00:00", "is_complete": "true"}
    changes = [{}, {"is_complete": " TRUE"}, {"is_complete": "yes"}, {"uic": "x"}, {"horizon_minutes": "abc"}, {"time_utc": "soon"}, {"volume": "many"}, {"low_bid": "?"}, {"open": ""}, {"data_version": "1.5"}, {"horizon_minutes": "60", "volume": "3"}]
    lines = [[(base | c)[n] for n in files.BAR_COLUMNS] for c in changes]
    path.write_bytes(("\ufeff" + "\n".join(",".join(x) for x in [files.BAR_COLUMNS, *lines]) + "\n").encode())
    got = {r.payload_sha256: r for r in files.read_bar_csv(spark, str(path)).collect()}
    want = [None, None, "INVALID_BOOLEAN", "INVALID_UIC", "INVALID_HORIZON_MINUTES", "INVALID_TIME_UTC", "INVALID_VOLUME", "INVALID_PRICE", "INVALID_PRICE", "INVALID_DATA_VERSION", None]
    for change, code in zip(changes, want):
        digest = hashlib.sha256(json.dumps(base | change, ensure_ascii=False, separators=(",", ":"), sort_keys=True).encode()).hexdigest()
        assert got[digest].error_code == code, change
    plain = [r for r in got.values() if r.error_code is None]
    assert sorted(r.horizon_minutes for r in plain) == [60, 1440, 1440] and all(r.is_complete for r in plain)


@pytest.mark.parametrize("text,want", [
    ('{"b":1,"API_KEY":2,"a":{"x":null,"refreshToken":[1],"é":"\u00e9"}}', '{"a":{"x":null,"é":"é"},"b":1}'), ('[{"Password":1},{"secret_":1,"secrets":2}]', '[{},{"secrets":2}]'), ("no json", None), (None, None), ("3", "3")])
def test_redaction_keeps_all_other_fields(spark, text, want):
    assert files.redact_json(spark.createDataFrame([(1, text)], "i int, body string"), "body").first().body == want


def test_export_refuses_to_overwrite(spark, tmp_path):
    bars = bars_of(spark, 5, 1)
    target = str(tmp_path / "out")
    assert files.export_bars(bars, target, "a", "1h").first().row_count == 5
    with pytest.raises(Exception):
        files.export_bars(bars, target, "a", "1h")
    with pytest.raises(ValueError):
        files.export_bars(bars, str(tmp_path / "more"), "a", "1h", most_rows=4)


def test_upsert_twice_is_upsert_once(spark):
    current, staged = bars_of(spark, 20, 1).withColumn("run_id", F.lit(1)).withColumn("price_basis", F.lit("x")), bars_of(spark, 25, 2, change=(3,)).withColumn("run_id", F.lit(2)).withColumn("price_basis", F.lit("x"))
    once = merge.upsert(current, staged)
    assert once.exceptAll(merge.upsert(once, staged)).count() == 0 and once.count() == 25


def test_page_by_page_equals_the_whole(spark):
    from barloom.operators.reads import keyset_page

    rows = bars_of(spark, 37, 1).select("time_utc", "instrument_key")
    seen, after = [], None
    while True:
        page = keyset_page(rows, ["time_utc", "instrument_key"], after, 10).collect()
        seen += page[:10]
        if len(page) <= 10:
            break
        after = (str(page[9].time_utc), page[9].instrument_key)
    assert seen == rows.orderBy("time_utc", "instrument_key").collect()


def test_forward_append_keeps_late_first_arrivals(spark, tmp_path):
    schema = "run_id bigint, instrument_key string, time_utc timestamp_ntz, price_basis string, horizon_minutes int, is_complete boolean, close int"
    def row(day, close, complete=True, horizon=60):
        return (1, "a", at(f"2024-01-{day:02} 10:00:00"), None, horizon, complete, close)
    out = str(tmp_path / "rows")
    # The newest time comes first; first arrivals weeks behind it stay, repeats of any age don't.
    for k, rows in enumerate([[row(30, 1), row(30, 1)], [row(2, 2), row(29, 3), row(30, 9), row(3, 9, False), row(4, 9, horizon=240)], [row(1, 4), row(2, 9)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        forward.stream_forward_append(stream, out, str(tmp_path / "checkpoint"), str(tmp_path / "rejects"))
        assert spark.read.schema(schema).parquet(out).count() == [1, 3, 4][k]
    assert sorted(r.close for r in spark.read.schema(schema).parquet(out).collect()) == [1, 2, 3, 4]
    refused = spark.read.schema(schema + ", error_code string").parquet(str(tmp_path / "rejects"))
    assert sorted(r.error_code for r in refused.collect()) == ["DUPLICATE_KEY"] * 3 + ["HORIZON_NOT_60", "INCOMPLETE_BAR"]


def test_missing_prices_are_invalid(spark):
    rows = spark.createDataFrame([(None, 2.0, 1.0, 1.5), (1.0, None, 1.0, 1.5), (1.0, 2.0, 1.0, None)], "o double, h double, l double, c double")
    assert [r[0] for r in rows.select(nz.validate_ohlc(*map(F.col, "ohlc"))).collect()] == ["INVALID_OPEN", "INVALID_HIGH", "INVALID_CLOSE"]


def test_selection_of_instruments(spark):
    registry = spark.createDataFrame([("a", "canonical"), ("b", "canonical"), ("c", "candidate")], "instrument_key string, registry_kind string")
    assert {r.instrument_key for r in nz.select_instruments(registry, [" A", "b"]).collect()} == {"a", "b"}
    for keys, match in ((["a", "x"], "unknown"), (["a", "c"], "together"), (["a", "A"], "unique"), ([], "unique")):
        with pytest.raises(ValueError, match=match):
            nz.select_instruments(registry, keys)


def test_quotes_are_content(spark):
    schema = "instrument_key string, time_utc timestamp_ntz, price_basis string, data_version long, open_bid decimal(24,12), market_trading_state string"
    from decimal import Decimal
    one = lambda bid, state: spark.createDataFrame([("a", at("2024-01-02 10:00:00"), "mid", 1, Decimal(bid), state)], schema)
    same, wider, closed = one("1.1", "Open"), one("1.2", "Open"), one("1.1", "Closed")
    assert [merge.diff_counts(x, same).first().updated for x in (same, wider, closed)] == [0, 1, 1]
    assert [r.field for x in (wider, closed) for r in revisions.field_diff(x, same).collect()] == ["open_bid", "market_trading_state"]


def test_total_return_flags_and_dataset(spark):
    flags = ["quality_missing_price", "quality_positive_price", "quality_valid_ohlc", "quality_valid_split", "quality_return_outlier"]
    rows = [("d", "false", "true", "true", "true", "false"), ("d", "false", "true", "true", "true", "true"), ("d", "true", "true", "true", "true", "true"), ("d", "false", "true", "no", "true", "true")]
    frame = spark.createDataFrame(rows, ["source_dataset_id", *flags])
    assert [(r.quality_status, r.error_code) for r in files.grade_total_return(frame, "d").collect()] == [("PASS", None), ("WARN", None), ("FAIL", None), (None, "INVALID_BOOLEAN")]
    with pytest.raises(Exception, match="mismatch"):
        files.grade_total_return(frame, "other").collect()


def test_numbers_of_ranges_follow_each_other(spark):
    rows = spark.range(5000).select(F.concat(F.lit("k"), (F.col("id") * 7919 % 5000).cast("string")).alias("k"), F.col("id").alias("v"))
    got = sorted((r.k, r.n) for r in merge.numbered(rows, ["k"], "n", each=300).collect())
    assert [n for _, n in got] == list(range(1, 5001))


def test_days_of_a_table_keep_their_newest_version(spark, tmp_path):
    folder = str(tmp_path / "bars")
    frame = lambda rows: st._dated(spark.createDataFrame(rows, "k string, time_utc timestamp_ntz"))
    at = lambda day, hour: dt.datetime(2024, 1, day, hour)
    days = lambda rows: rows.select("bar_day").distinct()
    first, second = frame([("a", at(1, 9)), ("a", at(2, 9)), ("late", None)]), frame([("b", at(2, 9)), ("b", at(3, 9))])
    schema = first.drop("bar_day").schema
    got = lambda n, d=None: sorted((r.k, r.time_utc and r.time_utc.day) for r in st.read_days(spark, folder, n, schema, d).collect())
    assert got(-1) == []
    st.write_days(first, folder, 0, days(first))
    st.write_days(second, folder, 1, days(second))
    st.write_days(second, folder, 1, days(second))  # a batch that runs again
    assert sorted(got(0), key=str) == [("a", 1), ("a", 2), ("late", None)]
    assert sorted(got(1), key=str) == [("a", 1), ("b", 2), ("b", 3), ("late", None)]
    assert got(1, days(second)) == [("b", 2), ("b", 3)]
    st.write_days(second.where("false"), folder, 2, days(second))  # days whose bars are gone
    assert sorted(got(2), key=str) == [("a", 1), ("late", None)]


# --- pages, hashes, versions --------------------------------------------------------------------

def test_pages_of_a_clustered_table_equal_it(spark, tmp_path):
    from barloom.operators.reads import clustered_page, paged, write_clustered

    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    path, keys = str(tmp_path / "table"), ["k", "g"]
    write_clustered(rows, path, keys, 100)
    after, seen, files = None, [], []
    while True:
        page = clustered_page(spark, path, rows.schema, keys, after, 64)
        files.append(len({f.rsplit("/", 2)[1] for f in page.inputFiles()}))
        got = page.collect()
        assert [tuple(r) for r in got] == [tuple(r) for r in paged(rows, keys, after, 64).collect()]
        seen += [(r.k, r.g, r.v) for r in got]
        if not got[0].truncated:
            break
        after = tuple(got[0].next_key)
    assert seen == sorted(tuple(r) for r in rows.collect()) and max(files) <= 3 < spark.read.parquet(f"{path}-bounds").count()
    assert clustered_page(spark, path, rows.schema, keys, (5000, 0), 10).count() == 0


def test_tree_hashes_of_any_length(spark):
    import hashlib
    import json

    from barloom.operators.digests import ordered_hash

    rows = [("a", n, f"é\"\\\n\x01{n}" if n % 5 else None) for n in range(700)] + [("b", 1, ""), ("c", 1, "x"), ("c", 2, "y")]

    def root(items, each, fanout):
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        text = [json.dumps({"n": str(n), "t": t}, ensure_ascii=False, separators=(",", ":"), sort_keys=True) for n, t in items]
        level = [sha("[" + ",".join(text[i : i + each]) + "]") for i in range(0, len(text), each)]
        while True:
            level = [sha(",".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
            if len(level) == 1:
                return level[0]

    frame = spark.createDataFrame(rows, "g string, n int, t string").repartition(5)
    for each, fanout in ((10, 3), (64, 4), (1024, 256)):
        got = {r.g: (r["rows"], r.content_sha256) for r in ordered_hash(frame, "g", ["n"], ["n", "t"], each, fanout).collect()}
        assert got == {g: (len(own), root(own, each, fanout)) for g in "abc" if (own := [(n, t) for k, n, t in rows if k == g])}


@pytest.mark.parametrize("change,code", [(None, None), ("row", "QUARANTINE_EXCEPTION_MISMATCH"), ("value", "QUARANTINE_EXCEPTION_MISMATCH"), ("field", "QUARANTINE_EXCEPTION_MISMATCH"), ("none", "QUARANTINE_EXCEPTION_MISMATCH")])
def test_approved_exceptions_match_exactly(spark, change, code):
    kind = "instrument_key string, time_utc timestamp_ntz, violations array<struct<field:string,bid:decimal(24,12),ask:decimal(24,12)>>"
    from decimal import Decimal

    row = lambda day, field="high", bid="2": ("a", at(f"2024-01-{day:02} 10:00:00"), [(field, Decimal(bid), Decimal("1"))])
    base = [row(1), row(2, "low"), row(3)]
    told = merge.quarantine_digest(spark.createDataFrame(base, kind))
    approved = told.select("instrument_key", F.col("rejected_times").alias("unique_rows"), F.array(F.lit("high"), F.lit("low")).alias("allowed_fields"), "first_utc", "last_utc", "content_digest")
    seen = {None: base[::-1] + [row(1)], "row": [*base, row(2, "low"), row(4)], "value": [row(1), row(2, "low", "3"), row(3)], "field": [row(1), row(2, "open"), row(3)], "none": []}[change]
    got = merge.approved_exceptions(merge.quarantine_digest(spark.createDataFrame(seen, kind)), approved).collect()
    assert [r.error_code for r in got] == [code]


def test_a_scoped_rebuild_replaces_its_own_partitions(spark, tmp_path):
    from barloom.operators.bars import read_derivation, write_derivation

    rows = lambda pairs: spark.createDataFrame(pairs, "instrument_key string, n int")
    path = str(tmp_path / "derived")
    write_derivation(rows([("a", 1), ("b", 1), ("c", 1)]), path, "v1")
    write_derivation(rows([("a", 2), ("b", 2), ("c", 2)]), path, "v2")
    write_derivation(rows([("a", 3), ("c", 9)]), path, "v2", rows([("a", 0), ("b", 0)]))  # c isn't in scope, of b nothing is left
    write_derivation(rows([]), path, "v2", rows([]))
    read = lambda v: sorted((r.instrument_key, r.n) for r in read_derivation(spark, path, v).collect())
    assert read("v1") == [("a", 1), ("b", 1), ("c", 1)] and read("v2") == [("a", 3), ("c", 2)]


CODES = [c for c in impute.BLOCKERS if c not in ("BLOCKED_RIGHT_ACTUAL_ANCHOR_MISSING", "BLOCKED_LEFT_ACTUAL_ANCHOR_MISSING")]  # the last slot is there and a run's left one too


@pytest.mark.parametrize("code", [*CODES, "PASS_NO_IMPUTATION", "PASS_WITH_IMPUTATION_WARNING", "VERSIONS_OF_ANCHORS"])
def test_every_blocker_of_a_session(spark, code):
    day, hours = dt.date(2024, 1, 10), [at(f"2024-01-10 {h:02}:00:00") for h in range(10, 17)]
    before = at("2024-01-09 16:00:00")
    gone, slots, versions = {2}, list(hours), {}
    scope, verified, approved_version, source = True, "VERIFIED", 1, hours[1]
    extra, wrong, digest, no_time = [], set(), "a" * 64, False
    if code == "BLOCKED_IMPUTATION_SCOPE":
        scope = False
    elif code == "BLOCKED_CALENDAR_NOT_VERIFIED":
        verified = "PENDING"
    elif code == "BLOCKED_EXPECTED_SESSION_INVALID":
        slots.append(None)
    elif code == "BLOCKED_EXPECTED_SESSION_DUPLICATE":
        slots.append(hours[0])
    elif code == "BLOCKED_ACTUAL_TIME_INVALID":
        no_time = True
    elif code == "BLOCKED_ACTUAL_DUPLICATE":
        extra = [hours[0]]
    elif code == "BLOCKED_ACTUAL_QUALITY":
        wrong = {4}
    elif code == "BLOCKED_DAILY_CLOSE_SOURCE_MISSING":
        gone = {6}
    elif code == "BLOCKED_MISSING_PER_SESSION_LIMIT":
        gone = {1, 3, 5}
    elif code == "BLOCKED_CONSECUTIVE_MISSING_LIMIT":
        gone = {1, 2, 3}
    elif code == "BLOCKED_UNAPPROVED_IMPUTATION_SCOPE":
        gone = {3}
    elif code == "BLOCKED_DATA_VERSION_IDENTITY":
        versions = {5: 2}
    elif code == "BLOCKED_UNAPPROVED_IMPUTATION_DATA_VERSION":
        approved_version = 2
    elif code == "BLOCKED_SESSION_START_WITHOUT_PREVIOUS_ACTUAL":
        gone, before = {0}, at("2024-01-09 15:00:00")
    elif code == "BLOCKED_UNAPPROVED_IMPUTATION_SOURCE":
        source = hours[0]
    elif code == "BLOCKED_SOURCE_LINEAGE_MISSING":
        digest = "none"
    elif code == "PASS_NO_IMPUTATION":
        gone = set()
    elif code == "VERSIONS_OF_ANCHORS":  # the bar of the session before has another version
        gone, source, versions = {0}, before, {-1: 2}
    kind = "instrument_key string, session_date date, time_utc timestamp_ntz, open int, high int, low int, close int, is_complete boolean, data_version int, payload_sha256 string, artifact_relative_path string"
    bar = lambda t, k, bad=False: ("a", t.date() if t else day, t, 2, 1 if bad else 3, 1, 2, True, versions.get(k, 1), digest, "raw/x")
    bars = [bar(t, k, k in wrong) for k, t in enumerate(hours) if k not in gone] + [bar(t, 0) for t in extra] + [bar(at("2024-01-09 16:00:00"), -1)] + ([bar(None, 0)] if no_time else [])
    listed = sorted(gone - {3} | {2} if code == "BLOCKED_UNAPPROVED_IMPUTATION_SCOPE" else gone)
    if code in ("BLOCKED_CONSECUTIVE_MISSING_LIMIT",):  # two limits of the same size: the first one in order speaks
        code = "BLOCKED_MISSING_PER_SESSION_LIMIT"
    got = impute.strict_plan(
        spark.createDataFrame([("a", day, t) for t in slots], "instrument_key string, session_date date, slot_utc timestamp_ntz"), spark.createDataFrame(bars, kind), spark.createDataFrame([("a", scope, verified)], "instrument_key string, in_scope boolean, verification_status string"),
        spark.createDataFrame([("a", day, before)], "instrument_key string, session_date date, previous_utc timestamp_ntz"),
        spark.createDataFrame([("a", day, [hours[k] for k in listed], approved_version, source)], "instrument_key string, session_date date, slots array<timestamp_ntz>, data_version int, source_utc timestamp_ntz")).collect()
    assert [r.plan_status for r in got] == ["BLOCKED_DATA_VERSION_IDENTITY" if code == "VERSIONS_OF_ANCHORS" else code]


GATE = {
    "run_pass": {"run_id": 8}, "watermark_active": {"data_status": "STALE_DATA_VERSION"}, "data_version_single": {"null_version_rows": 1}, "coverage_accounted": {"gap_unclassified": 1}, "effective_coverage_start_reached": {"first_utc": at("2024-02-01 00:00:00")},
    "freshness_pass": {"freshness_status": "STALE"}, "curated_duplicate_zero": {"duplicate_rows": 1}, "page_boundary_duplicates_audited": {"conflicting_boundary_rows": 4}, "null_zero": {"null_rows": None}, "nonpositive_zero": {"nonpositive_rows": 1},
    "side_ohlc_valid": {"side_violations": 1}, "midpoint_ohlc_valid": {"mid_violations": 2}, "bid_ask_valid": {"crossed_rows": 1}, "future_complete_zero": {"future_rows": 1}, "current_blockers_zero": {"current_blockers": 1}, "unknown_blockers_zero": {"unknown_blockers": None},
    "latest_sample_forming": {"latest_complete_utc": at("2024-01-20 00:00:00")}}


def test_each_check_of_the_gate_by_itself(spark):
    good = {
        "run_id": 7, "run_status": "PASS", "data_status": "ACTIVE", "versions": 1, "null_version_rows": 0, "coverage_status": "WARN", "gap_verdict": "PASS", "gap_blocking": 0, "gap_unclassified": 0, "first_utc": at("2024-01-01 00:00:00"), "freshness_status": "PASS",
        "duplicate_rows": 0, "inclusive_boundary_duplicates": 3, "conflicting_boundary_rows": 3, "null_rows": 0, "nonpositive_rows": 0, "side_violations": 0, "mid_violations": 0, "crossed_rows": 0, "future_rows": 0, "current_blockers": 0, "unknown_blockers": 0,
        "latest_complete_utc": at("2024-01-19 23:00:00"), "latest_seen_utc": at("2024-01-20 00:00:00")}
    kind = ", ".join(f"{c} {'string' if isinstance(v, str) else 'int' if isinstance(v, int) else 'timestamp_ntz'}" for c, v in good.items())
    rows = [("good", *good.values())] + [(name, *(good | change).values()) for name, change in GATE.items()]
    checks = publish.whole_checks(F.lit("2024-01-05").cast("timestamp_ntz"), F.lit(7))
    assert list(checks) == list(GATE)
    got = {r.instrument_key: (r.failed_checks, r.gate_status) for r in publish.candidate_gate(spark.createDataFrame(rows, "instrument_key string, " + kind), checks).collect()}
    assert got == {"good": ("", "PASS")} | {name: (name, "BLOCKED") for name in GATE}
    keys = spark.createDataFrame([("a",)], "instrument_key string")
    with_ = lambda *c: keys.select("*", *[F.lit(None).cast("int").alias(x) for x in c])
    whole = publish.whole_profile(keys, with_("coverage_status"), with_("freshness_status"), with_("run_id", "run_status"), with_("data_status"), with_("current_blockers", "unknown_blockers"), with_("gap_verdict", "gap_blocking", "gap_unclassified"), with_("inclusive_boundary_duplicates", "conflicting_boundary_rows"))
    assert whole.count() == 1 and len(whole.columns) == 13

"""Queries on file sources, sinks and streams.  Files are derived from the given tables into the session's shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import calendar as cal
from barloom.plans import bindings as b
from barloom.plans.bindings import NOW, fresh_folder, sql
from barloom.plans.change_queries import _PAGES, _pages
from barloom.plans.registry import query
from barloom.sources import files as fs
from barloom.streaming import bars as st

def _csv(spark, folder):
    """The bars as CSV text; one flag in 20 is spelled in a way that isn't allowed, some are in upper case, some horizons and volumes are no numbers."""
    rows, e = b.bars(spark, folder), F.col("last_event")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    given = {
        "uic": F.col("instrument_id").cast("string"), "category": F.when(e % 2 == 0, "legacy_reference").otherwise(F.lower("asset_type")), "time_utc": F.date_format("time_utc", "yyyy-MM-dd HH:mm:ss"),
        "horizon_minutes": F.when(e % 50 == 1, "abc").when(e % 3 != 0, "60").otherwise(""), "volume": F.when(e % 50 == 2, "many").when(e % 7 == 3, "").otherwise(F.col("volume").cast("string")),
        "is_complete": F.when(e % 20 == 0, "yes").when(e % 20 == 5, F.concat(F.lit(" "), F.upper(F.col("is_complete").cast("string")))).otherwise(F.col("is_complete").cast("string")),
        "delayed_by_minutes": F.when(e % 2 == 0, "15").otherwise(""), "retrieved_at_utc": F.lit("2024-02-01 00:00:00")}
    path = fresh_folder(spark, "bars-csv")
    rows.select(*[given[c].alias(c) if c in given else text(c) for c in fs.BAR_COLUMNS]).write.option("header", True).option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).csv(path)
    return path


_S01_GIVEN = {
    "uic": "CAST(instrument_id AS VARCHAR)", "category": "CASE WHEN last_event % 2 = 0 THEN 'legacy_reference' ELSE lower(asset_type) END", "time_utc": "strftime(time_utc, '%Y-%m-%d %H:%M:%S')",
    "horizon_minutes": "CASE WHEN last_event % 50 = 1 THEN 'abc' WHEN last_event % 3 <> 0 THEN '60' ELSE '' END", "volume": "CASE WHEN last_event % 50 = 2 THEN 'many' WHEN last_event % 7 = 3 THEN '' ELSE CAST(volume AS VARCHAR) END",
    "is_complete": "CASE WHEN last_event % 20 = 0 THEN 'yes' WHEN last_event % 20 = 5 THEN ' ' || upper(CAST(is_complete AS VARCHAR)) ELSE CAST(is_complete AS VARCHAR) END",
    "delayed_by_minutes": "CASE WHEN last_event % 2 = 0 THEN '15' ELSE '' END", "retrieved_at_utc": "'2024-02-01 00:00:00'"}
_S01_TEXTS = ", ".join(f"{_S01_GIVEN[c]} AS {c}" if c in _S01_GIVEN else f"coalesce(CAST({c} AS VARCHAR), '') AS {c}" for c in fs.BAR_COLUMNS)
_S01_TYPES = {"uic": "BIGINT", "time_utc": "TIMESTAMP", "retrieved_at_utc": "TIMESTAMP", "volume": "DECIMAL(30,8)", "data_version": "BIGINT", "delayed_by_minutes": "INTEGER"}
_S01_PRICES = [c for c in fs.BAR_COLUMNS if c.split("_")[0] in ("open", "high", "low", "close")]
_S01_TYPED = ", ".join(f"TRY_CAST(nullif({c}, '') AS {_S01_TYPES.get(c, 'DECIMAL(24,12)')}) AS {c}" if c in _S01_TYPES or c in _S01_PRICES else f"nullif({c}, '') AS {c}" for c in fs.BAR_COLUMNS if c not in ("horizon_minutes", "is_complete"))
_S01_JSON = "'{' || " + " || ',' || ".join(f"'\"{c}\":\"' || {c} || '\"'" for c in sorted(fs.BAR_COLUMNS)) + " || '}'"


@query("s01_read_bar_csv", sql(f"""WITH texts AS (SELECT {_S01_TEXTS} FROM bars)
SELECT {_S01_TYPED}, CASE WHEN horizon_minutes = '' THEN 1440 ELSE TRY_CAST(horizon_minutes AS INTEGER) END AS horizon_minutes,
  CASE lower(trim(is_complete)) WHEN 'true' THEN true WHEN 'false' THEN false END AS is_complete, sha256({_S01_JSON}) AS payload_sha256,
  CASE WHEN horizon_minutes = 'abc' THEN 'INVALID_HORIZON_MINUTES' WHEN volume = 'many' THEN 'INVALID_VOLUME' WHEN is_complete = 'yes' THEN 'INVALID_BOOLEAN' END AS error_code FROM texts"""))
def s01(spark, folder):
    return fs.read_bar_csv(spark, _csv(spark, folder))


@query("s02_classify_files", "SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'curated_total_return' WHEN page_id % 3 = 0 AND page_id % 2 = 1 THEN 'raw_market_bar' ELSE 'reference_observation' END AS file_class FROM pages")
def s02(spark, folder):
    i = F.col("page_id")
    path = F.concat(F.lit("data/"), F.when(i % 3 == 0, "normalized/").otherwise("raw/"), i.cast("string"), F.when(i % 2 == 0, "_daily.csv").otherwise(".csv"))
    rows = b.table(spark, folder, "pages").select("page_id", F.when(i % 5 == 0, "etf_total_return").otherwise("archive").alias("file_group"), path.alias("relative_path"))
    return fs.classify_files(rows).select("page_id", "file_class")


@query("s03_verify_inventory", """WITH f AS (SELECT page_id // 20 AS k, sha256(string_agg(html || chr(10), '' ORDER BY page_id)) AS sha256 FROM pages GROUP BY 1)
SELECT 'k=' || k AS name, CASE k % 4 WHEN 0 THEN 'SIZE' WHEN 1 THEN 'DIGEST' ELSE 'OK' END AS file_state, sha256 FROM f UNION ALL SELECT 'k=' || k || '.gone', 'MISSING', sha256 FROM f""")
def s03(spark, folder):
    """Pages in files of 20, in a folder each; the inventory has wrong sizes, wrong digests and files that aren't there."""
    path = fresh_folder(spark, "pages-text")
    pages = b.table(spark, folder, "pages").select((F.col("page_id") / 20).cast("long").alias("k"), "page_id", "html")
    pages.repartition("k").sortWithinPartitions("k", "page_id").drop("page_id").write.partitionBy("k").text(path)
    files = fs.file_digests(spark, path, "*.txt").withColumn("name", F.col("folder"))
    k = F.regexp_extract("folder", "[0-9]+", 0).cast("long") % 4
    told = files.select("name", (F.col("bytes") + F.when(k == 0, 1).otherwise(0)).alias("bytes"), F.when(k == 1, F.reverse("sha256")).otherwise(F.col("sha256")).alias("sha256"), F.col("sha256").alias("own"))
    inventory = told.unionByName(files.select(F.concat("name", F.lit(".gone")).alias("name"), "bytes", "sha256", F.col("sha256").alias("own")))
    return fs.verify_inventory(files, inventory).join(inventory.select("name", F.col("own").alias("sha256")), "name")


_S04_JSON = (
    "'{\"date\":\"' || strftime(ts, '%Y-%m-%d') || '\",\"market_key\":\"' || CASE WHEN event_id % 3 = 0 THEN event_type ELSE '' END || '\",\"ticker\":\"' || user_id || "
    "'\",\"time_utc\":' || CASE WHEN event_id % 2 = 0 THEN '\"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '\"' ELSE 'null' END || '}'")


@query("s04_load_reference", f"""SELECT event_id AS row_number, 'RA0_analysis_baseline' AS reference_kind, 'research_metadata' AS layer, CASE WHEN event_id % 3 = 0 THEN event_type ELSE CAST(user_id AS VARCHAR) END AS reference_key,
  CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ts) ELSE CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS observed_utc, payload_json, sha256(payload_json) AS payload_sha256 FROM (SELECT *, {_S04_JSON} AS payload_json FROM events)""")
def s04(spark, folder):
    i = F.col("event_id")
    rows = b.table(spark, folder, "events").select(
        "event_id", F.when(i % 3 == 0, F.col("event_type")).otherwise("").alias("market_key"), F.col("user_id").cast("string").alias("ticker"), F.when(i % 2 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("time_utc"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"))
    return fs.load_reference(rows, F.lit(1), i, ["market_key", "ticker", "time_utc", "date"], F.lit(fs.BASELINE)).drop("source_file_id")


@query("s05_grade_total_return", """WITH r AS (SELECT o_orderpriority AS ticker, CAST(o_orderdate AS DATE) AS date, CAST(max(o_totalprice) AS DECIMAL(18,2)) AS a, CAST(min(o_totalprice) AS DECIMAL(18,2)) AS lo, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT ticker, date, CASE WHEN n % 7 = 3 THEN NULL WHEN lo < 2000 OR n % 5 = 0 THEN 'FAIL' WHEN a > 2 * lo THEN 'WARN' ELSE 'PASS' END AS quality_status, CASE WHEN n % 7 = 3 THEN 'INVALID_BOOLEAN' END AS error_code FROM r""")
def s05(spark, folder):
    price = lambda c: c.cast("decimal(18,2)")
    rows = b.table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("ticker"), F.col("o_orderdate").cast("date").alias("date")).agg(price(F.max("o_totalprice")).alias("hi"), price(F.min("o_totalprice")).alias("lo"), F.count("*").alias("n"))
    text = lambda c: c.cast("string")
    rows = rows.select(
        "ticker", "date", F.lit("orders").alias("source_dataset_id"), F.lit("false").alias("quality_missing_price"), text(F.col("lo") >= 2000).alias("quality_positive_price"),
        F.when(F.col("n") % 7 == 3, "yes").otherwise("true").alias("quality_valid_ohlc"), text(F.col("n") % 5 != 0).alias("quality_valid_split"), text(F.col("hi") > 2 * F.col("lo")).alias("quality_return_outlier"))
    return fs.grade_total_return(rows, "orders").select("ticker", "date", "quality_status", "error_code")


def chart_bodies(pages, horizon):
    """Chart JSON of each (instrument_key, page_number) of some bars: FX samples have quotes, the others native prices."""
    fx = F.col("asset_type") == "FxSpot"
    text = lambda c, when: F.when(when, F.col(c)).cast("string")
    native = [text(c, ~fx).alias(c.title()) for c in ("open", "high", "low", "close")]
    quotes = [text(f"{c}_{s}", fx).alias(f"{c.title()}{s.title()}") for s in ("bid", "ask") for c in ("open", "high", "low", "close")]
    d = F.struct(F.date_format("time_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("Time"), *native, *quotes, F.col("volume").cast("string").alias("Volume"), F.col("market_trading_state").alias("MarketTradingState"))
    keys = [c for c in ("part", "instrument_key", "page_number", "data_version") if c in pages.columns]
    pages = pages.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("position", d.alias("d")))).alias("rows"))
    info = F.struct(horizon.alias("Horizon"), F.lit(15).alias("DelayedByMinutes"))
    body = F.to_json(F.struct(F.col("data_version").alias("DataVersion"), info.alias("ChartInfo"), F.transform("rows", lambda x: x["d"]).alias("Data")))
    return pages.select(*[c for c in keys if c != "data_version"], body.alias("body"))


def _json_pages(spark, folder):
    return chart_bodies(_pages(spark, folder), F.when(F.col("page_number") == 1, 1440).otherwise(60))


_QUOTE_NAMES = [f"{f}_{s}" for s in ("bid", "ask") for f in ("open", "high", "low", "close")]
_S06_NATIVE = ", ".join(f"CASE WHEN asset_type <> 'FxSpot' THEN {f} END AS {f}" for f in ("open", "high", "low", "close"))


@query("s06_explode_chart_pages", sql(f"""WITH {_PAGES}
SELECT instrument_key, page_number, time_utc, {_S06_NATIVE}, {", ".join(_QUOTE_NAMES)}, CAST(volume AS DECIMAL(30,8)) AS volume, market_trading_state, data_version, 15 AS delayed_by_minutes, CAST(NULL AS VARCHAR) AS error_code
FROM paged WHERE page_number <> 1
UNION ALL SELECT DISTINCT instrument_key, page_number, CAST(NULL AS TIMESTAMP), {", ".join(["NULL"] * 14)}, data_version, 15, 'INVALID_HORIZON' FROM paged WHERE page_number = 1"""))
def s06(spark, folder):
    return fs.explode_chart_pages(_json_pages(spark, folder)).drop("position", "time_text", "volume_text")


@query("s07_parse_column_chart", "WITH r AS (SELECT event_type AS ticker, CAST(epoch(date_trunc('day', ts) + INTERVAL 21 HOUR) AS BIGINT) AS t, arg_min(value, event_id) AS o, max(value) AS h, count(*) AS n FROM events GROUP BY 1, 2) SELECT ticker, CASE WHEN ticker = 'error' THEN NULL ELSE CAST(to_timestamp(t) AT TIME ZONE 'UTC' - INTERVAL 5 HOUR AS DATE) END AS date, CASE WHEN ticker <> 'error' THEN o END AS open, CASE WHEN ticker <> 'error' THEN h END AS high, o AS low, o AS close, n AS volume, o AS adjclose, CASE WHEN ticker = 'error' THEN 'COLUMN_LENGTHS' END AS error_code FROM r WHERE ticker <> 'error' UNION ALL SELECT 'error', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'COLUMN_LENGTHS'")
def s07(spark, folder):
    e = b.table(spark, folder, "events").withColumn("t", F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.date_trunc("day", "ts").cast("timestamp_ntz")) + 21 * 3600)
    days = e.groupBy("event_type", "t").agg(F.min_by("value", "event_id").alias("o"), F.max("value").alias("h"), F.count("*").alias("n"))
    rows = days.groupBy("event_type").agg(F.array_sort(F.collect_list(F.struct("t", "o", "h", "n"))).alias("r"))
    each = lambda f: F.transform("r", lambda x: x[f])
    short = F.when(F.col("event_type") == "error", F.slice(each("h"), 1, 2)).otherwise(each("h"))
    body = F.to_json(F.struct(F.col("event_type").alias("ticker"), each("t").alias("timestamp"), each("o").alias("open"), short.alias("high"), each("o").alias("low"), each("o").alias("close"), each("n").alias("volume"), each("o").alias("adjclose")))
    return fs.parse_column_chart(rows.select(body.alias("body"))).select("ticker", "date", "open", "high", "low", "close", "volume", "adjclose", "error_code")


@query("s08_export_bars", sql("SELECT 'view' AS instrument_key, '1h' AS layer, count(*) AS row_count, min(time_utc) AS min_time_utc, max(time_utc) AS max_time_utc FROM bars WHERE instrument_key = 'view'"))
def s08(spark, folder):
    return fs.export_bars(b.bars(spark, folder).where("instrument_key = 'view'"), fresh_folder(spark, "export"), "view", "1h")


@query("s09_register_sources", "WITH p AS (SELECT page_id, 'raw/' || page_id AS relative_path, sha256(html) AS sha256, length(html) AS n FROM pages), old AS (SELECT *, page_id + 1 AS id FROM p WHERE page_id % 3 = 0), neu AS (SELECT *, (SELECT max(id) FROM old) + row_number() OVER (ORDER BY relative_path, sha256) AS id FROM p WHERE page_id % 3 <> 0 AND page_id % 7 <> 0) SELECT relative_path, id AS source_file_id, CASE WHEN page_id % 7 <> 0 THEN n ELSE 0 END AS bytes FROM (SELECT * FROM old UNION ALL SELECT * FROM neu)")
def s09(spark, folder):
    i = F.col("page_id")
    p = b.table(spark, folder, "pages").select("page_id", F.concat(F.lit("raw/"), i.cast("string")).alias("relative_path"), F.sha2("html", 256).alias("sha256"), F.length("html").cast("long").alias("bytes"), F.lit(1).alias("row_count"))
    registry = p.where("page_id % 3 = 0").select("relative_path", "sha256", (i + 1).alias("source_file_id"), F.lit(0).cast("long").alias("bytes"), "row_count")
    seen = p.withColumn("relative_path", F.when(i % 7 == 0, F.concat(F.lit("/abs/"), i.cast("string"))).otherwise(F.col("relative_path"))).drop("page_id")
    return fs.register_sources(registry, seen).select("relative_path", "source_file_id", "bytes")


@query("s10_verify_seed", "WITH i AS (SELECT DISTINCT 'S' || s_suppkey AS k, s_nationkey AS u FROM supplier), x AS (SELECT 'S' || l_suppkey AS k, l_shipdate AS t FROM lineitem) SELECT k AS item, 'NO_BARS' AS error_code FROM i WHERE k NOT IN (SELECT k FROM x) UNION ALL SELECT DISTINCT k, 'UNKNOWN_INSTRUMENT' FROM x WHERE k NOT IN (SELECT k FROM i) UNION ALL SELECT CAST(u AS VARCHAR), 'DUPLICATE_UIC' FROM i GROUP BY u HAVING count(*) > 1 UNION ALL SELECT DISTINCT k, 'DUPLICATE_BAR' FROM (SELECT k FROM x GROUP BY k, t HAVING count(*) > 1) UNION ALL SELECT k, 'ROW_COUNT' FROM x GROUP BY k HAVING count(*) <> 2")
def s10(spark, folder):
    key = lambda c: F.concat(F.lit("S"), F.col(c).cast("string")).alias("instrument_key")
    return fs.verify_seed(b.table(spark, folder, "supplier").select(key("s_suppkey"), F.col("s_nationkey").alias("uic")), b.table(spark, folder, "lineitem").select(key("l_suppkey"), F.col("l_shipdate").alias("time_utc")))


@query("s11_freeze_snapshot", sql("SELECT 'bars' AS relation, count(*) FILTER (time_utc <= TIMESTAMP '2024-01-20') AS row_count, max(time_utc) FILTER (time_utc <= TIMESTAMP '2024-01-20') AS latest, count(*) FILTER (time_utc > TIMESTAMP '2024-01-20') AS excluded_rows FROM bars UNION ALL SELECT 'nation', count(*), NULL, 0 FROM nation"))
def s11(spark, folder):
    return fs.freeze_snapshot({"bars": (b.bars(spark, folder), "time_utc"), "nation": (b.table(spark, folder, "nation"), None)}, F.lit("2024-01-20").cast("timestamp_ntz"), fresh_folder(spark, "snapshot"))


@query("s13_redact_json", "SELECT event_id, '{\"items\":[{\"kind\":\"' || event_type || '\",\"note\":null}],\"user\":{\"id\":' || user_id || ',\"k' || event_id % 5 || '\":[]}}' AS body FROM events")
def s13(spark, folder):
    """Bodies with sensitive fields at several depths, and fields whose names differ from row to row."""
    i = F.col("event_id").cast("string")
    body = F.concat(
        F.lit('{"user":{"id":'), F.col("user_id").cast("string"), F.lit(',"Access_Token":"t","k'), (F.col("event_id") % 5).cast("string"), F.lit('":[]},"apiKey":{"v":'), i, F.lit('},"items":[{"note":null,"PASSWORD":"s","kind":"'), F.col("event_type"), F.lit('"}]}'))
    return fs.redact_json(b.table(spark, folder, "events").select("event_id", body.alias("body")), "body")


@query("s14_run_manifest", """SELECT page_id % 10 AS run_id, count(*) AS artifacts, CAST(sum(length(html)) AS BIGINT) AS bytes, count(*) AS rows,
  '[' || string_agg('{"relative_path":"page/' || page_id || '","sha256":"' || sha256(html) || '","bytes":' || length(html) || ',"row_count":1}', ',' ORDER BY 'page/' || page_id) || ']' AS artifacts_json FROM pages GROUP BY 1""")
def s14(spark, folder):
    rows = b.table(spark, folder, "pages").select((F.col("page_id") % 10).alias("run_id"), F.concat(F.lit("page/"), F.col("page_id").cast("string")).alias("relative_path"), F.sha2("html", 256).alias("sha256"), F.length("html").cast("long").alias("bytes"), F.lit(1).cast("long").alias("row_count"))
    return fs.run_manifest(rows)


@query("s15_manifests", "SELECT 'dataset' AS kind, CAST(n_nationkey AS VARCHAR) AS item, row_number() OVER (ORDER BY n_nationkey) AS position FROM nation UNION ALL SELECT 'snapshot', d, row_number() OVER (ORDER BY f DESC, d DESC) FROM (SELECT CAST(day(ts) AS VARCHAR) AS d, max(ts) AS f FROM events GROUP BY 1)")
def s15(spark, folder):
    days = b.table(spark, folder, "events").groupBy(F.dayofmonth("ts").cast("string").alias("snapshot_id")).agg(F.max("ts").alias("frozen_utc"))
    return fs.manifests(b.table(spark, folder, "nation").select(F.col("n_nationkey").alias("dataset_id")), days)


@query("s16_collect_instruments", sql("SELECT instrument_id AS uic, asset_type, arg_min(instrument_key, last_event) AS instrument_key, min(time_utc) AS active_from, CASE WHEN bool_or(last_event % 2 = 1) THEN lower(asset_type) ELSE 'legacy_reference' END AS category FROM bars GROUP BY instrument_id, asset_type"))
def s16(spark, folder):
    rows = b.bars(spark, folder).withColumn("uic", F.col("instrument_id")).withColumn("category", F.when(F.col("last_event") % 2 == 0, "legacy_reference").otherwise(F.lower("asset_type")))
    return fs.collect_instruments(rows, "last_event")


# --- streams ------------------------------------------------------------------------------------

def _stream(spark, rows, parts: int):
    """The rows as a file stream that takes one file at a time."""
    path = fresh_folder(spark, "stream")
    rows.repartitionByRange(parts, "time_utc", "instrument_key").write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query("x02_with_lookback", sql("SELECT instrument_key, count(*) AS rows FROM (SELECT instrument_key FROM bars WHERE time_utc >= TIMESTAMP '2024-01-25' UNION ALL SELECT instrument_key FROM (SELECT *, row_number() OVER (PARTITION BY instrument_key ORDER BY time_utc DESC) AS n FROM bars WHERE time_utc < TIMESTAMP '2024-01-25') WHERE n <= CASE WHEN asset_type = 'FxSpot' THEN 72 ELSE 20 END) GROUP BY 1"))
def x02(spark, folder):
    from barloom.operators.normalize import series_attributes
    rows = b.bars(spark, folder)
    late = rows.where("time_utc >= timestamp_ntz '2024-01-25'")
    return st.with_lookback(late, rows.where("time_utc < timestamp_ntz '2024-01-25'"), series_attributes(b.instruments(spark, folder))).groupBy("instrument_key").agg(F.count("*").alias("rows"))


@query("x04_split_version_change", sql("SELECT instrument_key, price_basis, CAST(2 AS BIGINT) AS observed_version, CAST(1 AS BIGINT) AS known_version, count(*) AS rows FROM bars2 WHERE instrument_key IN ('view', 'error') GROUP BY 1, 2"))
def x04(spark, folder):
    rows = b.bars(spark, folder, 2)
    marks = b.watermarks(spark, folder).withColumn("data_version", F.when(F.col("instrument_key").isin("view", "error"), F.lit(1)).otherwise(2).cast("long"))
    return st.split_version_change(rows, marks)[1]


@query("x05_stream_derive", sql("SELECT * FROM bars_4h"))
def x05(spark, folder):
    stream, out = _stream(spark, b.bars(spark, folder), 2), fresh_folder(spark, "derive")
    sessions = b.sessions(spark, folder)
    st.stream_derive(stream, sessions, out, f"{out}/checkpoint")
    from barloom.operators import bars as der
    schema = der.derive_4h(b.bars(spark, folder), sessions).schema
    return st.newest_days(spark, f"{out}/bars_4h", f"{out}/checkpoint", schema)


@query("x06_stream_slot_lag", sql(f"SELECT s.instrument_key, count(*) AS due_slots, count(b.time_utc) AS delivered, CASE WHEN arg_max(b.time_utc IS NOT NULL, slot_utc) THEN 'READY' ELSE 'DATA_NOT_READY' END AS readiness FROM slots s LEFT JOIN (SELECT * FROM bars WHERE is_complete) b ON b.instrument_key = s.instrument_key AND b.time_utc = slot_utc WHERE slot_utc <= TIMESTAMP '{NOW}' GROUP BY 1"))
def x06(spark, folder):
    stream, out = _stream(spark, b.bars(spark, folder), 2), fresh_folder(spark, "lag")
    slots = cal.complete_slots(b.instruments(spark, folder), b.sessions(spark, folder))
    st.stream_slot_lag(stream, slots, b.now(), f"{out}/arrived", f"{out}/checkpoint")
    arrived = spark.read.schema("instrument_key string, time_utc timestamp_ntz").parquet(f"{out}/arrived")
    return st.slot_lag(slots, arrived, b.now())

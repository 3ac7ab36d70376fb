"""Readers, writers and checks of files: bar CSVs, chart JSON, inventories, exports, snapshots, registries."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from barloom.functions.canonical import canonical_json
from barloom.functions.package import send_package
from barloom.functions.times import new_york
from barloom.operators.merge import numbered
from barloom.operators.normalize import PRICE, valid_digest, valid_path

# The columns of an archive of bars, in the order of its files.
BAR_COLUMNS = [
    "instrument_key", "uic", "asset_type", "category", "time_utc", "horizon_minutes", "price_basis", "open", "high", "low", "close", "open_bid", "high_bid", "low_bid", "close_bid",
    "open_ask", "high_ask", "low_ask", "close_ask", "volume", "market_trading_state", "is_complete", "data_version", "delayed_by_minutes", "retrieved_at_utc"]
# Fixed value: the group of files whose rows describe the analysis.
BASELINE = "RA0_analysis_baseline"
#: Names of fields that never leave the engine, in lower case without underscores.
SENSITIVE = ("authorization", "accesstoken", "refreshtoken", "apikey", "password", "secret", "clientkey", "accountkey")


def row_digest(columns: list[str]) -> Column:
    """SHA-256 of a row as canonical JSON of texts: empty fields are empty texts."""
    return F.sha2(canonical_json(columns), 256)


def flag_of(text: Column) -> Column:
    """True and false in any case and with spaces around; null for everything else."""
    word = F.lower(F.trim(text))
    return F.when(word == "true", True).when(word == "false", False)


def read_bar_csv(spark: SparkSession, path: str) -> DataFrame:
    """Typed bars with ``payload_sha256`` (of all fields as they stand in the file) and ``error_code``.

    A blank horizon is 1440; blank quotes, volume, state, version and delay are null.  What can't be read is an error: INVALID_<COLUMN> of the first such column in the
    order of the file, needed ones included where they are blank; an ``is_complete`` other than true or false (in any case) is INVALID_BOOLEAN, a price
    INVALID_PRICE.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in BAR_COLUMNS])
    raw = spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").option("enforceSchema", True).csv(path)
    raw = raw.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in BAR_COLUMNS])
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    prices, quotes = ("open", "high", "low", "close"), [f"{f}_{s}" for s in ("bid", "ask") for f in ("open", "high", "low", "close")]
    needed = {"uic": "bigint", **dict.fromkeys(prices, PRICE)}
    optional = {**dict.fromkeys(quotes, PRICE), "volume": "decimal(30,8)", "data_version": "bigint", "delayed_by_minutes": "int"}
    typed = {c: F.col(c).try_cast(t) for c, t in needed.items()} | {c: blank(c).try_cast(t) for c, t in optional.items()}
    typed |= {c: F.try_to_timestamp(c).cast("timestamp_ntz") for c in ("time_utc", "retrieved_at_utc")}
    typed["horizon_minutes"] = F.when(blank("horizon_minutes").isNull(), 1440).otherwise(F.col("horizon_minutes").try_cast("int"))
    typed["is_complete"] = flag_of(F.col("is_complete"))
    names = {"is_complete": "INVALID_BOOLEAN", **dict.fromkeys((*prices, *quotes), "INVALID_PRICE")}
    wrong = [F.when(typed[c].isNull() & (blank(c).isNotNull() if c in optional else F.lit(True)), names.get(c, f"INVALID_{c.upper()}")) for c in BAR_COLUMNS if c in typed]
    columns = [typed.get(c, blank(c)).alias(c) for c in BAR_COLUMNS]
    return raw.select(*columns, row_digest(BAR_COLUMNS).alias("payload_sha256"), F.coalesce(*wrong).alias("error_code"))


def classify_files(inventory: DataFrame) -> DataFrame:
    """file_class by group name, a path segment ``normalized`` and the suffix ``_daily.csv``."""
    path = F.col("relative_path")
    normal = F.array_contains(F.split(path, "/"), "normalized")
    return inventory.withColumn("file_class", F.when(F.col("file_group").contains("total_return"), "curated_total_return").when(normal & ~path.endswith("_daily.csv"), "raw_market_bar").otherwise("reference_observation"))


def file_digests(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """name, folder (the last one on the path), bytes and sha256 of the files below a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.element_at(F.split("path", "/"), -2).alias("folder"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verify_inventory(files: DataFrame, inventory: DataFrame) -> DataFrame:
    """What is wrong with each inventory row (name, bytes, sha256): MISSING, SIZE, DIGEST or OK."""
    f, i = files.alias("f"), inventory.alias("i")
    joined = i.join(f, F.col("i.name") == F.col("f.name"), "left")
    state = F.when(F.col("f.name").isNull(), "MISSING").when(F.col("f.bytes") != F.col("i.bytes"), "SIZE").when(F.col("f.sha256") != F.col("i.sha256"), "DIGEST").otherwise("OK")
    return joined.select(F.col("i.name").alias("name"), state.alias("file_state"))


def load_reference(rows: DataFrame, file_id: Column, ordinal: Column, columns: list[str], kind: Column) -> DataFrame:
    """Reference rows with their kind (the file's group) and layer (research_metadata for the analysis baseline, else raw), a key (the first of market_key, ticker, source_series, category, pair that
    isn't empty), a time (time_utc, else midnight of date), canonical JSON of all fields as texts (empty ones stay) and its digest."""
    has = lambda c: F.nullif(F.col(c), F.lit("")) if c in columns else F.lit(None).cast("string")
    key = F.coalesce(*[has(c) for c in ("market_key", "ticker", "source_series", "category", "pair")])
    time = F.coalesce(F.try_to_timestamp(has("time_utc")), F.try_to_timestamp(has("date"))).cast("timestamp_ntz")
    payload = canonical_json(columns)
    layer = F.when(kind == BASELINE, "research_metadata").otherwise("raw")
    return rows.select(
        file_id.alias("source_file_id"), ordinal.alias("row_number"), kind.alias("reference_kind"), key.alias("reference_key"), layer.alias("layer"), time.alias("observed_utc"), payload.alias("payload_json"),
        F.sha2(payload, 256).alias("payload_sha256"))


def grade_total_return(rows: DataFrame, dataset_id: str) -> DataFrame:
    """quality_status of total-return rows by the file's flags (text, true or false): FAIL for a missing or non-positive price, invalid OHLC or split; WARN for an outlying
    return.  ``error_code``: INVALID_BOOLEAN for a flag of another spelling.  A row of another dataset (source_dataset_id) raises an error."""
    flag = lambda c: F.col(c) == "true"
    flags = ["quality_missing_price", "quality_positive_price", "quality_valid_ohlc", "quality_valid_split", "quality_return_outlier"]
    bad = F.exists(F.array(*[F.coalesce(F.col(c).isin("true", "false"), F.lit(False)) for c in flags]), lambda x: ~x)
    failed = flag(flags[0]) | ~flag(flags[1]) | ~flag(flags[2]) | ~flag(flags[3])
    grade = F.when(bad, F.lit(None)).when(failed, "FAIL").when(flag(flags[4]), "WARN").otherwise("PASS")
    own = F.coalesce(F.col("source_dataset_id") == dataset_id, F.lit(False))
    guarded = F.when(own, grade).otherwise(F.raise_error(F.lit("curated total-return source_dataset_id mismatch")).cast("string"))
    return rows.withColumn("quality_status", guarded).withColumn("error_code", F.when(bad, "INVALID_BOOLEAN"))


# Names of the fields of a chart sample.
NATIVE = ("Open", "High", "Low", "Close")
QUOTES = tuple(f"{name}{side}" for side in ("Bid", "Ask") for name in NATIVE)
CHART = (
    "struct<DataVersion:bigint,ChartInfo:struct<Horizon:int,DelayedByMinutes:int>,Data:array<struct<"
    + ",".join(f"{name}:string" for name in ("Time", *NATIVE, *QUOTES, "Volume", "MarketTradingState")) + ">>>")


def explode_chart_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """Samples of chart pages (instrument_key, page_number, JSON text), with native prices, bid and ask quotes (null where a sample has none), and the texts of
    time and volume for checks; other columns of the pages stay.  A page whose horizon isn't 60 or that has no list gives one row with an error."""
    parsed = pages.withColumn("page", F.from_json(body, CHART))
    code = F.when(F.col("page.ChartInfo.Horizon").isNull() | (F.col("page.ChartInfo.Horizon") != 60), "INVALID_HORIZON").when(F.col("page.Data").isNull(), "INVALID_DATA")
    rows = parsed.withColumn("error_code", code).select("*", F.posexplode_outer(F.when(F.col("error_code").isNull(), F.col("page.Data"))).alias("position", "d"))
    price = lambda c, name: F.col(f"d.{c}").try_cast(PRICE).alias(name)
    others = [c for c in pages.columns if c not in ("instrument_key", "page_number", body)]
    sides = [price(f"{name}{side}", f"{name}_{side}".lower()) for side in ("Bid", "Ask") for name in NATIVE]
    return rows.select(
        "instrument_key", "page_number", "position", *others, F.try_to_timestamp("d.Time").cast("timestamp_ntz").alias("time_utc"), *[price(c, c.lower()) for c in NATIVE], *sides,
        F.col("d.Volume").try_cast("decimal(30,8)").alias("volume"), F.col("d.MarketTradingState").alias("market_trading_state"), F.col("page.DataVersion").alias("data_version"),
        F.col("page.ChartInfo.DelayedByMinutes").alias("delayed_by_minutes"), F.col("d.Time").alias("time_text"), F.col("d.Volume").alias("volume_text"), "error_code")


COLUMNS = "struct<ticker:string,timestamp:array<bigint>,open:array<double>,high:array<double>,low:array<double>,close:array<double>,volume:array<bigint>,adjclose:array<double>>"


def parse_column_chart(charts: DataFrame, body: str = "body") -> DataFrame:
    """Daily rows of charts whose columns are parallel arrays of one length; dates are local ones in New York.  Others give one row with an error."""
    c = charts.select(F.from_json(body, COLUMNS).alias("c")).select("c.*")
    names = ["timestamp", "open", "high", "low", "close", "volume", "adjclose"]
    same = F.size("timestamp") > 0
    for n in names[1:]:
        same = same & (F.size(n) == F.size("timestamp"))
    c = c.withColumn("error_code", F.when(~F.coalesce(same, F.lit(False)), "COLUMN_LENGTHS"))
    rows = c.select("ticker", "error_code", F.explode_outer(F.when(F.col("error_code").isNull(), F.arrays_zip(*names))).alias("r"))
    date = new_york(F.timestamp_seconds("r.timestamp").cast("timestamp_ntz")).cast("date")
    return rows.select("ticker", date.alias("date"), *[F.col(f"r.{n}").alias(n) for n in names[1:]], "error_code")


def export_bars(bars: DataFrame, path: str, key: str, layer: str, most_rows: int = 1_000_000) -> DataFrame:
    """Write bars as ZSTD Parquet to a new folder, read them back and give the manifest (one row).  Raises ValueError for more rows than allowed or a count that differs."""
    n = bars.count()
    if n > most_rows:
        raise ValueError(f"{n} rows, at most {most_rows} are allowed")
    bars.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    back = bars.sparkSession.read.parquet(path)
    manifest = back.agg(F.lit(key).alias("instrument_key"), F.lit(layer).alias("layer"), F.count("*").alias("row_count"), F.min("time_utc").alias("min_time_utc"), F.max("time_utc").alias("max_time_utc"))
    if manifest.first()["row_count"] != n:
        raise ValueError("the file's row count differs")
    return manifest


def register_sources(registry: DataFrame, files: DataFrame) -> DataFrame:
    """The registry (relative_path, sha256, source_file_id, bytes, row_count) with sizes refreshed, and new files with ids after the greatest.

    Files with an invalid path or digest are left out; see ``invalid_sources``.
    """
    good = files.where(valid_path(F.col("relative_path")) & valid_digest(F.col("sha256"))).dropDuplicates(["relative_path", "sha256"])
    r, f = registry.alias("r"), good.alias("f")
    joined = r.join(f, (F.col("r.relative_path") == F.col("f.relative_path")) & (F.col("r.sha256") == F.col("f.sha256")), "full").crossJoin(F.broadcast(registry.agg(F.coalesce(F.max("source_file_id"), F.lit(0)).alias("top"))))
    path, digest = F.coalesce("f.relative_path", "r.relative_path"), F.coalesce("f.sha256", "r.sha256")
    rows = joined.select(path.alias("relative_path"), digest.alias("sha256"), "r.source_file_id", F.coalesce("f.bytes", "r.bytes").alias("bytes"), F.coalesce("f.row_count", "r.row_count").alias("row_count"), "top")
    new = numbered(rows.where("source_file_id is null"), ["relative_path", "sha256"], "n").withColumn("source_file_id", F.col("top") + F.col("n")).drop("n")
    return rows.where("source_file_id is not null").unionByName(new).drop("top")


def invalid_sources(files: DataFrame) -> DataFrame:
    return files.where(~(valid_path(F.col("relative_path")) & valid_digest(F.col("sha256"))))


def verify_seed(instruments: DataFrame, bars: DataFrame, rows_each: int = 2) -> DataFrame:
    """Errors of seed tables: keys of one side alone, repeated uics, repeated bars, and instruments without exactly ``rows_each`` bars."""
    left, right = instruments.select("instrument_key").distinct(), bars.select("instrument_key").distinct()
    error = lambda rows, code: rows.select(F.col("instrument_key").cast("string").alias("item"), F.lit(code).alias("error_code"))
    uic = instruments.groupBy(F.col("uic").cast("string").alias("instrument_key")).agg(F.count("*").alias("n")).where("n > 1")
    twice = bars.groupBy("instrument_key", "time_utc").agg(F.count("*").alias("n")).where("n > 1").select("instrument_key").distinct()
    count = bars.groupBy("instrument_key").agg(F.count("*").alias("n")).where(F.col("n") != rows_each)
    return (error(left.subtract(right), "NO_BARS").unionByName(error(right.subtract(left), "UNKNOWN_INSTRUMENT")).unionByName(error(uic, "DUPLICATE_UIC"))
            .unionByName(error(twice, "DUPLICATE_BAR")).unionByName(error(count, "ROW_COUNT")))


def freeze_snapshot(tables: dict[str, tuple[DataFrame, str | None]], cutoff: Column, folder: str) -> DataFrame:
    """Write each table's rows up to the cutoff (by its time column; all rows without one) under ``folder``; a manifest row for each."""
    out = None
    for name, (rows, time) in tables.items():
        kept = rows if time is None else rows.where(F.col(time) <= cutoff)
        kept.write.mode("errorifexists").parquet(f"{folder}/{name}")
        back = rows.sparkSession.read.schema(rows.schema).parquet(f"{folder}/{name}")
        last = F.max(time).cast("timestamp_ntz") if time else F.lit(None).cast("timestamp_ntz")
        part = back.agg(F.lit(name).alias("relation"), F.count("*").alias("row_count"), last.alias("latest"))
        after = rows.agg((F.count_if(F.col(time) > cutoff) if time else F.lit(0).cast("long")).alias("excluded_rows"))
        part = part.crossJoin(F.broadcast(after))
        out = part if out is None else out.unionByName(part)
    return out


def redacted(column: Column, kind: T.DataType) -> Column:
    """A nested column without sensitive fields, at any depth."""
    if isinstance(kind, T.StructType):
        kept = [f for f in kind.fields if f.name.lower().replace("_", "") not in SENSITIVE]
        return F.when(column.isNotNull(), F.struct(*[redacted(column[f.name], f.dataType).alias(f.name) for f in kept]))
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: redacted(x, kind.elementType))
    return column


def _sanitized(value):
    if isinstance(value, dict):
        return {k: _sanitized(v) for k, v in value.items() if k.replace("_", "").lower() not in SENSITIVE}
    return [_sanitized(v) for v in value] if isinstance(value, list) else value


def redact_json(rows: DataFrame, column: str) -> DataFrame:
    """A JSON text column without sensitive fields (names count without case and underscores) at any depth, as canonical JSON: all other fields stay, whatever
    they are, nulls too.  A text that is no JSON becomes null.  A field's depth isn't known beforehand, which column expressions can't follow: a small function does, batch by batch."""
    send_package(rows.sparkSession)

    @F.pandas_udf("string")
    def redact(texts: pd.Series) -> pd.Series:
        def one(text):
            try:
                return json.dumps(_sanitized(json.loads(text)), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
            except (TypeError, ValueError, RecursionError):
                return None

        return texts.map(one)

    return rows.withColumn(column, redact(F.col(column)))


def run_manifest(artifacts: DataFrame) -> DataFrame:
    """By run: artifacts, bytes, rows, and the ordered list as JSON (a run has few artifacts)."""
    listed = F.array_sort(F.collect_list(F.struct("relative_path", "sha256", "bytes", "row_count")))
    return artifacts.groupBy("run_id").agg(F.count("*").alias("artifacts"), F.sum("bytes").alias("bytes"), F.sum("row_count").alias("rows"), F.to_json(listed).alias("artifacts_json"))


def manifests(datasets: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Datasets by id and snapshots, newest first, as one listing with positions."""
    d = numbered(datasets, ["dataset_id"], "position").select(F.lit("dataset").alias("kind"), F.col("dataset_id").cast("string").alias("item"), "position")
    s = numbered(snapshots, ["frozen_utc", "snapshot_id"], "n").crossJoin(F.broadcast(snapshots.agg(F.count("*").alias("of"))))
    s = s.select(F.lit("snapshot").alias("kind"), F.col("snapshot_id").cast("string").alias("item"), (F.col("of") - F.col("n") + 1).alias("position"))
    return d.unionByName(s).orderBy("kind", "position")


def collect_instruments(rows: DataFrame, ordinal: str) -> DataFrame:
    """One row for each (uic, asset_type): the first seen key, the earliest time, and the first category that isn't ``legacy_reference``, if any."""
    better = F.when(F.col("category") != "legacy_reference", F.col(ordinal))
    return rows.groupBy("uic", "asset_type").agg(
        F.min_by("instrument_key", ordinal).alias("instrument_key"), F.min("time_utc").alias("active_from"), F.coalesce(F.min_by("category", better), F.lit("legacy_reference")).alias("category"))

"""Validation and normalisation of bar samples, as column expressions and row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.functions.times import HOUR, plus_hours, seconds_between

PRICE = "decimal(24,12)"
FIELDS = ("open", "high", "low", "close")
FX_OVERLAP, OVERLAP = 72, 20


def decimal_value(text: Column, field: str, nullable: bool = False) -> tuple[Column, Column]:
    """The value and its error code: INVALID_<FIELD> unless it is a number (null only where allowed)."""
    value = text.try_cast(PRICE)
    bad = F.when(text.isNull(), F.lit(None) if nullable else F.lit(f"INVALID_{field.upper()}")).when(value.isNull(), f"INVALID_{field.upper()}")
    return value, bad


def parse_utc(text: Column) -> tuple[Column, Column]:
    """Time in UTC and error code: an offset is mandatory (TIME_NOT_UTC)."""
    has_offset = text.rlike(r"(Z|[+-]\d\d:?\d\d)$")
    return F.when(has_offset, F.try_to_timestamp(text)).cast("timestamp_ntz"), F.when(~has_offset | text.isNull(), "TIME_NOT_UTC").when(F.try_to_timestamp(text).isNull(), "INVALID_TIME")


def validate_ohlc(o: Column, h: Column, l: Column, c: Column) -> Column:  # noqa: E741
    """INVALID_OPEN, _HIGH, _LOW or _CLOSE for a missing price, NONPOSITIVE_OHLC, OHLC_VIOLATION or null."""
    missing = F.coalesce(*[F.when(p.isNull(), f"INVALID_{f.upper()}") for p, f in zip((o, h, l, c), FIELDS)])
    return F.when(missing.isNotNull(), missing).when(F.least(o, h, l, c) <= 0, "NONPOSITIVE_OHLC").when((h < F.greatest(o, l, c)) | (l > F.least(o, h, c)), "OHLC_VIOLATION")


def fx_mid(samples: DataFrame) -> DataFrame:
    """Mid prices (bid + ask) / 2 of bid_open .. ask_close, and the first failing rule of bid, ask and mid."""
    mids = [((F.col(f"bid_{f}") + F.col(f"ask_{f}")) / 2).cast(PRICE).alias(f) for f in FIELDS]
    rows = samples.select("*", *mids)
    check = lambda p: validate_ohlc(*(F.col(f"{p}{f}") for f in FIELDS))
    return rows.withColumn("error_code", F.coalesce(check("bid_"), check("ask_"), check("")))


def normalize_samples(samples: DataFrame, instruments: DataFrame) -> DataFrame:
    """Samples of chart pages as bars: FX prices are the mid of bid and ask, others the native ones with null quotes.

    ``error_code`` is that of the page, or the first failing rule of the sample: its time (TIME_NOT_UTC, INVALID_TIME), its instrument (UNKNOWN_INSTRUMENT), missing or
    unreadable prices (INVALID_OPENBID ...), the bid, ask and mid rules of ``validate_ohlc``, its volume, and FX_BID_ABOVE_ASK with the
    crossed fields in ``violations``.
    """
    known = instruments.select("instrument_key", "asset_type")
    fx = F.col("asset_type") == "FxSpot"
    mids = {f: F.when(fx, ((F.col(f"{f}_bid") + F.col(f"{f}_ask")) / 2).cast(PRICE)).otherwise(F.col(f)) for f in FIELDS}
    quotes = {f"{f}_{side}": F.when(fx, F.col(f"{f}_{side}")) for side in ("bid", "ask") for f in FIELDS}
    rows = samples.join(known, "instrument_key", "left").withColumns({**mids, **quotes})
    time, time_code = parse_utc(F.col("time_text"))
    side = lambda s: [F.col(f"{f}_{s}") for f in FIELDS]
    lacking_quote = F.coalesce(*[F.when(F.col(f"{f}_{s}").isNull(), f"INVALID_{f.upper()}{s.upper()}") for f in FIELDS for s in ("bid", "ask")])
    lacking = F.coalesce(*[F.when(F.col(f).isNull(), f"INVALID_{f.upper()}") for f in FIELDS])
    crossed = F.filter(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}_bid").alias("bid"), F.col(f"{f}_ask").alias("ask")) for f in FIELDS]), lambda x: x["bid"] > x["ask"])
    rows = rows.withColumn("violations", F.when(fx, crossed))
    own = F.coalesce(
        time_code, F.when(F.col("asset_type").isNull(), "UNKNOWN_INSTRUMENT"), F.when(fx, lacking_quote).otherwise(lacking), F.when(fx, F.coalesce(validate_ohlc(*side("bid")), validate_ohlc(*side("ask")))),
        validate_ohlc(*(F.col(f) for f in FIELDS)), F.when(F.col("volume_text").isNotNull() & F.col("volume").isNull(), "INVALID_VOLUME"), F.when(F.size("violations") > 0, "FX_BID_ABOVE_ASK"))
    return rows.withColumns({"time_utc": time, "error_code": F.coalesce(F.col("error_code"), own), "price_basis": F.when(fx, "bid_ask_mid").otherwise("native_ohlc")}).drop("time_text", "volume_text")


def quarantinable() -> Column:
    """Whether a row of ``normalize_samples`` may be set aside: its high or low alone is crossed.  Crossed opens and closes are quotes of one moment and fail the series."""
    return F.coalesce((F.col("error_code") == "FX_BID_ABOVE_ASK") & F.forall("violations", lambda v: v["field"].isin("high", "low")), F.lit(False))


def crossed_quotes(rows: DataFrame) -> DataFrame:
    """Adds ``violations``: the fields whose bid is above the ask, with both values."""
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"bid_{f}").alias("bid"), F.col(f"ask_{f}").alias("ask")) for f in FIELDS])
    return rows.withColumn("violations", F.filter(each, lambda x: x["bid"] > x["ask"]))


def split_quarantine(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Accepted rows, rows crossed in high or low alone (quarantined), and rows crossed in open or close (fatal for the batch)."""
    rows = crossed_quotes(rows)
    fatal = F.exists("violations", lambda x: x["field"].isin("open", "close"))
    some = F.size("violations") > 0
    return rows.where(~some), rows.where(some & ~fatal), rows.where(fatal)


def mark_incomplete(bars: DataFrame) -> DataFrame:
    """is_complete: not the newest row of its series in this batch."""
    w = Window.partitionBy("instrument_key").orderBy("time_utc")
    return bars.withColumn("is_complete", F.lead("time_utc").over(w).isNotNull())


def finalize_terminal(bars: DataFrame, sessions: DataFrame, retrieved: Column, delay_minutes: Column) -> DataFrame:
    """The newest incomplete bar of an ETF becomes complete if it is its session's terminal slot on a verified calendar and was retrieved after the
    close plus the delay; other asset types, which trade on past a session's end, are left alone.

    ``sessions``: calendar_id, session_date, open_utc, close_utc; bars carry asset_type, calendar_id, session_date and verification_status.
    """
    joined = bars.join(sessions.where("status <> 'HOLIDAY'").select("calendar_id", "session_date", "open_utc", "close_utc"), ["calendar_id", "session_date"], "left")
    terminal = plus_hours(F.col("open_utc"), F.floor((seconds_between(F.col("open_utc"), F.col("close_utc")) - 1) / HOUR))
    ripe = (F.col("asset_type") == "Etf") & (F.col("time_utc") == terminal) & (delay_minutes >= 0) & (retrieved >= F.timestamp_add("MINUTE", delay_minutes, F.col("close_utc"))) & (F.col("verification_status") == "VERIFIED")
    return joined.withColumn("is_complete", F.col("is_complete") | F.coalesce(ripe, F.lit(False))).drop("open_utc", "close_utc")


def admit(batch: DataFrame, now: Column) -> DataFrame:
    """One error code, or null, for each series of a batch."""
    counted = batch.groupBy("instrument_key").agg(
        F.count("*").alias("n"), F.count_if("is_complete").alias("complete"), F.count_distinct("data_version").alias("versions"), F.max(F.when(F.col("is_complete"), F.col("time_utc"))).alias("latest"))
    code = (F.when((F.col("n") < 2) | (F.col("complete") < 1), "INSUFFICIENT_INCREMENTAL_CHART_DATA").when(F.col("versions") > 1, "MULTIPLE_DATA_VERSIONS_IN_RUN")
            .when(F.col("latest") > now, "FUTURE_COMPLETED_BAR"))
    return counted.select("instrument_key", code.alias("error_code"))


def page_monotonic(samples: DataFrame) -> DataFrame:
    """Whether each page's times ascend strictly (page_number, position, time_utc)."""
    before = F.lag("time_utc").over(Window.partitionBy("instrument_key", "page_number").orderBy("position"))
    rows = samples.withColumn("rises", before.isNull() | (F.col("time_utc") > before))
    return rows.groupBy("instrument_key", "page_number").agg(F.bool_and("rises").alias("monotonic"))


def page_chain(pages: DataFrame, page_size: int) -> DataFrame:
    """For pages in request order (instrument_key, page_number, first_utc, last_utc, rows): whether each starts at the last time of the one before, moves on, and whether a short page ends the chain."""
    w = Window.partitionBy("instrument_key").orderBy("page_number")
    before = F.lag("last_utc").over(w)
    return pages.select(
        "instrument_key", "page_number", (before.isNull() | (F.col("first_utc") == before)).alias("linked"), (before.isNull() | (F.col("last_utc") > before)).alias("advances"),
        (F.col("rows") < page_size).alias("ends"))


def identity_drift(observed: DataFrame, registry: DataFrame) -> DataFrame:
    """Fields of each observed instrument that differ from the registry (uic if present, asset_type, symbol and currency case-insensitively)."""
    o, r = observed.alias("o"), registry.alias("r")
    joined = o.join(r, F.col("o.instrument_key") == F.col("r.instrument_key"))
    differs = F.array_compact(F.array(
        F.when(F.col("o.uic").isNotNull() & (F.col("o.uic") != F.col("r.uic")), "uic"), F.when(F.col("o.asset_type") != F.col("r.asset_type"), "asset_type"),
        F.when(F.lower("o.symbol") != F.lower("r.symbol"), "symbol"), F.when(F.upper("o.currency") != F.upper("r.currency"), "currency")))
    return joined.select(F.col("o.instrument_key").alias("instrument_key"), F.array_join(differs, ",").alias("mismatches")).where("mismatches <> ''")


def select_instruments(registry: DataFrame, keys: list[str]) -> DataFrame:
    """The registry's rows for the given keys, trimmed and in lower case; raises ValueError for none, repeats, unknown ones, or keys of both canonical and candidate
    instruments (``registry_kind``, if the registry has that column)."""
    wanted = [k.strip().lower() for k in keys]
    if not wanted or "" in wanted or len(set(wanted)) != len(wanted):
        raise ValueError("keys must be non-empty and unique")
    found = registry.where(F.col("instrument_key").isin(wanted))
    kind = F.col("registry_kind") if "registry_kind" in registry.columns else F.lit(None).cast("string")
    known = found.select("instrument_key", kind.alias("kind")).distinct().collect()  # as many as there are keys
    if unknown := sorted(set(wanted) - {r.instrument_key for r in known}):
        raise ValueError(f"unknown instruments: {', '.join(unknown)}")
    if len({r.kind for r in known}) > 1:
        raise ValueError("canonical and candidate instruments can't be chosen together")
    return found


def series_attributes(instruments: DataFrame) -> DataFrame:
    fx = F.col("asset_type") == "FxSpot"
    return instruments.select("instrument_key", F.when(fx, "bid_ask_mid").otherwise("native_ohlc").alias("price_basis"), F.when(fx, FX_OVERLAP).otherwise(OVERLAP).cast("long").alias("overlap_bars"))


def grade_rows(bars: DataFrame) -> DataFrame:
    return bars.withColumn("quality_status", F.when(F.col("is_complete"), "PASS").otherwise("NOT_EVALUATED"))


def valid_path(path: Column) -> Column:
    """Relative, without a drive letter or a parent segment."""
    return ~path.rlike(r"^(/|\\|[A-Za-z]:)") & ~path.rlike(r"(^|[/\\])\.\.([/\\]|$)") & (path != "")


def valid_digest(digest: Column) -> Column:
    return digest.rlike("^[0-9a-f]{64}$")


# Error codes of each domain.
OPERATIONAL = ["BLOCKED_RATE_LIMIT", "FAILED_NETWORK", "FAILED_SERVICE_UNAVAILABLE", "FAILED_INVALID_JSON", "FAILED_JSON_NOT_OBJECT", "FAILED_INSUFFICIENTPRIVILEGE"]
NOT_READY = ["DATA_NOT_READY", "INSUFFICIENT_INCREMENTAL_CHART_DATA"]
SOURCE_REVISION = ["BLOCKED_CANONICAL_WATERMARK_SET", "BLOCKED_FULL_REFETCH_REQUIRED", "BLOCKED_BOUNDED_REVISION_REQUIRED", "BLOCKED_REPEATED_DATA_VERSION_CHANGE", "BLOCKED_REVISION_SCOPE_UNRESOLVED_FULL_REFETCH_REQUIRED"]
NO_QUALITY_EVENT = ["BLOCKED_FULL_REFETCH_REQUIRED", "BLOCKED_BOUNDED_REVISION_REQUIRED", "BLOCKED_RATE_LIMIT", "FAILED_NETWORK", "FAILED_SERVICE_UNAVAILABLE", "FAILED_INVALID_JSON", "FAILED_JSON_NOT_OBJECT", "INSUFFICIENT_INCREMENTAL_CHART_DATA"]
TRANSIENT = ["BLOCKED_RATE_LIMIT", "FAILED_NETWORK", "DATA_NOT_READY", "INSUFFICIENT_INCREMENTAL_CHART_DATA"]


def error_domain(code: Column) -> Column:
    code = F.regexp_replace(F.coalesce(code, F.lit("")), "^(RETRY_EXHAUSTED:)+", "")
    return (
        F.when(code == "", "none").when(code.rlike("^(AUTH_|BLOCKED_TOKEN|BLOCKED_PERMISSION)"), "interface_auth")
        .when(code.isin(OPERATIONAL) | code.startswith("FAILED_HTTP_"), "interface_operational").when(code.isin(NOT_READY), "data_not_ready")
        .when(code.isin(SOURCE_REVISION), "source_revision").otherwise("data_quality"))


def records_quality_event(code: Column) -> Column:
    return ~(code.rlike("^(AUTH_|FAILED_HTTP_|BLOCKED_TOKEN|BLOCKED_PERMISSION|BLOCKED_REVISION_)") | code.isin(NO_QUALITY_EVENT))


def retry_disposition(code: Column) -> Column:
    return F.when(code.isin(TRANSIENT) | code.startswith("FAILED_HTTP_429"), "TRANSIENT_RETRY").otherwise("OPERATOR_ACTION_REQUIRED")


def summary_events(summary: DataFrame, counters: list[str]) -> DataFrame:
    """FAIL rows as ERROR events with their non-empty counters as JSON."""
    observed = F.to_json(F.struct(*[F.col(c) for c in counters]))
    return summary.where("quality_status = 'FAIL'").select("series_key", F.lit("ERROR").alias("severity"), observed.alias("observed_value"))

"""Total-return series: validation, completeness, revisions, index, corporate actions, contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from barloom.operators.digests import ordered_hash
from barloom.operators.reads import paged

VALUES = ("close_unadjusted", "adjusted_close", "dividend_cash", "split_factor")


def validate_batch(rows: DataFrame, tickers: list[str]) -> DataFrame:
    """Error rows (arrival, error_code) of a batch with an arrival order.

    A date reversal compares with the row before of the same ticker that has a valid date and is not a duplicate.  Of a ticker only these rows,
    one for each date, stand in one order; all others are dealt out by a hash of their arrival.
    """
    apart, dated = F.xxhash64("arrival"), F.col("date").isNotNull()
    first = F.row_number().over(Window.partitionBy("ticker", "date", F.when(~dated, apart)).orderBy("arrival")) == 1
    rows = rows.withColumn("valid", dated).withColumn("first", dated & first)
    before = F.lag("date").over(Window.partitionBy("ticker", F.when(~F.col("first"), apart)).orderBy("arrival"))  # read for first rows alone
    bad = lambda c, ok: ~F.coalesce(ok, F.lit(False))
    codes = F.array_compact(F.array(
        F.when(~F.col("ticker").isin(tickers), "UNSUPPORTED_TICKER"), F.when(~F.col("valid"), "INVALID_DATE"), F.when(F.col("valid") & ~F.col("first"), "DUPLICATE_DATE"),
        F.when(F.col("first") & (F.col("date") < F.col("before")), "DATE_REVERSAL"),
        F.when(bad("c", F.col("close_unadjusted") > 0), "NONPOSITIVE_CLOSE"), F.when(bad("a", F.col("adjusted_close") > 0), "NONPOSITIVE_ADJUSTED_CLOSE"),
        F.when(bad("d", F.col("dividend_cash") >= 0), "INVALID_DIVIDEND"), F.when(bad("s", F.col("split_factor") > 0), "INVALID_SPLIT_FACTOR")))
    return rows.withColumn("before", before).select("arrival", "ticker", F.explode(codes).alias("error_code"))


#: Values that a row of a publishable dataset must have, all positive.
QUALITY_VALUES = ("open_unadjusted", "high_unadjusted", "low_unadjusted", "close_unadjusted", "adjusted_close", "total_return_index")


def research_quality(rows: DataFrame, sessions: DataFrame, tickers: list[str]) -> DataFrame:
    """Error rows (ticker, error_code, detail) of a dataset before it is published, each once: all of ``validate_batch``, required values that are null or not positive, negative volumes, highs
    and lows that don't hold the other prices, missing revisions, sessions without a row, and tickers without any."""
    base = validate_batch(rows, tickers).select("ticker", "error_code", F.col("arrival").cast("string").alias("detail"))
    value = lambda c: F.col(c)
    o, h, l, c = (value(f"{f}_unadjusted") for f in ("open", "high", "low", "close"))  # noqa: E741
    code = lambda name, field=None: F.struct(F.lit(name).alias("error_code"), (F.lit(field) if field else F.col("arrival").cast("string")).alias("detail"))
    whole = o.isNotNull() & h.isNotNull() & l.isNotNull() & c.isNotNull()
    found = [F.when(value(f).isNull(), code("NULL_REQUIRED_VALUE", f)).when(value(f) <= 0, code("NONPOSITIVE_VALUE", f)) for f in QUALITY_VALUES]
    found += [
        F.when(F.col("volume") < 0, code("NEGATIVE_VOLUME")), F.when(whole & (h < F.greatest(o, l, c)), code("OHLC_HIGH_INCONSISTENT")), F.when(whole & (l > F.least(o, h, c)), code("OHLC_LOW_INCONSISTENT")),
        F.when(F.coalesce(F.trim("provider_revision"), F.lit("")) == "", code("PROVIDER_REVISION_MISSING"))]
    own = rows.select("ticker", F.explode(F.array_compact(F.array(*found))).alias("e"), "arrival").select("ticker", "e.error_code", F.when(F.col("e.error_code").isin("NULL_REQUIRED_VALUE", "NONPOSITIVE_VALUE"), F.concat_ws(":", "e.detail", F.col("arrival").cast("string"))).otherwise(F.col("e.detail")).alias("detail"))
    asked = rows.sparkSession.createDataFrame([(t,) for t in tickers], "ticker string")
    held = rows.where("date is not null").select("ticker", F.col("date").alias("session_date")).distinct()
    expected = asked.crossJoin(F.broadcast(sessions.select("session_date").distinct()))  # the tickers asked for; a calendar's sessions are few
    missing = expected.join(held, ["ticker", "session_date"], "left_anti").select("ticker", F.lit("MISSING_EXPECTED_SESSION").alias("error_code"), F.col("session_date").cast("string").alias("detail"))
    none = asked.join(held, "ticker", "left_anti").select("ticker", F.lit("TICKER_MISSING").alias("error_code"), F.lit("").alias("detail"))
    return base.unionByName(own).unionByName(missing).unionByName(none).distinct()


def batch_content(rows: DataFrame) -> DataFrame:
    """rows and content_sha256 of a whole batch, in order of ticker, date and arrival."""
    columns = [c for c in ("ticker", "date", *VALUES) if c in rows.columns]
    return ordered_hash(rows.withColumn("batch", F.lit("batch")), "batch", ["ticker", "date", "arrival"], columns).select("rows", "content_sha256")


def completeness(rows: DataFrame, sessions: DataFrame) -> DataFrame:
    """Expected sessions (session_date) that each ticker of the rows lacks."""
    tickers = rows.select("ticker").distinct()
    expected = tickers.crossJoin(F.broadcast(sessions.select("session_date").distinct()))  # a calendar's sessions are few
    return expected.join(rows.select("ticker", F.col("date").alias("session_date")), ["ticker", "session_date"], "left_anti")


def revision_keys(previous: DataFrame, current: DataFrame, content: list[str]) -> DataFrame:
    """ticker:date of rows in both batches whose content differs."""
    p, c = previous.alias("p"), current.alias("c")
    joined = p.join(c, (F.col("p.ticker") == F.col("c.ticker")) & (F.col("p.date") == F.col("c.date")))
    changed = ~F.struct(*[F.col(f"p.{x}").alias(x) for x in content]).eqNullSafe(F.struct(*[F.col(f"c.{x}").alias(x) for x in content]))
    return joined.where(changed).select(F.concat_ws(":", F.col("p.ticker"), F.col("p.date").cast("string")).alias("revision_key"))


def total_return_index(rows: DataFrame) -> DataFrame:
    """adjusted_close / first known adjusted_close * 100, from the first known one on."""
    w = Window.partitionBy("ticker").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    base = F.first("adjusted_close", ignorenulls=True).over(w)
    return rows.withColumn("total_return_index", F.when(base > 0, (F.col("adjusted_close") / base * 100).cast("decimal(24,6)")))


def split_factor(event) -> F.Column:
    """From numerator and denominator, else from a text ``a:b``; null where neither gives a number."""
    parts = F.split(event["ratio"], ":")
    return F.coalesce(F.try_divide(event["numerator"], event["denominator"]), F.try_divide(parts[0].try_cast("double"), parts[1].try_cast("double")))


def corporate_actions(rows: DataFrame, dividends: DataFrame, splits: DataFrame) -> DataFrame:
    """Rows with the sum of a date's dividends (0) and the last of its split factors (1)."""
    d = dividends.groupBy("ticker", "date").agg(F.sum("amount").alias("dividend_cash"))
    s = splits.groupBy("ticker", "date").agg(F.max_by("factor", "sequence").alias("split_factor"))
    joined = rows.join(d, ["ticker", "date"], "left").join(s, ["ticker", "date"], "left")
    return joined.withColumn("dividend_cash", F.coalesce("dividend_cash", F.lit(0))).withColumn("split_factor", F.coalesce("split_factor", F.lit(1)))


def switch_current(datasets: DataFrame, new_id: str) -> DataFrame:
    """The given dataset becomes the current one of its kind, all others are not."""
    kind = datasets.where(F.col("dataset_id") == new_id).select("kind")
    same = datasets.join(kind.withColumn("hit", F.lit(True)).distinct(), "kind", "left")
    return same.withColumn("is_current", F.when(F.col("hit"), F.col("dataset_id") == new_id).otherwise(F.col("is_current"))).drop("hit")


def candidates(mappings: DataFrame, datasets: DataFrame) -> DataFrame:
    """Active approved mappings, current datasets preferred, with the number of candidates of each instrument."""
    joined = mappings.where("active and approved").join(datasets.select("dataset_id", "is_current"), "dataset_id")
    best = Window.partitionBy("instrument_key")
    joined = joined.withColumn("any_current", F.bool_or("is_current").over(best)).where("is_current or not any_current")
    return joined.select("instrument_key", "dataset_id", "external_key", F.count("*").over(best).alias("candidates"))


def rows_page(rows: DataFrame, ticker: str, start, end, eligible: bool, after: tuple | None = None, limit: int = 100) -> DataFrame:
    """A page of a ticker's rows in [start, end), after a date (null dates come first), PASS rows alone if ``eligible``, with ``truncated`` and ``next_key``."""
    out = rows.where((F.col("ticker") == ticker) & (F.col("date").isNull() | ((F.col("date") >= start) & (F.col("date") < end))))
    if eligible:
        out = out.where("quality_status = 'PASS'")
    return paged(out, ["date"], after, limit)


def profile(rows: DataFrame) -> DataFrame:
    """Rows, dates, duplicates, null or nonpositive prices and status counts of each ticker."""
    price = F.col("adjusted_close")
    return rows.groupBy("ticker").agg(
        F.count("*").alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), (F.count("*") - F.count_distinct("date")).alias("duplicate_rows"),
        F.count_if(price.isNull() | (price <= 0)).alias("bad_prices"), *[F.count_if(F.col("quality_status") == s).alias(f"{s.lower()}_rows") for s in ("PASS", "WARN", "FAIL")])


def conformance(profiles: DataFrame, contract: DataFrame) -> DataFrame:
    """What of the contract (expected_rows, expected_first, expected_last, expected_warn) a ticker's profile breaks, joined."""
    joined = contract.join(profiles, "ticker", "left")
    broken = F.array_compact(F.array(
        F.when(F.col("rows").isNull(), "SERIES_MISSING"), F.when(F.col("rows") != F.col("expected_rows"), "ROW_COUNT"), F.when(F.col("first_date") != F.col("expected_first"), "FIRST_DATE"),
        F.when(F.col("last_date") != F.col("expected_last"), "LAST_DATE"), F.when(F.col("duplicate_rows") > 0, "DUPLICATES"), F.when(F.col("warn_rows") != F.col("expected_warn"), "WARNING_COUNT")))
    return joined.select("ticker", F.array_join(broken, ",").alias("blockers"))


def contract_audit(conformances: DataFrame) -> DataFrame:
    return conformances.agg(F.count("*").alias("series"), F.count_if(F.col("blockers") != "").alias("blocked"), F.when(F.bool_and(F.col("blockers") == ""), "PASS").otherwise("BLOCKED").alias("overall"))


def windows_inside(requests: DataFrame, contract: DataFrame) -> DataFrame:
    """Whether each requested [start, end) lies in its ticker's contract window."""
    joined = requests.join(contract, "ticker", "left")
    inside = (F.col("start_date") >= F.col("window_start")) & (F.col("end_date") <= F.col("window_end")) & (F.col("start_date") < F.col("end_date"))
    return joined.select(*requests.columns, F.coalesce(inside, F.lit(False)).alias("inside"))


def full_history(rows: DataFrame, contract: DataFrame, after=None) -> DataFrame:
    """Rows inside each ticker's contract window (after a date, if one is given), checked: status PASS or the first rule that fails, and the tree hash of their content in order.

    ``contract``: ticker, window_start, window_end, expected_rows, expected_warn.  A price or index that isn't positive fails the quality, a count,
    bound or repeated date the coverage.
    """
    inside = rows.join(contract, "ticker").where("date between window_start and window_end")
    if after is not None:
        inside = inside.where(F.col("date") > after)
    found = inside.groupBy("ticker", "window_start", "window_end", "expected_rows", "expected_warn").agg(
        F.count("*").alias("row_count"), F.count_distinct("date").alias("dates"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count_if(F.col("quality_status") == "WARN").alias("warn_rows"),
        F.count_if(~F.coalesce(F.col("adjusted_close") > 0, F.lit(False))).alias("bad_rows"))
    content = ordered_hash(inside, "ticker", ["date"], ["date", "adjusted_close", "quality_status"]).select("ticker", "content_sha256")
    covered = (F.col("row_count") == F.col("expected_rows")) & (F.col("dates") == F.col("row_count")) & (F.col("first_date") == F.col("window_start")) & (F.col("last_date") == F.col("window_end"))
    status = F.when(F.col("bad_rows") > 0, "QUALITY_FAILED").when(~covered, "COVERAGE_FAILED").when(F.col("warn_rows") != F.col("expected_warn"), "QUALITY_FAILED").otherwise("PASS")
    return found.join(content, "ticker").select("ticker", "row_count", "first_date", "last_date", "warn_rows", status.alias("history_status"), "content_sha256")

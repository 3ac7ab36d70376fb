"""The whole ingest of chart pages as one stream: from page JSON to raw, quarantined, curated and derived bars.

A micro-batch is parsed and validated once, into ``staged``; everything else reads that.  A series of the batch passes or stays as it
was: it is refused if any of its samples is wrong (crossed highs and lows may be quarantined instead), if it has too few rows or rows from
the future, or if the provider's data version isn't the accepted one.  Of a series that passes, rows within its lookback (its last 72 complete FX
bars, 20 of others) are taken, so late corrections land; older ones are reported and left out.

Tables below the folder, each with a version ``v=<batch>`` for every batch:

* ``staged``: all samples with their error codes;
* ``raw``, ``quarantine``, ``late``, ``outcomes``: what the batch appended; all versions together are the table;
* ``curated``, ``bars_4h``, ``bars_1d``: by session day, as in ``streaming.bars``: only touched days are written, only touched sessions derived;
* ``states``: a row for each series, its watermarks, data version, status and last complete times.

A batch that runs again after a failure overwrites its own versions from the same inputs; readers take the last committed batch, so its tables
appear together or not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from barloom.operators import bars as der, merge as m, normalize as nz
from barloom.operators.calendar import open_sessions, session_date_of, terminal_slot
from barloom.sources.files import explode_chart_pages
from barloom.streaming.bars import _run, _session_dated, last_batch, read_days, read_version, version_path, write_days

STATES = (
    "instrument_key string, price_basis string, latest_seen_utc timestamp_ntz, latest_complete_utc timestamp_ntz, data_version bigint, run_id bigint, "
    "data_status string, status_code string, recent array<timestamp_ntz>")
APPENDED = ("raw", "quarantine", "late", "outcomes")
# The states of a series.
ACTIVE, STALE, BLOCKED = "ACTIVE", "STALE_DATA_VERSION", "BLOCKED_QUALITY"
#: What a bar is; all tables of hourly bars have these columns.
BAR = ["instrument_key", "price_basis", "time_utc", *m.CONTENT, "data_version", "delayed_by_minutes", "retrieved_utc", "artifact_relative_path", "run_id"]


class PageIngest:
    """The stream's step and its readers.

    ``instruments``: instrument_key, asset_type, calendar_id, verification_status; ``sessions``: as in ``operators.calendar``; pages have instrument_key,
    page_number, body (JSON), retrieved_utc and artifact_relative_path.  ``most_rows`` and ``most_rate`` bound what a series may have quarantined in a batch.
    """

    def __init__(self, spark: SparkSession, folder: str, instruments: DataFrame, sessions: DataFrame, most_rows: int = 10, most_rate: str = "0.0001"):
        self.spark, self.folder, self.sessions, self.limits = spark, folder, sessions, (most_rows, most_rate)
        self.instruments = instruments.select("instrument_key", "asset_type", "calendar_id", "verification_status")
        self.checkpoint = f"{folder}/checkpoint"

    def run(self, pages: DataFrame) -> None:
        """Take all pages that are there now."""
        _run(pages, self.step, self.checkpoint)

    # --- readers --------------------------------------------------------------------------------

    def appended(self, name: str, schema: T.StructType | str | None = None) -> DataFrame:
        """``raw``, ``quarantine``, ``late`` or ``outcomes`` of all committed batches, with the batch as ``v``."""
        rows = self.spark.read.schema(schema).parquet(f"{self.folder}/{name}") if schema else self.spark.read.parquet(f"{self.folder}/{name}")
        return rows.where(F.col("v") <= last_batch(self.spark, self.checkpoint))

    def states(self) -> DataFrame:
        return read_version(self.spark, f"{self.folder}/states", last_batch(self.spark, self.checkpoint), STATES)

    def days(self, name: str) -> DataFrame:
        """``curated``, ``bars_4h`` or ``bars_1d`` as the last committed batch left it."""
        n = last_batch(self.spark, self.checkpoint)
        return read_days(self.spark, f"{self.folder}/{name}", n, self._schema(name))

    def _schema(self, name: str) -> T.StructType:
        hours = self.spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in self._hour_types()))
        if name == "curated":
            return hours.schema
        rows = hours.join(self.instruments, "instrument_key")
        return (der.derive_4h if name == "bars_4h" else der.derive_1d)(rows, self.sessions).schema

    @staticmethod
    def _hour_types() -> list[tuple[str, str]]:
        kinds = {"instrument_key": "string", "price_basis": "string", "time_utc": "timestamp_ntz", "volume": "decimal(30,8)", "market_trading_state": "string", "is_complete": "boolean", "data_version": "bigint",
                 "delayed_by_minutes": "int", "retrieved_utc": "timestamp_ntz", "artifact_relative_path": "string", "run_id": "bigint"}
        return [(c, kinds.get(c, nz.PRICE)) for c in BAR] + [("quality_status", "string")]

    # --- a batch --------------------------------------------------------------------------------

    def _stored(self, rows: DataFrame, name: str, n: int) -> DataFrame:
        path = version_path(f"{self.folder}/{name}", n)
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def step(self, batch: DataFrame, n: int) -> None:
        staged = self._stored(nz.normalize_samples(explode_chart_pages(batch), self.instruments).drop("asset_type"), "staged", n)
        states = read_version(self.spark, f"{self.folder}/states", n - 1, STATES)
        apart = staged.where(nz.quarantinable())
        merged = self._completed(m.merge_pages(staged.where("error_code is null")))
        outcomes = self._stored(self._outcomes(staged, merged, apart, states), "outcomes", n)
        passed = outcomes.where(F.col("data_status") == ACTIVE).select("instrument_key", "overlap_start_utc")

        rows = merged.join(passed, "instrument_key").withColumn("run_id", F.lit(n).cast("long"))
        old = F.coalesce(F.col("time_utc") < F.col("overlap_start_utc"), F.lit(False))
        self._stored(rows.where(old).select(*BAR, "overlap_start_utc"), "late", n)
        taken = self._stored(nz.grade_rows(rows.where(~old)).select(*[c for c, _ in self._hour_types()]), "raw", n)
        aside = apart.join(passed.select("instrument_key"), "instrument_key", "left_semi").dropDuplicates(["instrument_key", "time_utc"])
        digest = F.sha2(F.to_json(F.struct("instrument_key", "time_utc", "violations")), 256)
        self._stored(aside.select("instrument_key", "time_utc", "data_version", "error_code", "violations", "artifact_relative_path", digest.alias("content_sha256")), "quarantine", n)

        days = self._dated(taken).select("bar_day").distinct()
        self._upsert(taken, days, n)
        self._derive(taken, days, n)
        self._advance(states, taken, outcomes, n).write.mode("overwrite").parquet(version_path(f"{self.folder}/states", n))

    def _dated(self, rows: DataFrame) -> DataFrame:
        return _session_dated(rows.join(self.instruments.select("instrument_key", "asset_type"), "instrument_key")).drop("asset_type")

    def _completed(self, merged: DataFrame) -> DataFrame:
        """All but a series' newest row are complete, and so is an ETF's newest at its session's terminal slot once the close and the delay are past."""
        newest = merged.groupBy("instrument_key").agg(F.max("time_utc").alias("newest_utc"))
        rows = merged.join(newest, "instrument_key").withColumn("is_complete", F.col("time_utc") < F.col("newest_utc"))
        last = rows.where("time_utc = newest_utc").join(self.instruments, "instrument_key").where("asset_type = 'Etf' and verification_status = 'VERIFIED'")
        last = last.withColumn("session_date", session_date_of(F.col("time_utc"))).join(open_sessions(self.sessions), ["calendar_id", "session_date"])
        ripe = (F.col("time_utc") == terminal_slot()) & (F.col("delayed_by_minutes") >= 0) & (F.col("retrieved_utc") >= F.timestamp_add("MINUTE", F.col("delayed_by_minutes"), F.col("close_utc")))
        final = last.where(ripe).select("instrument_key", F.lit(True).alias("final"))
        return rows.join(final, "instrument_key", "left").withColumn("is_complete", F.col("is_complete") | F.coalesce("final", F.lit(False))).drop("newest_utc", "final")

    def _outcomes(self, staged: DataFrame, merged: DataFrame, apart: DataFrame, states: DataFrame) -> DataFrame:
        """A row for each series of the batch: its status, code and where its lookback starts."""
        wrong = F.when(F.col("error_code").isNotNull() & ~nz.quarantinable(), F.struct("page_number", "position", "error_code"))
        seen = staged.groupBy("instrument_key").agg(F.min(wrong)["error_code"].alias("sample_code"), F.min("price_basis").alias("price_basis"), F.count("*").alias("samples"), F.max("retrieved_utc").alias("retrieved"))
        held = merged.groupBy("instrument_key").agg(
            F.count("*").alias("n"), F.count_if("is_complete").alias("complete"), F.count_distinct("data_version").alias("versions"), F.max("data_version").alias("observed_version"),
            F.max(F.when(F.col("is_complete"), F.col("time_utc"))).alias("latest"))
        admitted = m.quarantine_admission(merged.select("instrument_key", "time_utc"), apart.select("instrument_key", "time_utc", *nz.FIELDS), *self.limits)
        known = states.select("instrument_key", F.col("data_version").alias("known_version"), "recent")
        rows = seen.join(held, "instrument_key", "left").join(admitted.select("instrument_key", F.col("error_code").alias("quarantine_code")), "instrument_key", "left").join(known, "instrument_key", "left")
        rows = rows.join(self.instruments.select("instrument_key", "asset_type"), "instrument_key", "left")
        code = F.coalesce(
            F.col("sample_code"), F.col("quarantine_code"), F.when((F.coalesce("n", F.lit(0)) < 2) | (F.coalesce("complete", F.lit(0)) < 1), "INSUFFICIENT_INCREMENTAL_CHART_DATA"),
            F.when(F.col("versions") > 1, "MULTIPLE_DATA_VERSIONS_IN_RUN"), F.when(F.col("latest") > F.col("retrieved"), "FUTURE_COMPLETED_BAR"))
        rows = rows.withColumn("status_code", code)
        changed = F.col("status_code").isNull() & (F.col("known_version") != F.col("observed_version"))
        status = F.when(changed, STALE).when(F.col("status_code").isNull(), ACTIVE).when(nz.records_quality_event(F.col("status_code")), BLOCKED)
        bars = F.when(F.col("asset_type") == "FxSpot", nz.FX_OVERLAP).otherwise(nz.OVERLAP)
        start = F.when(F.size("recent") >= bars, F.element_at("recent", bars))
        return rows.select(
            "instrument_key", "price_basis", status.alias("data_status"), F.when(changed, "DATA_VERSION_CHANGED_REVIEW_PENDING").otherwise(F.col("status_code")).alias("status_code"), "samples", "known_version", "observed_version", start.alias("overlap_start_utc"))

    def _upsert(self, taken: DataFrame, days: DataFrame, n: int) -> None:
        before = read_days(self.spark, f"{self.folder}/curated", n - 1, taken.schema, days)
        write_days(self._dated(m.upsert(before, taken)), f"{self.folder}/curated", n, days)

    def _derive(self, taken: DataFrame, days: DataFrame, n: int) -> None:
        """The touched sessions anew from all their hours; the other series' bars of these days stay."""
        touched = self._dated(taken).select("instrument_key", "bar_day").distinct()
        hours = self._dated(read_days(self.spark, f"{self.folder}/curated", n, taken.schema, days)).join(touched, ["instrument_key", "bar_day"], "left_semi")
        hours = hours.drop("bar_day").join(self.instruments, "instrument_key")
        for name, derive in (("bars_4h", der.derive_4h), ("bars_1d", der.derive_1d)):
            anew = derive(hours, self.sessions)
            dated = (lambda rows: self._dated(rows)) if name == "bars_4h" else (lambda rows: rows.withColumn("bar_day", F.col("session_date")))
            rest = dated(read_days(self.spark, f"{self.folder}/{name}", n - 1, anew.schema, days)).join(touched, ["instrument_key", "bar_day"], "left_anti")
            write_days(rest.unionByName(dated(anew)), f"{self.folder}/{name}", n, days)

    def _advance(self, states: DataFrame, taken: DataFrame, outcomes: DataFrame, n: int) -> DataFrame:
        """States after the batch: watermarks of series that passed never go back; others keep theirs and get the batch's status."""
        newest = Window.partitionBy(*m.SERIES).orderBy(F.col("time_utc").desc())
        complete = taken.where("is_complete").select(*m.SERIES, "time_utc").withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= nz.FX_OVERLAP)
        last = complete.groupBy(*m.SERIES).agg(F.collect_list("time_utc").alias("times"))  # at most FX_OVERLAP each
        seen = taken.groupBy(*m.SERIES).agg(
            F.max("time_utc").alias("seen"), F.max(F.when(F.col("is_complete"), F.col("time_utc"))).alias("complete"), F.max("data_version").alias("version"),
            F.collect_list(F.when(~F.col("is_complete"), F.col("time_utc"))).alias("open_times"))  # the newest row of each series alone
        told = outcomes.select("instrument_key", F.col("price_basis").alias("batch_basis"), F.col("data_status").alias("batch_status"), F.col("status_code").alias("batch_code"))
        rows = states.join(seen.join(last, m.SERIES, "left"), m.SERIES, "full").join(told, "instrument_key", "full")
        none = F.array().cast("array<timestamp_ntz>")
        times = F.array_except(F.array_distinct(F.concat(F.coalesce("recent", none), F.coalesce("times", none))), F.coalesce("open_times", none))
        rows = rows.withColumn("price_basis", F.coalesce("price_basis", "batch_basis")).where("price_basis is not null")
        return rows.select(
            *m.SERIES, F.greatest("latest_seen_utc", "seen").alias("latest_seen_utc"), F.greatest("latest_complete_utc", "complete").alias("latest_complete_utc"), F.coalesce("version", "data_version").alias("data_version"),
            F.when(F.col("seen").isNotNull(), F.lit(n).cast("long")).otherwise(F.col("run_id")).alias("run_id"), F.coalesce("batch_status", "data_status").alias("data_status"),
            F.when(F.col("batch_status").isNotNull(), F.col("batch_code")).otherwise(F.col("status_code")).alias("status_code"), F.slice(F.sort_array(times, asc=False), 1, nz.FX_OVERLAP).alias("recent"))


def feed(rows: DataFrame, folder: str, parts: Column, numbers: list[int]):
    """Write the rows of each part into a stream's folder, and yield after each, for the stream to take it."""
    for k in numbers:
        rows.where(parts == k).write.mode("append").parquet(folder)
        yield k

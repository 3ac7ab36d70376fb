"""Append-only sink of forward samples: each key once, however late it comes.

Each micro-batch writes its new rows as a version, divided by day, and for each of its days a filter of the keys it holds (a Bloom filter of
``HASHES`` bits a key, in bitmaps of 32,768 bits).  A batch asks the filters of its own days which versions may hold its keys, and reads those days of
those versions alone; what it finds there decides.  All versions together are the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from barloom.operators.normalize import PRICE, valid_digest
from barloom.streaming.bars import _dated, _run, version_path

KEY = ["run_id", "instrument_key", "time_utc", "price_basis"]
HASHES, BITS_EACH, BITMAP = 3, 16, 32_768
FILTERS = "bar_day date, bucket bigint, buckets bigint, bits binary, v bigint"
_QUOTES = [f"{f}_{s}" for s in ("bid", "ask") for f in ("open", "high", "low", "close")]
# The fields of a payload and their types; those of the second kind may be empty.
NEEDED = {**dict.fromkeys(("open", "high", "low", "close"), PRICE), "retrieved_at_utc": "timestamp", "payload_sha256": "string"}
OPTIONAL = {**dict.fromkeys(_QUOTES, PRICE), "volume": "decimal(30,8)", "data_version": "bigint", "delayed_by_minutes": "int"}


def parse_payload(rows: DataFrame) -> DataFrame:
    """Samples (run_id, source_file_id, instrument_key, horizon_minutes, time_utc, price_basis, payload: JSON) as typed rows with ``error_code``.

    Empty texts of optional fields are null; a field that can't be read as its type, or a needed one that is absent, is INVALID_<FIELD>, a payload that is no object INVALID_PAYLOAD.
    """
    names = ["is_complete", "market_trading_state", *NEEDED, *OPTIONAL]
    p = F.from_json("payload", T.StructType([T.StructField(n, T.StringType()) for n in names]))
    rows = rows.withColumn("p", p)
    told = lambda n: F.nullif(F.col(f"p.{n}"), F.lit("")) if n in OPTIONAL else F.col(f"p.{n}")
    typed = {n: told(n).try_cast(kind) for n, kind in {**NEEDED, **OPTIONAL}.items()}
    typed["retrieved_at_utc"] = typed["retrieved_at_utc"].cast("timestamp_ntz")
    broken = [F.when((told(n).isNotNull() if n in OPTIONAL else F.lit(True)) & typed[n].isNull(), f"INVALID_{n.upper()}") for n in typed]
    digest = F.when(~valid_digest(F.col("p.payload_sha256")), "INVALID_PAYLOAD_SHA256")
    none = F.forall(F.array(*[F.col(f"p.{n}") for n in names]), lambda x: x.isNull())
    code = F.coalesce(_refused(F.col("p.is_complete").try_cast("boolean")), F.when(none, "INVALID_PAYLOAD"), *broken, digest)
    # A payload without any readable field isn't an incomplete bar but a broken payload.
    code = F.when(none & (F.col("horizon_minutes") == 60), "INVALID_PAYLOAD").otherwise(code)
    out = rows.withColumn("error_code", code).withColumns({n: v.alias(n) for n, v in typed.items()})
    return out.withColumn("market_trading_state", F.col("p.market_trading_state")).withColumn("is_complete", F.col("p.is_complete").try_cast("boolean")).drop("p", "payload")


def _refused(is_complete: Column) -> Column:
    return F.when(~F.coalesce(F.col("horizon_minutes") == 60, F.lit(False)), "HORIZON_NOT_60").when(~F.coalesce(is_complete, F.lit(False)), "INCOMPLETE_BAR")


def _places(buckets: Column) -> Column:
    """The places of a key's bits in a filter of some bitmaps."""
    return F.array(*[F.pmod(F.xxhash64(*KEY, F.lit(i)), buckets * BITMAP) for i in range(HASHES)])


def key_filters(rows: DataFrame) -> DataFrame:
    """bar_day, bucket, buckets and bits of the filters of dated rows."""
    sizes = rows.groupBy("bar_day").agg(F.ceil(F.count("*") * BITS_EACH / BITMAP).alias("buckets"))
    placed = rows.join(sizes, "bar_day").select("bar_day", "buckets", F.explode(_places(F.col("buckets"))).alias("place"))
    return placed.groupBy("bar_day", F.floor(F.col("place") / BITMAP).alias("bucket"), "buckets").agg(F.bitmap_construct_agg(F.col("place") % BITMAP).alias("bits"))


def may_hold(rows: DataFrame, filters: DataFrame) -> DataFrame:
    """v and bar_day of the versions whose filters may hold a key of the dated rows."""
    heads = filters.select("v", "bar_day", "buckets").distinct()
    keys = rows.select("bar_day", *KEY).distinct().join(heads, "bar_day")
    asked = keys.select("v", "bar_day", F.xxhash64(*KEY).alias("key"), F.explode(F.array_distinct(_places(F.col("buckets")))).alias("place"))
    asked = asked.withColumn("bucket", F.floor(F.col("place") / BITMAP)).withColumn("bit", F.col("place") % BITMAP)
    joined = asked.join(filters.select("v", "bar_day", "bucket", "bits"), ["v", "bar_day", "bucket"], "left")
    byte = F.conv(F.hex(F.substr("bits", (F.floor(F.col("bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1, F.lit(False))
    return joined.groupBy("v", "bar_day", "key").agg(F.bool_and(is_set).alias("there")).where("there").select("v", "bar_day").distinct()


def stored_keys(rows: DataFrame, folder: str, batch: int) -> DataFrame | None:
    """Keys of the earlier versions and days that may hold those of the dated rows; None where none may."""
    spark = rows.sparkSession
    filters = spark.read.schema(FILTERS).parquet(f"{folder}-keys").where(F.col("v") < batch)
    places = may_hold(rows, filters).collect()  # names of partitions to read, as a listing gives them
    if not places:
        return None
    paths = [f"{version_path(folder, r['v'])}/bar_day={r['bar_day']}" for r in places]
    return spark.read.schema(rows.select(*KEY).schema).option("basePath", folder).parquet(*paths).select(*KEY)


def stream_forward_append(stream: DataFrame, folder: str, checkpoint: str, rejects: str | None = None) -> None:
    """Append complete 60-minute samples once; empty texts become null.

    A stream with a ``payload`` column is parsed first.  Under ``rejects`` each batch writes what it refused with an ``error_code``: that of the payload,
    HORIZON_NOT_60, INCOMPLETE_BAR, and DUPLICATE_KEY for a key that stands in the table or that came twice.  Without ``rejects``, wrong rows
    raise an error and repeats are dropped.
    """
    def step(batch: DataFrame, n: int) -> None:
        if "payload" in batch.columns:
            batch = parse_payload(batch)
        else:
            batch = batch.withColumns({c: F.nullif(F.col(c), F.lit("")) for c, t in batch.dtypes if t == "string"}).withColumn("error_code", _refused(F.col("is_complete")))
        if rejects is None:
            batch = batch.withColumn("error_code", F.when(F.col("error_code").isNotNull(), F.raise_error(F.col("error_code")).cast("string")))
        good = _dated(batch.where("error_code is null").drop("error_code"))
        first = Window.partitionBy(*KEY).orderBy(*[c for c, t in good.dtypes if c not in KEY and not t.startswith("map")] or [F.lit(1)])
        ranked = good.withColumn("__rank", F.row_number().over(first))
        rows, again = ranked.where("__rank = 1").drop("__rank"), ranked.where("__rank > 1").drop("__rank")
        stored = stored_keys(rows, folder, n) if n else None  # the versions before this one: a batch that is run again doesn't meet its own rows
        if stored is not None:
            same = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in KEY]
            again = again.unionByName(rows.alias("r").join(stored.alias("s"), same, "left_semi"))
            rows = rows.alias("r").join(stored.alias("s"), same, "left_anti")
        if rejects is not None:
            refused = batch.where("error_code is not null").unionByName(again.drop("bar_day").withColumn("error_code", F.lit("DUPLICATE_KEY")))
            refused.write.mode("overwrite").parquet(version_path(rejects, n))
        path = version_path(folder, n)
        rows.hint("rebalance", "bar_day").write.mode("overwrite").partitionBy("bar_day").parquet(path)
        written = rows.sparkSession.read.schema(rows.schema).parquet(path)
        key_filters(written).write.mode("overwrite").parquet(version_path(f"{folder}-keys", n))

    _run(stream, step, checkpoint)


def forward_rows(spark: SparkSession, folder: str, schema: T.StructType | str) -> DataFrame:
    """All appended rows."""
    return spark.read.schema(schema).parquet(folder)

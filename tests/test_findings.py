"""Inputs on which queries once gave other rows than their SQL, or took too much."""

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as entry
from barloom.operators import receipts as rc, total_return as tr
from barloom.plans import ingest_queries
from barloom.streaming import slots
from tests.conftest import SMALL
from tests.test_oracles import _plain


def same_as_sql(spark, name: str, folder: str, **changed) -> None:
    """The query's rows and its SQL's over the small tables, of which some are changed: written under ``folder``."""
    con = duckdb.connect()
    for table, rows in changed.items():
        rows.write.parquet(f"{folder}/{table}.parquet")
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    frame = entry.queries()[name](spark, folder)
    columns = sorted(frame.columns)
    got = sorted(tuple(_plain(r[c]) for c in columns) for r in frame.collect())
    answer = con.sql(entry.oracle_sql()[name])
    assert got == sorted(tuple(_plain(r[answer.columns.index(c)]) for c in columns) for r in answer.fetchall())
    assert got


def small(spark, table: str):
    return spark.read.parquet(f"{SMALL}/{table}.parquet")


def test_strict_plan_takes_prices_of_any_sign(spark, tmp_path):
    i, value = F.col("event_id"), F.col("value")
    events = small(spark, "events").withColumn("value", F.when(i % 3 == 0, 0.0).when(i % 7 == 1, -value).otherwise(value))
    same_as_sql(spark, "i04_strict_plan", str(tmp_path), events=events)


def largest_share(spark, build) -> float:
    """The share of the rows of ``build()`` in its largest partition, as they lie after shuffles."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        counts = [r["count"] for r in build().groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    return max(counts) / sum(counts)


def test_a_batch_of_one_ticker_is_validated_in_many_tasks(spark):
    batch = spark.range(20000).select(
        F.col("id").alias("arrival"), F.lit("T").alias("ticker"), F.when(F.col("id") % 2 == 0, F.date_add(F.lit("2024-01-01").cast("date"), ((F.col("id") * 7919) % 400).cast("int"))).alias("date"),
        F.lit(1).alias("close_unadjusted"), F.lit(1).alias("adjusted_close"), F.lit(0).alias("dividend_cash"), F.lit(1).alias("split_factor"))
    assert largest_share(spark, lambda: tr.validate_batch(batch, ["T"])) < 0.25
    seen, before, want = set(), None, []
    for r in batch.orderBy("arrival").collect():
        if r.date is None or r.date in seen:
            want.append((r.arrival, "INVALID_DATE" if r.date is None else "DUPLICATE_DATE"))
            continue
        if before is not None and r.date < before:
            want.append((r.arrival, "DATE_REVERSAL"))
        seen.add(r.date)
        before = r.date
    assert sorted((r.arrival, r.error_code) for r in tr.validate_batch(batch, ["T"]).collect()) == sorted(want)


def test_equal_rows_of_a_batch_are_duplicates_but_for_one(spark, tmp_path):
    items = small(spark, "lineitem")
    same_as_sql(spark, "t01_validate_batch", str(tmp_path), lineitem=items.union(items.limit(500)).union(items.limit(200)))


def test_receipts_of_one_contract_are_checked_in_many_tasks(spark):
    receipts = spark.range(0, 20000, 1, 8).select(
        F.col("id").alias("receipt_id"), F.when(F.col("id") % 100 == 7, "unknown").otherwise("c").alias("contract_id"), F.lit("AVAILABLE").alias("availability_state"), F.lit("2024-01-02").cast("timestamp_ntz").alias("created_utc"),
        F.lit(None).cast("timestamp_ntz").alias("accepted_utc"), F.array(F.lit("w")).alias("warning_ids"), F.array().cast("array<string>").alias("blocker_ids"), F.sha2(F.col("id").cast("string"), 256).alias("receipt_sha256"))
    contracts = spark.createDataFrame([("c", "role 1"), ("d", "role 2")], "contract_id string, dataset_role string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for registries whose size Spark can't tell
    try:
        assert largest_share(spark, lambda: rc.validate_receipts(receipts, contracts)) < 0.25
        assert "SortMergeJoin" not in rc.list_receipts(receipts, contracts, "role 1", 25)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    codes = {r.error_code: r["count"] for r in rc.validate_receipts(receipts, contracts).groupBy("error_code").count().collect()}
    assert codes == {None: 19800, "UNKNOWN_CONTRACT": 200}


def test_slots_have_as_many_state_stores_as_their_rows_ask_for(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest_queries, "fresh_folder", lambda spark, name: f"{tmp_path}/{name}")
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    same_as_sql(spark, "x06_slot_sla", str(tmp_path), events=small(spark, "events"))
    for name in ("ready", "deadline"):
        state = tmp_path / "slots" / "events" / f"checkpoint-{name}" / "state" / "0"
        assert [p.name for p in state.iterdir() if p.name.isdigit()] == ["0"]
    assert spark.conf.get("spark.sql.shuffle.partitions") == kept == "4"
    assert [slots.partitions_for(n) for n in (1, slots.ROWS_EACH, slots.ROWS_EACH + 1)] == [1, 1, 2]

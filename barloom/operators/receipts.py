"""External data receipts: validation, contract status, listing, accepted calendars, bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Contracts are a registry of a few rows, each with any number of receipts: they are broadcast, so that receipts don't meet by contract in one task.

GOOD = ("AVAILABLE", "AVAILABLE_WITH_WARNINGS")
STATES = ("AVAILABLE", "AVAILABLE_WITH_WARNINGS", "BLOCKED")


def contract_status(contracts: DataFrame, receipts: DataFrame) -> DataFrame:
    """Each contract with its newest receipt and its newest good and accepted one; what a receipt lacks comes from the contract."""
    w = Window.partitionBy("contract_id").orderBy(F.col("created_utc").desc(), F.col("receipt_id").desc())
    newest = receipts.withColumn("rank", F.row_number().over(w)).where("rank = 1").select("contract_id", F.col("receipt_id").alias("latest_receipt_id"), F.col("availability_state").alias("state"))
    good = receipts.where(F.col("availability_state").isin(*GOOD) & F.col("accepted_utc").isNotNull()).withColumn("rank", F.row_number().over(w)).where("rank = 1").select("contract_id", F.col("receipt_id").alias("last_good_receipt_id"))
    return contracts.join(newest, "contract_id", "left").join(good, "contract_id", "left").select(
        "contract_id", "dataset_role", F.coalesce("state", "default_state").alias("availability_state"), "latest_receipt_id", "last_good_receipt_id")


def validate_receipts(receipts: DataFrame, contracts: DataFrame) -> DataFrame:
    """The first rule that each receipt breaks, or null."""
    joined = receipts.join(F.broadcast(contracts.select("contract_id", F.lit(True).alias("known"))), "contract_id", "left")
    unique = lambda c: F.size(F.array_distinct(c)) == F.size(c)
    good = F.col("availability_state").isin(*GOOD)
    code = (
        F.when(F.col("known").isNull(), "UNKNOWN_CONTRACT").when(~F.col("availability_state").isin(*STATES), "INVALID_STATE").when(F.col("accepted_utc") < F.col("created_utc"), "INVALID_TIME_ORDER")
        .when(~unique(F.col("warning_ids")) | ~unique(F.col("blocker_ids")), "REPEATED_ID").when(good & (F.size("blocker_ids") > 0), "AVAILABLE_WITH_BLOCKERS")
        .when((F.col("availability_state") == "AVAILABLE_WITH_WARNINGS") & (F.size("warning_ids") == 0), "WARNINGS_MISSING").when(~F.col("receipt_sha256").rlike("^[0-9a-f]{64}$"), "INVALID_DIGEST"))
    return joined.select("receipt_id", code.alias("error_code"))


def list_receipts(receipts: DataFrame, contracts: DataFrame, role: str | None, limit: int) -> DataFrame:
    rows = receipts.join(F.broadcast(contracts.select("contract_id", "dataset_role")), "contract_id")
    if role is not None:
        rows = rows.where(F.col("dataset_role") == role)
    return rows.orderBy(F.col("created_utc").desc(), F.col("receipt_id").desc()).limit(limit)


def calendar_sessions(receipts: DataFrame, calendar_id: str, start, end) -> DataFrame:
    """Sessions in [start, end) of the newest accepted receipt of a calendar, from its JSON."""
    newest = receipts.where((F.col("calendar_id") == calendar_id) & F.col("accepted_utc").isNotNull()).orderBy(F.col("created_utc").desc(), F.col("receipt_id").desc()).limit(1)
    shape = "array<struct<session_date:date,state:string>>"
    return newest.select("receipt_id", F.explode(F.from_json("sessions_json", shape)).alias("s")).select("receipt_id", "s.session_date", "s.state").where((F.col("session_date") >= start) & (F.col("session_date") < end))


def bundle_status(status: DataFrame) -> DataFrame:
    """BLOCKED if any role is not available, with warnings if any has some."""
    blocked, warned = F.count_if(~F.col("availability_state").isin(*GOOD)), F.count_if(F.col("availability_state") == "AVAILABLE_WITH_WARNINGS")
    return status.agg(F.count("*").alias("roles"), blocked.alias("blocked"), warned.alias("warned"), F.when(blocked > 0, "BLOCKED_EXTERNAL_CONTRACT").when(warned > 0, "AVAILABLE_WITH_WARNINGS").otherwise("AVAILABLE").alias("overall"))

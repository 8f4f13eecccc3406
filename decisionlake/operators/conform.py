"""Raw feeds to typed tables: trimming, safe casts, latest record per key, change envelopes.

Bad values become null (never an error); rows without key are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from decisionlake.functions.text import email_lower, emirates_id, name_soundex, phone_e164
from decisionlake.functions.times import gulf_micros


def code(c: Column) -> Column:
    """An enumeration's code: trimmed upper case."""
    return F.upper(F.trim(c))


def safely(c: Column, kind: str) -> Column:
    """The value cast, null where it can't be."""
    return c.try_cast(kind)


def amount(c: Column, kind: str = "decimal(18,2)") -> Column:
    """A number written with or without thousands separators."""
    return F.regexp_replace(c.cast("string"), ",", "").try_cast(kind)


def instant(text: Column) -> Column:
    """A feed's time as Gulf wall clock."""
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(secs=(gulf_micros(text) / 1_000_000).cast("decimal(18,6)"))


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key with the highest order, nulls last; ties go to the highest row by the other columns.

    An aggregate with map-side combining instead of a window: a key with many rows never gathers in one task.  Rows whose
    key is null form a key of their own.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max(F.struct(*[F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(order)], *[F.col(f"`{c}`") for c in rest]))
    return df.groupBy(*keys).agg(best.alias("__best")).select(*[F.col(f"`{c}`") if c in keys else F.col(f"__best.`{c}`") for c in df.columns])


def envelope(feed: DataFrame) -> DataFrame:
    """A change feed flattened: nested ``before/after/op/ts_ms``, or flat with ``cdc_op``, ``__op`` or ``op``.

    Gives the record's columns with ``__op`` (default ``u``) and ``__ts_ms`` (default 0); a delete takes its record from before.
    """
    columns = feed.columns
    if "after" in columns and "op" in columns:
        after = feed.schema["after"].dataType
        assert isinstance(after, T.StructType)
        before = {f.name for f in feed.schema["before"].dataType.fields} if "before" in columns and isinstance(feed.schema["before"].dataType, T.StructType) else set()
        picked = [F.when(F.col("op") == "d", F.col(f"before.{f.name}")).otherwise(F.col(f"after.{f.name}")).alias(f.name) if f.name in before else F.col(f"after.{f.name}").alias(f.name) for f in after.fields]
        return feed.select(*picked, F.col("op").alias("__op"), (F.coalesce("ts_ms", F.lit(0)) if "ts_ms" in columns else F.lit(0)).cast("long").alias("__ts_ms"))
    ops = [F.col(c) for c in ("cdc_op", "__op", "op") if c in columns]
    times = [F.col(c).cast("long") for c in ("cdc_source_ts_ms", "__source_ts_ms", "ts_ms") if c in columns]
    known = {"cdc_op", "__op", "op", "cdc_source_ts_ms", "__source_ts_ms", "ts_ms"}
    return feed.select(*[c for c in columns if c not in known], F.coalesce(*ops, F.lit("u")).alias("__op"), F.coalesce(*times, F.lit(0)).alias("__ts_ms"))


def profiles(feed: DataFrame, key: str = "internal_customer_uuid") -> tuple[DataFrame, DataFrame]:
    """The typed current profiles and the keys whose latest change is a delete."""
    flat = envelope(feed).where(F.col(key).isNotNull())
    order = ["__ts_ms"] + (["cdc_lsn"] if "cdc_lsn" in flat.columns else [])
    latest = latest_per_key(flat, [key], order)
    gone = F.coalesce(F.lower("__op") == "d", F.lit(False))
    typed = latest.where(~gone).select(
        key, emirates_id(F.col("emirates_id")).alias("emirates_id"), F.trim("full_name").alias("full_name"), safely(F.col("date_of_birth"), "date").alias("date_of_birth"),
        phone_e164(F.col("phone")).alias("phone"), email_lower(F.col("email")).alias("email"), amount(F.col("monthly_income_aed")).alias("monthly_income_aed"),
        safely(F.col("kyc_completed"), "boolean").alias("kyc_completed"), F.col("__ts_ms").alias("source_ts_ms"),
    )
    return typed, latest.where(gone).select(key)


def screenings(raw: DataFrame) -> DataFrame:
    """Screening callbacks, typed, the latest of each reference."""
    typed = raw.select(
        F.col("screening_ref").alias("aml_case_id"), F.trim("full_name").alias("full_name"), name_soundex(F.col("full_name")).alias("name_soundex"), safely(F.trim("date_of_birth"), "date").alias("date_of_birth"),
        code(F.col("aml_status")).alias("aml_status"), safely(F.col("is_pep"), "boolean").alias("is_pep"), instant(F.col("screened_at")).alias("screened_at"),
    ).where("aml_case_id IS NOT NULL")
    return latest_per_key(typed, ["aml_case_id"], ["screened_at"])


def fraud_events(raw: DataFrame) -> DataFrame:
    """Scoring events, typed, the latest of each id."""
    typed = raw.select(
        F.col("event_id").alias("fraud_assessment_id"), phone_e164(F.col("phone")).alias("phone"), email_lower(F.col("email")).alias("email"),
        safely(F.col("fraud_score"), "decimal(5,4)").alias("fraud_score"), code(F.col("fraud_decision")).alias("fraud_decision"), instant(F.col("scored_at")).alias("scored_at"),
    ).where("fraud_assessment_id IS NOT NULL")
    return latest_per_key(typed, ["fraud_assessment_id"], ["scored_at"])


def bureau_reports(raw: DataFrame) -> DataFrame:
    """Bureau reports, typed, the latest of each reference."""
    typed = raw.select(
        "aecb_report_ref", emirates_id(F.col("emirates_id")).alias("emirates_id"), safely(F.col("aecb_credit_score"), "int").alias("aecb_credit_score"),
        safely(F.col("aecb_total_outstanding_aed"), "decimal(18,2)").alias("aecb_total_outstanding_aed"), "report_timestamp", "updated_timestamp",
    ).where("aecb_report_ref IS NOT NULL")
    return latest_per_key(typed, ["aecb_report_ref"], ["report_timestamp", "updated_timestamp"])


def decisions(raw: DataFrame) -> DataFrame:
    """Decisions, typed, the latest delivery of each id."""
    typed = raw.select(
        "decision_id", "application_id", "internal_customer_uuid", code(F.col("product_code")).alias("product_code"), instant(F.col("decision_timestamp")).alias("decision_timestamp"),
        amount(F.col("requested_amount_aed")).alias("requested_amount_aed"), amount(F.col("approved_amount_aed")).alias("approved_amount_aed"), code(F.col("decision_outcome")).alias("decision_outcome"), "ingested_timestamp",
    ).where("decision_id IS NOT NULL")
    return latest_per_key(typed, ["decision_id"], ["ingested_timestamp"]).withColumn("decision_date", F.col("decision_timestamp").cast("date"))

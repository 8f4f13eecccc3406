"""The fused decision record, its completeness and its content-hashed snapshot."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decisionlake.config import RETENTION_YEARS, UNRESOLVED

INPUTS = ("aecb_credit_score", "fraud_score", "aml_status", "monthly_income_aed")


def completeness(*inputs: Column) -> Column:
    """Share of the inputs that are there, as DECIMAL(5,4)."""
    return (sum((c.isNotNull().cast("int") for c in inputs), F.lit(0)) / len(inputs)).cast("decimal(5,4)")


def fuse(decisions: DataFrame, xref: DataFrame, bureau: DataFrame, fraud: DataFrame, aml: DataFrame, profile: DataFrame) -> DataFrame:
    """One row per decision with the inputs to which the cross-reference leads; a decision without customer is UNRESOLVED.

    Every join is left and its right side has one row per key, so that decisions are neither lost nor multiplied.
    """
    golden = xref.where(F.col("master_customer_id") != UNRESOLVED).select("internal_customer_uuid", "master_customer_id", "aecb_source_key", "fraud_source_key", "aml_source_key")
    joined = (
        decisions.join(golden, "internal_customer_uuid", "left")
        .join(bureau.select(F.col("aecb_report_ref").alias("aecb_source_key"), "aecb_credit_score", "aecb_total_outstanding_aed"), "aecb_source_key", "left")
        .join(fraud.select(F.col("fraud_assessment_id").alias("fraud_source_key"), "fraud_score", "fraud_decision"), "fraud_source_key", "left")
        .join(aml.select(F.col("aml_case_id").alias("aml_source_key"), "aml_status", "is_pep"), "aml_source_key", "left")
        .join(profile.select("internal_customer_uuid", "monthly_income_aed", "kyc_completed"), "internal_customer_uuid", "left")
    )
    return joined.select(
        "decision_id", "application_id", F.coalesce("master_customer_id", F.lit(UNRESOLVED)).alias("master_customer_id"), "internal_customer_uuid", "product_code", "decision_timestamp",
        F.col("decision_timestamp").cast("date").alias("decision_date"), "aecb_credit_score", "aecb_total_outstanding_aed", F.col("aecb_source_key").alias("aecb_report_ref"), "fraud_score", "fraud_decision",
        "aml_status", "is_pep", "monthly_income_aed", "kyc_completed", "requested_amount_aed", "approved_amount_aed", "decision_outcome", completeness(*[F.col(c) for c in INPUTS]).alias("input_completeness_score"),
    )


def record_hash(*columns: str) -> Column:
    """SHA-256 over the columns as JSON in the order given, nulls kept."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def text_json(columns: list[str]) -> Column:
    """Canonical JSON of a row: every value in its text form or null, so that the bytes don't depend on an engine's number formats."""
    return F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"})


def latest_record(rows: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """``name_key, name_record, name_sha256, name_uri``: the latest raw row of each key word for word, with its hash and file."""
    uri = F.col("source_file_s3_uri") if "source_file_s3_uri" in rows.columns else F.lit(None).cast("string")
    latest = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"{name}_key")).agg(F.max(F.struct(F.col(order).alias("at"), text_json(rows.columns).alias("record"), uri.alias("uri"))).alias("r"))
    return latest.select(f"{name}_key", F.col("r.record").alias(f"{name}_record"), F.sha2("r.record", 256).alias(f"{name}_sha256"), F.col("r.uri").alias(f"{name}_uri"))


def snapshots(fused: DataFrame, raw: dict[str, tuple[DataFrame, str, str, str]], root: str, captured_at: Column) -> DataFrame:
    """One immutable document per decision: the fused record and, word for word, the raw record of each input with its hash.

    raw: by name the raw rows, their key, the fused column that holds it and the column by which the latest row counts.  An
    input that isn't there is null.  The hash covers what was decided on and not the time of capture, so that a repeated
    capture gives the same document.
    """
    out = fused
    for name, (rows, key, ours, order) in raw.items():
        out = out.join(latest_record(rows, key, order, name), F.col(ours) == F.col(f"{name}_key"), "left").drop(f"{name}_key")
    inputs = [F.struct(F.col(f"{n}_record").alias("record"), F.col(f"{n}_sha256").alias("sha256"), F.col(f"{n}_uri").alias("uri")).alias(n) for n in raw]
    texts = [F.col(f"`{c}`").cast("string").alias(c) for c in fused.columns]
    content = F.to_json(F.struct(F.struct(*texts).alias("decision"), F.struct(*inputs).alias("inputs")), {"ignoreNullFields": "false"})
    path = F.concat(F.lit(f"{root}/decision_date="), F.coalesce(F.date_format("decision_date", "yyyy-MM-dd"), F.lit("unknown")), F.lit("/decision_id="), F.col("decision_id"), F.lit("/snapshot.json"))
    return out.select(
        "decision_id", "decision_date", path.alias("snapshot_uri"), content.alias("body"), F.sha2(content, 256).alias("content_sha256"), *[f"{n}_sha256" for n in raw], captured_at.alias("captured_at"),
        F.lit(RETENTION_YEARS).alias("retention_years"), F.add_months(captured_at.cast("date"), 12 * RETENTION_YEARS).alias("retain_until"),
    )


def _put(uri: str, body: str) -> bool:
    """Write an object unless it is there; a reader sees it whole or not at all."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri if "://" in uri else os.path.abspath(uri))
    if store.get_file_info(path).type != fs.FileType.NotFound:
        return False
    folder, name = path.rsplit("/", 1)
    store.create_dir(folder, recursive=True)
    attempt = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(attempt) as out:
        out.write(body.encode())
    store.move(attempt, path)
    return True


def write_snapshots(documents: DataFrame) -> DataFrame:
    """``snapshot_uri, written``: puts each document as one object at its own address; what is there already stays as it is.

    Runs when the result is read; a repeated or retried run writes only what is missing.
    """

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"snapshot_uri": batch["snapshot_uri"], "written": [_put(u, b) for u, b in zip(batch["snapshot_uri"], batch["body"])]})

    return documents.where("snapshot_uri IS NOT NULL").select("snapshot_uri", "body").mapInPandas(put, "snapshot_uri string, written boolean")

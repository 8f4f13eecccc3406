"""Queries that write: tables with merge, append, update and delete, streams into tables, and XML batches.

They write to a folder of their own below the shared one, and what they return is read back from there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from decisionlake.operators import conform
from decisionlake.session import cut, shared_folder, table
from decisionlake.sources import feeds
from decisionlake.sources.tables import Table, read_partitions, write_partitioned
from decisionlake.streaming import cdc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return register


def _place(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"


_KEY = "internal_customer_uuid"
_CHANGE = "internal_customer_uuid, full_name, phone, cdc_lsn, is_deleted"
_STATE = f"""SELECT {_CHANGE} FROM (SELECT *, lower(trim(cdc_op)) = 'd' AS is_deleted FROM customer_profile_raw WHERE {_KEY} IS NOT NULL AND cdc_lsn IS NOT NULL)
    QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY cdc_lsn DESC, full_name DESC NULLS LAST, phone DESC NULLS LAST) = 1"""


def _changes(spark: SparkSession, folder: str) -> DataFrame:
    feed = table(spark, folder, "customer_profile_raw").where(f"{_KEY} IS NOT NULL AND cdc_lsn IS NOT NULL")
    return feed.select(_KEY, "full_name", "phone", "cdc_lsn", F.coalesce(F.lower(F.trim("cdc_op")) == "d", F.lit(False)).alias("is_deleted"))


def _merged(spark: SparkSession, folder: str) -> Table:
    """The change feed merged in two parts, the later one first: the older never overwrites the newer."""
    changes = cut(_changes(spark, folder))
    middle = changes.agg(F.percentile_approx("cdc_lsn", 0.5)).first()[0] or 0
    stored = Table(spark, _place(spark), [_KEY], event_time="cdc_lsn")
    for part in (changes.where(F.col("cdc_lsn") > middle), changes.where(F.col("cdc_lsn") <= middle)):
        stored.merge(conform.latest_per_key(part, [_KEY], ["cdc_lsn"]))
    return stored


@query(_STATE)
def table_upsert(spark, folder):
    """Merge by key with event time."""
    return _merged(spark, folder).read()


@query(f"SELECT {_CHANGE} FROM ({_STATE}) WHERE NOT is_deleted")
def table_delete(spark, folder):
    """Rows removed by key."""
    stored = _merged(spark, folder)
    stored.delete(stored.read().where("is_deleted").select(_KEY))
    return stored.read()


@query("SELECT decision_id, application_id, batch_id FROM decision_input UNION ALL SELECT decision_id, application_id, batch_id FROM decision_input WHERE product_code = 'BNPL'")
def table_append(spark, folder):
    """Rows appended without regard to keys, laid out by load."""
    rows = table(spark, folder, "decision_input")
    stored = Table(spark, _place(spark), ["decision_id"], partition="batch_id")
    for part in (rows, rows.where("product_code = 'BNPL'")):
        stored.append(part.select("decision_id", "application_id", "batch_id"))
    return stored.read()


_GATED = "SELECT DISTINCT decision_id FROM decision_input WHERE decision_id IS NOT NULL AND aecb_credit_score NOT BETWEEN 300 AND 900"


@query(f"SELECT decision_id, batch_id, CASE WHEN decision_id IN ({_GATED}) THEN false ELSE dq_pass END AS dq_pass FROM decision_input")
def table_column_update(spark, folder):
    """The gate's verdict written back: one column of the rows that failed."""
    rows = table(spark, folder, "decision_input")
    stored = Table(spark, _place(spark), ["decision_id"], partition="batch_id")
    stored.overwrite(rows.select("decision_id", "batch_id", "dq_pass"))
    failed = rows.where("decision_id IS NOT NULL AND aecb_credit_score NOT BETWEEN 300 AND 900").select("decision_id").distinct()
    stored.update_columns(failed.withColumn("dq_pass", F.lit(False)), ["dq_pass"])
    return stored.read()


@query("SELECT ingest_date, count(*) AS records, count(DISTINCT screening_ref) AS screenings FROM aml_raw WHERE ingest_date BETWEEN '2025-01-01' AND '2025-03-31' GROUP BY 1")
def partitions_read(spark, folder):
    """A partitioned folder written by day and read by its range of days."""
    at = _place(spark)
    write_partitioned(table(spark, folder, "aml_raw"), at)
    days = read_partitions(spark, at, "ingest_date", "2025-01-01", "2025-03-31")
    return days.groupBy(F.col("ingest_date").cast("string").alias("ingest_date")).agg(F.count("*").alias("records"), F.count_distinct("screening_ref").alias("screenings"))


@query(f"SELECT {_KEY}, full_name, phone, cdc_lsn FROM ({_STATE}) WHERE NOT is_deleted")
def stream_current_profiles(spark, folder):
    """The change feed followed as a stream of files, merged batch by batch with tombstones."""
    at = _place(spark)
    _changes(spark, folder).withColumn("cdc_op", F.when(F.col("is_deleted"), "d").otherwise("u")).drop("is_deleted").repartition(4).write.parquet(f"{at}/in")
    schema = spark.read.parquet(f"{at}/in").schema
    stored = Table(spark, f"{at}/table", [_KEY], event_time="cdc_lsn")
    cdc.follow_changes(spark, f"{at}/in", schema, stored, _KEY, "cdc_lsn", f"{at}/checkpoint", per_batch=2).awaitTermination()
    return cdc.current(stored).select(_KEY, "full_name", "phone", "cdc_lsn")


@query("SELECT feed_ok, count(*) AS records FROM (SELECT screening_ref IS NOT NULL AS feed_ok FROM aml_raw) GROUP BY 1")
def stream_of_files(spark, folder):
    """An incremental scan of files, good rows by day, bad rows apart."""
    at = _place(spark)
    table(spark, folder, "aml_raw").repartition(3).write.parquet(f"{at}/in")
    schema = spark.read.parquet(f"{at}/in").schema
    cdc.follow_files(spark, f"{at}/in", schema, f"{at}/out", f"{at}/checkpoint", F.col("screening_ref").isNotNull()).awaitTermination()
    parts = [spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{at}/out{p}").select(F.lit(ok).alias("feed_ok")) for p, ok in (("/batch=*", True), ("/_rejected", False))]
    return parts[0].unionByName(parts[1]).groupBy("feed_ok").agg(F.count("*").alias("records"))


@query("""SELECT aecb_report_ref AS report_ref, nullif(trim(emirates_id), '') AS emirates_id, aecb_credit_score AS credit_score, aecb_total_outstanding_aed AS total_outstanding_aed, count(*) AS copies FROM aecb_credit_report
    WHERE aecb_report_ref IS NOT NULL GROUP BY ALL""")
def xml_batches(spark, folder):
    """Bureau reports as XML batches, read back typed."""
    at = _place(spark)
    reports = table(spark, folder, "aecb_credit_report").where("aecb_report_ref IS NOT NULL")
    text = lambda c: F.col(c).cast("string")
    made = reports.select(
        text("aecb_report_ref").alias("ReportRef"), text("report_timestamp").alias("ReportDate"), F.struct(text("emirates_id").alias("EmiratesId"), F.lit(None).cast("string").alias("FullName"), F.lit(None).cast("string").alias("DateOfBirth")).alias("Subject"),
        text("aecb_credit_score").alias("CreditScore"), text("aecb_total_outstanding_aed").alias("TotalOutstandingAED"), F.lit("1").alias("ActiveLoans"),
    )
    made.write.format("xml").option("rootTag", "Reports").option("rowTag", "CreditReport").save(f"{at}/batch")
    read = feeds.bureau_xml(spark, f"{at}/batch")
    return read.groupBy("report_ref", "emirates_id", "credit_score", "total_outstanding_aed").agg(F.count("*").alias("copies"))

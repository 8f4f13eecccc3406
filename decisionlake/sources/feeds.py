"""Sources at the edge: XML batches, a file manifest, a paged REST feed, webhook callbacks and their checks."""

from __future__ import annotations

import hashlib
import hmac
import json
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from decisionlake.config import AML_STATUSES
from decisionlake.functions.times import gulf_micros

_REPORT = T.StructType([
    T.StructField("ReportRef", T.StringType()), T.StructField("ReportDate", T.StringType()),
    T.StructField("Subject", T.StructType([T.StructField(n, T.StringType()) for n in ("EmiratesId", "FullName", "DateOfBirth")])),
    T.StructField("CreditScore", T.StringType()), T.StructField("TotalOutstandingAED", T.StringType()), T.StructField("ActiveLoans", T.StringType()),
])


def bureau_xml(spark: SparkSession, path: str) -> DataFrame:
    """One row per CreditReport of the XML batches in a folder, typed; blanks are null; with file name and record hash."""
    raw = spark.read.format("xml").option("rowTag", "CreditReport").option("pathGlobFilter", "*.xml").schema(_REPORT).load(path)
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    return raw.select(
        text("ReportRef").alias("report_ref"), text("ReportDate").alias("report_date"), text("Subject.EmiratesId").alias("emirates_id"), text("Subject.FullName").alias("full_name"),
        text("Subject.DateOfBirth").alias("date_of_birth"), text("CreditScore").try_cast("int").alias("credit_score"), F.round(text("TotalOutstandingAED").try_cast("decimal(20,6)"), 2).cast("decimal(18,2)").alias("total_outstanding_aed"),
        text("ActiveLoans").try_cast("int").alias("num_active_loans"), F.sha2(F.to_json(F.struct(*raw.columns), {"ignoreNullFields": "false"}), 256).alias("record_hash"), F.col("_metadata.file_path").alias("source_file"),
    )


def new_files(spark: SparkSession, path: str, manifest: DataFrame | None, pattern: str = "*.xml") -> DataFrame:
    """``file, content_sha256`` of the files that the manifest doesn't have with this content; changed files come again."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select(F.col("path").alias("file"), F.sha2("content", 256).alias("content_sha256"))
    return files if manifest is None else files.join(manifest.select("file", "content_sha256"), ["file", "content_sha256"], "left_anti")


# ---- REST ------------------------------------------------------------------------------------------------------------
RETRIED = frozenset({429, 500, 502, 503, 504})


def with_retries(call: Callable[[], dict], attempts: int = 5, most: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> dict:
    """The call's answer; busy and broken servers and lost connections are tried again with doubled, jittered waits."""
    for n in range(attempts):
        try:
            return call()
        except urllib.error.HTTPError as e:
            if e.code not in RETRIED or n == attempts - 1:
                raise
        except (urllib.error.URLError, TimeoutError, ConnectionError):
            if n == attempts - 1:
                raise
        sleep(min(2**n, most) + random.random())
    raise AssertionError


def pages(fetch: Callable[[str | None], dict], sleep: Callable[[float], None] = time.sleep) -> Iterator[dict]:
    """The events of all pages; a page without more or without a next cursor is the last."""
    cursor = None
    while True:
        page = with_retries(lambda c=cursor: fetch(c), sleep=sleep)
        yield from page.get("events", [])
        cursor = page.get("next_cursor")
        if not page.get("has_more") or not cursor:
            return


class FraudApi(DataSource):
    """``spark.read.format("fraud_api").option("url", ...).option("since", ...)``: raw events as JSON text."""

    @classmethod
    def name(cls) -> str:
        return "fraud_api"

    def schema(self) -> str:
        return "raw_json string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _FraudReader(dict(self.options))


class _FraudReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]  # cursors follow one another

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        def fetch(cursor: str | None) -> dict:
            query = f"?since={self.options.get('since', '1970-01-01T00:00:00Z')}" + (f"&cursor={cursor}" if cursor else "")
            request = urllib.request.Request(self.options["url"] + query, headers={"Authorization": f"Bearer {self.options.get('token', '')}"})
            with urllib.request.urlopen(request, timeout=float(self.options.get("timeout", 30))) as answer:
                return json.load(answer)

        for event in pages(fetch):
            yield (json.dumps(event, sort_keys=True, separators=(",", ":")),)


_EVENT = "event_id string, phone string, email string, fraud_score string, fraud_decision string, scored_at string"


def fraud_events(raw: DataFrame) -> DataFrame:
    """Raw JSON events typed, with their hash; of a repeated id the first text counts; events without id are kept.

    Scoring times without zone are UTC here, and come out as Gulf wall clock.
    """
    e = raw.select("raw_json", F.from_json("raw_json", _EVENT).alias("e")).select("raw_json", "e.*")
    known = e.where("event_id IS NOT NULL").groupBy("event_id").agg(F.min(F.struct("raw_json", *[c for c in e.columns if c not in ("raw_json", "event_id")])).alias("r")).select("event_id", "r.*")
    kept = known.unionByName(e.where("event_id IS NULL"))
    zoned = F.when(F.col("scored_at").rlike(r"(Z|[+-]\d{2}:?\d{2})$"), F.col("scored_at")).otherwise(F.concat("scored_at", F.lit("Z")))
    return kept.withColumns({"fraud_score": F.col("fraud_score").try_cast("decimal(5,4)"), "scored_at": F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(secs=(gulf_micros(zoned) / 1_000_000).cast("decimal(18,6)")), "record_hash": F.sha2("raw_json", 256)})


def above(df: DataFrame, column: str, mark: str | None) -> DataFrame:
    """The rows beyond a high-water mark."""
    return df if mark is None else df.where(F.col(column) > F.lit(mark))


def next_mark(df: DataFrame, column: str, mark: str | None) -> str | None:
    """The mark after these rows were written; none read leaves it as it is."""
    top = df.agg(F.max(F.col(column).cast("string"))).first()[0]
    return top or mark


# ---- webhook ---------------------------------------------------------------------------------------------------------
def signed(body: bytes, signature: str | None, secret: bytes) -> bool:
    """Whether the signature (hex, perhaps behind ``sha256=``) is the body's HMAC-SHA256."""
    if not signature:
        return False
    return hmac.compare_digest(hmac.new(secret, body, hashlib.sha256).hexdigest(), signature.removeprefix("sha256=").strip().lower())


def reject_reason() -> Column:
    """Why a callback can't be taken; null if it can."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    # The reasons as rejected records carry them.
    return (
        F.when(blank("screening_ref"), "missing screening_ref").when(~F.coalesce(F.col("aml_status").isin(*AML_STATUSES), F.lit(False)), "invalid aml_status")
        .when(blank("full_name") | blank("date_of_birth"), "missing full_name or date_of_birth")
    )


_CALLBACK = "screening_ref string, full_name string, date_of_birth string, aml_status string, is_pep boolean, screened_at string"


def callbacks(bodies: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected records of request bodies, each an object or an array of objects."""
    body = F.trim(F.col(column))
    many = F.when(body.startswith("["), F.from_json(body, f"array<struct<{_CALLBACK.replace(' string', ':string').replace(' boolean', ':boolean')}>>")).otherwise(F.array(F.from_json(body, _CALLBACK)))
    each = bodies.select(F.explode(many).alias("r")).select("r.*").withColumn("reject_reason", reject_reason())
    return each.where("reject_reason IS NULL").drop("reject_reason"), each.where("reject_reason IS NOT NULL")

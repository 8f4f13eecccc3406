"""Daily marts and views over fused records and scorecards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from decisionlake.config import UNRESOLVED

# Lower bounds of the bands of a bureau score.
RISK_BANDS = ((800, "EXCELLENT"), (740, "VERY_GOOD"), (670, "GOOD"), (580, "FAIR"))


def risk_band(bureau_score: Column) -> Column:
    band = F.when(bureau_score.isNull(), "UNKNOWN")
    for least, name in RISK_BANDS:
        band = band.when(bureau_score >= least, name)
    return band.otherwise("POOR")


def outcome_band(outcome: Column) -> Column:
    return F.coalesce(F.upper(outcome), F.lit("UNKNOWN"))


def mean(c: str, places: int) -> Column:
    """The mean rounded half up; a tie of decimal values stays one in spite of binary fractions."""
    return F.round(F.avg(F.col(c).cast("double")) + 1e-9, places)


def percent(part: Column, whole: Column) -> Column:
    """A share in percent as DECIMAL(5,2); null for nothing of nothing."""
    return F.round(100.0 * part / F.nullif(whole, F.lit(0)), 2).cast("decimal(5,2)")


def portfolio(rows: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """The daily cube by product, outcome band and risk band of the rows that passed; scores: ``snapshot_date, dq_score``."""
    n, approved = F.count("*"), F.count_if(F.col("decision_outcome") == "APPROVED")
    hit, pep = F.count_if(F.col("aml_status") == "HIT"), F.count_if(F.col("is_pep"))
    money = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("decimal(18,2)")
    cube = rows.where("dq_pass").groupBy(
        F.col("decision_date").alias("snapshot_date"), "product_code", outcome_band(F.col("decision_outcome")).alias("decision_outcome_band"), risk_band(F.col("aecb_credit_score")).alias("risk_band")
    ).agg(
        n.alias("decision_count"), approved.alias("approved_count"), percent(approved, n).alias("approval_rate_pct"), mean("fraud_score", 4).cast("decimal(5,4)").alias("avg_fraud_score"),
        hit.alias("aml_hit_count"), percent(hit, n).alias("aml_hit_rate_pct"), pep.alias("pep_count"), percent(pep, n).alias("pep_exposure_pct"),
        mean("aecb_credit_score", 2).cast("decimal(7,2)").alias("avg_aecb_credit_score"), money("requested_amount_aed").alias("total_requested_amount_aed"), money("approved_amount_aed").alias("total_approved_amount_aed"),
    )
    if scores is None:
        return cube.withColumn("dq_score", F.lit(None).cast("decimal(5,2)"))
    return cube.join(scores.select("snapshot_date", "dq_score"), "snapshot_date", "left")


def daily_summary(rows: DataFrame) -> DataFrame:
    """Decisions by day and product; approval here means the fraud decision APPROVE."""
    n, approved, hit = F.count("*"), F.count_if(F.col("fraud_decision") == "APPROVE"), F.count_if(F.col("aml_status") == "HIT")
    return rows.where("dq_pass").groupBy(F.col("decision_timestamp").cast("date").alias("decision_date"), "product_code").agg(
        n.alias("decision_count"), approved.alias("approved_count"), percent(approved, n).alias("approval_rate_pct"), mean("fraud_score", 4).alias("avg_fraud_score"),
        hit.alias("aml_hit_count"), percent(hit, n).alias("aml_hit_rate_pct"), F.count_if(F.col("aml_status") == "PENDING").alias("aml_pending_count"), F.count_if(F.col("is_pep")).alias("pep_count"),
        mean("aecb_credit_score", 2).alias("avg_aecb_credit_score"),
    )


def audit_trail(rows: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Every fused record with its snapshot, and whether that is missing."""
    found = snapshots.select("decision_id", "snapshot_uri", "content_sha256", "retain_until", F.lit(False).alias("__there"))
    return rows.join(found, "decision_id", "left").withColumn("snapshot_missing", F.coalesce("__there", F.lit(True))).drop("__there")


def score_trend(cards: DataFrame) -> DataFrame:
    """The scorecards (one row per ``snapshot_date``) with the mean of seven rows and the change from the row before.

    The window has no partition: there is one row per day.
    """
    order = Window.orderBy("snapshot_date")
    return cards.withColumn("dq_score_7d_avg", F.round(F.avg(F.col("dq_score").cast("double")).over(order.rowsBetween(-6, 0)), 2)).withColumn("dq_score_dod_delta", F.col("dq_score") - F.lag("dq_score").over(order))


def steward_queue(xref: DataFrame) -> DataFrame:
    """Cross-reference rows that a person must look at, and why."""
    open_ = F.col("master_customer_id") == UNRESOLVED
    reason = F.when(open_, UNRESOLVED).when(F.col("needs_manual_review"), "NEEDS_MANUAL_REVIEW")
    return xref.where(open_ | F.coalesce("needs_manual_review", F.lit(False))).withColumn("steward_queue_reason", reason)


def product_trend(mart: DataFrame, last: Column, days: int = 30) -> DataFrame:
    """The cube rolled up to day and product over the days up to ``last``."""
    n = F.sum("decision_count")
    return mart.where(F.col("snapshot_date") >= F.date_add(last, -days)).groupBy("snapshot_date", "product_code").agg(
        n.alias("decisions"), percent(F.sum("approved_count"), n).alias("approval_rate_pct"),
        F.round(F.sum(F.col("avg_fraud_score").cast("double") * F.col("decision_count")) / F.nullif(n, F.lit(0)), 4).alias("avg_fraud_score"), percent(F.sum("aml_hit_count"), n).alias("aml_hit_rate_pct"), F.max("dq_score").alias("dq_score"),
    )


def pep_exposure(mart: DataFrame, day: Column | None = None) -> DataFrame:
    """Products and risk bands with exposed persons, on one day or over all."""
    rows = mart if day is None else mart.where(F.col("snapshot_date") == day)
    return rows.groupBy("product_code", "risk_band").agg(
        F.sum("decision_count").alias("decisions"), F.sum("pep_count").alias("pep_decisions"), percent(F.sum("pep_count"), F.sum("decision_count")).alias("pep_exposure_pct"), F.sum("total_approved_amount_aed").cast("decimal(18,2)").alias("approved_amount_aed")
    ).where("pep_decisions > 0")


def queue_size(queue: DataFrame) -> DataFrame:
    return queue.groupBy("steward_queue_reason", "match_method").agg(F.count("*").alias("records"), F.round(F.avg(F.col("match_confidence").cast("double")), 4).alias("avg_confidence"))


def breached_days(trend: DataFrame) -> DataFrame:
    """Days on which rows were quarantined or a warn rule didn't hold."""
    return trend.where("quarantined_row_count > 0 OR warn_ok_count < warn_count")


def reconstruct(trail: DataFrame, decision_id: Column | str) -> DataFrame:
    """One decision with its snapshot: a point lookup that reaches the scan as a pushed filter."""
    return trail.where(F.col("decision_id") == decision_id)


def freshness_by_day(loads: DataFrame, sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``snapshot_date`` and ``name_freshness_hours``: how old each source's newest row was when the day's last load was made.

    loads: ``snapshot_date, now``, one row per day.  A source's newest row up to a day is a running maximum over its days; the
    window has one row per source and day.
    """
    out = loads
    for name, (rows, column) in sources.items():
        days = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("date").alias("snapshot_date")).agg(F.max(column).alias("last"))
        both = days.unionByName(loads.select("snapshot_date"), allowMissingColumns=True).groupBy("snapshot_date").agg(F.max("last").alias("last"))
        upto = both.withColumn("newest", F.max("last").over(Window.orderBy("snapshot_date").rowsBetween(Window.unboundedPreceding, 0))).select("snapshot_date", "newest")
        micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
        out = out.join(upto, "snapshot_date").withColumn(f"{name}_freshness_hours", F.greatest((micros("now") - micros("newest")) / 3.6e9, F.lit(0.0))).drop("newest")
    return out.drop("now")


def sla_breaches(fresh: DataFrame, limits: dict[str, float], most: int | None = None) -> DataFrame:
    """The days on which a source was too old, latest first; ``most`` of them, if given."""
    late = F.lit(False)
    for name, hours in limits.items():
        late = late | F.coalesce(F.col(f"{name}_freshness_hours") >= hours, F.lit(True))
    found = fresh.where(late).orderBy(F.desc("snapshot_date"))
    return found if most is None else found.limit(most)

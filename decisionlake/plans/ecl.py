"""Expected credit loss: staging, scenario-weighted provision, stage transitions, summary and audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SCENARIOS = ("BASE", "UPSIDE", "DOWNSIDE")


def _flag(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(False))


def staged(snapshots: DataFrame, exposures: DataFrame) -> DataFrame:
    """Each exposure's stage at each date, what triggered it, and its probability of default against the one at origination."""
    ratio = F.col("current_lifetime_pd").cast("double") / F.nullif(F.col("origination_lifetime_pd").cast("double"), F.lit(0.0))
    overdue = F.coalesce("days_past_due", F.lit(0))
    default = (overdue >= 90) | _flag("is_unlikely_to_pay")
    worse = F.coalesce(ratio >= 2.0, F.lit(False))
    risen = worse | (overdue >= 30) | _flag("is_forborne") | _flag("is_watchlist")
    trigger = (
        F.when(overdue >= 90, "DEFAULT_90DPD").when(default, "UNLIKELY_TO_PAY").when(worse, "PD_DETERIORATION").when(overdue >= 30, "DPD_30_BACKSTOP")
        .when(_flag("is_forborne"), "FORBEARANCE").when(_flag("is_watchlist"), "WATCHLIST").otherwise("NONE")
    )
    return snapshots.join(exposures, "exposure_id").withColumns(
        {"pd_ratio": F.round(ratio, 6), "is_default": default, "is_sicr": risen, "sicr_trigger": trigger, "assigned_stage": F.when(default, 3).when(risen, 2).otherwise(1)}
    )


def in_force(sets: DataFrame, dates: DataFrame) -> DataFrame:
    """The current point-in-time parameter set of each scenario at each reporting date (a range join; sets are few)."""
    s = sets.where("parameter_basis = 'PIT' AND is_current").select("parameter_set_id", F.col("macro_scenario_id").alias("scenario_id"), "effective_from_date", "effective_to_date")
    held = (F.col("reporting_date") >= F.col("effective_from_date")) & (F.col("effective_to_date").isNull() | (F.col("reporting_date") <= F.col("effective_to_date")))
    return dates.join(s, "scenario_id").where(held).drop("effective_from_date", "effective_to_date")


def scored(stages: DataFrame, weights: DataFrame, sets: DataFrame, pd_terms: DataFrame, lgd: DataFrame, ccf: DataFrame) -> DataFrame:
    """One row per exposure, date and scenario with exposure at default, both losses and the loss reported.

    Parameters come by left joins: an exposure without one keeps its row, marked ``missing_parameter``.  The horizon of a
    lifetime is the shortest of the term structure that covers it, else the longest, found in one sorted array.
    """
    horizons = pd_terms.agg(F.sort_array(F.collect_set("horizon_months")).alias("horizons"))  # one small row
    covering = F.coalesce(F.get(F.filter("horizons", lambda h: h >= F.col("remaining_maturity_months")), F.lit(0)), F.array_max("horizons"))
    based = stages.crossJoin(F.broadcast(horizons)).withColumn("lifetime_horizon", covering).drop("horizons")
    based = based.withColumn("collateral_segment", F.coalesce("collateral_type", F.lit("UNSECURED")))
    fanned = based.join(in_force(sets, weights), "reporting_date")
    term = pd_terms.select("parameter_set_id", F.col("rating_grade").alias("current_rating_grade"), "horizon_months", "cumulative_pd")
    year = term.where("horizon_months = 12").select("parameter_set_id", "current_rating_grade", F.col("cumulative_pd").alias("pd_12m"))
    life = term.select("parameter_set_id", "current_rating_grade", F.col("horizon_months").alias("lifetime_horizon"), F.col("cumulative_pd").alias("pd_life"))
    full = (
        fanned.join(ccf.select("parameter_set_id", "product_type", "credit_conversion_factor"), ["parameter_set_id", "product_type"], "left")
        .join(lgd.select("parameter_set_id", "collateral_segment", "downturn_lgd_rate"), ["parameter_set_id", "collateral_segment"], "left")
        .join(year, ["parameter_set_id", "current_rating_grade"], "left").join(life, ["parameter_set_id", "current_rating_grade", "lifetime_horizon"], "left")
    )
    number = lambda c: F.col(c).cast("double")
    raw = number("drawn_balance_aed") + number("credit_conversion_factor") * number("undrawn_commitment_aed")
    impaired = F.col("assigned_stage") == 3
    loss = lambda pd_used, years: F.round(F.round(raw, 2) * F.when(impaired, 1.0).otherwise(number(pd_used)) * number("downturn_lgd_rate") * F.pow(1 + number("effective_interest_rate"), -years) + 1e-9, 2)
    months = F.col("lifetime_horizon") / 24.0
    out = full.withColumns({"ead_amount_aed": F.round(raw, 2), "ecl_12m": loss("pd_12m", F.lit(0.5)), "ecl_life": loss("pd_life", months)})
    out = out.withColumn("ecl_amount_aed", F.when(F.col("assigned_stage") == 1, F.col("ecl_12m")).otherwise(F.col("ecl_life")))
    return out.withColumn("missing_parameter", F.col("ecl_amount_aed").isNull())


def provision(scores: DataFrame) -> DataFrame:
    """The probability-weighted loss of each exposure, its losses by scenario, both horizons and coverage."""
    # weights and amounts are decimals, so that sums and ties are exact
    weight = F.col("probability_weight").cast("decimal(9,8)")
    total = lambda c: F.sum(weight * F.col(c).cast("decimal(18,2)"))
    weighted = lambda c: F.round(total(c), 2).cast("double")
    return scores.groupBy("reporting_date", "exposure_id", "assigned_stage").agg(
        F.max("ead_amount_aed").alias("ead_amount_aed"), *[F.max(F.when(F.col("scenario_id") == s, F.col("ecl_amount_aed"))).alias(f"ecl_{s.lower()}_aed") for s in SCENARIOS],
        weighted("ecl_12m").alias("ecl_12m_aed"), weighted("ecl_life").alias("ecl_lifetime_aed"), weighted("ecl_amount_aed").alias("reported_ecl_aed"),
        F.round(total("ecl_amount_aed").cast("double") / F.nullif(F.max("ead_amount_aed"), F.lit(0.0)), 6).alias("coverage_ratio"),
    )


def transitions(stages: DataFrame) -> DataFrame:
    """First stages and changes of stage from one date of an exposure to its next."""
    order = Window.partitionBy("exposure_id").orderBy("reporting_date")
    seen = stages.withColumns({"prior_stage": F.lag("assigned_stage").over(order), "prior_reporting_date": F.lag("reporting_date").over(order)})
    before, now = F.col("prior_stage"), F.col("assigned_stage")
    way = F.when(before.isNull(), "INITIAL").when(now > before, "DETERIORATION").when((now < before) & (now == 1), "CURE").when(now < before, "IMPROVEMENT").otherwise("UNCHANGED")
    reason = F.when(F.col("is_default"), "DEFAULT").otherwise(F.col("sicr_trigger"))
    return seen.where(before.isNull() | (now != before)).select(
        F.concat_ws("-", F.lit("TR"), "exposure_id", F.date_format("reporting_date", "yyyyMMdd")).alias("transition_id"), "exposure_id", "prior_reporting_date", "reporting_date", "prior_stage", now.alias("new_stage"),
        way.alias("transition_direction"), reason.alias("trigger_reason"), F.col("days_past_due").alias("dpd_at_transition"), F.round("pd_ratio", 4).alias("pd_ratio_at_transition"),
    )


def summary(provisions: DataFrame, stages: DataFrame) -> DataFrame:
    """Totals by stage and over all: grouping sets; the total is told by its grouping, not by a null."""
    p = provisions.join(stages.select(F.col("stage_id").alias("assigned_stage"), "stage_name", "ecl_horizon"), "assigned_stage")
    keys = [F.col(c) for c in ("assigned_stage", "stage_name", "ecl_horizon")]
    total = F.grouping_id(*keys) != 0
    sums = lambda c: F.sum(F.col(c).cast("decimal(18,2)")).cast("double")
    return p.groupingSets([keys, []], *keys).agg(
        F.when(total, F.lit("TOTAL")).otherwise(F.col("assigned_stage").cast("string")).alias("stage"), F.count("*").alias("exposure_count"), sums("ead_amount_aed").alias("total_ead_aed"),
        sums("reported_ecl_aed").alias("total_provision_aed"), F.round(F.sum("reported_ecl_aed") / F.nullif(F.sum("ead_amount_aed"), F.lit(0.0)), 6).alias("portfolio_coverage_ratio"),
    ).select("stage", "stage_name", "ecl_horizon", "exposure_count", "total_ead_aed", "total_provision_aed", "portfolio_coverage_ratio")


def calculation_audit(provisions: DataFrame, scores: DataFrame, model: str) -> DataFrame:
    """What each provision was calculated from, as canonical JSON with its SHA-256: money and weights as exact decimals' text."""
    text = lambda c, kind: F.col(c).cast(kind).cast("string")
    weights = F.sort_array(F.collect_set(F.concat_ws("=", "scenario_id", text("probability_weight", "decimal(9,8)"))))
    used = scores.groupBy("reporting_date", "exposure_id").agg(F.sort_array(F.collect_set("parameter_set_id")).alias("sets"), weights.alias("weights"))
    fields = {
        "date": text("reporting_date", "date"), "ead": text("ead_amount_aed", "decimal(18,2)"), "ecl": text("reported_ecl_aed", "decimal(18,2)"), "exposure": F.col("exposure_id"),
        "model": F.lit(model), "sets": F.array_join("sets", ","), "stage": text("assigned_stage", "int"), "weights": F.array_join("weights", ","),
    }
    body = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"})
    calc = F.concat_ws("-", F.lit("CALC"), "exposure_id", F.date_format("reporting_date", "yyyyMMdd"))
    return provisions.join(used, ["reporting_date", "exposure_id"]).select(calc.alias("calculation_id"), "exposure_id", "reporting_date", "assigned_stage", "reported_ecl_aed", body.alias("inputs_json"), F.sha2(body, 256).alias("input_sha256"))

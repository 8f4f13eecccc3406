"""Goldens of the seven-customer sample, loss goldens, tables, sources, streams and the graph."""

import datetime as dt
import hashlib
import json
import os
import urllib.error

import pytest
from pyspark.sql import functions as F

from decisionlake.operators import conform, identity, quality
from decisionlake.plans import ecl, marts, pipeline
from decisionlake.sources import feeds, tables
from decisionlake.streaming import cdc

PEOPLE = [
    ("784-1988-1234567-1", "Ahmed Al Mansoori", "1988-03-14", "+971501234567", "ahmed.almansoori@example.ae", 32000), ("784-1992-2345678-2", "Fatima Hassan", "1992-07-22", "+971502345678", "fatima.hassan@example.ae", 18500),
    ("784-1985-3456789-3", "Rajesh Kumar", "1985-11-30", "+971503456789", "rajesh.kumar@example.ae", 27000), ("784-1995-4567890-4", "Sara Abdullah", "1995-01-09", "+971504567890", "sara.abdullah@example.ae", 15000),
    ("784-1979-5678901-5", "Mohammed Ali", "1979-06-18", "+971505678901", "mohammed.ali@example.ae", 45000), ("784-1990-6789012-6", "Priya Nair", "1990-09-03", "+971506789012", "priya.nair@example.ae", 21000),
    ("784-1983-7890123-7", "Omar Sheikh", "1983-12-25", "+971507890123", "omar.sheikh@example.ae", 38000),
]
SCORES = [742, 688, 705, 612, 811, 669, 573]
FRAUD = [(".0234", "APPROVE"), (".1180", "APPROVE"), (".4720", "REVIEW"), (".2015", "APPROVE"), (".0091", "APPROVE"), (".3345", "REVIEW"), (".8890", "DECLINE")]
AML = [("CLEAR", False), ("CLEAR", False), ("PENDING", False), ("CLEAR", False), ("HIT", True), ("CLEAR", False), ("HIT", False)]
DECISIONS = [(1, "PERSONAL_FINANCE", "09:30", 150000, 150000, "APPROVED"), (2, "BNPL", "10:05", 5000, 5000, "APPROVED"), (3, "CARD_ALT", "10:40", 40000, 25000, "APPROVED"), (4, "PERSONAL_FINANCE", "11:15", 80000, 0, "REFERRED"), (5, "PERSONAL_FINANCE", "12:00", 250000, 200000, "APPROVED"), (6, "BNPL", "13:20", 8000, 8000, "APPROVED"), (7, "CARD_ALT", "14:10", 30000, 0, "DECLINED"), (3, "BNPL", "15:45", 3000, 3000, "APPROVED")]


def uid(n):
    return f"{str(n) * 8}-{str(n) * 4}-4{str(n) * 3}-8{str(n) * 3}-{str(n) * 12}"


@pytest.fixture(scope="module")
def day(spark):
    at = dt.datetime(2025, 4, 1, 6)
    profile = spark.createDataFrame([(uid(i + 1), *p[:5], str(p[5]), True, "c", 1, i) for i, p in enumerate(PEOPLE)], "internal_customer_uuid string, emirates_id string, full_name string, date_of_birth string, phone string, email string, monthly_income_aed string, kyc_completed boolean, cdc_op string, cdc_source_ts_ms long, cdc_lsn long")
    bureau = spark.createDataFrame([(f"AECB-RPT-20250401-{i + 1:06d}", p[0], SCORES[i], at, at) for i, p in enumerate(PEOPLE)], "aecb_report_ref string, emirates_id string, aecb_credit_score int, report_timestamp timestamp_ntz, updated_timestamp timestamp_ntz").withColumn("aecb_total_outstanding_aed", F.lit(1).cast("decimal(18,2)"))
    fraud = spark.createDataFrame([(f"FRD-20250401-{i + 1:04d}", "+971503456700" if i == 2 else p[3], p[4], FRAUD[i][0], FRAUD[i][1], f"2025-04-01T06:1{i}:00+04:00") for i, p in enumerate(PEOPLE)], "event_id string, phone string, email string, fraud_score string, fraud_decision string, scored_at string")
    aml = spark.createDataFrame([(f"AML-20250401-{i + 1:04d}", "Omar Shaikh" if i == 6 else p[1], p[2], AML[i][0], AML[i][1], f"2025-04-01T05:0{i}:00+04:00") for i, p in enumerate(PEOPLE)], "screening_ref string, full_name string, date_of_birth string, aml_status string, is_pep boolean, screened_at string")
    made = spark.createDataFrame([(f"d000000{i + 1}-0000-4000-8000-00000000000{i + 1}", f"APP-2025-00000{i + 1}", uid(d[0]), d[1], f"2025-04-01T{d[2]}:00+04:00", str(d[3]), str(d[4]), d[5], at) for i, d in enumerate(DECISIONS)], "decision_id string, application_id string, internal_customer_uuid string, product_code string, decision_timestamp string, requested_amount_aed string, approved_amount_aed string, decision_outcome string, ingested_timestamp timestamp_ntz")
    raw = {"profile": profile, "bureau": bureau, "fraud": fraud, "aml": aml, "decisions": made}
    return pipeline.daily_graph(raw, F.lit("2025-04-01 20:00:00").cast("timestamp_ntz")).run()


def test_cross_reference(day):
    x = {r.source_record_key: r for r in day["xref"].collect()}
    assert len(x) == 8 and [r.source_record_key for r in x.values() if r.master_customer_id == "UNRESOLVED"] == ["FRD-20250401-0003"]
    golden = [r for r in x.values() if r.source_system == "POSTGRES"]
    assert all(r.aecb_matched and r.aml_matched for r in golden) and sum(r.fraud_matched for r in golden) == 6
    omar = x[uid(7)]
    assert float(omar.aml_match_confidence) == 0.9758 and omar.match_method == "PROBABILISTIC" and omar.matched_on == ["internal_customer_uuid", "emirates_id", "phone_email", "full_name_dob"]
    assert day["queue"].count() == 1


def test_fused_and_judged(day):
    rows = day["fused"].collect()
    assert len(rows) == 8 and sorted(float(r.input_completeness_score) for r in rows) == [0.75] * 2 + [1.0] * 6
    fresh = day["fused"].sparkSession.createDataFrame([("AECB", True), ("FRAUD", False), ("AML", False), ("POSTGRES", False)], "source string, ok boolean")
    card = quality.scorecard(day["judged"], fresh).first()
    assert (card.total_decision_count, card.passed_count, card.dup_application_id, card.dup_master_customer_id, card.warn_ok_count, card.warn_count, float(card.dq_score)) == (8, 8, 0, 1, 2, 6, 86.67)
    assert json.loads(card.warn_json)["aml_pending"] == 0.25


def test_mart(day):
    cube = {(r.product_code, r.decision_outcome_band, r.risk_band): r for r in day["mart"].collect()}
    assert len(cube) == 7 and cube["BNPL", "APPROVED", "GOOD"].decision_count == 2
    assert float(cube["BNPL", "APPROVED", "GOOD"].avg_fraud_score) == 0.118 and float(cube["BNPL", "APPROVED", "GOOD"].avg_aecb_credit_score) == 696.5
    assert cube["CARD_ALT", "APPROVED", "GOOD"].avg_fraud_score is None and cube["PERSONAL_FINANCE", "APPROVED", "EXCELLENT"].pep_count == 1


def test_disjunctive_blocks_are_equi_joins(day, spark):
    customers = identity.spine(day["profile"])
    plan = identity.candidates(day["fraud"], "fraud_assessment_id", customers, ["phone", "email"])._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_rules_fail_on_null(spark):
    now = F.lit("2025-04-03 00:00:00").cast("timestamp_ntz")
    rows = [("a", "x", "m", "BNPL", dt.datetime(2025, 4, 1), 900, 0.5), ("b", None, "UNRESOLVED", None, dt.datetime(2025, 3, 31, 23, 59, 59), 901, 1.1), ("b", " ", "m", "BNPL", dt.datetime(2025, 4, 3, 0, 0, 1), None, None), (None, "x", "m", "BNPL", None, 299, None)]
    df = spark.createDataFrame(rows, "decision_id string, application_id string, master_customer_id string, product_code string, decision_timestamp timestamp_ntz, aecb_credit_score int, fraud_score double")
    got = [r.dq_fail_reasons for r in quality.evaluate(df, now).orderBy(F.col("aecb_credit_score").desc_nulls_last()).collect()]
    assert sorted(got) == sorted([
        [], ["application_id_not_null", "master_customer_id_resolved", "fraud_score_in_range", "aecb_credit_score_in_range", "product_code_in_enum", "decision_timestamp_not_stale", "unique_decision_id"],
        ["application_id_not_null", "decision_timestamp_not_future", "unique_decision_id"], ["decision_id_not_null", "aecb_credit_score_in_range", "decision_timestamp_not_future", "decision_timestamp_not_stale", "unique_decision_id"],
    ])
    empty = quality.scorecard(quality.evaluate(df.limit(0), now).withColumn("input_completeness_score", F.lit(1.0)).withColumn("aml_status", F.lit("CLEAR"))).first()
    assert float(empty.dq_score) == 100 and empty.total_decision_count == 0


def test_checks_and_contract(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, -2)], "k string, n int")
    checks = [quality.check("row_count > 0"), quality.check("missing_count(k) = 0"), quality.check("duplicate_count(k, n) = 0"), quality.check("min(n) >= 0"), quality.check("invalid_count(k) = 0", ("a",)), quality.failed_rows("neg", "n < 0")]
    assert [r.outcome for r in quality.run_checks(df, checks).collect()] == ["pass", "fail", "fail", "fail", "pass", "fail"]
    with pytest.raises(ValueError):
        quality.check("sum(n) = 1")
    bad = spark.createDataFrame([], "Bad string, x_aed decimal(10,2), y double, a_date string, b_timestamp date")
    assert len(quality.contract_breaches(bad.schema, ("z",))) == 6


# ---- expected credit loss --------------------------------------------------------------------------------------------
P12 = [0.001, 0.0025, 0.006, 0.012, 0.022, 0.04, 0.07, 0.12, 0.2, 0.32, 1]
SETS = {"PS_PIT_BASE_202505": ("BASE", 1, "2025-05-01", "2025-05-31", False), "PS_PIT_BASE_202506": ("BASE", 1, "2025-06-01", None, True), "PS_PIT_UP_202506": ("UPSIDE", 0.7, "2025-06-01", None, True), "PS_PIT_DOWN_202506": ("DOWNSIDE", 1.8, "2025-06-01", None, True)}


@pytest.fixture(scope="module")
def loss(spark):
    grades = [*(f"R{i}" for i in range(1, 11)), "D"]
    pd_terms = [(s, g, h, round(1 - (1 - min(1.0, p * m)) ** (h / 12), 8)) for s, (_, m, *_) in SETS.items() for g, p in zip(grades, P12) for h in (12, 24, 36, 48, 60)]
    lgd = [(s, c, v) for s in SETS for c, v in (("UNSECURED", 0.75), ("RESIDENTIAL_RE", 0.3), ("VEHICLE", 0.5))]
    ccf = [(s, c, v) for s in SETS for c, v in (("PERSONAL_FINANCE", 1.0), ("BNPL", 1.0), ("CARD_ALT", 0.55))]
    weights = [(d, s, w) for d, ws in (("2025-05-31", (0.55, 0.2, 0.25)), ("2025-06-30", (0.5, 0.2, 0.3))) for s, w in zip(ecl.SCENARIOS, ws)]
    exposures = [("EXP-0001", "PERSONAL_FINANCE", 0.01789222, "UNSECURED"), ("EXP-0002", "CARD_ALT", 0.03556973, "UNSECURED"), ("EXP-0003", "PERSONAL_FINANCE", 0.01789222, "UNSECURED"), ("EXP-0004", "BNPL", 0.06455865, None), ("EXP-0005", "PERSONAL_FINANCE", 0.03556973, "VEHICLE"), ("EXP-0006", "CARD_ALT", 0.06455865, "UNSECURED"), ("EXP-0007", "PERSONAL_FINANCE", 0.03556973, "UNSECURED")]
    t, f = True, False
    snaps = [("2025-06-30", 1, 120000, 0, 0, "R3", 0.01789222, 0.09, 43, f, f, f), ("2025-06-30", 2, 18000, 12000, 35, "R5", 0.06455865, 0.24, 36, f, f, f), ("2025-06-30", 3, 90000, 0, 5, "R7", 0.195643, 0.1, 21, f, f, f), ("2025-06-30", 4, 5000, 0, 10, "R6", 0.115264, 0.01, 6, t, f, f), ("2025-06-30", 5, 60000, 0, 95, "R9", 0.488, 0.11, 15, f, f, f), ("2025-06-30", 6, 30000, 5000, 20, "R8", 0.318528, 0.24, 36, f, f, t), ("2025-06-30", 7, 40000, 0, 0, "R5", 0.06455865, 0.1, 24, f, t, f), ("2025-05-31", 2, 17000, 13000, 5, "R4", 0.03556973, 0.24, 37, f, f, f), ("2025-05-31", 5, 60000, 0, 65, "R8", 0.318528, 0.11, 16, f, f, f)]
    snapshots = spark.createDataFrame([(s[0], f"EXP-000{s[1]}", *[float(x) for x in s[2:4]], *s[4:]) for s in snaps], "reporting_date string, exposure_id string, drawn_balance_aed double, undrawn_commitment_aed double, days_past_due int, current_rating_grade string, current_lifetime_pd double, effective_interest_rate double, remaining_maturity_months int, is_forborne boolean, is_watchlist boolean, is_unlikely_to_pay boolean").withColumn("reporting_date", F.to_date("reporting_date"))
    stages = ecl.staged(snapshots, spark.createDataFrame(exposures, "exposure_id string, product_type string, origination_lifetime_pd double, collateral_type string"))
    sets = spark.createDataFrame([(k, "PIT", v[0], v[4], v[2], v[3]) for k, v in SETS.items()], "parameter_set_id string, parameter_basis string, macro_scenario_id string, is_current boolean, effective_from_date string, effective_to_date string")
    sets = sets.withColumns({c: F.to_date(c) for c in ("effective_from_date", "effective_to_date")})
    w = spark.createDataFrame(weights, "reporting_date string, scenario_id string, probability_weight double").withColumn("reporting_date", F.to_date("reporting_date"))
    scores = ecl.scored(stages.where("reporting_date = DATE '2025-06-30'"), w, sets, spark.createDataFrame(pd_terms, "parameter_set_id string, rating_grade string, horizon_months int, cumulative_pd double"), spark.createDataFrame(lgd, "parameter_set_id string, collateral_segment string, downturn_lgd_rate double"), spark.createDataFrame(ccf, "parameter_set_id string, product_type string, credit_conversion_factor double"))
    return stages, scores


def test_loss_goldens(spark, loss):
    stages, scores = loss
    got = {r.exposure_id: (r.assigned_stage, r.ead_amount_aed, r.ecl_base_aed, r.ecl_upside_aed, r.ecl_downside_aed, r.reported_ecl_aed) for r in ecl.provision(scores).collect()}
    assert got == {
        "EXP-0001": (1, 120000.0, 517.23, 362.06, 931.01, 610.33), "EXP-0002": (2, 24600.0, 862.62, 607.86, 1525.35, 1010.49), "EXP-0003": (2, 90000.0, 8290.23, 5866.30, 14489.43, 9665.20), "EXP-0004": (2, 5000.0, 149.26, 104.48, 268.66, 176.12),
        "EXP-0005": (3, 60000.0, 27027.03, 27027.03, 27027.03, 27027.03), "EXP-0006": (3, 32750.0, 17788.53, 17788.53, 17788.53, 17788.53), "EXP-0007": (2, 40000.0, 1186.80, 833.53, 2117.23, 1395.28),
    }
    names = spark.createDataFrame([(1, "PERFORMING", "12M"), (2, "UNDERPERFORMING", "LIFETIME"), (3, "IMPAIRED", "LIFETIME")], "stage_id int, stage_name string, ecl_horizon string")
    totals = {r.stage: (r.total_provision_aed, r.total_ead_aed, r.portfolio_coverage_ratio) for r in ecl.summary(ecl.provision(scores), names).collect()}
    assert totals == {"1": (610.33, 120000.0, 0.005086), "2": (12247.09, 159600.0, 0.076736), "3": (44815.56, 92750.0, 0.483187), "TOTAL": (57672.98, 372350.0, 0.154889)}
    audit = ecl.calculation_audit(ecl.provision(scores), scores, "m").collect()
    assert len({r.input_sha256 for r in audit}) == 7 and audit[0].calculation_id.startswith("CALC-EXP-000")


def test_transitions(loss):
    got = {(r.exposure_id, str(r.reporting_date)): (r.prior_stage, r.new_stage, r.transition_direction) for r in ecl.transitions(loss[0]).collect()}
    assert len(got) == 9 and got["EXP-0002", "2025-06-30"] == (1, 2, "DETERIORATION") and got["EXP-0005", "2025-06-30"] == (2, 3, "DETERIORATION") and got["EXP-0001", "2025-06-30"] == (None, 1, "INITIAL")


# ---- tables, sources, streams ----------------------------------------------------------------------------------------
def test_table(spark, tmp_path):
    t = tables.Table(spark, str(tmp_path / "t"), ["k"], partition="p", protected=("flag",), event_time="at")
    schema = "k string, p string, v int, flag boolean, at long, created_timestamp long"
    df = lambda *rows: spark.createDataFrame(list(rows), schema)
    assert t.read(df().schema).count() == 0
    t.merge(df(("a", "x", 1, True, 5, 1), (None, "y", 2, None, 5, 1)))
    t.merge(df(("a", "x", 9, False, 4, 2), ("b", "x", 3, None, 1, 2)))  # a's change is older
    t.merge(df((None, "y", 7, True, 6, 3)))
    rows = lambda: {(r.k, r.v, r.flag, r.created_timestamp) for r in t.read().collect()}
    assert rows() == {("a", 1, True, 1), ("b", 3, None, 2), (None, 7, True, 1)}
    before = rows()
    t.merge(df((None, "y", 7, True, 6, 3)))
    assert rows() == before and t.version == 4
    with pytest.raises(ValueError):
        t.merge(df(("a", "x", 1, True, 5, 1), ("a", "x", 2, True, 5, 1)))
    t.update_columns(spark.createDataFrame([("b", 30)], "k string, v int"), ["v"])
    t.delete(spark.createDataFrame([("a",)], "k string"))
    t.append(df(("b", "x", 4, None, 1, 1)))
    assert sorted(v for _, v, *_ in rows()) == [4, 7, 30]
    with pytest.raises(ValueError):
        tables.Table(spark, "x", [])
    t.register("the_table")
    assert spark.table("the_table").count() == 3
    assert tables.commented(df(), {"k": "PII Level 1"}).schema["k"].metadata == {"comment": "PII Level 1"}


def test_changes_rewrite_only_the_files_they_touch(spark, tmp_path):
    t = tables.Table(spark, str(tmp_path / "t"), ["k"], partition="p")
    df = lambda *rows: spark.createDataFrame(list(rows), "k long, p string, v int")
    t.append(df(*[(i, "x", 0) for i in range(50)]))
    t.append(df(*[(i, "y y/é", 0) for i in range(50, 100)]))
    files = lambda: set(t._manifest()[2]["files"])
    before = files()
    t.append(df((100, "x", 1)))
    assert before < files()
    before = files()
    t.update_columns(spark.createDataFrame([(60, 5), (999, 1)], "k long, v int"), ["v"])
    assert len(before - files()) == 1 and t.read().where("v = 5").count() == 1 and t.read().count() == 101
    before = files()
    t.delete(spark.createDataFrame([(70,), (71,)], "k long"))
    assert len(before - files()) == 1 and t.read().count() == 99
    before = files()
    t.merge(df((60, "y y/é", 9), (200, "y y/é", 9)))
    assert len(before - files()) == 1 and t.read().where("v = 9").count() == 2 and t.read().count() == 100
    version = t.version
    t.delete(spark.createDataFrame([(12345,)], "k long"))
    assert t.version == version and t.read(partitions={"x"}).count() == 51


def test_two_writers_do_not_lose_each_other(spark, tmp_path):
    t = tables.Table(spark, str(tmp_path / "t"), ["k"])
    df = lambda *rows: spark.createDataFrame(list(rows), "k int, v int")
    t.append(df((1, 1)))
    with pytest.raises(RuntimeError):
        t._commit(df((2, 2)), {}, base=0)  # began before version 1
    assert [tuple(r) for r in t.read().collect()] == [(1, 1)]
    (tmp_path / "t" / "_versions" / "2.json").write_text("")  # a writer that was lost after its claim
    t.append(df((3, 3)))
    assert t.version == 3 and {tuple(r) for r in t.read().collect()} == {(1, 1), (3, 3)}


def test_stream_converges_whatever_the_order(spark, tmp_path):
    flat = "k string, v int, op string, ts_ms long"
    batches = [[("a", 2, "u", 20), ("b", 1, "c", 5)], [("a", 1, "c", 10), ("b", None, "d", 30)], [("b", 7, "u", 20)]]
    t = tables.Table(spark, str(tmp_path / "t"), ["k"], event_time="__ts_ms")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, flat).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / str(i)))
        q = cdc.follow_changes(spark, str(tmp_path / "in"), spark.createDataFrame([], flat).schema, t, "k", "__ts_ms", str(tmp_path / "cp"))
        q.awaitTermination()
    assert [(r.k, r.v) for r in cdc.current(t).collect()] == [("a", 2)]


def test_envelope_forms(spark):
    nested = spark.createDataFrame([(("k", 1), None, "c", 5), (None, ("k", 1), "d", 6)], "after struct<id:string,v:int>, before struct<id:string,v:int>, op string, ts_ms long")
    assert [tuple(r) for r in conform.envelope(nested).collect()] == [("k", 1, "c", 5), ("k", 1, "d", 6)]
    flat = spark.createDataFrame([("k", None, 3)], "id string, __op string, __source_ts_ms long")
    assert tuple(conform.envelope(flat).first()) == ("k", "u", 3)


def test_xml_and_manifest(spark, tmp_path):
    body = '<Batch xmlns="urn:x"><CreditReport><ReportRef>R1</ReportRef><ReportDate>2025-04-01</ReportDate><Subject><EmiratesId>784-1</EmiratesId><FullName> A </FullName></Subject><CreditScore>700</CreditScore><TotalOutstandingAED>10.005</TotalOutstandingAED><ActiveLoans></ActiveLoans></CreditReport><CreditReport><ReportRef>R2</ReportRef><CreditScore>x</CreditScore></CreditReport></Batch>'
    (tmp_path / "a.xml").write_text(body)
    (tmp_path / "b.txt").write_text("no")
    rows = {r.report_ref: r for r in feeds.bureau_xml(spark, str(tmp_path)).collect()}
    assert rows["R1"].credit_score == 700 and str(rows["R1"].total_outstanding_aed) == "10.01" and rows["R1"].full_name == "A" and rows["R1"].num_active_loans is None and rows["R2"].emirates_id is None and rows["R2"].credit_score is None
    seen = spark.createDataFrame(feeds.new_files(spark, str(tmp_path), None).collect())
    assert seen.count() == 1 and feeds.new_files(spark, str(tmp_path), seen).count() == 0
    (tmp_path / "a.xml").write_text(body + " ")
    assert feeds.new_files(spark, str(tmp_path), seen).count() == 1


def test_rest_pages_retries_and_marks(spark):
    calls = []

    def fetch(cursor):
        calls.append(cursor)
        if len(calls) == 2:
            raise urllib.error.HTTPError("u", 503, "busy", {}, None)
        return {"events": [{"event_id": f"e{cursor}"}], "has_more": cursor != "2", "next_cursor": {None: "1", "1": "2", "2": None}[cursor]}

    assert [e["event_id"] for e in feeds.pages(fetch, sleep=lambda s: None)] == ["eNone", "e1", "e2"] and len(calls) == 4
    with pytest.raises(urllib.error.HTTPError):
        feeds.with_retries(lambda: (_ for _ in ()).throw(urllib.error.HTTPError("u", 404, "no", {}, None)), sleep=lambda s: None)
    raw = [json.dumps({"event_id": i, "fraud_score": s, "scored_at": t}) for i, s, t in (("a", "0.5", "2025-04-01T06:00:00"), ("a", "0.5", "2025-04-01T06:00:00"), (None, "x", "2025-04-01T06:00:00+04:00"), (None, "2", None))]
    got = feeds.fraud_events(spark.createDataFrame([(r,) for r in raw], "raw_json string")).collect()
    assert len(got) == 3 and [str(r.scored_at) for r in got if r.event_id] == ["2025-04-01 10:00:00"]
    marks = spark.createDataFrame([("2025-01-02",), ("2025-01-03",)], "at string")
    assert feeds.next_mark(feeds.above(marks, "at", "2025-01-02"), "at", "x") == "2025-01-03" and feeds.next_mark(marks.limit(0), "at", "x") == "x"


def test_webhook(spark):
    import hashlib
    import hmac

    sig = hmac.new(b"s", b"body", hashlib.sha256).hexdigest()
    assert feeds.signed(b"body", f"sha256={sig}", b"s") and feeds.signed(b"body", sig, b"s") and not feeds.signed(b"body!", sig, b"s") and not feeds.signed(b"body", None, b"s")
    one = {"screening_ref": "r", "full_name": "n", "date_of_birth": "d", "aml_status": "HIT"}
    bodies = [json.dumps(one), json.dumps([one, one | {"aml_status": "?"}, one | {"screening_ref": " "}, one | {"full_name": None}])]
    good, bad = feeds.callbacks(spark.createDataFrame([(b,) for b in bodies], "value string"))
    assert good.count() == 2 and {r.reject_reason for r in bad.collect()} == {"invalid aml_status", "missing screening_ref", "missing full_name or date_of_birth"}


def test_graph():
    tries = []

    def flaky(results):
        tries.append(1)
        if len(tries) < 3:
            raise OSError
        return results["a"] + 1

    g = pipeline.Graph([pipeline.Step("b", flaky, ("a",)), pipeline.Step("a", lambda r: 1)])
    assert g.run(sleep=lambda s: None) == {"a": 1, "b": 2}
    with pytest.raises(ValueError):
        pipeline.Graph([pipeline.Step("a", lambda r: 1, ("z",))]).order()
    assert pipeline.arguments(["--env", "dev", "--batch_id", "1"]).run_date is None


def test_trend_and_bands(spark):
    cards = spark.createDataFrame([(f"2025-01-{d:02d}", float(d)) for d in range(1, 10)], "snapshot_date string, dq_score double")
    last = marts.score_trend(cards).orderBy(F.desc("snapshot_date")).first()
    assert last.dq_score_7d_avg == 6.0 and last.dq_score_dod_delta == 1.0
    bands = spark.createDataFrame([(s,) for s in (None, 579, 580, 669, 670, 739, 740, 799, 800)], "s int").select(marts.risk_band(F.col("s"))).collect()
    assert [r[0] for r in bands] == ["UNKNOWN", "POOR", "FAIR", "FAIR", "GOOD", "GOOD", "VERY_GOOD", "VERY_GOOD", "EXCELLENT"]


def test_snapshots_are_stable_and_written(day, spark, tmp_path):
    from decisionlake.operators import fuse

    raw = {"aecb": (day["bureau"], "aecb_report_ref", "aecb_report_ref", "updated_timestamp"), "profile": (day["profile"], "internal_customer_uuid", "internal_customer_uuid", "source_ts_ms")}
    take = lambda when: {r.decision_id: r for r in fuse.snapshots(day["fused"], raw, "root", F.lit(when).cast("timestamp_ntz")).collect()}
    a, b = take("2025-04-01 10:00:00"), take("2026-01-01 00:00:00")
    assert len(a) == 8 and all(a[k].content_sha256 == b[k].content_sha256 for k in a) and len({r.content_sha256 for r in a.values()}) == 8
    one = next(iter(a.values()))
    assert one.snapshot_uri.startswith("root/decision_date=2025-04-01/decision_id=") and str(one.retain_until) == "2032-04-01" and one.aecb_sha256
    inputs = json.loads(one.body)["inputs"]
    record = json.loads(inputs["aecb"]["record"])
    assert record["aecb_report_ref"] == json.loads(one.body)["decision"]["aecb_report_ref"] and json.loads(inputs["profile"]["record"])["internal_customer_uuid"]
    assert hashlib.sha256(inputs["aecb"]["record"].encode()).hexdigest() == one.aecb_sha256 and hashlib.sha256(one.body.encode()).hexdigest() == one.content_sha256
    root = str(tmp_path / "s")
    first = fuse.write_snapshots(fuse.snapshots(day["fused"], raw, root, F.lit("2025-04-01 10:00:00").cast("timestamp_ntz"))).collect()
    assert len(first) == 8 and all(r.written for r in first) and all(open(r.snapshot_uri).read() == a[r.snapshot_uri.split("decision_id=")[1].split("/")[0]].body for r in first)
    changed = day["fused"].withColumn("fraud_decision", F.lit("LATER"))
    again = fuse.write_snapshots(fuse.snapshots(changed, raw, root, F.lit("2026-01-01").cast("timestamp_ntz"))).collect()
    assert len(again) == 8 and not any(r.written for r in again) and not any("LATER" in open(r.snapshot_uri).read() for r in first)
    assert sum(len(files) for _, _, files in os.walk(root)) == 8
    trail = marts.audit_trail(day["fused"], spark.createDataFrame([(one.decision_id, one.snapshot_uri, one.content_sha256, one.retain_until)], "decision_id string, snapshot_uri string, content_sha256 string, retain_until date"))
    assert trail.where("snapshot_missing").count() == 7


def test_partitioned_writes_replace_their_days(spark, tmp_path):
    df = lambda *rows: spark.createDataFrame(list(rows), "v int, ingest_date string")
    tables.write_partitioned(df((1, "d1"), (2, "d2")), str(tmp_path / "w"))
    tables.write_partitioned(df((3, "d2")), str(tmp_path / "w"))
    assert sorted(r.v for r in spark.read.parquet(str(tmp_path / "w")).collect()) == [1, 3]
    loaded = tables.audited(df((1, "d")), "AECB", "b1", F.lit("2025-01-01").cast("timestamp"))
    assert loaded.columns[-4:] == ["source_system", "batch_id", "created_timestamp", "updated_timestamp"]


def test_stream_of_files_and_once_within(spark, tmp_path):
    schema = "id string, at timestamp, ingest_date string"
    rows = [("a", dt.datetime(2025, 1, 1), "d1"), ("a", dt.datetime(2025, 1, 1, 1), "d1"), (None, dt.datetime(2025, 1, 1), "d2")]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    kinds = spark.createDataFrame([], schema).schema
    cdc.follow_files(spark, str(tmp_path / "in"), kinds, str(tmp_path / "out"), str(tmp_path / "cp"), F.col("id").isNotNull()).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.where("ingest_date = 'd1'").count() == 2 == out.count() and spark.read.parquet(str(tmp_path / "out" / "_rejected")).count() == 1
    once = cdc.once_within(spark.readStream.schema(kinds).parquet(str(tmp_path / "in")).where("id IS NOT NULL"), "id", "at")
    once.writeStream.format("memory").queryName("once").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("once").count() == 1


def test_queues_and_metrics(day):
    assert {r.metric for r in pipeline.metrics(day["card"]).collect()} >= {"dq_score", "passed_count"}
    assert marts.queue_size(day["queue"]).first().records == 1


def test_graph_retries_what_runs_within_a_step(spark):
    tried = []

    def fails_once(_):
        tried.append(1)
        return spark.range(3).select(F.expr(f"if({len(tried)} < 2, raise_error('lost'), id)").alias("id"))

    got = pipeline.Graph([pipeline.Step("a", fails_once, carried_out=True)]).run(sleep=lambda _: None)
    assert len(tried) == 2 and got["a"].count() == 3


def test_run_of_one_day_replaces_its_day(spark, small, tmp_path):
    names = {"profile": "customer_profile_raw", "bureau": "aecb_credit_report", "fraud": "fraud_raw", "aml": "aml_raw", "decisions": "decisions_raw"}
    raw = {k: spark.read.parquet(f"{small}/{t}.parquet") for k, t in names.items()}
    day_ = str(conform.decisions(raw["decisions"]).where("decision_date IS NOT NULL").agg(F.max("decision_date")).first()[0])
    args = pipeline.arguments(["--env", "test", "--batch_id", "b1", "--run_date", day_])
    for _ in range(2):
        pipeline.run_day(spark, args, raw, str(tmp_path), F.lit(f"{day_} 23:59:59").cast("timestamp_ntz"))
    written = spark.read.parquet(str(tmp_path / "test" / "fused"))
    assert {str(r[0]) for r in written.select("decision_date").distinct().collect()} == {day_} and written.count() == written.select("decision_id").distinct().count() > 0
    assert pipeline.landed(spark, [str(tmp_path / "test" / "fused")]) and not pipeline.landed(spark, [str(tmp_path / "none")], timeout=1, every=1, sleep=lambda _: None)


def test_alerts(day):
    assert {r.alert for r in pipeline.alerts(day["card"]).collect()} <= {"rows_quarantined", "warn_rules_failed", "score_low"}


def test_envelopes_of_a_broker(spark):
    record = spark.createDataFrame([], "k string, v int").schema
    values = ['{"payload": {"before": null, "after": {"k": "a", "v": 1}, "op": "c", "ts_ms": 5}}', '{"before": {"k": "a", "v": 1}, "after": null, "op": "d", "ts_ms": 6}', None, "x"]
    got = cdc.changes(cdc.envelopes(spark.createDataFrame([(v,) for v in values], "value string"), record))
    assert {tuple(r) for r in got.select("k", "v", "is_deleted").collect()} == {("a", 1, False), ("a", 1, True)}


def test_freshness_check(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1),), (None,)], "created_timestamp timestamp_ntz")
    at = lambda h: quality.run_checks(df, [quality.check("freshness(created_timestamp) < 25h", now=F.lit(f"2025-01-02 0{h}:00:00").cast("timestamp_ntz"))]).first().outcome
    assert at(0) == "pass" and at(1) == "fail"

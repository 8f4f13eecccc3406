"""Queries of the conforming, identity, fusion, quality, mart and loss operators over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from decisionlake.functions import ids, text
from decisionlake.operators import conform, fuse, identity, quality
from decisionlake.plans import ecl, marts, pipeline
from decisionlake.session import table
from decisionlake.sources import feeds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


# ---- SQL shared by the oracles ---------------------------------------------------------------------------------------
def _eid(c: str) -> str:
    return f"nullif(regexp_replace(trim({c}), '[\\s\\-]', '', 'g'), '')"


def _phone(c: str) -> str:
    d = f"regexp_replace({c}, '[^0-9+]', '', 'g')"
    n = f"CASE WHEN starts_with({d}, '0') THEN '+971' || substr({d}, 2) WHEN starts_with({d}, '971') THEN '+' || {d} ELSE {d} END"
    return f"CASE WHEN regexp_matches({n}, '^\\+[0-9]{{8,15}}$') THEN {n} END"


def _email(c: str) -> str:
    return f"nullif(lower(trim({c})), '')"


def _name(c: str) -> str:
    return f"nullif(lower(trim(regexp_replace({c}, '\\s+', ' ', 'g'))), '')"


def _gulf(c: str) -> str:
    zoned = f"regexp_matches(trim({c}), '(Z|[+-]\\d\\d:\\d\\d)$')"
    instant = f"TRY_CAST(CASE WHEN {zoned} THEN trim({c}) ELSE trim({c}) || '+04:00' END AS TIMESTAMPTZ)"
    return f"CASE WHEN regexp_matches(trim({c}), '^\\d{{4}}-\\d\\d-\\d\\d[T ]') THEN timezone('UTC', {instant}) + INTERVAL 4 HOURS END"


def _best(rows: str, key: str, order: str, columns: str) -> str:
    """The latest row of each key, ties by all columns, greatest first."""
    ties = ", ".join(f"{c.strip()} DESC NULLS LAST" for c in columns.split(","))
    return f"SELECT {key}, {columns} FROM ({rows}) WHERE {key} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order} DESC NULLS LAST, {ties}) = 1"


_KEY = "internal_customer_uuid"
_LATEST = f"SELECT * FROM customer_profile_raw WHERE {_KEY} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY cdc_source_ts_ms DESC, cdc_lsn DESC) = 1"
_PROFILE = f"""SELECT {_KEY}, {_eid('emirates_id')} AS emirates_id, trim(full_name) AS full_name, TRY_CAST(date_of_birth AS DATE) AS date_of_birth, {_phone('phone')} AS phone, {_email('email')} AS email,
    TRY_CAST(replace(monthly_income_aed, ',', '') AS DECIMAL(18,2)) AS monthly_income_aed, kyc_completed, cdc_source_ts_ms AS source_ts_ms FROM ({_LATEST}) WHERE lower(cdc_op) <> 'd'"""
_NS = ids.MASTER_NAMESPACE.replace("-", "")


def _uuid5(c: str) -> str:
    h = f"sha1(unhex('{_NS}') || encode({c}))"
    return f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || substr('89ab', CAST(('0x' || substr({h}, 17, 1)) AS INT) % 4 + 1, 1) || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"


_SPINE = f"SELECT {_uuid5(_KEY)} AS master_customer_id, * FROM ({_PROFILE})"
_BUREAU = _best(f"SELECT aecb_report_ref, {_eid('emirates_id')} AS emirates_id, aecb_credit_score, aecb_total_outstanding_aed, report_timestamp, updated_timestamp FROM aecb_credit_report", "aecb_report_ref", "report_timestamp", "emirates_id, aecb_credit_score, aecb_total_outstanding_aed, report_timestamp, updated_timestamp").replace("report_timestamp DESC NULLS LAST, emirates_id", "report_timestamp DESC NULLS LAST, updated_timestamp DESC NULLS LAST, emirates_id", 1)
_FRAUD = _best(f"SELECT event_id AS fraud_assessment_id, {_phone('phone')} AS phone, {_email('email')} AS email, TRY_CAST(fraud_score AS DECIMAL(5,4)) AS fraud_score, upper(trim(fraud_decision)) AS fraud_decision, {_gulf('scored_at')} AS scored_at FROM fraud_raw", "fraud_assessment_id", "scored_at", "phone, email, fraud_score, fraud_decision, scored_at")
_AML = _best(f"SELECT screening_ref AS aml_case_id, trim(full_name) AS full_name, TRY_CAST(CASE WHEN regexp_full_match(trim(date_of_birth), '\\d{{4}}-\\d\\d-\\d\\d') THEN trim(date_of_birth) END AS DATE) AS date_of_birth, upper(trim(aml_status)) AS aml_status, is_pep, {_gulf('screened_at')} AS screened_at FROM aml_raw", "aml_case_id", "screened_at", "full_name, date_of_birth, aml_status, is_pep, screened_at")


def _profiles(spark: SparkSession, folder: str) -> DataFrame:
    return conform.profiles(table(spark, folder, "customer_profile_raw"))[0]


def _spine(spark: SparkSession, folder: str) -> DataFrame:
    return identity.spine(_profiles(spark, folder))


# ---- conforming ------------------------------------------------------------------------------------------------------
@query(f"SELECT DISTINCT emirates_id, phone, email, full_name, {_eid('emirates_id')} AS eid, {_phone('phone')} AS e164, {_email('email')} AS mail, {_name('full_name')} AS name FROM customer_profile_raw")
def normalise_ids(spark, folder):
    c = F.col
    return table(spark, folder, "customer_profile_raw").select("emirates_id", "phone", "email", "full_name", text.emirates_id(c("emirates_id")).alias("eid"), text.phone_e164(c("phone")).alias("e164"), text.email_lower(c("email")).alias("mail"), text.name_normal(c("full_name")).alias("name")).distinct()


@query(f"SELECT DISTINCT {_KEY} AS uuid, CASE WHEN coalesce({_KEY}, '') = '' THEN 'UNRESOLVED' ELSE {_uuid5(_KEY)} END AS master FROM customer_profile_raw")
def uuid5_master(spark, folder):
    return table(spark, folder, "customer_profile_raw").select(F.col(_KEY).alias("uuid"), ids.master_id(F.col(_KEY)).alias("master")).distinct()


@query(_PROFILE)
def latest_profile_per_key(spark, folder):
    return _profiles(spark, folder)


@query(f"SELECT {_KEY} FROM ({_LATEST}) WHERE lower(cdc_op) = 'd'")
def cdc_apply_deletes(spark, folder):
    return conform.profiles(table(spark, folder, "customer_profile_raw"))[1]


@query(_BUREAU)
def conform_bureau(spark, folder):
    return conform.bureau_reports(table(spark, folder, "aecb_credit_report"))


@query(_FRAUD)
def conform_fraud(spark, folder):
    return conform.fraud_events(table(spark, folder, "fraud_raw"))


@query(_AML)
def conform_screening(spark, folder):
    return conform.screenings(table(spark, folder, "aml_raw")).drop("name_soundex")


def _soundex(c: str) -> str:
    upper = f"translate(trim({c}), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"
    # letters to their digits; 7 (H, W) doesn't part equal digits, 0 (vowels and what is no letter) does
    digits = f"translate(regexp_replace({upper}, '[^A-Z]', 'A', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230127022455012623017202')"
    runs = f"left({digits}, 1) || replace(substr({digits}, 2), '7', '')"
    for d in "123456":
        runs = f"regexp_replace({runs}, '{d}+', '{d}', 'g')"
    return f"CASE WHEN regexp_matches({upper}, '^[A-Z]') THEN left({upper}, 1) || left(replace(substr({runs}, 2), '0', '') || '000', 3) ELSE trim({c}) END"


@query(f"SELECT DISTINCT full_name, {_soundex('full_name')} AS name_soundex FROM ({_AML})")
def name_soundex(spark, folder):
    return conform.screenings(table(spark, folder, "aml_raw")).select("full_name", "name_soundex").distinct()


_DECISION_COLUMNS = "application_id, internal_customer_uuid, product_code, decision_timestamp, requested_amount_aed, approved_amount_aed, decision_outcome, ingested_timestamp"
_DECISIONS = _best(
    f"SELECT decision_id, application_id, {_KEY}, upper(trim(product_code)) AS product_code, {_gulf('decision_timestamp')} AS decision_timestamp, TRY_CAST(replace(requested_amount_aed, ',', '') AS DECIMAL(18,2)) AS requested_amount_aed, "
    "TRY_CAST(replace(approved_amount_aed, ',', '') AS DECIMAL(18,2)) AS approved_amount_aed, upper(trim(decision_outcome)) AS decision_outcome, ingested_timestamp FROM decisions_raw",
    "decision_id", "ingested_timestamp", _DECISION_COLUMNS,
)


@query(f"SELECT *, CAST(decision_timestamp AS DATE) AS decision_date FROM ({_DECISIONS})")
def conform_decisions(spark, folder):
    return conform.decisions(table(spark, folder, "decisions_raw"))


@query("""SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1""")
def dedupe_lineitem(spark, folder):
    return conform.latest_per_key(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


# ---- identity --------------------------------------------------------------------------------------------------------
_JW = "(j + CASE WHEN a[1] <> b[1] THEN 0 WHEN substr(a, 2, 1) <> substr(b, 2, 1) OR length(a) < 2 OR length(b) < 2 THEN 1 WHEN substr(a, 3, 1) <> substr(b, 3, 1) OR length(a) < 3 OR length(b) < 3 THEN 2 WHEN substr(a, 4, 1) <> substr(b, 4, 1) OR length(a) < 4 OR length(b) < 4 THEN 3 ELSE 4 END * 0.1 * (1 - j))"
_NAME_PAIRS = f"SELECT DISTINCT lower(s.full_name) AS a, lower(p.full_name) AS b FROM ({_AML}) s JOIN ({_PROFILE}) p USING (date_of_birth) WHERE s.full_name <> '' AND p.full_name <> ''"


@query(f"SELECT a, b, round({_JW}, 6) AS similarity FROM (SELECT a, b, jaro_similarity(a, b) AS j FROM ({_NAME_PAIRS}))")
def jw_similarity(spark, folder):
    s = conform.screenings(table(spark, folder, "aml_raw")).select(F.lower("full_name").alias("a"), "date_of_birth")
    p = _profiles(spark, folder).select(F.lower("full_name").alias("b"), "date_of_birth")
    pairs = s.join(p, "date_of_birth").where("a <> '' AND b <> ''").select("a", "b").distinct()
    return pairs.select("a", "b", F.round(text.jaro_winkler_column(F.col("a"), F.col("b")), 6).alias("similarity"))


@query(f"""SELECT aml_case_id, master_customer_id, round(CASE WHEN a <> '' AND b <> '' THEN (0.4 * {_JW} + 0.2) / 0.6 ELSE 1.0 END + 1e-12, 4) AS confidence FROM (
    SELECT aml_case_id, master_customer_id, lower(coalesce(s.full_name, '')) AS a, lower(coalesce(p.full_name, '')) AS b, jaro_similarity(lower(coalesce(s.full_name, '')), lower(coalesce(p.full_name, ''))) AS j
    FROM ({_AML}) s JOIN ({_SPINE}) p USING (date_of_birth))""")
def weighted_confidence(spark, folder):
    s = conform.screenings(table(spark, folder, "aml_raw"))
    p = _spine(spark, folder).select("master_customer_id", F.col("full_name").alias("theirs"), "date_of_birth")
    both = s.join(p, "date_of_birth")
    c = text.match_confidence({"full_name": F.col("full_name"), "date_of_birth": F.col("date_of_birth")}, {"full_name": F.col("theirs"), "date_of_birth": F.col("date_of_birth")})
    return both.select("aml_case_id", "master_customer_id", c.alias("confidence"))


@query("""SELECT match_confidence, count(*) AS records, CASE WHEN match_confidence >= 0.7 THEN 'PROBABILISTIC' ELSE 'UNRESOLVED' END AS match_class,
    coalesce(match_confidence >= 0.7 AND match_confidence < 0.85, false) AS review FROM customer_identity_xref GROUP BY match_confidence""")
def match_band(spark, folder):
    c = F.col("match_confidence")
    return table(spark, folder, "customer_identity_xref").groupBy("match_confidence").agg(F.count("*").alias("records")).select("match_confidence", "records", identity.match_class(c).alias("match_class"), F.coalesce(identity.needs_review(c), F.lit(False)).alias("review"))


_LINK = "'DETERMINISTIC' AS match_method, CAST(1 AS DECIMAL(5,4)) AS match_confidence"
_BUREAU_LINKS = f"SELECT aecb_report_ref AS source_record_key, master_customer_id, {_LINK}, report_timestamp AS source_ts FROM ({_BUREAU}) JOIN (SELECT master_customer_id, emirates_id FROM ({_SPINE})) USING (emirates_id)"


@query(_BUREAU_LINKS)
def bureau_exact_links(spark, folder):
    return identity.bureau_links(conform.bureau_reports(table(spark, folder, "aecb_credit_report")), _spine(spark, folder))


_BOTH = f"SELECT fraud_assessment_id AS source_record_key, master_customer_id, {_LINK}, scored_at AS source_ts FROM ({_FRAUD}) JOIN (SELECT master_customer_id, phone, email FROM ({_SPINE})) USING (phone, email)"
_EITHER = f"""SELECT fraud_assessment_id AS k, master_customer_id, scored_at, f.phone AS fp, f.email AS fe, s.phone AS sp, s.email AS se FROM ({_FRAUD}) f JOIN ({_SPINE}) s ON f.phone = s.phone OR f.email = s.email
    WHERE fraud_assessment_id NOT IN (SELECT source_record_key FROM ({_BOTH}))"""
_SCORED = f"SELECT *, round((CASE WHEN fp = sp THEN 0.15 ELSE 0 END + CASE WHEN fe = se THEN 0.15 ELSE 0 END) / (CASE WHEN fp <> '' AND sp <> '' THEN 0.15 ELSE 0 END + CASE WHEN fe <> '' AND se <> '' THEN 0.15 ELSE 0 END), 4) AS c FROM ({_EITHER})"


_FRAUD_LINKS = f"""{_BOTH} UNION ALL SELECT k, master_customer_id, 'PROBABILISTIC', CAST(c AS DECIMAL(5,4)), scored_at FROM ({_SCORED}) WHERE c >= 0.7
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY c DESC, scored_at DESC, master_customer_id DESC) = 1"""


@query(_FRAUD_LINKS)
def fraud_two_key_links(spark, folder):
    return identity.fraud_links(conform.fraud_events(table(spark, folder, "fraud_raw")), _spine(spark, folder))


@query(f"SELECT DISTINCT fraud_assessment_id, master_customer_id FROM ({_FRAUD}) f JOIN ({_SPINE}) s ON f.phone = s.phone OR f.email = s.email")
def or_block_candidates(spark, folder):
    return identity.candidates(conform.fraud_events(table(spark, folder, "fraud_raw")), "fraud_assessment_id", _spine(spark, folder), ["phone", "email"])


@query(f"SELECT DISTINCT fraud_assessment_id, master_customer_id FROM ({_FRAUD}) f JOIN ({_SPINE}) s ON f.phone = s.phone AND f.email = s.email")
def and_block_candidates(spark, folder):
    return identity.candidates(conform.fraud_events(table(spark, folder, "fraud_raw")), "fraud_assessment_id", _spine(spark, folder), ["phone", "email"], "and")


_SOUND = lambda rows: f"SELECT *, {_soundex('full_name')} AS sound FROM ({rows})"
_AML_PAIRS = f"""SELECT s.aml_case_id, p.master_customer_id, s.screened_at, lower(coalesce(s.full_name, '')) AS a, lower(coalesce(p.full_name, '')) AS b, s.date_of_birth AS da, p.date_of_birth AS db,
    jaro_similarity(lower(coalesce(s.full_name, '')), lower(coalesce(p.full_name, ''))) AS j FROM ({_SOUND(_AML)}) s JOIN ({_SOUND(_SPINE)}) p ON s.sound = p.sound OR s.date_of_birth = p.date_of_birth"""
_AML_SCORED = f"""SELECT *, round(coalesce((CASE WHEN a <> '' AND b <> '' THEN 0.4 * {_JW} ELSE 0 END + CASE WHEN da = db THEN 0.2 ELSE 0 END) / nullif(CASE WHEN a <> '' AND b <> '' THEN 0.4 ELSE 0 END + CASE WHEN da IS NOT NULL AND db IS NOT NULL THEN 0.2 ELSE 0 END, 0), 0) + 1e-12, 4) AS c FROM ({_AML_PAIRS})"""
_AML_LINKS = f"""SELECT aml_case_id AS source_record_key, master_customer_id, 'PROBABILISTIC' AS match_method, CAST(c AS DECIMAL(5,4)) AS match_confidence, screened_at AS source_ts FROM ({_AML_SCORED}) WHERE c >= 0.7
    QUALIFY row_number() OVER (PARTITION BY aml_case_id ORDER BY c DESC, screened_at DESC NULLS LAST, master_customer_id DESC) = 1"""


@query(_AML_LINKS)
def aml_links(spark, folder):
    return identity.screening_links(conform.screenings(table(spark, folder, "aml_raw")), _spine(spark, folder))


@query(f"SELECT * FROM ({_BUREAU}) WHERE aecb_report_ref NOT IN (SELECT source_record_key FROM ({_BUREAU_LINKS}))")
def unresolved_anti(spark, folder):
    bureau = conform.bureau_reports(table(spark, folder, "aecb_credit_report"))
    return identity.unresolved(bureau, "aecb_report_ref", identity.bureau_links(bureau, _spine(spark, folder)))


_DAY = {"profile": "customer_profile_raw", "bureau": "aecb_credit_report", "fraud": "fraud_raw", "aml": "aml_raw", "decisions": "decisions_raw"}


def _run(spark, folder) -> dict:
    raw = {k: table(spark, folder, t) for k, t in _DAY.items()}
    return pipeline.daily_graph(raw, F.col("decision_timestamp") + F.expr("INTERVAL 1 HOUR")).run()


def _golden() -> str:
    """The cross-reference, as common tables ``sp, bu, fr, am, links_*, golden, xref``."""
    sources = {"aecb": ("AECB", "bu", "aecb_report_ref"), "fraud": ("FRAUD", "fr", "fraud_assessment_id"), "aml": ("AML", "am", "aml_case_id")}
    ctes = [f"sp AS MATERIALIZED ({_SPINE})", f"bu AS MATERIALIZED ({_BUREAU})", f"fr AS MATERIALIZED ({_FRAUD})", f"am AS MATERIALIZED ({_AML})"]
    for n, sql in (("aecb", _BUREAU_LINKS), ("fraud", _FRAUD_LINKS), ("aml", _AML_LINKS)):
        ctes.append(f"links_{n} AS MATERIALIZED ({sql})")
        ctes.append(f"best_{n} AS (SELECT master_customer_id, source_record_key AS {n}_source_key, match_method AS {n}_match_method, match_confidence AS {n}_match_confidence FROM links_{n} QUALIFY row_number() OVER (PARTITION BY master_customer_id ORDER BY match_confidence DESC, source_ts DESC NULLS LAST, source_record_key DESC) = 1)")
    parts = ", ".join(f"{n}_source_key IS NOT NULL AS {n}_matched, {n}_source_key, {n}_match_method, {n}_match_confidence, coalesce({n}_match_confidence >= 0.7 AND {n}_match_confidence < 0.85, false) AS {n}_needs_review" for n in sources)
    least = "least(CAST(1 AS DECIMAL(5,4)), " + ", ".join(f"{n}_match_confidence" for n in sources) + ")"
    probable = " OR ".join(f"coalesce({n}_match_method = 'PROBABILISTIC', false)" for n in sources)
    ctes.append(f"""golden AS (SELECT sp.master_customer_id, sp.internal_customer_uuid, sp.emirates_id, coalesce(sp.phone, fr.phone) AS phone, coalesce(sp.email, fr.email) AS email, coalesce(sp.full_name, am.full_name) AS full_name, coalesce(sp.date_of_birth, am.date_of_birth) AS date_of_birth,
        {parts}, concat_ws(',', 'internal_customer_uuid', CASE WHEN aecb_source_key IS NOT NULL THEN 'emirates_id' END, CASE WHEN fraud_source_key IS NOT NULL THEN 'phone_email' END, CASE WHEN aml_source_key IS NOT NULL THEN 'full_name_dob' END) AS matched_on,
        {least} AS match_confidence, CASE WHEN {probable} THEN 'PROBABILISTIC' ELSE 'DETERMINISTIC' END AS match_method, {least} >= 0.7 AND {least} < 0.85 AS needs_manual_review, sp.internal_customer_uuid AS source_record_key, 'POSTGRES' AS source_system
        FROM sp LEFT JOIN best_aecb USING (master_customer_id) LEFT JOIN best_fraud USING (master_customer_id) LEFT JOIN best_aml USING (master_customer_id) LEFT JOIN fr ON fraud_assessment_id = fraud_source_key LEFT JOIN am ON aml_case_id = aml_source_key)""")
    left = [
        f"SELECT 'UNRESOLVED' AS master_customer_id, {', '.join(columns)}, 'UNRESOLVED' AS match_method, CAST(0 AS DECIMAL(5,4)) AS match_confidence, true AS needs_manual_review, {key} AS source_record_key, '{system}' AS source_system FROM {rows} WHERE {key} NOT IN (SELECT source_record_key FROM links_{n})"
        for (n, (system, rows, key)), columns in zip(sources.items(), (["emirates_id"], ["phone", "email"], ["full_name", "date_of_birth"]))
    ]
    ctes.append("xref AS (SELECT * FROM golden UNION ALL BY NAME " + " UNION ALL BY NAME ".join(left) + ")")
    return "WITH " + ", ".join(ctes)


_FUSED = f"""{_golden()}, fused AS MATERIALIZED (SELECT d.decision_id, application_id, coalesce(g.master_customer_id, 'UNRESOLVED') AS master_customer_id, d.internal_customer_uuid, product_code, decision_timestamp, CAST(decision_timestamp AS DATE) AS decision_date, aecb_credit_score, aecb_total_outstanding_aed,
    g.aecb_source_key AS aecb_report_ref, fraud_score, fraud_decision, aml_status, is_pep, p.monthly_income_aed, p.kyc_completed, requested_amount_aed, approved_amount_aed, decision_outcome,
    CAST(((aecb_credit_score IS NOT NULL)::INT + (fraud_score IS NOT NULL)::INT + (aml_status IS NOT NULL)::INT + (p.monthly_income_aed IS NOT NULL)::INT) / 4 AS DECIMAL(5,4)) AS input_completeness_score, fraud_source_key, aml_source_key
    FROM ({_DECISIONS}) d LEFT JOIN golden g USING (internal_customer_uuid) LEFT JOIN bu ON bu.aecb_report_ref = g.aecb_source_key LEFT JOIN fr ON fraud_assessment_id = fraud_source_key LEFT JOIN am ON aml_case_id = aml_source_key LEFT JOIN sp p ON p.internal_customer_uuid = d.internal_customer_uuid)"""


@query(f"{_golden()} SELECT * FROM xref")
def xref_full(spark, folder):
    x = _run(spark, folder)["xref"]
    return x.withColumn("matched_on", F.array_join("matched_on", ","))


@query(f"{_FUSED} SELECT * EXCLUDE (fraud_source_key, aml_source_key) FROM fused")
def fuse_decision_input(spark, folder):
    return _run(spark, folder)["fused"]


# the rows' text forms and files, as snapshots keep them word for word
_RAW = {
    "aecb": ("aecb_credit_report", "aecb_report_ref", "aecb_report_ref", "updated_timestamp", "emirates_id, aecb_report_ref, aecb_credit_score, aecb_total_outstanding_aed, report_timestamp, source_system, batch_id, created_timestamp, updated_timestamp", "NULL"),
    "fraud": ("fraud_raw", "event_id", "fraud_source_key", "ingested_timestamp", "event_id, phone, email, fraud_score, fraud_decision, scored_at, source_file_s3_uri, ingested_timestamp, ingest_date", "source_file_s3_uri"),
    "aml": ("aml_raw", "screening_ref", "aml_source_key", "ingested_timestamp", "screening_ref, full_name, date_of_birth, aml_status, is_pep, screened_at, source_file_s3_uri, ingested_timestamp, ingest_date", "source_file_s3_uri"),
    "profile": ("customer_profile_raw", "internal_customer_uuid", "internal_customer_uuid", "cdc_lsn", "internal_customer_uuid, emirates_id, full_name, date_of_birth, phone, email, monthly_income_aed, kyc_completed, address, created_at, updated_at, cdc_op, cdc_source_ts_ms, cdc_lsn, ingested_timestamp", "NULL"),
}
_TEXTS = lambda columns: "to_json({" + ", ".join(f"'{c.strip()}': CAST({c.strip()} AS VARCHAR)" for c in columns.split(",")) + "})"
_FUSED_COLUMNS = "decision_id, application_id, master_customer_id, internal_customer_uuid, product_code, decision_timestamp, decision_date, aecb_credit_score, aecb_total_outstanding_aed, aecb_report_ref, fraud_score, fraud_decision, aml_status, is_pep, monthly_income_aed, kyc_completed, requested_amount_aed, approved_amount_aed, decision_outcome, input_completeness_score"


def _snapshot_sql() -> str:
    kept = ", ".join(
        f"raw_{n} AS (SELECT {key} AS {n}_key, record AS {n}_record, sha256(record) AS {n}_sha256, uri AS {n}_uri FROM (SELECT {key}, {order} AS moment, CAST({_TEXTS(columns)} AS VARCHAR) AS record, {uri} AS uri FROM {rows} WHERE {key} IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY moment DESC NULLS LAST, record DESC, uri DESC NULLS LAST) = 1)"
        for n, (rows, key, _, order, columns, uri) in _RAW.items()
    )
    joins = " ".join(f"LEFT JOIN raw_{n} ON {n}_key = {ours}" for n, (_, _, ours, *_) in _RAW.items())
    decision = ", ".join(f"'{c.strip()}': CAST({c.strip()} AS VARCHAR)" for c in f"{_FUSED_COLUMNS}, fraud_source_key, aml_source_key".split(","))
    inputs = ", ".join(f"'{n}': {{'record': {n}_record, 'sha256': {n}_sha256, 'uri': CAST({n}_uri AS VARCHAR)}}" for n in _RAW)
    path = "'snapshots/decision_date=' || coalesce(CAST(decision_date AS VARCHAR), 'unknown') || '/decision_id=' || decision_id || '/snapshot.json'"
    return f"""{_FUSED}, {kept}, b AS (SELECT *, to_json({{'decision': {{{decision}}}, 'inputs': {{{inputs}}}}}) AS body FROM fused {joins})
        SELECT decision_id, decision_date, {path} AS snapshot_uri, CAST(body AS VARCHAR) AS body, sha256(body) AS content_sha256, {', '.join(f'{n}_sha256' for n in _RAW)}, TIMESTAMP '2025-10-01 00:00:00' AS captured_at, 7 AS retention_years, DATE '2032-10-01' AS retain_until FROM b"""


@query(_snapshot_sql())
def decision_snapshots(spark, folder):
    run = _run(spark, folder)
    keys = run["xref"].where("internal_customer_uuid IS NOT NULL").select("internal_customer_uuid", "fraud_source_key", "aml_source_key")
    raw = {n: (table(spark, folder, rows), key, ours, order) for n, (rows, key, ours, order, *_) in _RAW.items()}
    decided = run["fused"].join(keys, "internal_customer_uuid", "left").select(*run["fused"].columns, "fraud_source_key", "aml_source_key")
    return fuse.snapshots(decided, raw, "snapshots", F.lit("2025-10-01 00:00:00").cast("timestamp_ntz"))


@query("SELECT sha256(to_json({'screening_ref': screening_ref, 'full_name': full_name, 'aml_status': aml_status, 'is_pep': is_pep})) AS record_hash, count(*) AS records FROM aml_raw GROUP BY 1")
def record_hash(spark, folder):
    return table(spark, folder, "aml_raw").select(fuse.record_hash("screening_ref", "full_name", "aml_status", "is_pep").alias("record_hash")).groupBy("record_hash").agg(F.count("*").alias("records"))


# ---- fused records, quality ------------------------------------------------------------------------------------------
@query("""SELECT decision_id, batch_id, CAST(((aecb_credit_score IS NOT NULL)::INT + (fraud_score IS NOT NULL)::INT + (aml_status IS NOT NULL)::INT + (monthly_income_aed IS NOT NULL)::INT) / 4 AS DECIMAL(5,4)) AS completeness FROM decision_input""")
def completeness(spark, folder):
    return table(spark, folder, "decision_input").select("decision_id", "batch_id", fuse.completeness(*[F.col(c) for c in fuse.INPUTS]).alias("completeness"))


_BAND = "CASE WHEN aecb_credit_score IS NULL THEN 'UNKNOWN' WHEN aecb_credit_score < 580 THEN 'POOR' WHEN aecb_credit_score < 670 THEN 'FAIR' WHEN aecb_credit_score < 740 THEN 'GOOD' WHEN aecb_credit_score < 800 THEN 'VERY_GOOD' ELSE 'EXCELLENT' END"


@query(f"SELECT {_BAND} AS risk_band, coalesce(upper(decision_outcome), 'UNKNOWN') AS outcome_band, count(*) AS records FROM decision_input GROUP BY 1, 2")
def risk_band(spark, folder):
    return table(spark, folder, "decision_input").groupBy(marts.risk_band(F.col("aecb_credit_score")).alias("risk_band"), marts.outcome_band(F.col("decision_outcome")).alias("outcome_band")).agg(F.count("*").alias("records"))


_RULES = {
    "decision_id_not_null": "coalesce(trim(decision_id) <> '', false)", "application_id_not_null": "coalesce(trim(application_id) <> '', false)", "master_customer_id_not_null": "coalesce(trim(master_customer_id) <> '', false)",
    "master_customer_id_resolved": "coalesce(master_customer_id <> 'UNRESOLVED', false)", "fraud_score_in_range": "(fraud_score IS NULL OR fraud_score BETWEEN 0 AND 1)", "aecb_credit_score_in_range": "(aecb_credit_score IS NULL OR aecb_credit_score BETWEEN 300 AND 900)",
    "product_code_in_enum": "coalesce(product_code IN ('PERSONAL_FINANCE', 'BNPL', 'CARD_ALT'), false)", "decision_timestamp_not_future": "coalesce(decision_timestamp <= created_timestamp, false)",
    "decision_timestamp_not_stale": "coalesce(decision_timestamp >= created_timestamp - INTERVAL 48 HOURS, false)", "unique_decision_id": "coalesce(decision_id IS NOT NULL AND count(*) OVER (PARTITION BY decision_id) = 1, false)",
}
_JUDGED = f"SELECT *, {' AND '.join(f'pass__{n}' for n in _RULES)} AS dq_ok FROM (SELECT *, {', '.join(f'{p} AS pass__{n}' for n, p in _RULES.items())} FROM decision_input)"
_REASONS = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT pass__{n} THEN '{n}' END" for n in _RULES) + ")"


def _judged(spark, folder) -> DataFrame:
    return quality.evaluate(table(spark, folder, "decision_input"), F.col("created_timestamp"))


@query(f"SELECT decision_id, batch_id, {', '.join(f'pass__{n}' for n in _RULES)}, dq_ok AS dq_pass FROM ({_JUDGED})")
def dq_row_flags(spark, folder):
    return _judged(spark, folder).select("decision_id", "batch_id", *[f"pass__{n}" for n in _RULES], "dq_pass")


@query(f"SELECT {_REASONS} AS reasons, count(*) AS records FROM ({_JUDGED}) WHERE NOT dq_ok GROUP BY 1")
def dq_fail_reasons(spark, folder):
    return quality.quarantine(_judged(spark, folder), F.col("created_timestamp")).groupBy(F.array_join("dq_fail_reasons", ",").alias("reasons")).agg(F.count("*").alias("records"))


@query(f"SELECT decision_id, batch_id, {_REASONS} AS reasons, created_timestamp AS quarantined_timestamp FROM ({_JUDGED}) WHERE NOT dq_ok")
def quarantine_split(spark, folder):
    return quality.quarantine(_judged(spark, folder), F.col("created_timestamp")).select("decision_id", "batch_id", F.array_join("dq_fail_reasons", ",").alias("reasons"), "quarantined_timestamp")


@query("SELECT decision_id, count(*) AS copies FROM decision_input WHERE decision_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def dq_uniqueness(spark, folder):
    return table(spark, folder, "decision_input").where("decision_id IS NOT NULL").groupBy("decision_id").agg(F.count("*").alias("copies")).where("copies > 1")


_COMPLETE, _PENDING = ("avg(CASE WHEN input_completeness_score >= 0.75 THEN 1.0 ELSE 0.0 END)", "avg(CASE WHEN aml_status = 'PENDING' THEN 1.0 ELSE 0.0 END)")
_CARD = f"""SELECT CAST(created_timestamp AS DATE) AS snapshot_date, count(*) AS total_decision_count, count(*) FILTER (dq_ok) AS passed_count, count(*) FILTER (NOT dq_ok) AS quarantined_row_count,
    ({_COMPLETE} >= 0.95)::BIGINT + ({_PENDING} <= 0.05)::BIGINT AS warn_ok_count, 2::BIGINT AS warn_count, count(*) - count(DISTINCT application_id) AS dup_application_id, count(*) - count(DISTINCT master_customer_id) AS dup_master_customer_id FROM ({_JUDGED}) GROUP BY 1"""
_SCORED_CARD = f"SELECT *, CAST(round(100 * (0.8 * passed_count / total_decision_count + 0.2 * warn_ok_count / warn_count), 2) AS DECIMAL(5,2)) AS dq_score FROM ({_CARD})"


def _cards(spark, folder) -> DataFrame:
    judged = _judged(spark, folder).withColumn("snapshot_date", F.col("created_timestamp").cast("date"))
    return quality.scorecard(judged, by=["snapshot_date"])


@query(_SCORED_CARD)
def dq_score(spark, folder):
    return _cards(spark, folder).drop("must_pass_json", "warn_json")


@query(f"SELECT CAST(created_timestamp AS DATE) AS snapshot_date, {', '.join(f'count(*) FILTER (NOT pass__{n}) AS {n}' for n in _RULES)} FROM ({_JUDGED}) GROUP BY 1")
def dq_summary(spark, folder):
    card = _cards(spark, folder)
    rules = F.from_json("must_pass_json", ", ".join(f"{n} long" for n in _RULES))
    return card.select("snapshot_date", rules.alias("r")).select("snapshot_date", "r.*")


@query(f"SELECT batch_id, {_COMPLETE} AS completeness, {_PENDING} AS aml_pending FROM decision_input GROUP BY 1")
def dq_warn_ratios(spark, folder):
    return table(spark, folder, "decision_input").groupBy("batch_id").agg(*[quality.ratio(r.good()).alias(r.name) for r in quality.RATIO_RULES])


@query(f"SELECT *, round(avg(CAST(dq_score AS DOUBLE)) OVER (ORDER BY snapshot_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) + 1e-9, 2) AS dq_score_7d_avg, dq_score - lag(dq_score) OVER (ORDER BY snapshot_date) AS dq_score_dod_delta FROM ({_SCORED_CARD})")
def dq_trend_7d(spark, folder):
    return marts.score_trend(_cards(spark, folder).drop("must_pass_json", "warn_json"))


@query(f"SELECT snapshot_date, dq_score, quarantined_row_count FROM ({_SCORED_CARD}) WHERE quarantined_row_count > 0 OR warn_ok_count < warn_count")
def breached_days(spark, folder):
    return marts.breached_days(marts.score_trend(_cards(spark, folder))).select("snapshot_date", "dq_score", "quarantined_row_count")


_NOW = "2025-10-01 00:00:00"
_SOURCES = {"AECB": ("aecb_credit_report", "updated_timestamp", 24.0), "FRAUD": ("fraud_raw", "ingested_timestamp", 1.0), "AML": ("aml_raw", "ingested_timestamp", 6.0), "POSTGRES": ("customer_profile_raw", "ingested_timestamp", 0.25)}


@query(" UNION ALL ".join(f"SELECT '{s}' AS source, round(epoch(TIMESTAMP '{_NOW}' - max({c})) / 3600, 4) AS lag_hours, CAST({h} AS DOUBLE) AS sla_hours, coalesce(epoch(TIMESTAMP '{_NOW}' - max({c})) / 3600 <= {h}, false) AS ok FROM {t}" for s, (t, c, h) in _SOURCES.items()))
def freshness_lag(spark, folder):
    fresh = quality.freshness({s: (table(spark, folder, t), c) for s, (t, c, _) in _SOURCES.items()}, F.lit(_NOW).cast("timestamp_ntz"))
    return fresh.withColumn("lag_hours", F.round("lag_hours", 4))


def _check_sql(texts: tuple[str, ...], fails: dict[str, str], valid: dict[str, tuple[str, ...]], rows: str) -> str:
    """The measures of checks in SQL, read from their words."""
    out = []
    for text_ in (*texts, *fails):
        kind, _, rest = text_.partition("(")
        inside, _, limit = rest.partition(")")
        whole = " AND ".join(f"{x} IS NOT NULL" for x in inside.split(", "))
        if text_ in fails:
            measure, limit = f"count(*) FILTER ({fails[text_]})", "= 0"
        elif kind.startswith("row_count"):
            measure, limit = "count(*)", "> 0"
        elif kind == "missing_count":
            measure = f"count(*) FILTER ({inside} IS NULL OR CAST({inside} AS VARCHAR) = '')"
        elif kind == "duplicate_count":
            measure = f"count(*) FILTER ({whole}) - count(DISTINCT ({inside})) FILTER ({whole})"
        elif kind == "invalid_count":
            measure = f"count(*) FILTER ({inside} IS NOT NULL AND {inside} NOT IN {valid[inside]})"
        elif kind == "freshness":
            measure, limit = f"epoch(TIMESTAMP '{_NOW}' - max({inside})) / 3600", limit.replace("h", "")
        else:
            measure = f"{kind}({inside})"
        out.append(f"SELECT '{text_}' AS check_name, CAST({measure} AS DOUBLE) AS measured, CASE WHEN coalesce(CAST({measure} AS DOUBLE) {limit}, true) THEN 'pass' ELSE 'fail' END AS outcome FROM rows")
    return f"WITH rows AS ({rows}) " + " UNION ALL ".join(out)


@query(_check_sql(quality.DECISION_CHECKS, quality.DECISION_FAILS, quality.VALID, "SELECT * FROM decision_input"))
def decision_checks(spark, folder):
    return quality.run_checks(table(spark, folder, "decision_input"), quality.decision_checks(F.lit(_NOW).cast("timestamp_ntz")))


# ---- marts -----------------------------------------------------------------------------------------------------------
_PCT = lambda part, whole="count(*)": f"CAST(round(100.0 * {part} / nullif({whole}, 0), 2) AS DECIMAL(5,2))"
_A, _H, _P = "count(*) FILTER (decision_outcome = 'APPROVED')", "count(*) FILTER (aml_status = 'HIT')", "count(*) FILTER (is_pep)"
_CUBE = f"""SELECT decision_date AS snapshot_date, product_code, coalesce(upper(decision_outcome), 'UNKNOWN') AS decision_outcome_band, {_BAND} AS risk_band, count(*) AS decision_count, {_A} AS approved_count, {_PCT(_A)} AS approval_rate_pct,
    CAST(round(avg(CAST(fraud_score AS DOUBLE)) + 1e-9, 4) AS DECIMAL(5,4)) AS avg_fraud_score, {_H} AS aml_hit_count, {_PCT(_H)} AS aml_hit_rate_pct, {_P} AS pep_count, {_PCT(_P)} AS pep_exposure_pct, CAST(round(avg(CAST(aecb_credit_score AS DOUBLE)) + 1e-9, 2) AS DECIMAL(7,2)) AS avg_aecb_credit_score,
    CAST(coalesce(sum(requested_amount_aed), 0) AS DECIMAL(18,2)) AS total_requested_amount_aed, CAST(coalesce(sum(approved_amount_aed), 0) AS DECIMAL(18,2)) AS total_approved_amount_aed FROM decision_input WHERE dq_pass GROUP BY 1, 2, 3, 4"""
_MART = f"SELECT c.*, s.dq_score FROM ({_CUBE}) c LEFT JOIN (SELECT snapshot_date, dq_score FROM ({_SCORED_CARD})) s USING (snapshot_date)"


def _mart(spark, folder) -> DataFrame:
    return marts.portfolio(table(spark, folder, "decision_input"), _cards(spark, folder))


@query(_MART)
def portfolio_mart(spark, folder):
    return _mart(spark, folder)


_DAY_JUDGED = _JUDGED.replace("created_timestamp", "(decision_timestamp + INTERVAL 1 HOUR)").replace("decision_input", "fused")
_DAY_CARD = _SCORED_CARD.replace(_JUDGED, "SELECT * FROM judged").replace("CAST(created_timestamp AS DATE) AS snapshot_date", "decision_date AS snapshot_date")


@query(f"{_FUSED}, judged AS MATERIALIZED ({_DAY_JUDGED}) SELECT c.*, s.dq_score FROM ({_CUBE.replace('FROM decision_input WHERE dq_pass', 'FROM judged WHERE dq_ok')}) c LEFT JOIN (SELECT snapshot_date, dq_score FROM ({_DAY_CARD})) s USING (snapshot_date)")
def pipeline_mart(spark, folder):
    return _run(spark, folder)["mart"]


_FA = "count(*) FILTER (fraud_decision = 'APPROVE')"


@query(f"""SELECT CAST(decision_timestamp AS DATE) AS decision_date, product_code, count(*) AS decision_count, {_FA} AS approved_count, {_PCT(_FA)} AS approval_rate_pct, round(avg(CAST(fraud_score AS DOUBLE)) + 1e-9, 4) AS avg_fraud_score, {_H} AS aml_hit_count,
    {_PCT(_H)} AS aml_hit_rate_pct, count(*) FILTER (aml_status = 'PENDING') AS aml_pending_count, {_P} AS pep_count, round(avg(CAST(aecb_credit_score AS DOUBLE)) + 1e-9, 2) AS avg_aecb_credit_score FROM decision_input WHERE dq_pass GROUP BY 1, 2""")
def daily_summary(spark, folder):
    return marts.daily_summary(table(spark, folder, "decision_input"))


@query(f"""SELECT snapshot_date, product_code, CAST(sum(decision_count) AS BIGINT) AS decisions, {_PCT('sum(approved_count)', 'sum(decision_count)')} AS approval_rate_pct, round(sum(CAST(avg_fraud_score AS DOUBLE) * decision_count) / nullif(sum(decision_count), 0), 4) AS avg_fraud_score,
    {_PCT('sum(aml_hit_count)', 'sum(decision_count)')} AS aml_hit_rate_pct, max(dq_score) AS dq_score FROM ({_MART}) WHERE snapshot_date >= DATE '2025-09-30' - 30 GROUP BY 1, 2""")
def approval_trend_30d(spark, folder):
    return marts.product_trend(_mart(spark, folder), F.lit("2025-09-30").cast("date"))


@query(f"""SELECT product_code, risk_band, CAST(sum(decision_count) AS BIGINT) AS decisions, CAST(sum(pep_count) AS BIGINT) AS pep_decisions, {_PCT('sum(pep_count)', 'sum(decision_count)')} AS pep_exposure_pct, CAST(sum(total_approved_amount_aed) AS DECIMAL(18,2)) AS approved_amount_aed
    FROM ({_CUBE}) GROUP BY 1, 2 HAVING sum(pep_count) > 0""")
def pep_exposure(spark, folder):
    return marts.pep_exposure(marts.portfolio(table(spark, folder, "decision_input")))


_QUEUE = "SELECT *, CASE WHEN master_customer_id = 'UNRESOLVED' THEN 'UNRESOLVED' ELSE 'NEEDS_MANUAL_REVIEW' END AS steward_queue_reason FROM customer_identity_xref WHERE master_customer_id = 'UNRESOLVED' OR needs_manual_review"


@query(f"SELECT master_customer_id, source_record_key, steward_queue_reason, match_method, match_confidence, array_to_string(matched_on, ',') AS matched_on FROM ({_QUEUE})")
def steward_queue(spark, folder):
    q = marts.steward_queue(table(spark, folder, "customer_identity_xref"))
    return q.select("master_customer_id", "source_record_key", "steward_queue_reason", "match_method", "match_confidence", F.array_join("matched_on", ",").alias("matched_on"))


@query(f"SELECT steward_queue_reason, match_method, count(*) AS records, round(avg(CAST(match_confidence AS DOUBLE)), 4) AS avg_confidence FROM ({_QUEUE}) GROUP BY 1, 2")
def queue_size(spark, folder):
    return marts.queue_size(marts.steward_queue(table(spark, folder, "customer_identity_xref")))


@query("SELECT decision_id, batch_id, snapshot_s3_uri IS NULL AS snapshot_missing FROM decision_input")
def audit_trail_missing(spark, folder):
    rows = table(spark, folder, "decision_input")
    kept = rows.where("snapshot_s3_uri IS NOT NULL").groupBy("decision_id", "batch_id").agg(F.max("snapshot_s3_uri").alias("snapshot_uri"))
    snaps = kept.select(F.concat_ws("/", "batch_id", "decision_id").alias("decision_id"), "snapshot_uri", F.lit("").alias("content_sha256"), F.lit(None).cast("date").alias("retain_until"))
    named = rows.where("decision_id IS NOT NULL").withColumn("own", F.col("decision_id")).withColumn("decision_id", F.concat_ws("/", "batch_id", "own"))
    return marts.audit_trail(named, snaps).select(F.col("own").alias("decision_id"), "batch_id", (F.col("snapshot_missing") | F.col("snapshot_s3_uri").isNull()).alias("snapshot_missing"))


_MART_KEYS = ("snapshot_date", "product_code", "decision_outcome_band", "risk_band")
_MART_CHECKS = ("row_count > 0", f"duplicate_count({', '.join(_MART_KEYS)}) = 0", "min(decision_count) >= 0", "min(total_approved_amount_aed) >= 0", *(f"missing_count({c}) = 0" for c in _MART_KEYS), "invalid_count(decision_outcome_band) = 0")
_MART_FAILS = {"approved_count_leq_decision_count": "approved_count > decision_count"} | {f"{c}_within_bounds": f"{c} < 0 OR {c} > 100" for c in ("approval_rate_pct", "aml_hit_rate_pct", "pep_exposure_pct", "dq_score")}
_BANDS = {"decision_outcome_band": ("APPROVED", "DECLINED", "REFERRED", "UNKNOWN")}


@query(_check_sql(_MART_CHECKS, _MART_FAILS, _BANDS, _MART))
def mart_checks(spark, folder):
    return quality.run_checks(_mart(spark, folder), quality.checks(_MART_CHECKS, _MART_FAILS, _BANDS))


@query("SELECT decision_id, batch_id, product_code, decision_timestamp, snapshot_s3_uri IS NULL AS snapshot_missing FROM decision_input WHERE decision_id = (SELECT min(decision_id) FROM decision_input)")
def reconstruct_decision(spark, folder):
    rows = table(spark, folder, "decision_input")
    asked = rows.agg(F.min("decision_id")).first()[0]
    return marts.reconstruct(rows, F.lit(asked)).select("decision_id", "batch_id", "product_code", "decision_timestamp", F.col("snapshot_s3_uri").isNull().alias("snapshot_missing"))


_LIMITS = {s.lower(): (t, c, h) for s, (t, c, h) in _SOURCES.items()}
_FRESH = "SELECT l.snapshot_date, " + ", ".join(f"round(greatest((epoch(l.now) - epoch((SELECT max({c}) FROM {t} WHERE CAST({c} AS DATE) <= l.snapshot_date))) / 3600, 0), 6) AS {n}_freshness_hours" for n, (t, c, _) in _LIMITS.items()) + " FROM (SELECT CAST(created_timestamp AS DATE) AS snapshot_date, max(created_timestamp) AS now FROM decision_input GROUP BY 1) l"


@query(f"SELECT * FROM ({_FRESH}) WHERE {' OR '.join(f'coalesce({n}_freshness_hours >= {h}, true)' for n, (_, _, h) in _LIMITS.items())} ORDER BY snapshot_date DESC LIMIT 7")
def sla_breaches(spark, folder):
    loads = table(spark, folder, "decision_input").where("created_timestamp IS NOT NULL").groupBy(F.col("created_timestamp").cast("date").alias("snapshot_date")).agg(F.max("created_timestamp").alias("now"))
    fresh = marts.freshness_by_day(loads, {n: (table(spark, folder, t), c) for n, (t, c, _) in _LIMITS.items()})
    late = marts.sla_breaches(fresh, {n: h for n, (_, _, h) in _LIMITS.items()}, 7)
    return late.select("snapshot_date", *[F.round(f"{n}_freshness_hours", 6).alias(f"{n}_freshness_hours") for n in _LIMITS])


@query("""SELECT reject_reason, count(*) AS records FROM (SELECT CASE WHEN coalesce(trim(screening_ref), '') = '' THEN 'missing screening_ref' WHEN NOT coalesce(aml_status IN ('CLEAR', 'HIT', 'PENDING'), false) THEN 'invalid aml_status'
    WHEN coalesce(trim(full_name), '') = '' OR coalesce(trim(date_of_birth), '') = '' THEN 'missing full_name or date_of_birth' ELSE 'accepted' END AS reject_reason FROM aml_raw) GROUP BY 1""")
def webhook_intake(spark, folder):
    bodies = table(spark, folder, "aml_raw").select(F.to_json(F.struct("screening_ref", "full_name", "date_of_birth", "aml_status", "is_pep", "screened_at")).alias("value"))
    good, bad = feeds.callbacks(bodies)
    return good.withColumn("reject_reason", F.lit("accepted")).unionByName(bad).groupBy("reject_reason").agg(F.count("*").alias("records"))


# ---- expected credit loss: exposures made from customers, in SQL that both engines read --------------------------------
_EXPOSURES = """SELECT concat('EXP-', CAST(c_custkey AS STRING)) AS exposure_id, CASE c_custkey % 3 WHEN 0 THEN 'PERSONAL_FINANCE' WHEN 1 THEN 'BNPL' ELSE 'CARD_ALT' END AS product_type,
    CASE WHEN c_custkey % 7 = 0 THEN 'VEHICLE' WHEN c_custkey % 11 = 0 THEN 'RESIDENTIAL_RE' WHEN c_custkey % 13 = 0 THEN NULL ELSE 'UNSECURED' END AS collateral_type, CAST((1 + c_custkey % 40) * 0.001 AS DOUBLE) AS origination_lifetime_pd FROM customer"""
_SNAPSHOT = """SELECT DATE '{day}' AS reporting_date, concat('EXP-', CAST(c_custkey AS STRING)) AS exposure_id, CAST(round(abs(c_acctbal), 2) AS DECIMAL(18,2)) AS drawn_balance_aed, CAST((c_custkey % 50) * 100 AS DECIMAL(18,2)) AS undrawn_commitment_aed,
    CAST((c_custkey * 7 + {k} * 31) % 120 AS INT) AS days_past_due, concat('R', CAST(1 + (c_custkey + {k}) % 10 AS STRING)) AS current_rating_grade, CAST((1 + (c_custkey * 3 + {k}) % 60) * 0.0015 AS DOUBLE) AS current_lifetime_pd,
    CAST(0.05 + (c_custkey % 20) * 0.01 AS DOUBLE) AS effective_interest_rate, CAST(1 + (c_custkey * 5 + {k}) % 70 AS INT) AS remaining_maturity_months, c_custkey % 17 = 0 AS is_forborne, c_custkey % 19 = {k} AS is_watchlist, c_custkey % 23 = {k} AS is_unlikely_to_pay FROM customer"""
_SNAPSHOTS = _SNAPSHOT.format(day="2025-05-31", k=0) + " UNION ALL " + _SNAPSHOT.format(day="2025-06-30", k=1)
_WEIGHTS = "SELECT CAST(d AS DATE) AS reporting_date, s AS scenario_id, CAST(w AS DOUBLE) AS probability_weight FROM (VALUES ('2025-06-30', 'BASE', 0.5), ('2025-06-30', 'UPSIDE', 0.2), ('2025-06-30', 'DOWNSIDE', 0.3)) AS t(d, s, w)"
_SETS = """SELECT i AS parameter_set_id, b AS parameter_basis, s AS macro_scenario_id, c AS is_current, CAST(f AS DATE) AS effective_from_date, CAST(u AS DATE) AS effective_to_date FROM (VALUES ('TTC', 'TTC', 'BASE', true, '2025-01-01', NULL),
    ('B5', 'PIT', 'BASE', false, '2025-05-01', '2025-05-31'), ('B6', 'PIT', 'BASE', true, '2025-06-01', NULL), ('U6', 'PIT', 'UPSIDE', true, '2025-06-01', NULL), ('D6', 'PIT', 'DOWNSIDE', true, '2025-06-01', NULL)) AS t(i, b, s, c, f, u)"""
_GRADES = "(VALUES ('R1', 0.001), ('R2', 0.0025), ('R3', 0.006), ('R4', 0.012), ('R5', 0.022), ('R6', 0.04), ('R7', 0.07), ('R8', 0.12), ('R9', 0.2), ('R10', 0.32), ('D', 1.0)) AS g(rating_grade, p)"
_PD = f"""SELECT i AS parameter_set_id, rating_grade, h AS horizon_months, round(1 - power(1 - least(CAST(p AS DOUBLE) * CAST(m AS DOUBLE), 1.0), h / 12.0), 8) AS cumulative_pd FROM {_GRADES}
    CROSS JOIN (VALUES ('TTC', 1.0), ('B5', 1.0), ('B6', 1.0), ('U6', 0.7), ('D6', 1.8)) AS s(i, m) CROSS JOIN (VALUES (12), (24), (36), (48), (60)) AS t(h)"""
_LGD = "SELECT i AS parameter_set_id, c AS collateral_segment, CAST(l AS DOUBLE) AS downturn_lgd_rate FROM (VALUES ('TTC'), ('B5'), ('B6'), ('U6'), ('D6')) AS s(i) CROSS JOIN (VALUES ('UNSECURED', 0.75), ('RESIDENTIAL_RE', 0.3), ('VEHICLE', 0.5)) AS t(c, l)"
_CCF = "SELECT i AS parameter_set_id, c AS product_type, CAST(f AS DOUBLE) AS credit_conversion_factor FROM (VALUES ('TTC'), ('B5'), ('B6'), ('U6'), ('D6')) AS s(i) CROSS JOIN (VALUES ('PERSONAL_FINANCE', 1.0), ('BNPL', 1.0), ('CARD_ALT', 0.55)) AS t(c, f)"
_STAGES = "SELECT * FROM (VALUES (1, 'PERFORMING', '12M'), (2, 'UNDERPERFORMING', 'LIFETIME'), (3, 'IMPAIRED', 'LIFETIME')) AS t(stage_id, stage_name, ecl_horizon)"

_STAGED = f"""SELECT *, round(r, 6) AS pd_ratio, dflt AS is_default, r >= 2 OR days_past_due >= 30 OR is_forborne OR is_watchlist AS is_sicr,
    CASE WHEN days_past_due >= 90 THEN 'DEFAULT_90DPD' WHEN dflt THEN 'UNLIKELY_TO_PAY' WHEN r >= 2 THEN 'PD_DETERIORATION' WHEN days_past_due >= 30 THEN 'DPD_30_BACKSTOP' WHEN is_forborne THEN 'FORBEARANCE' WHEN is_watchlist THEN 'WATCHLIST' ELSE 'NONE' END AS sicr_trigger,
    CASE WHEN dflt THEN 3 WHEN r >= 2 OR days_past_due >= 30 OR is_forborne OR is_watchlist THEN 2 ELSE 1 END AS assigned_stage
    FROM (SELECT *, current_lifetime_pd / nullif(origination_lifetime_pd, 0) AS r, days_past_due >= 90 OR is_unlikely_to_pay AS dflt FROM ({_SNAPSHOTS}) JOIN ({_EXPOSURES}) USING (exposure_id))"""


def _sql(spark: SparkSession, folder: str, text_: str) -> DataFrame:
    """The mapping's SQL on the folder's customers."""
    return spark.sql(text_.replace("FROM customer", "FROM {customer}"), customer=table(spark, folder, "customer")) if "FROM customer" in text_ else spark.sql(text_)


def _stages_of(spark, folder) -> DataFrame:
    return ecl.staged(_sql(spark, folder, _SNAPSHOTS), _sql(spark, folder, _EXPOSURES))


def _scores(spark, folder) -> DataFrame:
    return ecl.scored(_stages_of(spark, folder), *[_sql(spark, folder, s) for s in (_WEIGHTS, _SETS, _PD, _LGD, _CCF)])


@query(f"SELECT reporting_date, exposure_id, pd_ratio, is_default, is_sicr, sicr_trigger, assigned_stage FROM ({_STAGED})")
def stage_classify(spark, folder):
    return _stages_of(spark, folder).select("reporting_date", "exposure_id", "pd_ratio", "is_default", "is_sicr", "sicr_trigger", "assigned_stage")


@query(f"SELECT w.reporting_date, w.scenario_id, parameter_set_id FROM ({_WEIGHTS}) w JOIN ({_SETS}) s ON s.macro_scenario_id = w.scenario_id AND parameter_basis = 'PIT' AND is_current AND w.reporting_date >= effective_from_date AND (effective_to_date IS NULL OR w.reporting_date <= effective_to_date)")
def effective_param_join(spark, folder):
    return ecl.in_force(_sql(spark, folder, _SETS), _sql(spark, folder, _WEIGHTS)).select("reporting_date", "scenario_id", "parameter_set_id")


_HORIZON = f"coalesce((SELECT min(horizon_months) FROM ({_PD}) h WHERE h.horizon_months >= b.remaining_maturity_months), (SELECT max(horizon_months) FROM ({_PD}) h))"
_ECL_SCORED = f"""SELECT *, round(ead * CASE WHEN assigned_stage = 3 THEN 1.0 ELSE pd12 END * lgd * power(1 + effective_interest_rate, -0.5) + 1e-9, 2) AS e12, round(ead * CASE WHEN assigned_stage = 3 THEN 1.0 ELSE pdl END * lgd * power(1 + effective_interest_rate, -(h / 24.0)) + 1e-9, 2) AS el FROM (
    SELECT b.*, w.scenario_id, w.probability_weight AS wt, p.parameter_set_id, a.cumulative_pd AS pd12, z.cumulative_pd AS pdl, l.downturn_lgd_rate AS lgd, round(CAST(drawn_balance_aed AS DOUBLE) + credit_conversion_factor * CAST(undrawn_commitment_aed AS DOUBLE), 2) AS ead
    FROM (SELECT b.*, {_HORIZON} AS h FROM ({_STAGED}) b) b JOIN ({_WEIGHTS}) w USING (reporting_date) JOIN ({_SETS}) p ON p.macro_scenario_id = w.scenario_id AND p.parameter_basis = 'PIT' AND p.is_current
    JOIN ({_CCF}) c ON c.parameter_set_id = p.parameter_set_id AND c.product_type = b.product_type JOIN ({_LGD}) l ON l.parameter_set_id = p.parameter_set_id AND l.collateral_segment = coalesce(b.collateral_type, 'UNSECURED')
    JOIN ({_PD}) a ON a.parameter_set_id = p.parameter_set_id AND a.rating_grade = b.current_rating_grade AND a.horizon_months = 12 JOIN ({_PD}) z ON z.parameter_set_id = p.parameter_set_id AND z.rating_grade = b.current_rating_grade AND z.horizon_months = b.h)"""


@query(f"SELECT DISTINCT exposure_id, {_HORIZON} AS lifetime_horizon FROM ({_STAGED}) b WHERE reporting_date = DATE '2025-06-30'")
def horizon_lookup(spark, folder):
    return _scores(spark, folder).select("exposure_id", "lifetime_horizon").distinct()


@query(f"SELECT exposure_id, scenario_id, ead AS ead_amount_aed, e12 AS ecl_12m, el AS ecl_life FROM ({_ECL_SCORED})")
def provision_by_scenario(spark, folder):
    return _scores(spark, folder).select("exposure_id", "scenario_id", "ead_amount_aed", "ecl_12m", "ecl_life")


_WSUM = lambda c: f"CAST(round(sum(CAST(wt AS DECIMAL(9,8)) * CAST({c} AS DECIMAL(18,2))), 2) AS DOUBLE)"
_PROVISION = f"""SELECT reporting_date, exposure_id, assigned_stage, max(ead) AS ead_amount_aed, max(CASE WHEN scenario_id = 'BASE' THEN e END) AS ecl_base_aed, max(CASE WHEN scenario_id = 'UPSIDE' THEN e END) AS ecl_upside_aed, max(CASE WHEN scenario_id = 'DOWNSIDE' THEN e END) AS ecl_downside_aed,
    {_WSUM('e12')} AS ecl_12m_aed, {_WSUM('el')} AS ecl_lifetime_aed, {_WSUM('e')} AS reported_ecl_aed, round(CAST(sum(CAST(wt AS DECIMAL(9,8)) * CAST(e AS DECIMAL(18,2))) AS DOUBLE) / nullif(max(ead), 0), 6) AS coverage_ratio FROM (SELECT *, CASE WHEN assigned_stage = 1 THEN e12 ELSE el END AS e FROM ({_ECL_SCORED})) GROUP BY 1, 2, 3"""


@query(_PROVISION)
def provision_weighted(spark, folder):
    return ecl.provision(_scores(spark, folder))


@query(f"""SELECT 'TR-' || exposure_id || '-' || strftime(reporting_date, '%Y%m%d') AS transition_id, CASE WHEN dflt THEN 'DEFAULT' ELSE sicr_trigger END AS trigger_reason, days_past_due AS dpd_at_transition, round(pd_ratio, 4) AS pd_ratio_at_transition, exposure_id, prior_reporting_date, reporting_date, prior_stage, assigned_stage AS new_stage, CASE WHEN prior_stage IS NULL THEN 'INITIAL' WHEN assigned_stage > prior_stage THEN 'DETERIORATION' WHEN assigned_stage = 1 THEN 'CURE' ELSE 'IMPROVEMENT' END AS transition_direction
    FROM (SELECT *, lag(assigned_stage) OVER w AS prior_stage, lag(reporting_date) OVER w AS prior_reporting_date FROM ({_STAGED}) WINDOW w AS (PARTITION BY exposure_id ORDER BY reporting_date)) WHERE prior_stage IS NULL OR prior_stage <> assigned_stage""")
def stage_transitions(spark, folder):
    return ecl.transitions(_stages_of(spark, folder))


@query(f"""SELECT coalesce(CAST(assigned_stage AS VARCHAR), 'TOTAL') AS stage, stage_name, ecl_horizon, count(*) AS exposure_count, CAST(sum(CAST(ead_amount_aed AS DECIMAL(18,2))) AS DOUBLE) AS total_ead_aed, CAST(sum(CAST(reported_ecl_aed AS DECIMAL(18,2))) AS DOUBLE) AS total_provision_aed, round(CAST(sum(CAST(reported_ecl_aed AS DECIMAL(18,2))) AS DOUBLE) / nullif(CAST(sum(CAST(ead_amount_aed AS DECIMAL(18,2))) AS DOUBLE), 0), 6) AS portfolio_coverage_ratio
    FROM ({_PROVISION}) JOIN ({_STAGES}) ON stage_id = assigned_stage GROUP BY GROUPING SETS ((assigned_stage, stage_name, ecl_horizon), ())""")
def ecl_summary_grouping_sets(spark, folder):
    return ecl.summary(ecl.provision(_scores(spark, folder)), _sql(spark, folder, _STAGES))


_AUDIT = f"""SELECT 'CALC-' || exposure_id || '-' || strftime(reporting_date, '%Y%m%d') AS calculation_id, exposure_id, reporting_date, assigned_stage, reported_ecl_aed, to_json({{'date': CAST(reporting_date AS VARCHAR), 'ead': CAST(CAST(ead_amount_aed AS DECIMAL(18,2)) AS VARCHAR), 'ecl': CAST(CAST(reported_ecl_aed AS DECIMAL(18,2)) AS VARCHAR), 'exposure': exposure_id,
    'model': 'staging 1.0', 'sets': sets, 'stage': CAST(assigned_stage AS VARCHAR), 'weights': weights}}) AS body FROM ({_PROVISION}) JOIN (SELECT reporting_date, exposure_id, string_agg(DISTINCT parameter_set_id, ',' ORDER BY parameter_set_id) AS sets, string_agg(DISTINCT scenario_id || '=' || CAST(CAST(wt AS DECIMAL(9,8)) AS VARCHAR), ',' ORDER BY scenario_id || '=' || CAST(CAST(wt AS DECIMAL(9,8)) AS VARCHAR)) AS weights FROM ({_ECL_SCORED}) GROUP BY 1, 2) USING (reporting_date, exposure_id)"""


@query(f"SELECT * EXCLUDE (body), CAST(body AS VARCHAR) AS inputs_json, sha256(body) AS input_sha256 FROM ({_AUDIT})")
def ecl_calculation_audit(spark, folder):
    scores = _scores(spark, folder)
    return ecl.calculation_audit(ecl.provision(scores), scores, "staging 1.0")

"""Queries of the general problems 1, 3, 6 and 7 over the tables of a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from decisionlake.functions.ids import packed, unpacked
from decisionlake.functions.times import gulf_micros, gulf_micros_of_epoch, wall_micros
from decisionlake.operators import asof, messages, profile, replay
from decisionlake.session import cut, table

FEEDS = {"aml": ("aml_raw", "screening_ref"), "fraud": ("fraud_raw", "event_id")}


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Identifiers that stand on more than one row of their feed."""
    found = [
        messages.repeated_keys(table(spark, folder, name), identifier, "ingested_timestamp").select(F.lit(feed).alias("feed"), F.col("key").alias("message_id"))
        for feed, (name, identifier) in FEEDS.items()
    ]
    return found[0].unionByName(found[1])


def p1_aml_once(spark: SparkSession, folder: str) -> DataFrame:
    """The screening callbacks, each once."""
    return messages.exactly_once(table(spark, folder, "aml_raw"), "screening_ref", "ingested_timestamp")


def p1_fraud_once(spark: SparkSession, folder: str) -> DataFrame:
    """The fraud events, each once."""
    return messages.exactly_once(table(spark, folder, "fraud_raw"), "event_id", "ingested_timestamp")


SCORE, FRAUD, PRODUCT, TIME = "aecb_credit_score", "fraud_score", "product_code", "decision_timestamp"
PROFILED = (SCORE, FRAUD, PRODUCT, TIME)
RANGES = {SCORE: (300, 900), FRAUD: (0, 1)}
DRIFT = {SCORE: 60.0, FRAUD: 0.10}


def _time_in_range() -> Column:
    created = F.col("created_timestamp")
    return F.coalesce((F.col(TIME) >= created - F.expr("INTERVAL 48 HOURS")) & (F.col(TIME) <= created), F.lit(False)).cast("int")


def _decision_counts(rows: DataFrame) -> DataFrame:
    columns = {c: F.col(c) for c in (SCORE, FRAUD, PRODUCT)} | {TIME: profile.hash_bucket(F.col(TIME), _time_in_range())}
    return cut(profile.value_counts(rows, "batch_id", columns))


def _findings(rows: DataFrame) -> DataFrame:
    counts = _decision_counts(rows)
    low, high = (F.coalesce(*[F.when(F.col("column_name") == c, F.lit(float(r[i]))) for c, r in RANGES.items()]) for i in (0, 1))
    out = (
        F.when(F.col("column_name") == TIME, F.col("value").startswith("0:"))
        .when(F.col("column_name").isin(*RANGES), ~F.when(F.col("column_name").isin(*RANGES), F.expr("try_cast(value AS double)")).between(low, high))
        .otherwise(F.lit(False))
    )
    loads = cut(
        counts.groupBy("load", "column_name").agg(
            F.sum("rows").alias("n"),
            F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("rows"))), F.lit(0)).alias("present"),
            F.coalesce(F.sum(F.when(F.col("value").isNotNull() & out, F.col("rows"))), F.lit(0)).alias("outside"),
            F.max(F.when(F.col("value").isNotNull(), F.col("rows"))).alias("largest"),
        )
    )  # one row per load and column
    finding = lambda df, name: df.select(F.col("load").alias("batch_id"), "column_name", F.lit(name).alias("finding"))
    middle = lambda df, x: df.groupBy("column_name").agg(F.expr(f"percentile({x}, 0.5)").alias("usual"))
    share = lambda c: F.col(c) / F.col("present")

    nulls = loads.withColumn("rate", 1 - F.col("present") / F.col("n"))
    null_rate = nulls.join(middle(nulls, "rate"), "column_name").where("rate > usual + 0.10")
    value_range = loads.where((F.col("present") > 0) & (share("outside") > 0.05))
    single = loads.where(F.col("column_name").isin(*RANGES) & (share("largest") > 0.30))
    buckets = counts.where((F.col("column_name") == TIME) & F.col("value").isNotNull()).select("load", F.split("value", ":")[1].alias("bucket"), "rows")
    single_time = profile.frequent_values(rows, "batch_id", F.col(TIME), buckets, 0.30).select("load", F.lit(TIME).alias("column_name")).distinct()

    # what conforms, and how the codes are mixed, is told by the coverage of the induced expressions, compared between loads
    codes = counts.where((F.col("column_name") == PRODUCT) & F.col("value").isNotNull())
    shares = cut(profile.usual_coverage(codes))
    coded = shares.where("usual >= 0.05")
    covered = coded.groupBy("load", "column_name").agg(F.sum("share").alias("covered"))
    pattern = loads.where((F.col("column_name") == PRODUCT) & (F.col("present") > 0)).join(covered, ["load", "column_name"], "left").where(1 - F.coalesce("covered", F.lit(0.0)) > 0.05 + 1e-12)
    shifted = coded.where("abs(share - usual) > 0.20").select("load", "column_name").distinct()

    inside = counts.where(F.col("column_name").isin(*RANGES) & F.col("value").isNotNull()).where(~out)
    medians = inside.groupBy("load", "column_name").agg(F.expr("percentile(CAST(value AS DOUBLE), 0.5D, rows)").alias("median"))
    limit = F.coalesce(*[F.when(F.col("column_name") == c, F.lit(x)) for c, x in DRIFT.items()])
    moved = medians.join(middle(medians, "median"), "column_name").where(F.abs(F.col("median") - F.col("usual")) > limit + 1e-9)
    return profile.union(
        finding(null_rate, "null_rate"), finding(value_range, "value_range"), finding(single, "single_value"), finding(single_time, "single_value"),
        finding(pattern, "pattern"), finding(moved, "distribution"), finding(shifted, "distribution"),
    )


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """The loads of decision_input in which a profiled column is out of order, with what was found."""
    return _findings(table(spark, folder, "decision_input"))


def p3_expressions(spark: SparkSession, folder: str) -> DataFrame:
    """The induced expressions of the profiled columns and the rows that they cover in each load."""
    rows = table(spark, folder, "decision_input")
    counts = cut(profile.value_counts(rows, "batch_id", {c: F.col(c) for c in PROFILED}))
    induced = profile.induced_expressions(counts.where("value IS NOT NULL").groupBy("column_name", "value").agg(F.sum("rows").alias("rows")))
    return profile.coverage(counts, induced).select(F.col("load").alias("batch_id"), "column_name", "expression", F.col("rows").alias("covered_rows"))


def p3_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Standard figures of each profiled column and load, from one pass that counts values."""
    counts = profile.value_counts(table(spark, folder, "decision_input"), "batch_id", {c: F.col(c) for c in PROFILED})
    ends = []
    for end in (F.min, F.max):
        typed = {SCORE: F.expr("try_cast(value AS int)"), FRAUD: F.expr("try_cast(value AS decimal(5,4))")}
        ends.append(F.coalesce(*[end(F.when(F.col("column_name") == c, x)).cast("string") for c, x in typed.items()], end(F.when(~F.col("column_name").isin(*typed), F.col("value")))))
    return counts.groupBy(F.col("load").alias("batch_id"), "column_name").agg(
        F.sum("rows").alias("row_count"), F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("rows"))), F.lit(0)).alias("present_count"), F.count("value").alias("distinct_count"), ends[0].alias("low"), ends[1].alias("high")
    )


KEY, LSN = "internal_customer_uuid", "cdc_lsn"
UNAVAILABLE = {"address": "__unavailable_value"}
#: The changes of one commit are a transaction; the stored feed has ended, and its numbers are byte positions, not dense.
COMMITS = replay.Commits("cdc_source_ts_ms")


def _deleted() -> Column:
    return F.coalesce(F.lower(F.trim("cdc_op")) == "d", F.lit(False))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """The customers that exist after all changes, with the number of their last change."""
    return replay.last_changes(table(spark, folder, "customer_profile_raw"), KEY, LSN, _deleted(), COMMITS)


def p6_state(spark: SparkSession, folder: str) -> DataFrame:
    """The whole current profile of each existing customer."""
    return replay.current_state(table(spark, folder, "customer_profile_raw"), KEY, LSN, _deleted(), COMMITS, UNAVAILABLE)


def decisions_once(decisions: DataFrame) -> DataFrame:
    """``decision_id, uuid, at``: each decision with a readable time and a customer, once; both ids packed."""
    readable = decisions.select(packed(F.col("decision_id")).alias("decision_id"), packed(F.col(KEY)).alias("uuid"), gulf_micros(F.col(TIME)).alias("at")).where("decision_id IS NOT NULL AND uuid IS NOT NULL AND at IS NOT NULL")
    return readable.groupBy("decision_id").agg(F.min(F.struct("at", "uuid")).alias("first")).select("decision_id", "first.uuid", "first.at")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """The change and the bureau report in effect at each decision."""
    feed = table(spark, folder, "customer_profile_raw")
    reports = table(spark, folder, "aecb_credit_report")
    decisions = decisions_once(table(spark, folder, "decisions_raw"))

    changes = feed.where(F.col(KEY).isNotNull() & F.col(LSN).isNotNull()).groupBy(packed(F.col(KEY)).alias("entity"), F.col(LSN).alias("rank")).agg(
        gulf_micros_of_epoch(F.min("cdc_source_ts_ms")).alias("at"), F.max(_deleted()).alias("gone")
    )
    events = decisions.select(F.col("uuid").alias("entity"), "at", F.col("decision_id").alias("event"))
    # raw rows by customer tell which are heavy, without reading times
    count = lambda rows, key: rows.groupBy(key.alias("entity")).agg(F.count("*").alias("n"))
    asked = count(table(spark, folder, "decisions_raw"), packed(F.col(KEY)))
    income = (
        asof.as_of(changes.select("entity", "at", "rank"), events, changes.select("entity", "rank", "gone"), sizes=asked.unionByName(count(feed, packed(F.col(KEY)))))
        .where("NOT gone")
        .select(unpacked(F.col("event")).alias("decision_id"), F.lit("monthly_income_aed").alias("attribute"), F.col("effective").cast("string").alias("source_key"))
    )

    digits = lambda c: F.nullif(F.regexp_replace(F.col(c), "[^0-9]", ""), F.lit(""))
    holders = feed.where(F.col(KEY).isNotNull()).groupBy(packed(F.col(KEY)).alias("uuid")).agg(F.max(digits("emirates_id")).alias("entity")).where("entity IS NOT NULL")
    about = decisions.join(holders, "uuid").select("entity", "at", F.col("decision_id").alias("event"))
    # a report's rank is its own time, so that the one in effect is the latest; one reference stands for a time
    reported = (
        reports.select(digits("emirates_id").alias("entity"), wall_micros(F.col("report_timestamp")).alias("rank"), "aecb_report_ref")
        .where("entity IS NOT NULL AND rank IS NOT NULL AND aecb_report_ref IS NOT NULL")
        .groupBy("entity", "rank")
        .agg(F.max("aecb_report_ref").alias("ref"))
    )
    sizes = asked.join(holders.withColumnRenamed("entity", "id"), F.col("entity") == F.col("uuid")).select(F.col("id").alias("entity"), "n").unionByName(count(reports, digits("emirates_id")))
    report = asof.as_of(reported.select("entity", F.col("rank").alias("at"), "rank"), about, reported, sizes=sizes).select(
        unpacked(F.col("event")).alias("decision_id"), F.lit("aecb_credit_report").alias("attribute"), F.col("ref").alias("source_key")
    )
    return income.unionByName(report)


QUERIES = {f.__name__: f for f in (p1_found, p1_aml_once, p1_fraud_once, p3_found, p3_expressions, p3_profile, p6_found, p6_state, p7_found)}

ORACLES = {
    "p1_found": """
        SELECT 'aml' AS feed, upper(trim(screening_ref)) AS message_id FROM aml_raw WHERE trim(screening_ref) <> '' GROUP BY 2 HAVING count(*) > 1
        UNION ALL
        SELECT 'fraud', upper(trim(event_id)) FROM fraud_raw WHERE trim(event_id) <> '' GROUP BY 2 HAVING count(*) > 1""",
    "p1_aml_once": """
        WITH k AS (SELECT *, nullif(upper(trim(screening_ref)), '') AS k, row_number() OVER () AS i FROM aml_raw),
        r AS (SELECT *, row_number() OVER (PARTITION BY coalesce(k, '#' || i) ORDER BY ingested_timestamp NULLS FIRST, screening_ref NULLS FIRST, full_name NULLS FIRST, date_of_birth NULLS FIRST,
              aml_status NULLS FIRST, is_pep NULLS FIRST, screened_at NULLS FIRST, source_file_s3_uri NULLS FIRST, ingest_date NULLS FIRST) AS n FROM k)
        SELECT screening_ref, full_name, date_of_birth, aml_status, is_pep, screened_at, source_file_s3_uri, ingested_timestamp, ingest_date FROM r WHERE n = 1""",
    "p1_fraud_once": """
        WITH k AS (SELECT *, nullif(upper(trim(event_id)), '') AS k, row_number() OVER () AS i FROM fraud_raw),
        r AS (SELECT *, row_number() OVER (PARTITION BY coalesce(k, '#' || i) ORDER BY ingested_timestamp NULLS FIRST, event_id NULLS FIRST, phone NULLS FIRST, email NULLS FIRST,
              fraud_score NULLS FIRST, fraud_decision NULLS FIRST, scored_at NULLS FIRST, source_file_s3_uri NULLS FIRST, ingest_date NULLS FIRST) AS n FROM k)
        SELECT event_id, phone, email, fraud_score, fraud_decision, scored_at, source_file_s3_uri, ingested_timestamp, ingest_date FROM r WHERE n = 1""",
    "p3_profile": " UNION ALL ".join(
        f"SELECT batch_id, '{c}' AS column_name, count(*) AS row_count, count({c}) AS present_count, count(DISTINCT {c}) AS distinct_count, "
        f"CAST(min({c}) AS VARCHAR) AS low, CAST(max({c}) AS VARCHAR) AS high FROM decision_input GROUP BY 1"
        for c in PROFILED
    ),
    "p3_found": """
        WITH d AS (SELECT *, decision_timestamp BETWEEN created_timestamp - INTERVAL 48 HOURS AND created_timestamp AS timely FROM decision_input),
        l AS (SELECT batch_id, count(*) AS n, count(aecb_credit_score) AS a, count(fraud_score) AS f, count(product_code) AS p, count(decision_timestamp) AS t,
                count(*) FILTER (aecb_credit_score NOT BETWEEN 300 AND 900) AS ao, count(*) FILTER (fraud_score NOT BETWEEN 0 AND 1) AS fo,
                count(*) FILTER (decision_timestamp IS NOT NULL AND NOT coalesce(timely, false)) AS tt,
                count(*) FILTER (product_code NOT IN ('PERSONAL_FINANCE', 'BNPL', 'CARD_ALT')) AS po,
                median(aecb_credit_score) FILTER (aecb_credit_score BETWEEN 300 AND 900) AS am, median(CAST(fraud_score AS DOUBLE)) FILTER (fraud_score BETWEEN 0 AND 1) AS fm,
                count(*) FILTER (product_code = 'PERSONAL_FINANCE') AS p1, count(*) FILTER (product_code = 'BNPL') AS p2, count(*) FILTER (product_code = 'CARD_ALT') AS p3
              FROM d GROUP BY 1),
        u AS (SELECT batch_id, 'aecb_credit_score' AS c, n, a AS present, ao AS o FROM l UNION ALL SELECT batch_id, 'fraud_score', n, f, fo FROM l
              UNION ALL SELECT batch_id, 'product_code', n, p, 0 FROM l UNION ALL SELECT batch_id, 'decision_timestamp', n, t, tt FROM l),
        r AS (SELECT *, 1 - present / n AS rate FROM u),
        s AS (SELECT batch_id, 'aecb_credit_score' AS c, count(*) AS m FROM d WHERE aecb_credit_score IS NOT NULL GROUP BY batch_id, aecb_credit_score
              UNION ALL SELECT batch_id, 'fraud_score', count(*) FROM d WHERE fraud_score IS NOT NULL GROUP BY batch_id, fraud_score
              UNION ALL SELECT batch_id, 'decision_timestamp', count(*) FROM d WHERE decision_timestamp IS NOT NULL GROUP BY batch_id, decision_timestamp)
        SELECT batch_id, c AS column_name, 'null_rate' AS finding FROM r JOIN (SELECT c, median(rate) AS usual FROM r GROUP BY 1) USING (c) WHERE rate > usual + 0.10
        UNION ALL SELECT batch_id, c, 'value_range' FROM u WHERE present > 0 AND o / present > 0.05
        UNION ALL SELECT DISTINCT batch_id, c, 'single_value' FROM s JOIN u USING (batch_id, c) WHERE m / present > 0.30
        UNION ALL SELECT batch_id, 'product_code', 'pattern' FROM l WHERE p > 0 AND po / p > 0.05
        UNION ALL SELECT batch_id, 'aecb_credit_score', 'distribution' FROM l WHERE abs(am - (SELECT median(am) FROM l)) > 60
        UNION ALL SELECT batch_id, 'fraud_score', 'distribution' FROM l WHERE abs(fm - (SELECT median(fm) FROM l)) > 0.10 + 1e-9
        UNION ALL SELECT batch_id, 'product_code', 'distribution' FROM l WHERE p > 0 AND (abs(p1 / p - (SELECT median(p1 / p) FROM l WHERE p > 0)) > 0.20
              OR abs(p2 / p - (SELECT median(p2 / p) FROM l WHERE p > 0)) > 0.20 OR abs(p3 / p - (SELECT median(p3 / p) FROM l WHERE p > 0)) > 0.20)""",
    "p6_found": """
        SELECT internal_customer_uuid, max(cdc_lsn) AS cdc_lsn FROM customer_profile_raw WHERE internal_customer_uuid IS NOT NULL AND cdc_lsn IS NOT NULL
        GROUP BY 1 HAVING max(cdc_lsn) > coalesce(max(cdc_lsn) FILTER (lower(trim(cdc_op)) = 'd'), -1)""",
    "p6_state": """
        WITH e AS (SELECT internal_customer_uuid AS k, max(cdc_lsn) AS l, coalesce(max(cdc_lsn) FILTER (lower(trim(cdc_op)) = 'd'), -1) AS g FROM customer_profile_raw
              WHERE internal_customer_uuid IS NOT NULL AND cdc_lsn IS NOT NULL GROUP BY 1 HAVING l > g),
        a AS (SELECT k, arg_max_null(address, cdc_lsn) AS known FROM customer_profile_raw JOIN e ON k = internal_customer_uuid WHERE cdc_lsn > g AND address IS DISTINCT FROM '__unavailable_value' GROUP BY 1),
        r AS (SELECT * FROM customer_profile_raw JOIN e ON k = internal_customer_uuid AND l = cdc_lsn QUALIFY row_number() OVER (PARTITION BY k ORDER BY ingested_timestamp) = 1)
        SELECT r.* EXCLUDE (k, l, g) REPLACE (CASE WHEN r.address = '__unavailable_value' THEN a.known ELSE r.address END AS address) FROM r LEFT JOIN a USING (k)""",
    "p7_found": """
        WITH d AS (SELECT decision_id, min(ts) AS ts, arg_min(uuid, ts) AS uuid FROM (
              SELECT decision_id, internal_customer_uuid AS uuid, CASE WHEN regexp_matches(t, '(Z|[+-]\\d\\d:\\d\\d)$') THEN TRY_CAST(t AS TIMESTAMPTZ) ELSE TRY_CAST(t || '+04:00' AS TIMESTAMPTZ) END AS ts
              FROM (SELECT *, trim(decision_timestamp) AS t FROM decisions_raw) WHERE regexp_matches(t, '^\\d{4}-\\d\\d-\\d\\d[T ]') AND internal_customer_uuid IS NOT NULL) WHERE ts IS NOT NULL GROUP BY 1),
        e AS (SELECT decision_id, epoch_ms(ts) AS ms, uuid FROM d),
        c AS (SELECT internal_customer_uuid AS uuid, cdc_lsn, min(cdc_source_ts_ms) AS ms, bool_or(lower(trim(cdc_op)) = 'd') AS gone FROM customer_profile_raw WHERE internal_customer_uuid IS NOT NULL GROUP BY 1, 2),
        i AS (SELECT decision_id, max(cdc_lsn) AS cdc_lsn, arg_max(gone, cdc_lsn) AS gone FROM e JOIN c ON c.uuid = e.uuid AND c.ms <= e.ms GROUP BY 1),
        h AS (SELECT internal_customer_uuid AS uuid, max(nullif(regexp_replace(emirates_id, '[^0-9]', '', 'g'), '')) AS eid FROM customer_profile_raw GROUP BY 1),
        b AS (SELECT regexp_replace(emirates_id, '[^0-9]', '', 'g') AS eid, aecb_report_ref AS ref, epoch_ms(report_timestamp) - 14400000 AS ms FROM aecb_credit_report),
        r AS (SELECT decision_id, arg_max(ref, b.ms) AS ref FROM e JOIN h USING (uuid) JOIN b ON b.eid = h.eid AND b.ms <= e.ms GROUP BY 1)
        SELECT decision_id, 'monthly_income_aed' AS attribute, CAST(cdc_lsn AS VARCHAR) AS source_key FROM i WHERE NOT gone
        UNION ALL SELECT decision_id, 'aecb_credit_report', ref FROM r""",
}

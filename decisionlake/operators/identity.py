"""Customer identity across sources: exact and weighted links, the cross-reference and what stays unresolved.

Candidate pairs come from one equi-join per key, united, never from a disjunctive join; only pairs with some evidence are
scored.  Keys that are null join nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decisionlake.config import MATCH_THRESHOLD, REVIEW_THRESHOLD, UNRESOLVED
from decisionlake.functions.ids import master_id
from decisionlake.functions.text import match_confidence, name_normal, name_soundex
from decisionlake.operators.conform import latest_per_key
from decisionlake.session import cut

DETERMINISTIC, PROBABILISTIC = "DETERMINISTIC", "PROBABILISTIC"


def match_class(confidence: Column) -> Column:
    """PROBABILISTIC from the review threshold on, else (and for null) UNRESOLVED."""
    return F.when(confidence >= REVIEW_THRESHOLD, F.lit(PROBABILISTIC)).otherwise(F.lit(UNRESOLVED))


def needs_review(confidence: Column) -> Column:
    return (confidence >= REVIEW_THRESHOLD) & (confidence < MATCH_THRESHOLD)


def attachable(confidence: Column) -> Column:
    return confidence >= REVIEW_THRESHOLD


def spine(profile: DataFrame) -> DataFrame:
    """The internal customers with their master id and matching keys."""
    return profile.select(
        master_id(F.col("internal_customer_uuid")).alias("master_customer_id"), "internal_customer_uuid", "emirates_id", "full_name", "date_of_birth", "phone", "email",
        name_normal(F.col("full_name")).alias("name_key"), name_soundex(F.col("full_name")).alias("name_soundex"),
    )


def candidates(source: DataFrame, source_key: str, customers: DataFrame, keys: list[str], mode: str = "or") -> DataFrame:
    """``source_key, master_customer_id``: pairs that share one of the keys (or, with mode ``and``, all)."""
    right = customers.select("master_customer_id", *keys)
    if mode == "and":
        return source.select(source_key, *keys).join(right, keys).select(source_key, "master_customer_id").distinct()
    found = None
    for key in keys:
        one = source.where(F.col(key).isNotNull()).select(source_key, key).join(right.select("master_customer_id", key), key).select(source_key, "master_customer_id")
        found = one if found is None else found.unionByName(one)
    assert found is not None
    return found.distinct()


def best_per(links: DataFrame, key: str) -> DataFrame:
    """The best link of each key: highest confidence, then the most recent record, then the greatest keys."""
    return latest_per_key(links, [key], ["match_confidence", "source_ts"])


def _links(pairs: DataFrame, key: str, method: Column, confidence: Column, ts: str) -> DataFrame:
    return pairs.select(F.col(key).alias("source_record_key"), "master_customer_id", method.alias("match_method"), confidence.cast("decimal(5,4)").alias("match_confidence"), F.col(ts).alias("source_ts"))


def bureau_links(bureau: DataFrame, customers: DataFrame) -> DataFrame:
    """Reports whose Emirates ID is a customer's."""
    pairs = bureau.where("emirates_id IS NOT NULL").join(customers.select("master_customer_id", "emirates_id"), "emirates_id")
    return _links(pairs, "aecb_report_ref", F.lit(DETERMINISTIC), F.lit(1.0), "report_timestamp")


def fraud_links(fraud: DataFrame, customers: DataFrame) -> DataFrame:
    """Events with a customer's phone and e-mail; the rest scored on phone and e-mail where one of them agrees."""
    exact = fraud.join(customers.select("master_customer_id", "phone", "email"), ["phone", "email"])
    sure = _links(exact, "fraud_assessment_id", F.lit(DETERMINISTIC), F.lit(1.0), "scored_at")
    rest = fraud.join(sure.select(F.col("source_record_key").alias("fraud_assessment_id")).distinct(), "fraud_assessment_id", "left_anti")
    theirs = customers.select("master_customer_id", F.col("phone").alias("c_phone"), F.col("email").alias("c_email"))
    pairs = candidates(rest, "fraud_assessment_id", customers, ["phone", "email"]).join(rest, "fraud_assessment_id").join(theirs, "master_customer_id")
    scored = pairs.withColumn("c", match_confidence({"phone": F.col("phone"), "email": F.col("email")}, {"phone": F.col("c_phone"), "email": F.col("c_email")})).where(attachable(F.col("c")))
    return sure.unionByName(best_per(_links(scored, "fraud_assessment_id", match_class(F.col("c")), F.col("c"), "scored_at"), "source_record_key"))


def screening_links(aml: DataFrame, customers: DataFrame, mode: str = "or") -> DataFrame:
    """Screenings scored by name and birth date against customers of the same soundex or (``and``: and) birth date."""
    theirs = customers.select("master_customer_id", F.col("full_name").alias("c_name"), F.col("date_of_birth").alias("c_birth"))
    pairs = candidates(aml, "aml_case_id", customers, ["name_soundex", "date_of_birth"], mode).join(aml, "aml_case_id").join(theirs, "master_customer_id")
    scored = pairs.withColumn("c", match_confidence({"full_name": F.col("full_name"), "date_of_birth": F.col("date_of_birth")}, {"full_name": F.col("c_name"), "date_of_birth": F.col("c_birth")}))
    linked = _links(scored.where(attachable(F.col("c"))), "aml_case_id", match_class(F.col("c")), F.col("c"), "screened_at")
    return best_per(linked, "source_record_key")


def unresolved(source: DataFrame, key: str, links: DataFrame) -> DataFrame:
    """The source's records without link."""
    return source.join(links.select(F.col("source_record_key").alias(key)).distinct(), key, "left_anti")


def cross_reference(customers: DataFrame, bureau: DataFrame, fraud: DataFrame, aml: DataFrame) -> DataFrame:
    """One golden row per customer with its best link of each source, and one row per record without a customer."""
    # each set of links is read twice, and scoring names is what costs
    links = {"aecb": bureau_links(bureau, customers), "fraud": cut(fraud_links(fraud, customers)), "aml": cut(screening_links(aml, customers))}
    golden = customers.select("master_customer_id", "internal_customer_uuid", "emirates_id", "phone", "email", "full_name", "date_of_birth")
    for name, linked in links.items():
        best = best_per(linked, "master_customer_id").select("master_customer_id", F.col("source_record_key").alias(f"{name}_source_key"), F.col("match_method").alias(f"{name}_match_method"), F.col("match_confidence").alias(f"{name}_match_confidence"))
        golden = golden.join(best, "master_customer_id", "left")
    f = fraud.select(F.col("fraud_assessment_id").alias("fraud_source_key"), F.col("phone").alias("f_phone"), F.col("email").alias("f_email"))
    a = aml.select(F.col("aml_case_id").alias("aml_source_key"), F.col("full_name").alias("a_name"), F.col("date_of_birth").alias("a_birth"))
    golden = golden.join(f, "fraud_source_key", "left").join(a, "aml_source_key", "left")
    probable = F.lit(False)
    for name in links:
        probable = probable | F.coalesce(F.col(f"{name}_match_method") == PROBABILISTIC, F.lit(False))
        golden = golden.withColumn(f"{name}_matched", F.col(f"{name}_source_key").isNotNull()).withColumn(f"{name}_needs_review", F.coalesce(needs_review(F.col(f"{name}_match_confidence")), F.lit(False)))
    confidence = F.array_min(F.array(F.lit(1).cast("decimal(5,4)"), *[F.col(f"{n}_match_confidence") for n in links]))
    golden = golden.select(
        "master_customer_id", "internal_customer_uuid", "emirates_id", F.coalesce("phone", "f_phone").alias("phone"), F.coalesce("email", "f_email").alias("email"),
        F.coalesce("full_name", "a_name").alias("full_name"), F.coalesce("date_of_birth", "a_birth").alias("date_of_birth"),
        *[f"{n}_{c}" for n in links for c in ("matched", "source_key", "match_method", "match_confidence", "needs_review")],
        F.array_compact(F.array(F.lit("internal_customer_uuid"), *[F.when(F.col(f"{n}_matched"), F.lit(k)) for n, k in (("aecb", "emirates_id"), ("fraud", "phone_email"), ("aml", "full_name_dob"))])).alias("matched_on"),
        confidence.alias("match_confidence"), F.when(probable, PROBABILISTIC).otherwise(DETERMINISTIC).alias("match_method"), needs_review(confidence).alias("needs_manual_review"),
        F.col("internal_customer_uuid").alias("source_record_key"), F.lit("POSTGRES").alias("source_system"),
    )
    sources = (("AECB", bureau, "aecb_report_ref", "aecb"), ("FRAUD", fraud, "fraud_assessment_id", "fraud"), ("AML", aml, "aml_case_id", "aml"))
    for system, source, key, name in sources:
        keep = [c for c in ("emirates_id", "phone", "email", "full_name", "date_of_birth") if c in source.columns]
        left = unresolved(source, key, links[name]).select(
            F.lit(UNRESOLVED).alias("master_customer_id"), *keep, F.lit(UNRESOLVED).alias("match_method"), F.lit(0).cast("decimal(5,4)").alias("match_confidence"),
            F.lit(True).alias("needs_manual_review"), F.col(key).alias("source_record_key"), F.lit(system).alias("source_system"),
        )
        golden = golden.unionByName(left, allowMissingColumns=True)
    return golden

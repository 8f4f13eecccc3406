"""Queries of the problems 2, 4, 5, 8, 9 and 10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from decisionlake.llm import contamination, linkage, names, subjects, survivors, tokenizer
from decisionlake.session import table


def _spellings(spark: SparkSession, folder: str) -> DataFrame:
    return names.spellings(*[table(spark, folder, t).select("full_name") for t in ("aml_raw", "customer_profile_raw")])


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every pair of different spellings of one person or firm."""
    return names.linked_pairs(names.entities(_spellings(spark, folder)))


def p2_entities(spark: SparkSession, folder: str) -> DataFrame:
    """The entity of each spelling, with the rule that linked it."""
    return names.entities(_spellings(spark, folder)).select("name", "entity", "rule", F.round("rarity", 4).alias("rarity"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """The best value of each of the four fields of every duplicate group."""
    records = table(spark, folder, "customer_identity_xref")
    return survivors.surviving_fields(records, "master_customer_id", survivors.single_fields(), survivors.source_trust(F.col("source_system")), "updated_timestamp")


def p4_person(spark: SparkSession, folder: str) -> DataFrame:
    """The surviving record of every duplicate group with name and birth date as one bundle, the Emirates ID consistent with it."""
    records = table(spark, folder, "customer_identity_xref")
    return survivors.surviving_fields(records, "master_customer_id", survivors.person_bundles(), survivors.source_trust(F.col("source_system")), "updated_timestamp")


def _links(spark: SparkSession, folder: str) -> DataFrame:
    return linkage.customer_links(*[table(spark, folder, t) for t in ("aml_raw", "fraud_raw", "aecb_credit_report", "customer_profile_raw")])


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """The customer whom each screening, fraud event or bureau report is about."""
    return _links(spark, folder).select("internal_customer_uuid", "record_key").distinct()


def p5_confidence(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the marginal probability of each link."""
    return _links(spark, folder).select("internal_customer_uuid", "record_key", F.round("confidence", 4).alias("confidence"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of each document's text by byte_bpe_50k."""
    return tokenizer.token_ids(table(spark, folder, "documents"), "doc_id", "text")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """The evaluation items that leak into each document."""
    return p9_coverage(spark, folder).select("doc_id", "item_id")


def p9_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the share of the passage's words that stand in the text."""
    texts, items = table(spark, folder, "documents"), table(spark, folder, "eval_items")
    leaks = contamination.leaked_items(texts, "doc_id", "text", items, "item_id", "passage")
    return leaks.select("doc_id", "item_id", F.round("covered", 4).alias("covered"))


def p9_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the spans of evaluation items that exceed the limits of length or coverage."""
    texts, items = table(spark, folder, "documents"), table(spark, folder, "eval_items")
    return contamination.cleaned(texts, "doc_id", "text", items, "passage")


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """The subject areas that each document is about."""
    return p10_shares(spark, folder).select("doc_id", "subject")


def p10_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The same with each subject's expected share of the sentences about any."""
    shares = subjects.subject_shares(*[table(spark, folder, t) for t in ("documents", "doc_labels", "subject_areas", "eval_items")])
    return shares.select("doc_id", "subject", F.round("share", 4).alias("share"))


QUERIES = {f.__name__: f for f in (p2_found, p2_entities, p4_found, p4_person, p5_found, p5_confidence, p8_ids, p9_found, p9_coverage, p9_cleaned, p10_found, p10_shares)}

# what both oracles of problem 4 read: the records of real groups with their fields made good
_RECORDS = f"""
        x AS (SELECT DISTINCT * FROM customer_identity_xref WHERE trim(master_customer_id) NOT IN ('', 'UNRESOLVED')),
        g AS (SELECT master_customer_id FROM x GROUP BY 1 HAVING count(*) > 1),
        c AS (SELECT *, CASE upper(trim(source_system)) WHEN 'POSTGRES' THEN 4 WHEN 'AECB' THEN 3 WHEN 'FRAUD' THEN 2 WHEN 'AML' THEN 1 ELSE 0 END AS r,
                regexp_replace(trim(emirates_id), '[\\s-]', '', 'g') AS e, regexp_extract(regexp_replace(trim(phone), '[\\s().-]', '', 'g'), '^(?:\\+971|00971|971|0)0?(5\\d{{8}})$', 1) AS p,
                lower(trim(email)) AS m, trim(regexp_replace(full_name, '\\s+', ' ', 'g')) AS n
              FROM x JOIN g USING (master_customer_id)),
        v AS (SELECT master_customer_id, r, updated_timestamp AS u, 'emirates_id' AS field_name, e AS field_value FROM c WHERE regexp_full_match(e, '784\\d{{12}}') AND e NOT LIKE '784000000000000'
              UNION ALL SELECT master_customer_id, r, updated_timestamp, 'phone', '+971' || p FROM c WHERE p <> ''
              UNION ALL SELECT master_customer_id, r, updated_timestamp, 'email', m FROM c WHERE regexp_full_match(m, '[^@]*[^@\\s][^@]*@[^@]*\\.[^@]*')
              UNION ALL SELECT master_customer_id, r, updated_timestamp, 'full_name', n FROM c WHERE regexp_matches(n, '\\pL') AND lower(n) NOT IN ({survivors.placeholders_sql()}))"""

ORACLES = {
    "p4_found": f"""WITH {_RECORDS}
        SELECT master_customer_id, field_name, field_value FROM v
        QUALIFY row_number() OVER (PARTITION BY master_customer_id, field_name ORDER BY r DESC, u DESC, field_value DESC) = 1""",
    # documents and persons by the birth year that they tell, the best of each; of the pairs that agree, or of one alone, the most trusted
    "p4_person": f"""WITH {_RECORDS},
        t AS (SELECT *, coalesce(epoch_us(updated_timestamp), 0) AS us FROM c),
        d AS (SELECT master_customer_id, r, us, e, substr(e, 4, 4) AS y FROM t WHERE regexp_full_match(e, '784\\d{{12}}') AND e NOT LIKE '784000000000000' QUALIFY row_number() OVER (PARTITION BY master_customer_id, substr(e, 4, 4) ORDER BY r DESC, us DESC, e DESC) = 1),
        p AS (SELECT master_customer_id, r, us, n, CAST(date_of_birth AS VARCHAR) AS born, strftime(date_of_birth, '%Y') AS y FROM t WHERE regexp_matches(n, '\\pL') AND lower(n) NOT IN ({survivors.placeholders_sql()})
              QUALIFY row_number() OVER (PARTITION BY master_customer_id, strftime(date_of_birth, '%Y') ORDER BY r DESC, us DESC, n DESC, date_of_birth DESC NULLS LAST) = 1),
        o AS (SELECT d.master_customer_id, d.r + p.r AS r, d.us + p.us AS us, d.r AS dr, d.us AS du, p.r AS pr, p.us AS pu, e, n, born FROM d JOIN p ON p.master_customer_id = d.master_customer_id AND (p.y IS NULL OR p.y = d.y)
              UNION ALL SELECT master_customer_id, r, us, r, us, 0, 0, e, NULL, NULL FROM d UNION ALL SELECT master_customer_id, r, us, 0, 0, r, us, NULL, n, born FROM p),
        b AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY master_customer_id ORDER BY r DESC, us DESC, dr DESC, du DESC, e DESC NULLS LAST, pr DESC, pu DESC, n DESC NULLS LAST) = 1),
        f AS (SELECT master_customer_id, 'emirates_id' AS field_name, e AS field_value FROM b UNION ALL SELECT master_customer_id, 'full_name', n FROM b UNION ALL SELECT master_customer_id, 'date_of_birth', born FROM b
              UNION ALL (SELECT master_customer_id, field_name, field_value FROM v WHERE field_name IN ('phone', 'email') QUALIFY row_number() OVER (PARTITION BY master_customer_id, field_name ORDER BY r DESC, u DESC, field_value DESC) = 1))
        SELECT * FROM f WHERE field_value IS NOT NULL""",
}

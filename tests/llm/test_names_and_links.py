import itertools

import pytest

from decisionlake.llm import linkage, name_forms, names
from decisionlake.session import table

PEOPLE = {
    "a": ["Richard Fiona Welimmel", "Welimmel, Richard Fiona", "WELIMMEL Richard Fiona", "Dick Welimmel", "R.F. Welimmel", "R. Fiona Welimmel", " richard  fiona welimmel", "Richard Welimel", "Richard FionaWelimmel", "Dr Richard Fiona Welimmel", "Richrad Fiona Welimmel"],
    "b": ["Omar Lucas Al Welimmel", "Al Welimmel Omar", "O. Welimmel", "Omar Lukas AL-WELIMMEL"],
    "c": ["Richard Fiona Gilgemses", "Gilgemses, Richard Fiona", "Reechard Gilgemses"],
    "d": ["Binduhon Trading Company", "BINDUHON TRDG CO.", "M/s Binduhon Trading Company", "Trading Co. - Binduhon", "Binduhom Trading Company"],
    "e": ["Fiona Omar Gilgemses", "Lucas Fiona Polwutim", "Lukas Polwutim"],
}
PEOPLE["f"] = PEOPLE["e"][1:]
PEOPLE["e"] = PEOPLE["e"][:1]


def test_variants_meet_and_others_do_not(spark):
    rows = [(n,) for ns in PEOPLE.values() for n in ns] + [(None,), ("",), ("N/A",), ("UNKNOWN",), (PEOPLE["a"][0],)]
    df = spark.createDataFrame(rows, "full_name string")
    got = {tuple(r) for r in names.linked_pairs(names.entities(names.spellings(df))).collect()}
    assert got == {p for ns in PEOPLE.values() for p in itertools.combinations(sorted(ns), 2)}


def test_a_better_key_that_fails_does_not_hide_the_next(spark):
    """Amita shares its form (amia) with Amina, one edit away, and with Lamia, better established but two edits away."""
    rows = [f"{g} {s}" for g in ("Lamia", "Amina", "Omar") for s in ("Rumsunfor", "Gilgemses", "Polwutim")]
    rows += ["Rumsunfor, Lamia", "RUMSUNFOR Lamia", "Lamia  Rumsunfor", "Dr Lamia Rumsunfor", "Amita Rumsunfor"]
    df = spark.createDataFrame([(n,) for n in rows], "full_name string")
    entity = {r.name: r.entity for r in names.entities(names.spellings(df)).collect()}
    assert entity["Amita Rumsunfor"] == entity["Amina Rumsunfor"] != entity["Lamia Rumsunfor"]


def test_no_names(spark):
    df = spark.createDataFrame([(None,), (" ",), ("tbc",)], "full_name string")
    assert names.entities(names.spellings(df)).count() == 0
    assert names.linked_pairs(names.entities(names.spellings(df.limit(0)))).count() == 0


@pytest.mark.parametrize("name", [None, "", "-", "n/a", "Not Provided", "123"])
def test_placeholders_have_no_reading(name):
    assert name_forms.parse_name(name) == []


def test_readings():
    first = name_forms.parse_name("van Pilshotor Valentina")[0]
    assert (first.given, first.surname) == (name_forms.sounds("valentina"), name_forms.sounds("pilshotor"))
    assert {r.given for r in name_forms.parse_name("Judy Shelshelvom")} >= {name_forms.sounds("judith")}
    assert name_forms.parse_name("x" * 200_000 + " Y" * 10)


def test_marginals(spark):
    rows = [("d1", "u1", "s1", 5.0), ("d2", "u1", "s2", -1.0), ("d2", "u2", "s2", 4.0), ("d3", "u3", "s3", 4.0), ("d3", "u4", "s3", 4.0), ("d4", "u5", "s4", -3.0)]
    p = {(r.descriptor, r.customer): r.probability for r in linkage.marginals(spark.createDataFrame(rows, "descriptor string, customer string, slot string, prior double")).collect()}
    assert p["d1", "u1"] > 0.9 and p["d2", "u2"] > 0.9 and p["d2", "u1"] < 0.05
    assert abs(p["d3", "u3"] - 0.5) <= 0.02 and p["d3", "u3"] <= 0.5 and p["d4", "u5"] < 0.1
    assert linkage.marginals(spark.createDataFrame([], "descriptor string, customer string, slot string, prior double")).count() == 0


@pytest.fixture(scope="module")
def feed(spark):
    rows = [("u1", "Richard Fiona Welimmel", "1990-01-02", "+971501234567", "richard.w001@mail.example", "784-1990-1234567-1"), ("u2", "Omar Lucas Polwutim", "1985-05-06", "+971507654321", "omar_p002@mail.example", "784 1985 1234567 2"), ("u3", None, None, "0501234567", None, None), (None, "Nobody Known", "1990-01-02", "1", "x@y.z", "784199012345679")]
    return spark.createDataFrame(rows, "internal_customer_uuid string, full_name string, date_of_birth string, phone string, email string, emirates_id string")


def test_links(spark, feed):
    aml = spark.createDataFrame([("aml-1 ", "WELIMMEL, RICHARD", "02/01/1990"), ("AML-2", "Richard Fiona Welimmel", None), ("AML-3", None, "1990-01-02"), ("AML-4", "Somebody Else", "1990-01-02"), (None, "Omar Lucas Polwutim", "1985-05-06"), ("AML-5", "O. Polwutim", "06 May 1985")], "screening_ref string, full_name string, date_of_birth string")
    fraud = spark.createDataFrame([("f1", "x", " RICHARD.W001+tag@mail.example"), ("f2", "x", "omr_p002@mail.example"), ("f3", "+971507654321", None), ("f4", "+971507654321", "stranger77@mail.example"), ("f5", "050-1234567", ""), ("f6", None, None)], "event_id string, phone string, email string")
    aecb = spark.createDataFrame([("R1", "784199012345671"), ("R1", "784-1990-1234567-1"), ("R2", None), ("R3", "784")], "aecb_report_ref string, emirates_id string")
    got = {(r.internal_customer_uuid, r.record_key) for r in linkage.customer_links(aml, fraud, aecb, feed).collect()}
    assert got == {("u1", "AML-1"), ("u1", "AML-2"), ("u2", "AML-5"), ("u1", "F1"), ("u2", "F2"), ("u2", "F3"), ("u1", "R1")}
    assert linkage.customer_links(aml.limit(0), fraud.limit(0), aecb.limit(0), feed.limit(0)).count() == 0


def test_names_of_one_customer_are_no_rivals(spark):
    rows = [("u1", "Lorenzo Vasanti Sinsosrir", "1980-09-04"), ("u1", "Rashid Gilgemses", "1980-09-04"), ("u2", "Omar Lucas Polwutim", "1985-05-06"), ("u3", "Oscar Hugo Polwutim", "1970-05-06")]
    feed = spark.createDataFrame(rows, "internal_customer_uuid string, full_name string, date_of_birth string")
    asked = [("A1", "Lorenzo Sinsosrir", "1980-09-04"), ("A2", "Gilgemses, Rashid", "04/09/1980"), ("A3", "Omar Lucas Polwutim", "1985-05-06"), ("A4", "O. Polwutim", "06/05/1985"), ("A5", "O. Polwutim", "1970-05-06"), ("A6", "O. Polwutim", None), ("A7", "Rashid Gilgemses", None)]
    aml = spark.createDataFrame(asked, "screening_ref string, full_name string, date_of_birth string")
    got = {(r.internal_customer_uuid, r.record_key) for r in linkage.screening_links(aml, feed).collect()}
    assert got == {("u1", "A1"), ("u1", "A2"), ("u1", "A7"), ("u2", "A3"), ("u2", "A4"), ("u3", "A5")}


def test_links_over_a_table_agree_with_plain_rules(spark, small):
    """Bureau reports and exact e-mails, found again without the operator."""
    t = {n: table(spark, small, n).toPandas() for n in ("fraud_raw", "aecb_credit_report", "customer_profile_raw")}
    links = {(r.internal_customer_uuid, r.record_key) for r in linkage.fraud_links(table(spark, small, "fraud_raw"), table(spark, small, "customer_profile_raw")).collect()}
    p = t["customer_profile_raw"].dropna(subset=["internal_customer_uuid", "email"])
    owner = {e.strip().lower(): u for e, u in zip(p.email, p.internal_customer_uuid)}
    for event, email in zip(t["fraud_raw"].event_id, t["fraud_raw"].email):
        if event and email and email.strip().lower() in owner:
            assert (owner[email.strip().lower()], event.strip().upper()) in links


def test_twins_and_shared_phones_are_rivals(spark):
    feed = spark.createDataFrame(
        [("u1", "Amina Gilgemses", "1990-01-02", "+971501111111", "amina.g@mail.example"), ("u2", "Ahmed Gilgemses", "1990-01-02", "+971501111111", "ahmed.g@mail.example"), ("u3", "Omar Polwutim", "1985-05-06", "+971502222222", "omar.p@mail.example")],
        "internal_customer_uuid string, full_name string, date_of_birth string, phone string, email string",
    )
    aml = spark.createDataFrame([("A1", "A. Gilgemses", "1990-01-02"), ("A2", "Amina Gilgemses", "1990-01-02"), ("A3", "Ahmed Gilgemses", None), ("A4", "O. Polwutin", "1985-05-06")], "screening_ref string, full_name string, date_of_birth string")
    assert {(r[0], r[1]) for r in linkage.screening_links(aml, feed).collect()} == {("u1", "A2"), ("u2", "A3"), ("u3", "A4")}
    fraud = spark.createDataFrame([("F1", "+971501111111", None), ("F2", "+971502222222", None), ("F3", "+971502222222", "someone@else.example"), ("F4", "+971502222222", "omra.p@mail.example"), ("F5", None, "a.g@mail.example")], "event_id string, phone string, email string")
    assert {(r[0], r[1]) for r in linkage.fraud_links(fraud, feed).collect()} == {("u3", "F2"), ("u3", "F4")}


def test_long_chains_settle(spark):
    chain = [(f"d{i}", f"u{i + j}", f"s{i}", 4.0 + (i == 0 and j == 0)) for i in range(12) for j in (0, 1)]
    p = linkage.marginals(spark.createDataFrame(chain, "descriptor string, customer string, slot string, prior double")).collect()
    assert len(p) == 24 and all(0 <= r.probability <= 1 for r in p)
    with pytest.raises(RuntimeError):
        linkage.marginals(spark.createDataFrame(chain, "descriptor string, customer string, slot string, prior double"), rounds=2)


def test_switching_propagation_off_changes_the_links(spark, small, monkeypatch):
    tables = [table(spark, small, t) for t in ("aml_raw", "fraud_raw", "aecb_credit_report", "customer_profile_raw")]
    found = lambda: {(r[0], r[1]) for r in linkage.customer_links(*tables).collect()}
    whole = found()
    monkeypatch.setattr(linkage, "marginals", lambda c: c.select("descriptor", "customer", linkage._logistic(c["prior"]).alias("probability")))
    assert found() > whole


def test_switching_rarity_off_changes_the_entities(spark, monkeypatch):
    """Rina is one edit from Rita and from Nina: nothing says which is meant."""
    rows = [f"{g} {s}" for g in ("Rita", "Nina", "Omar") for s in ("Rumsunfor", "Gilgemses", "Polwutim")] + ["Rumsunfor, Rita", "Rumsunfor, Nina", "Rina Rumsunfor"]
    df = spark.createDataFrame([(n,) for n in rows], "full_name string")
    entity = lambda: {r.name: r.entity for r in names.entities(names.spellings(df)).collect()}
    apart = entity()
    assert apart["Rina Rumsunfor"] not in (apart["Rita Rumsunfor"], apart["Nina Rumsunfor"])
    monkeypatch.setattr(names, "DECIDES", 0.0)
    assert entity()["Rina Rumsunfor"] in (apart["Rita Rumsunfor"], apart["Nina Rumsunfor"])

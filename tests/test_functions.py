import uuid

import pytest
from pyspark.sql import functions as F

from decisionlake.functions import ids, text, times


@pytest.mark.parametrize(("a", "b", "value"), [("MARTHA", "MARHTA", 0.9611), ("DWAYNE", "DUANE", 0.84), ("DIXON", "DICKSONX", 0.8133), ("same", "same", 1.0), ("", "x", 0.0), (None, None, 0.0), ("abc", "xyz", 0.0)])
def test_jaro_winkler(a, b, value):
    assert text.jaro_winkler(a, b) == pytest.approx(value, abs=1e-4)
    assert text.jaro_winkler(a, b) == text.jaro_winkler(b, a)


def test_master_id_is_uuid5(spark):
    names = ["11111111-1111-4111-8111-111111111111", "é", "x" * 300]
    rows = spark.createDataFrame([(n,) for n in [*names, "", None]], "u string").select("u", ids.master_id(F.col("u")).alias("m")).collect()
    for r in rows:
        assert r.m == (str(uuid.uuid5(uuid.UUID(ids.MASTER_NAMESPACE), r.u)) if r.u else "UNRESOLVED")
    assert rows[0].m == "d17cd42a-6e7f-5136-bed2-77111066a17d"


def test_packed_ids_come_back(spark):
    values = ["11111111-1111-4111-8111-111111111111", "", "not a uuid", "ABC", "11111111-1111-4111-8111-11111111111G"]
    got = spark.createDataFrame([(v,) for v in values], "u string").select("u", ids.unpacked(ids.packed(F.col("u"))).alias("v"), ids.packed(F.col("u")).alias("p")).collect()
    assert [r.u for r in got] == [r.v for r in got] and len({bytes(r.p) for r in got}) == len(values)


def test_normalisers(spark):
    cases = [("784-1988-1234567-1", "0501234567", " A@B.C "), (" ", "971501234567", ""), (None, "00971501234567", None), ("784 1", "12", "x"), ("1", "+971 50 123 4567", "X")]
    c = F.col
    got = spark.createDataFrame(cases, "e string, p string, m string").select(text.emirates_id(c("e")), text.phone_e164(c("p")), text.email_lower(c("m")), text.phone_e164(c("p"), strip_00=True)).collect()
    assert [tuple(r) for r in got] == [
        ("784198812345671", "+971501234567", "a@b.c", "+971501234567"), (None, "+971501234567", None, "+971501234567"), (None, None, None, "+971501234567"), ("7841", None, "x", None), ("1", "+971501234567", "x", "+971501234567"),
    ]


def test_gulf_times(spark):
    cases = {"2025-01-05T08:00:00+04:00": 0, "2025-01-05T04:00:00Z": 0, "2025-01-05 08:00:00": 0, "2025-01-05T08:00:00.250+04:00": 250_000, "2025-01-05T10:00:00+06:00": 0, "2025-01-04T23:00:00-05:00": 0}
    bad = ["2025-13-40T25:61:00+04:00", "pending", "", None, "2025-01-05"]
    rows = spark.createDataFrame([(c,) for c in [*cases, *bad]], "t string").select("t", times.gulf_micros(F.col("t")).alias("m"), times.wall_micros(F.lit("2025-01-05 08:00:00").cast("timestamp_ntz")).alias("w")).collect()
    assert {r.t: r.m - r.w for r in rows[: len(cases)]} == cases
    assert all(r.m is None for r in rows[len(cases) :])


def test_confidence(spark):
    c = F.col
    rows = [("Omar Sheikh", "1983-12-25", "Omar Shaikh", "1983-12-25"), ("a", None, None, "x"), ("Ann", "1", "Ann", "2")]
    got = spark.createDataFrame(rows, "n string, d string, m string, e string").select(text.match_confidence({"full_name": c("n"), "date_of_birth": c("d")}, {"full_name": c("m"), "date_of_birth": c("e")})).collect()
    assert [r[0] for r in got] == [0.9758, 0.0, 0.6667]

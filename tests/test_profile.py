import random

from pyspark.sql import functions as F

from decisionlake.operators import profile


def test_induced_expressions(spark):
    values = [("code", "PERSONAL_FINANCE", 500), ("code", "BNPL", 300), ("code", "oops!", 1), ("when", "x", 1)] + [("when", f"2025-01-{d:02d} 10:{m:02d}:00", 3) for d in range(1, 29) for m in range(0, 60, 7)]
    got = {(r.column_name, r.value): r.expression for r in profile.induced_expressions(spark.createDataFrame(values, "column_name string, value string, rows long")).collect()}
    assert got["code", "BNPL"] == "BNPL" and got["code", "PERSONAL_FINANCE"] == "PERSONAL_FINANCE" and got["code", "oops!"] is None and got["when", "x"] is None
    assert {v for (c, x), v in got.items() if c == "when" and x != "x"} <= {r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}", r"\d+-\d+-\d+ \d+:\d+:\d+"}


def test_frequent_values_are_exact(spark):
    rng = random.Random(2)
    rows = [("a", rng.randrange(10**6)) for _ in range(600)] + [("a", 77)] * 400 + [("b", rng.randrange(10**6)) for _ in range(500)] + [("b", 5)] * 100 + [("c", None)] * 3
    df = spark.createDataFrame(rows, "load string, x long")
    counts = profile.value_counts(df, "load", {"x": profile.hash_bucket(F.col("x"), F.lit(1))}).where("value IS NOT NULL").select("load", F.split("value", ":")[1].alias("bucket"), "rows")
    assert [(r.load, r.value, r.rows) for r in profile.frequent_values(df, "load", F.col("x"), counts, 0.3).collect()] == [("a", 77, 400)]


def test_counts_keep_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([("a", None), ("a", "1"), (None, "1")], "load string, x string")
    got = {(r.load, r.value): r.rows for r in profile.value_counts(df, "load", {"x": F.col("x")}).collect()}
    assert got == {("a", None): 1, ("a", "1"): 1, (None, "1"): 1}
    assert profile.value_counts(df.limit(0), "load", {"x": F.col("x")}).count() == 0


def test_usual_coverage_compares_loads(spark):
    """The induced expressions decide what conforms: a variant in one load isn't usual, and one load's mix stands out."""
    rows = [(f"l{n}", "code", v, r) for n in range(5) for v, r in (("PERSONAL_FINANCE", 50), ("BNPL", 30), ("CARD_ALT", 20))]
    rows += [("l5", "code", "PERSONAL_FINANCE", 10), ("l5", "code", "BNPL", 60), ("l5", "code", "bnpl", 30), ("l6", "code", None, 9)]
    got = {(r.load, r.expression): (r.share, r.usual) for r in profile.usual_coverage(spark.createDataFrame(rows, "load string, column_name string, value string, rows long")).collect()}
    assert got["l0", "BNPL"] == (0.3, 0.3) and got["l5", "BNPL"] == (0.6, 0.3) and got["l5", "CARD_ALT"] == (0.0, 0.2)
    assert got["l5", "bnpl"] == (0.3, 0.0) and not any(load == "l6" for load, _ in got)
    assert profile.usual_coverage(spark.createDataFrame([], "load string, column_name string, value string, rows long")).count() == 0


def test_switching_induction_off_changes_the_findings(spark, small, monkeypatch):
    from decisionlake.queries import general

    small = small.replace("sf0.001", "sf0.01")
    found = lambda: {tuple(r) for r in general.p3_found(spark, small).collect() if r.column_name == "product_code"}
    before = found()
    monkeypatch.setattr(profile, "induced_expressions", lambda values, *_: values.withColumn("expression", F.lit(".*")))
    assert {f for *_, f in before} >= {"pattern"} and found() != before

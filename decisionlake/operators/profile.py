"""Column-level quality profile over loads.

``value_counts`` makes one narrow pass: rows per load, column and value, combined map-side, nulls included.  Columns with
few values keep them; for a column with nearly as many values as rows ("continuous"), values are counted by hash bucket,
and only the buckets that alone hold more than the looked-for share are counted by value in a second narrow pass, which is
exact: a value's share is at most its bucket's.

``induced_expressions`` learns regular expressions from all distinct values by minimum description length.  Every value is a
leaf of a three-level tree: the literal, its shape with run lengths (``[A-Z]{4}_[A-Z]{3}``), its shape without
(``[A-Z]+_[A-Z]+``).  A node is worth keeping when its own bits (8 per character of the expression, plus for every distinct
value the bits to tell it from the others that the expression admits) are fewer than those of its children; the choice goes
bottom-up by aggregation.  Expressions that hold less than ``MIN_SHARE`` of a column's non-null rows are exceptions; rows
with such a value are the nonconforming ones.

Defined cases: an empty table gives no row; a load of nulls only has a null rate and no other figure; a null load
(``batch_id``) is a load of its own, named null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SHARE = 0.01
BUCKETS = 1024


def value_counts(df: DataFrame, load: str, columns: dict[str, Column]) -> DataFrame:
    """``load, column_name, value, rows``; columns maps a name to the expression that is counted, read as string."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), x.cast("string").alias("value")) for c, x in columns.items()]))
    return df.select(F.col(load).alias("load"), pairs.alias("p")).select("load", "p.*").groupBy("load", "column_name", "value").agg(F.count("*").alias("rows"))


def hash_bucket(value: Column, mark: Column) -> Column:
    """What a continuous column is counted by: a mark of the row (in range or not) and the value's hash bucket."""
    return F.when(value.isNotNull(), F.concat_ws(":", mark.cast("string"), F.pmod(F.xxhash64(value), F.lit(BUCKETS)).cast("string")))


def frequent_values(df: DataFrame, load: str, value: Column, counts: DataFrame, share: float) -> DataFrame:
    """``load, value, rows, n``: values of a continuous column that hold more than ``share`` of a load's non-null rows.

    counts: ``load, bucket, rows``, the column's counts by hash bucket.
    """
    totals = counts.groupBy("load").agg(F.sum("rows").alias("n"))
    heavy = counts.groupBy("load", "bucket").agg(F.sum("rows").alias("rows")).join(totals, "load").where(F.col("rows") > share * F.col("n")).select("load", "bucket", "n")
    narrow = df.select(F.col(load).alias("load"), value.alias("value")).where("value IS NOT NULL").withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(BUCKETS)).cast("string"))
    # at most 1/share buckets of a load are heavy
    return narrow.join(F.broadcast(heavy), ["load", "bucket"]).groupBy("load", "value", "n").agg(F.count("*").alias("rows")).where(F.col("rows") > share * F.col("n"))


def _shape(value: Column, exact: bool) -> Column:
    """A regular expression of the value's character classes."""
    kinds = F.translate(value, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "a" * 26 + "A" * 26 + "9" * 10)
    literal = F.regexp_replace(kinds, r"([^A-Za-z0-9 _:,-])", r"\\$1")
    if not exact:
        for kind in "aA9":
            literal = F.regexp_replace(literal, f"{kind}+", kind)
    names = {"a": "[a-z]", "A": "[A-Z]", "9": r"\\d"}
    runs = F.regexp_replace(literal, r"(a+|A+|9+)", "<$1>")
    if not exact:
        for kind, name in names.items():
            runs = F.replace(runs, F.lit(f"<{kind}>"), F.lit(name.replace("\\\\", "\\") + "+"))
        return runs
    # run lengths: every run becomes its class and length, by splitting at the run marks
    parts = F.split(runs, "[<>]")
    named = F.transform(
        parts,
        lambda p: F.when(p.rlike("^a+$"), F.concat(F.lit("[a-z]{"), F.length(p), F.lit("}")))
        .when(p.rlike("^A+$"), F.concat(F.lit("[A-Z]{"), F.length(p), F.lit("}")))
        .when(p.rlike("^9+$"), F.concat(F.lit("\\d{"), F.length(p), F.lit("}")))
        .otherwise(p),
    )
    return F.array_join(named, "")


def _bits(value: Column) -> Column:
    """Bits that tell the value from the others of its shape."""
    count = lambda p: F.length(value) - F.length(F.regexp_replace(value, p, ""))
    return count("[A-Za-z]") * 4.7 + count("[0-9]") * 3.33


def induced_expressions(values: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """``column_name, expression, value, rows``: for every distinct value its induced expression, null for an exception.

    values: ``column_name, value, rows``, one row per distinct non-null value of a column.
    """
    leaf = values.select(
        "column_name", "value", "rows",
        F.regexp_replace("value", r"([^A-Za-z0-9 _:,-])", r"\\$1").alias("literal"),
        _shape(F.col("value"), True).alias("sized"), _shape(F.col("value"), False).alias("open"), _bits(F.col("value")).alias("own"),
    )
    price = lambda c: 8.0 * F.length(c)
    sized = leaf.groupBy("column_name", "open", "sized").agg(F.sum(price("literal")).alias("apart"), F.sum("own").alias("told"))
    sized = sized.withColumn("together", price("sized") + F.col("told")).withColumn("best", F.least("apart", "together"))
    opened = sized.groupBy("column_name", "open").agg(F.sum("best").alias("apart_open"), F.sum("told").alias("told_open"), F.count("*").alias("shapes"))
    # without run lengths a value costs 4 bits more for each length
    opened = opened.withColumn("together_open", price("open") + F.col("told_open") + 4.0 * F.col("shapes"))
    chosen = leaf.join(sized.drop("told", "best"), ["column_name", "open", "sized"]).join(opened, ["column_name", "open"])
    expression = F.when(F.col("together_open") < F.col("apart_open"), F.col("open")).when(F.col("together") < F.col("apart"), F.col("sized")).otherwise(F.col("literal"))
    named = chosen.select("column_name", "value", "rows", expression.alias("expression"))
    total = values.groupBy("column_name").agg(F.sum("rows").alias("total"))
    worth = named.groupBy("column_name", "expression").agg(F.sum("rows").alias("covered")).join(total, "column_name").where(F.col("covered") >= min_share * F.col("total")).select("column_name", "expression", F.lit(True).alias("kept"))
    return named.join(worth, ["column_name", "expression"], "left").select("column_name", "value", "rows", F.when(F.col("kept"), F.col("expression")).alias("expression"))


def coverage(counts: DataFrame, expressions: DataFrame) -> DataFrame:
    """``load, column_name, expression, rows``: how many rows each expression covers in each load; null: nonconforming."""
    known = expressions.select("column_name", "value", "expression")
    return counts.where("value IS NOT NULL").join(known, ["column_name", "value"]).groupBy("load", "column_name", "expression").agg(F.sum("rows").alias("rows"))


def usual_coverage(counts: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """``load, column_name, expression, share, usual``: each induced expression's share of a load's non-null rows.

    ``usual`` is the median of the shares over all loads in which the column has values; a load without a row of the
    expression counts as 0.  counts: as from ``value_counts``.
    """
    there = counts.where("value IS NOT NULL")
    induced = induced_expressions(there.groupBy("column_name", "value").agg(F.sum("rows").alias("rows")), min_share).where("expression IS NOT NULL")
    loads = there.groupBy("load", "column_name").agg(F.sum("rows").alias("present"))
    # an expression covers at least min_share of its column, so there are few to set against the loads
    grid = loads.join(induced.select("column_name", "expression").distinct(), "column_name")
    covered = coverage(there, induced).where("expression IS NOT NULL").withColumnsRenamed({"load": "l", "column_name": "c", "expression": "e"})
    on = F.col("load").eqNullSafe(F.col("l")) & (F.col("column_name") == F.col("c")) & (F.col("expression") == F.col("e"))
    shares = grid.join(covered, on, "left").select("load", "column_name", "expression", (F.coalesce("rows", F.lit(0)) / F.col("present")).alias("share"))
    usual = shares.groupBy("column_name", "expression").agg(F.expr("percentile(share, 0.5)").alias("usual"))
    return shares.join(usual, ["column_name", "expression"])


def union(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)

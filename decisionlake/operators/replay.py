"""Applying a change feed: commit-ordered transactional replay.

1. Changes are assembled to transactions (by what they share, such as their commit time); a transaction spans from its first
   to its last sequence number, the latter being its place in the order of commits.
2. A transaction is complete if it holds as many different changes as it declares, if its predecessor (where a change names
   one) is in the feed, and, in a feed that is still open, if something was committed behind it.
3. The committed watermark lies before the first change of the first incomplete transaction and, in a feed whose sequence
   numbers are dense, before the first missing number.  A transaction that isn't wholly up to the watermark is held as a whole.
4. Keys don't conflict with one another, so every key is replayed on its own, in parallel, by aggregates that combine
   map-side: repeated deliveries collapse, and a key with a third of all changes is one row per task.

Log sequence numbers that are byte positions have natural gaps, so ``dense`` is an option.

Defined cases: changes without key or sequence number are ignored by the replay, but belong to their transaction; a change
without a transaction is one of its own; an empty feed gives no row; a delete with the highest number removes the key, and a
later insert brings it back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Sequence numbers are looked through in spans of so many, so that no task sees them all.
SPAN = 1_000_000


@dataclass(frozen=True)
class Commits:
    """What tells transactions apart, and when one is complete.

    transaction: the column that the changes of one transaction share; size: the column with the number of its changes;
    previous: the column with the sequence number of the change before (null for the first); dense: whether every number must
    come; closed: whether the feed has ended, so that its last transaction is whole too.
    """

    transaction: str
    size: str | None = None
    previous: str | None = None
    dense: bool = False
    closed: bool = True


def _belongs(commits: Commits, sequence: str) -> Column:
    return F.coalesce(F.concat(F.lit("t"), F.col(commits.transaction).cast("string")), F.concat(F.lit("s"), F.col(sequence).cast("string")))


def transactions(feed: DataFrame, sequence: str, commits: Commits) -> DataFrame:
    """``transaction, first, last, whole``: one row per transaction, from aggregates with map-side combining."""
    changes = feed.where(F.col(sequence).isNotNull()).withColumn("__t", _belongs(commits, sequence))
    size = F.max(commits.size) if commits.size else F.lit(None)
    if commits.size:  # repeated deliveries count once
        before = F.max(commits.previous).alias("before") if commits.previous else F.lit(None).alias("before")
        changes = changes.groupBy("__t", sequence).agg(size.alias("of"), before)
    else:
        changes = changes.select("__t", sequence, F.lit(None).cast("long").alias("of"), (F.col(commits.previous) if commits.previous else F.lit(None).cast("long")).alias("before"))
    spans = changes.groupBy("__t").agg(F.min(sequence).alias("first"), F.max(sequence).alias("last"), F.count("*").alias("n"), F.max("of").alias("of"))
    whole = F.coalesce(F.col("n") >= F.col("of"), F.lit(True)) if commits.size else F.lit(True)
    spans = spans.withColumn("whole", whole)
    if commits.previous:
        came = changes.select(F.col(sequence).alias("before")).distinct()
        orphans = changes.where("before IS NOT NULL").join(came, "before", "left_anti").select("__t").distinct().withColumn("orphan", F.lit(True))
        spans = spans.join(orphans, "__t", "left").withColumn("whole", F.col("whole") & F.col("orphan").isNull())
    return spans.select(F.col("__t").alias("transaction"), "first", "last", "whole")


def _missing(feed: DataFrame, sequence: str) -> DataFrame:
    """``watermark``: the last number before the first missing one; no row or null if none is missing."""
    seen = feed.where(F.col(sequence).isNotNull()).select(F.col(sequence).alias("s")).distinct().withColumn("span", F.floor(F.col("s") / SPAN))
    ahead = Window.partitionBy("span").orderBy("s")
    broken = seen.withColumn("next", F.lead("s").over(ahead)).where("next > s + 1").agg(F.min("s").alias("watermark"))
    spans = seen.groupBy("span").agg(F.min("s").alias("a"), F.max("s").alias("b"))  # one row per million numbers
    following = spans.withColumn("next", F.lead("a").over(Window.orderBy("span")))
    return broken.unionByName(following.where("next > b + 1").agg(F.min("b").alias("watermark")))


def committed_watermark(feed: DataFrame, sequence: str, commits: Commits, spans: DataFrame | None = None) -> DataFrame:
    """One row ``watermark``: the highest sequence number up to which all is committed; null for an empty feed."""
    spans = transactions(feed, sequence, commits) if spans is None else spans
    top, held = F.max("last"), F.min(F.when(~F.col("whole"), F.col("first") - 1))
    if commits.closed:
        mark = spans.agg(F.least(top, held).alias("watermark"))
    else:  # nothing stands behind the last transaction, so more of it may come
        mark = spans.agg(F.least(F.max(F.struct("last", (F.col("first") - 1).alias("before")))["before"], held).alias("watermark"))
    if commits.dense:
        mark = mark.unionByName(_missing(feed, sequence)).agg(F.min("watermark").alias("watermark"))
    return mark


def committed(feed: DataFrame, sequence: str, commits: Commits) -> DataFrame:
    """The changes of the transactions that lie wholly up to the watermark."""
    spans = transactions(feed, sequence, commits)
    mark = F.broadcast(committed_watermark(feed, sequence, commits, spans).toDF("__watermark"))  # one row
    changes = feed.where(F.col(sequence).isNotNull())
    upto = changes.join(mark, F.col(sequence) <= F.col("__watermark"))
    # transactions astride the watermark are few, as many as run at one time
    astride = spans.join(mark, (F.col("first") <= F.col("__watermark")) & (F.col("last") > F.col("__watermark"))).select(F.col("transaction").alias("__t"))
    return upto.drop("__watermark").withColumn("__t", _belongs(commits, sequence)).join(astride, "__t", "left_anti").drop("__t")


def _shown(feed: DataFrame, key: str, sequence: str, commits: Commits) -> DataFrame:
    return committed(feed, sequence, commits).where(F.col(key).isNotNull())


def last_changes(feed: DataFrame, key: str, sequence: str, deleted: Column, commits: Commits) -> DataFrame:
    """``key, sequence``: the last committed change of each key that exists after it."""
    ends = _shown(feed, key, sequence, commits).groupBy(key).agg(F.max(sequence).alias("__last"), F.max(F.when(deleted, F.col(sequence))).alias("__gone"))
    return ends.where("__gone IS NULL OR __gone < __last").select(key, F.col("__last").alias(sequence))


def current_state(feed: DataFrame, key: str, sequence: str, deleted: Column, commits: Commits, unavailable: dict[str, str] | None = None) -> DataFrame:
    """The whole row of each existing key as after its last committed change.

    ``unavailable`` names columns and the marker that stands for "not sent with this change"; such a value is taken from the
    latest earlier change since the key was last deleted.
    """
    unavailable = unavailable or {}
    shown = _shown(feed, key, sequence, commits)
    known = [F.max(F.when(deleted, F.col(sequence))).alias("__gone"), F.max(sequence).alias("__last")]
    ends = shown.groupBy(key).agg(*known).where("__gone IS NULL OR __gone < __last")
    rest = [c for c in feed.columns if c not in (key, sequence)]
    # repeated deliveries of the last change are one row: the smallest by its columns
    rows = (
        shown.join(ends, key)
        .where(F.col(sequence) == F.col("__last"))
        .groupBy(key, sequence, "__gone")
        .agg(F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("__row"))
        .select(key, sequence, *[F.col(f"__row.`{c}`").alias(c) for c in rest])
    )
    for column, marker in unavailable.items():
        real = shown.join(ends.select(key, "__gone"), key).where((F.col(sequence) > F.coalesce(F.col("__gone"), F.lit(-(2**63)))) & ~F.coalesce(F.col(column) == marker, F.lit(False)))
        latest = real.groupBy(key).agg(F.max(F.struct(F.col(sequence), F.col(column))).alias("__real"))
        rows = rows.join(latest, key, "left").withColumn(column, F.when(F.col(column) == marker, F.col(f"__real.{column}")).otherwise(F.col(column))).drop("__real")
    return rows.select(*feed.columns)

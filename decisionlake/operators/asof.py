"""Attributes as known at event time, by version numbers.

The version of an entity at an event is the number of its changes up to the event's time.  It is counted over narrow rows
(entity, time, rank), then wide attributes come by an equi-join on entity and version.  Nothing later than the event can be
met, since a later change has a higher number.

No task holds a whole entity: the rows of an entity are split by spans of time, the changes of the earlier spans are a
prefix sum over one row per span, and only the rows of one span are sorted together.  Entities with more than ``HEAVY`` rows, the
``PARTS`` largest at most, have spans ``PIECES`` times as short.  In the last join the rows of one version are spread by the adaptive skew join.

Defined cases: rows with a null entity or time take no part; several changes at one time are ordered by rank; an event at
the very time of a change sees it; an event before the first change has version 0 and gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Length of a span of time in microseconds: 14 days.
SPAN = 14 * 86_400_000_000
#: Rows from which on an entity is heavy; how many entities may be, the largest first (each of the others has less than one in
#: so many of all rows); how many times as short their spans are.
HEAVY = 100_000
PARTS = 10_000
PIECES = 4_096


def _spanned(narrow: DataFrame, span: int, heavy: int, sizes: DataFrame | None = None) -> DataFrame:
    """The rows with ``span``: the number of the span of time in which they stand, of short spans for heavy entities.

    An entity beyond the PARTS largest has at most one in PARTS of all rows, so that the list to broadcast is short.
    """
    counts = narrow.groupBy("entity").agg(F.count("*").alias("n")) if sizes is None else sizes.groupBy("entity").agg(F.sum("n").alias("n"))
    listed = counts.where(F.col("n") > heavy).orderBy(F.desc("n")).limit(PARTS).select("entity", F.lit(True).alias("heavy"))
    length = F.when(F.col("heavy"), F.lit(max(1, span // PIECES))).otherwise(F.lit(span))
    return narrow.join(F.broadcast(listed), "entity", "left").withColumn("span", F.floor(F.col("at") / length)).drop("heavy")


def numbered(changes: DataFrame, events: DataFrame, span: int = SPAN, heavy: int = HEAVY, sizes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The changes and the events with their version.

    changes: ``entity, at, rank`` (longs but for entity), one row each; events: ``entity, at, event``.  Returned are the
    changes as ``entity, version, effective``, where effective is the highest rank among the first ``version`` changes, and
    the events as ``entity, event, version``.
    """
    kind = events.schema["event"].dataType
    narrow = (
        changes.select("entity", "at", F.col("rank"), F.lit(None).cast(kind).alias("event"))
        .unionByName(events.select("entity", "at", F.lit(None).cast("long").alias("rank"), "event"))
        .where("entity IS NOT NULL AND at IS NOT NULL")
    )
    rows = _spanned(narrow, span, heavy, sizes).where("span IS NOT NULL").repartition("entity", "span")
    change = F.col("rank").isNotNull()
    before = Window.partitionBy("entity").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    # a span without change continues the one before it.  All three uses below read every column of the rows, so that they
    # are the same plan up to their one exchange, which then runs once
    spans = rows.groupBy("entity", "span").agg(F.count("rank").alias("n"), F.max("rank").alias("top"), F.count("event").alias("events"), F.max("at").alias("last")).where("n > 0 OR (events > 0 AND last IS NOT NULL)")
    offsets = spans.select("entity", "span", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.max("top").over(before).alias("base_top"))
    upto = Window.partitionBy("entity", "span").orderBy("at", F.col("rank").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    counted = (
        rows.withColumn("here", F.count("rank").over(upto))
        .withColumn("here_top", F.max("rank").over(upto))
        .join(offsets, ["entity", "span"])
        .withColumn("version", F.col("base") + F.col("here"))
        .withColumn("effective", F.greatest("base_top", "here_top"))
    )
    return (
        counted.where(change & F.col("event").isNull()).select("entity", "version", "effective"),
        counted.where(~change & (F.col("version") > 0)).select("entity", "event", "version"),
    )


def as_of(changes: DataFrame, events: DataFrame, wide: DataFrame, span: int = SPAN, heavy: int = HEAVY, sizes: DataFrame | None = None) -> DataFrame:
    """``event`` with the columns of ``wide`` in effect at its time; wide has one row per ``entity`` and ``rank``.

    sizes: ``entity, n``, about how many rows entities have, where that is known more cheaply than by counting the rows here.
    """
    versions, at = numbered(changes, events, span, heavy, sizes)
    valued = versions.join(wide.withColumnRenamed("rank", "effective"), ["entity", "effective"])
    return at.join(valued, ["entity", "version"]).drop("version")

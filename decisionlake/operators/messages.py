"""Messages delivered more than once: keep exactly one copy of each identifier.

Every time bucket gets a Bloom filter of its identifiers.  The filter is blocked: an identifier lives in one segment of
32,768 bits, and the number of segments grows with the bucket, so that a segment holds about ``PER_SEGMENT`` identifiers
(16 bits each, 4 hashes: about 0.25 % false alarms).  A delivery whose bits aren't all set in an earlier bucket's filter is
definitely new there.  The rest, the possible repeats, are verified exactly by an equi-join with the stored identifiers of
the matching bucket and segment only.  Rows of one bucket are counted when the bucket is stored, with map-side combining,
so that one identifier on a third of all rows is one row per task from the first shuffle on.

Defined cases: identifiers are compared trimmed and in upper case; rows with a null or blank identifier have none and are
always kept; a null time is a bucket of its own, before all others; an empty table gives no row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decisionlake.session import cut

BITS = 32_768
HASHES = 4
PER_SEGMENT = 2_000
#: Filters of at most so many bytes in all are broadcast; larger ones are joined by segment.
BROADCAST_BYTES = 32 * 1024 * 1024
_NONE = "0000"


def message_key(identifier: Column) -> Column:
    """The identifier trimmed and in upper case; null if blank."""
    return F.nullif(F.upper(F.trim(identifier)), F.lit(""))


def _position(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(n)), F.lit(BITS)).cast("int")


def _bit(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.expr("1").cast("int") * F.pow(F.lit(2), position % 8).cast("int")) != 0


def stored(messages: DataFrame, identifier: str, time: str, bucket: str = "yyyy-MM") -> tuple[DataFrame, int]:
    """One row per identifier and time bucket (``key, bucket, copies, segment``), and the filters' size in bytes."""
    narrow = messages.select(message_key(F.col(identifier)).alias("key"), F.coalesce(F.date_format(F.col(time), bucket), F.lit(_NONE)).alias("bucket")).where("key IS NOT NULL")
    sizes = [r["n"] for r in narrow.groupBy("bucket").agg(F.count("*").alias("n")).collect()]  # one number per bucket of time
    segments = max(1, math.ceil(max(sizes, default=0) / PER_SEGMENT))
    store = narrow.groupBy("bucket", "key").agg(F.count("*").alias("copies")).withColumn("segment", F.pmod(F.xxhash64("key"), F.lit(segments)).cast("int"))
    return cut(store.repartition("segment")), segments * len(sizes) * BITS // 8


def bloom_filters(store: DataFrame) -> DataFrame:
    """``segment, bucket, bits``: the Bloom filter of each time bucket, by segment."""
    positions = store.select("segment", "bucket", F.explode(F.array(*[_position(F.col("key"), n) for n in range(HASHES)])).alias("at"))
    return positions.groupBy("segment", "bucket").agg(F.bitmap_construct_agg(F.col("at").cast("long")).alias("bits"))


def possible_repeats(store: DataFrame, filter_bytes: int) -> DataFrame:
    """``key, bucket, segment, earlier``: identifiers that an earlier bucket's filter doesn't declare new."""
    filters = bloom_filters(store).select("segment", F.col("bucket").alias("earlier"), "bits")
    if filter_bytes <= BROADCAST_BYTES:
        filters = F.broadcast(filters)
    hit = F.lit(True)
    for n in range(HASHES):
        hit = hit & _bit(F.col("bits"), _position(F.col("key"), n))
    return store.join(filters, "segment").where(F.col("earlier") < F.col("bucket")).where(hit).select("segment", "key", "bucket", "earlier")


def repeats(messages: DataFrame, identifier: str, time: str, bucket: str = "yyyy-MM") -> DataFrame:
    """``key, bucket, copies, again``: the identifiers on more than one row.

    One row per identifier and bucket that holds a repeat: ``copies`` rows of the bucket have it, and ``again`` says whether
    an earlier bucket was verified to hold it too.
    """
    store, filter_bytes = stored(messages, identifier, time, bucket)
    earlier = store.select("segment", "key", F.col("bucket").alias("earlier"))
    verified = possible_repeats(store, filter_bytes).join(earlier, ["segment", "key", "earlier"], "left_semi")
    return (
        verified.select("key", "bucket", F.lit(1).cast("long").alias("copies"), F.lit(True).alias("again"))
        .unionByName(store.where("copies > 1").select("key", "bucket", "copies", F.lit(False).alias("again")))
        .groupBy("key", "bucket")
        .agg(F.max("copies").alias("copies"), F.max("again").alias("again"))
    )


def repeated_keys(messages: DataFrame, identifier: str, time: str, bucket: str = "yyyy-MM") -> DataFrame:
    """``key``: each identifier that stands on more than one row, once."""
    return repeats(messages, identifier, time, bucket).select("key").distinct()


def exactly_once(messages: DataFrame, identifier: str, time: str, bucket: str = "yyyy-MM") -> DataFrame:
    """The messages with one row for each identifier: the earliest, then the smallest by the other columns in their order.

    Definitely new rows and rows without identifier pass untouched and unshuffled where the repeats are few enough to be
    broadcast by the adaptive planner; only repeated identifiers are aggregated, map-side first.
    """
    columns = messages.columns
    again = repeated_keys(messages, identifier, time, bucket).select(F.col("key").alias("__key"), F.lit(True).alias("__again"))
    keyed = messages.withColumn("__key", message_key(F.col(identifier)))
    without = keyed.where("__key IS NULL").select(*columns)  # they would all meet in one task of a join
    marked = keyed.where("__key IS NOT NULL").join(again, "__key", "left")
    single = without.unionByName(marked.where("__again IS NULL").select(*columns))
    order = F.struct(F.col(time).alias("__time"), *[F.col(f"`{c}`") for c in columns])
    kept = marked.where("__again").groupBy("__key").agg(F.min(order).alias("__row")).select(*[F.col(f"__row.`{c}`") for c in columns])
    return single.unionByName(kept)

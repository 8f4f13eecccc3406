"""Times of the feeds, as Gulf Standard wall clock (UTC+4, no summer time), independent of the session's zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: date, time, fraction, zone
_READABLE = r"^\s*(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}:\d{2})(\.\d{1,6})?\s*(Z|z|[+-]\d{2}:?\d{2})?\s*$"
GULF_MINUTES = 240


def gulf_micros(text: Column) -> Column:
    """Microseconds of the Gulf wall clock since 1970, from raw text with ``Z``, an offset or neither (then Gulf time).

    Null for null, blank, malformed and impossible times.
    """
    part = lambda n: F.regexp_extract(text, _READABLE, n)
    wall = F.try_to_timestamp(F.concat(part(1), F.lit(" "), part(2), F.lit("+00:00")), F.lit("yyyy-MM-dd HH:mm:ssXXX"))
    zone = F.regexp_replace(part(4), ":", "")
    minutes = F.substring(zone, 2, 2).cast("int") * 60 + F.substring(zone, 4, 2).cast("int")
    offset = (
        F.when(zone == "", F.lit(GULF_MINUTES)).when(F.upper(zone) == "Z", F.lit(0)).when(zone.startswith("-"), -minutes).otherwise(minutes)
    )
    fraction = F.coalesce(F.rpad(F.substring(F.nullif(part(3), F.lit("")), 2, 6), 6, "0").cast("long"), F.lit(0))
    return F.when(part(1) != "", F.unix_micros(wall) + fraction + (F.lit(GULF_MINUTES) - offset).cast("long") * 60_000_000)


def gulf_micros_of_epoch(milliseconds: Column) -> Column:
    """Microseconds of the Gulf wall clock, from epoch milliseconds."""
    return milliseconds * 1000 + GULF_MINUTES * 60_000_000


def wall_micros(ntz: Column) -> Column:
    """Microseconds since 1970 of a ``timestamp_ntz`` wall clock."""
    days = F.datediff(ntz.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = F.hour(ntz) * 3600 + F.minute(ntz) * 60
    return (days * 86_400 + seconds) * 1_000_000 + (F.extract(F.lit("SECOND"), ntz) * 1_000_000).cast("long")

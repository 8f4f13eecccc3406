"""Identifiers: name-based master ids and a compact form of UUIDs, both as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from decisionlake.config import UNRESOLVED

_UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def packed(text: Column) -> Column:
    """A UUID in 16 bytes; any other text as its UTF-8 bytes behind a zero byte, so that no two texts meet."""
    return F.when(text.rlike(_UUID), F.unhex(F.replace(text, F.lit("-"), F.lit("")))).otherwise(F.concat(F.lit(bytearray(b"\x00")), F.encode(text, "UTF-8"), F.lit(bytearray(16))))


def unpacked(value: Column) -> Column:
    """The text of a packed value."""
    h = F.lower(F.hex(value))
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(F.length(value) == 16, F.concat_ws("-", *parts)).otherwise(F.decode(F.substring(value, F.lit(2), F.length(value) - 17), "UTF-8"))


#: Namespace of master ids (fixed value).
MASTER_NAMESPACE = "6f9a1e2c-7b3d-5a4e-9c8f-0d1b2a3c4d5e"


def uuid5(namespace: str, name: Column) -> Column:
    """The name-based (SHA-1) UUID of a text, from built-in hashing only."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-5"), F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"), F.substring(digest, 21, 12),
    )


def master_id(internal_uuid: Column, namespace: str = MASTER_NAMESPACE) -> Column:
    """The master id of a customer; the sentinel for null and empty."""
    return F.when(F.coalesce(internal_uuid, F.lit("")) == "", F.lit(UNRESOLVED)).otherwise(uuid5(namespace, internal_uuid))

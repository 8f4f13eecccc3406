"""Normalisers of identity fields and the similarity behind match confidence."""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from decisionlake.config import MATCH_WEIGHTS


def _present(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def emirates_id(c: Column) -> Column:
    """Trimmed, without white space and dashes; blank is null."""
    return _present(F.regexp_replace(F.trim(c), r"[\s\-]", ""))


def phone_e164(c: Column, strip_00: bool = False) -> Column:
    """Digits and plus only; a leading 0 or 971 becomes +971; null unless ``+`` and 8 to 15 digits result.

    ``strip_00`` first reads a leading 00 as plus; without it such a number comes out as the rule for 0 makes it.
    """
    digits = F.regexp_replace(c, r"[^0-9+]", "")
    if strip_00:
        digits = F.regexp_replace(digits, "^00", "+")
    national = F.when(digits.startswith("0"), F.concat(F.lit("+971"), F.substring(digits, F.lit(2), F.length(digits)))).when(digits.startswith("971"), F.concat(F.lit("+"), digits)).otherwise(digits)
    return F.when(national.rlike(r"^\+[0-9]{8,15}$"), national)


def email_lower(c: Column) -> Column:
    return _present(F.lower(F.trim(c)))


def name_normal(c: Column) -> Column:
    """Trimmed lower case with single spaces; blank is null."""
    return _present(F.lower(F.trim(F.regexp_replace(c, r"\s+", " "))))


def name_soundex(c: Column) -> Column:
    """Soundex of the whole trimmed name."""
    return F.soundex(F.trim(c))


def jaro(a: str | None, b: str | None) -> float:
    """Jaro similarity of two texts: shared letters within a window, and how many of them stand in another order."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    free = [True] * len(b)
    from_a = []
    for i, letter in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == letter:
                free[j] = False
                from_a.append(letter)
                break
    if not from_a:
        return 0.0
    from_b = [letter for letter, open_ in zip(b, free) if not open_]
    swapped = sum(x != y for x, y in zip(from_a, from_b)) // 2
    m = len(from_a)
    return (m / len(a) + m / len(b) + (m - swapped) / m) / 3


def jaro_winkler(a: str | None, b: str | None) -> float:
    """Jaro raised by a tenth of what is missing for each of up to four equal first letters."""
    base = jaro(a, b)
    prefix = 0
    for x, y in zip((a or "")[:4], (b or "")[:4]):
        if x != y:
            break
        prefix += 1
    return base + prefix * 0.1 * (1 - base)


def jaro_winkler_column(a: Column, b: Column) -> Column:
    """jaro_winkler on Arrow batches; equal pairs of a batch are scored once."""

    def score(left: pd.Series, right: pd.Series) -> pd.Series:
        known: dict[tuple, float] = {}
        out = []
        for pair in zip(left, right):
            value = known.get(pair)
            if value is None:
                value = known[pair] = jaro_winkler(*pair)
            out.append(value)
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(score, "double")(a, b)


def match_confidence(left: Mapping[str, Column], right: Mapping[str, Column], weights: Mapping[str, float] = MATCH_WEIGHTS) -> Column:
    """Weighted agreement over the fields present on both sides, rounded to 4 places; 0 without any.

    The name counts by Jaro-Winkler of its lower case, every other field by equality of its text.
    """
    both = {f: (F.coalesce(left[f].cast("string"), F.lit("")), F.coalesce(right[f].cast("string"), F.lit(""))) for f in weights if f in left and f in right}
    there = {f: (a != "") & (b != "") for f, (a, b) in both.items()}
    gained, possible = F.lit(0.0), F.lit(0.0)
    for f, (a, b) in both.items():
        agreement = jaro_winkler_column(F.lower(a), F.lower(b)) if f == "full_name" else (a == b).cast("double")
        gained = gained + F.when(there[f], F.lit(weights[f]) * agreement).otherwise(0.0)
        possible = possible + F.when(there[f], F.lit(weights[f])).otherwise(0.0)
    return F.round(F.when(possible > 0, gained / possible).otherwise(0.0), 4)

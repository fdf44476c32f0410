"""Text functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def street_of(line: Column) -> Column:
    """Text before the first ``#``; null when the line has none."""
    return F.when(line.contains("#"), strip(F.substring_index(line, "#", 1)))


def details_of(line: Column) -> Column:
    """Text after the first ``#``; null when the line has none."""
    return F.when(line.contains("#"), strip(F.regexp_extract(line, r"(?s)^[^#]*#(.*)$", 1)))


def full_address(line: Column) -> Column:
    """``street, details`` of an address line."""
    return F.concat(street_of(line), F.lit(", "), details_of(line))


def key_value(key: Column, value: Column) -> Column:
    """``key=value`` text of a tag."""
    return F.concat(key, F.lit("="), value)


def decode_value(value: Column) -> Column:
    """Message bytes as text."""
    return value.cast("string")


def token_sort(text: Column) -> Column:
    """Drop non-ASCII characters, keep word characters, lower-case, sort the words."""
    ascii_only = F.regexp_replace(text, r"[^\x00-\x7F]", "")
    words = F.trim(F.lower(F.regexp_replace(ascii_only, r"[^A-Za-z0-9_]+", " ")))
    return F.array_join(F.sort_array(F.split(words, " ")), " ")


def length_bound(a: Column, b: Column) -> Column:
    """Upper bound of :func:`similarity` from the two text lengths alone."""
    la, lb = F.length(a), F.length(b)
    return F.when(
        (la > 0) & (lb > 0), F.lit(200.0) * F.least(la, lb) / (la + lb)
    ).otherwise(F.lit(0.0))


#: The characters that are left by :func:`token_sort`.
_SORTED_CHARACTERS = " 0123456789_abcdefghijklmnopqrstuvwxyz"


def letters_bound(a: Column, b: Column) -> Column:
    """Upper bound of :func:`similarity` of two token-sorted texts from the letters they share."""

    def count(text: Column, char: Column) -> Column:
        return F.length(text) - F.length(F.replace(text, char, F.lit("")))

    characters = F.array(*[F.lit(c) for c in _SORTED_CHARACTERS])
    shared = F.aggregate(characters, F.lit(0), lambda n, c: n + F.least(count(a, c), count(b, c)))
    total = F.length(a) + F.length(b)
    return F.when(total > 0, F.lit(200.0) * shared / total).otherwise(F.lit(0.0))


@F.pandas_udf(T.IntegerType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-block ratio of two texts as a whole number from 0 to 100; a batch at a time."""
    from .blocks import ratios

    known = a.notna() & b.notna()
    found = pd.Series(pd.NA, index=a.index, dtype="Int32")
    found[known] = ratios(a[known].tolist(), b[known].tolist()).astype("int32")
    return found

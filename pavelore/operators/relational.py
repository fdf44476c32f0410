"""Projection, filter, set and lookup operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import balanced_join


def whitelist(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the named columns that exist, in the given order."""
    return df.select(*[F.col(f"`{n}`") for n in names if n in df.columns])


def extract(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add flat columns computed from nested paths."""
    return df.withColumns(dict(columns))


def require_not_null(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows in which every named column has a value."""
    keep = F.lit(True)
    for name in names:
        keep = keep & F.col(f"`{name}`").isNotNull()
    return df.filter(keep)


def keep_equal(df: DataFrame, name: str, value) -> DataFrame:
    return df.filter(F.col(name) == F.lit(value))


def append(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Concatenate by column name; duplicates stay."""
    for other in others:
        first = first.unionByName(other)
    return first


def first_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every group in the given order.

    One aggregate with map-side combine, so no group is ever sorted or held as a whole.
    ``order`` must be ascending expressions that decide the row.
    """
    rest = [c for c in df.columns if c not in by]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    best = F.min_by(row, F.struct(*order)).alias("_row")
    picked = df.groupBy(*by).agg(best)
    return picked.select(*by, *[F.col("_row").getField(c).alias(c) for c in rest])


def rejects(left: DataFrame, matched: DataFrame, on: list[str], reason: str) -> DataFrame:
    """Rows of ``left`` without a match, with the reason they were skipped."""
    keys = matched.select(*on).distinct()
    return balanced_join(left, keys, on, "left_anti").withColumn("reason", F.lit(reason))

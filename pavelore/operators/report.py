"""Dashboard queries over scored points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import MAP_BOUNDS, RECENT_MINUTES, TOP_ROADS
from ..functions.geo import z_ranges


def recent(
    df: DataFrame, ts: str, now: Column | None = None, minutes: int = RECENT_MINUTES
) -> DataFrame:
    """Rows of the last minutes up to ``now`` (default: the newest time in the table).

    The limits reach the scan as pushed filters.
    """
    length = F.expr(f"INTERVAL {int(minutes)} MINUTES")
    if now is None:
        # nothing is newer than the newest, so one limit is enough
        return df.filter(F.col(ts) >= df.agg(F.max(ts) - length).scalar())
    return df.filter((F.col(ts) >= now - length) & (F.col(ts) <= now))


def in_bounds(
    df: DataFrame,
    lat: str = "lat",
    lon: str = "lon",
    min_lat: float = MAP_BOUNDS["min_lat"],
    min_lon: float = MAP_BOUNDS["min_lon"],
    max_lat: float = MAP_BOUNDS["max_lat"],
    max_lon: float = MAP_BOUNDS["max_lon"],
) -> DataFrame:
    """Rows inside a map rectangle; with ``min_lon`` above ``max_lon`` it crosses 180 degrees.

    Where the rows have a ``cell`` (:func:`pavelore.functions.geo.z_cell`), its ranges reach the
    scan, so files and parts of files that hold other cells alone are not read.
    """
    if "cell" in df.columns:
        ranges = z_ranges(min_lat, min_lon, max_lat, max_lon)
        inside = F.lit(False)
        for low, high in ranges:
            inside = inside | F.col("cell").between(low, high)
        df = df.filter(inside)
    east, west = F.col(lon) <= max_lon, F.col(lon) >= min_lon
    return df.filter(F.col(lat).between(min_lat, max_lat) & (east & west if min_lon <= max_lon else east | west))


def _partials(df: DataFrame, name: str, value: str) -> DataFrame:
    return df.filter(F.col(name).isNotNull()).groupBy(name).agg(
        F.sum(value).alias("_sum"),
        F.count(value).alias("_n"),
        F.min(value).alias("min_danger"),
        F.max(value).alias("max_danger"),
    )


def _average() -> Column:
    return (F.col("_sum") / F.nullif(F.col("_n"), F.lit(0))).alias("avg_danger")


def road_metrics(df: DataFrame, name: str = "name", value: str = "danger_index") -> DataFrame:
    """Average, smallest and largest risk per named road."""
    return _partials(df, name, value).select(name, _average(), "min_danger", "max_danger")


def top_roads(
    df: DataFrame, k: int = TOP_ROADS, name: str = "name", value: str = "danger_index"
) -> DataFrame:
    """The ``k`` roads of highest average risk and one ``Other`` row for all the rest.

    The rest is merged from the per-road sums, so the points are aggregated once.
    """
    roads = _partials(df, name, value)
    best = (
        roads.select(name, _average())
        .orderBy(F.col("avg_danger").desc_nulls_last(), F.col(name))
        .limit(k)
        .select(name, F.lit(True).alias("_top"))
    )
    return (
        roads.join(F.broadcast(best), on=name, how="left")
        .groupBy(
            F.col("_top").isNull().alias("is_other"),
            F.when(F.col("_top"), F.col(name)).otherwise("Other").alias(name),
        )
        .agg(
            F.sum("_sum").alias("_sum"),
            F.sum("_n").alias("_n"),
            F.min("min_danger").alias("min_danger"),
            F.max("max_danger").alias("max_danger"),
        )
        .select(name, "is_other", _average(), "min_danger", "max_danger")
    )

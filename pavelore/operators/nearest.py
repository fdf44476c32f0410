"""The nearest mark of every place, by a descent through nested grid cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import MAX_LEVEL, cell_at, cell_centre, cell_reach_m, cells_touched, haversine_m
from ..session import materialize
from .ranking import global_rank
from .skew import balanced_join

LEAF = 16  # marks of a cell that are compared one by one
TASK_PLACES = 20_000  # places whose pairs one task holds, about


def _dealt(df: DataFrame, tasks: int) -> DataFrame:
    """Rows dealt by place to the session's shuffle partitions, or to more tasks if so many are asked for."""
    if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(tasks, "_key")


def _cells(marks: DataFrame, cell_m: float, level: int) -> DataFrame:
    """The cells of a level that hold marks, with the cell around them and how many they hold."""
    place = F.col("m_lat"), F.col("m_lon")
    cells = marks.select(
        cell_at(*place, cell_m, level).alias("cell"), cell_at(*place, cell_m, max(0, level - 1)).alias("parent")
    )
    return cells.groupBy("cell", "parent").agg(F.count(F.lit(1)).alias("n"))


def _bounded(pairs: DataFrame, radius_m: float, level: int) -> DataFrame:
    """Pairs of place and cell that may hold the place's nearest mark, with ``far``: no mark
    that counts is farther from the place.

    A cell's marks are as near and as far as its centre, less or more the reach from there.
    """
    centre = cell_centre(F.col("cell"), radius_m, level)
    away = haversine_m(F.col("lat"), F.col("lon"), *centre)
    pairs = pairs.withColumn("_away", away).withColumn("_reach", cell_reach_m(F.col("cell"), radius_m, level))
    here = Window.partitionBy("_key", "lat", "lon")
    most = F.least("far", F.min(F.col("_away") + F.col("_reach")).over(here))
    return pairs.withColumn("far", most).filter(F.col("_away") - F.col("_reach") <= F.col("far")).drop("_away", "_reach")


def nearest_marks(places: DataFrame, marks: DataFrame, radius_m: float, order: Column, value: str) -> DataFrame:
    """(lat, lon, ``value``): of the marks within the radius of each place the nearest one's value.

    ``places`` (lat, lon); ``marks`` (lat, lon, ``value``), one row per coordinate; of equally
    near marks the one that is first by ``order`` counts. Nulls are left out; so are places
    without a mark in the radius.

    Only cells that hold marks are looked at, first large ones. A cell farther away than
    the farthest place of another is dropped; one with more than ``LEAF`` marks is replaced
    by those of its 16 parts that hold marks. So a place meets a few cells on each level
    and a few marks, however many marks are around it or lie together. The number of tasks
    that hold the pairs of places follows from the number of places.
    """
    marks = marks.select(F.col("lat").alias("m_lat"), F.col("lon").alias("m_lon"), value).dropna(subset=["m_lat", "m_lon"])
    # pairs carry the mark's rank in place of its value and order
    values = materialize(global_rank(marks, [order.asc()], "_mark"))
    marks = values.select("m_lat", "m_lon", "_mark")
    here = materialize(places.select("lat", "lon").dropna().distinct())
    # Spark deals no window by plain doubles, so rows are dealt by a whole number of the place
    here = here.withColumn("_key", F.xxhash64("lat", "lon"))
    tasks = -(-here.count() // TASK_PLACES)
    # the cells of places that a cell with marks may count for: those that its widened circle touches
    cells = _cells(marks, radius_m, 0).drop("parent")
    middle = cell_centre(F.col("cell"), radius_m, 0)
    around = cells_touched(*middle, cell_reach_m(F.col("cell"), radius_m, 0) + radius_m, radius_m)
    reached = cells.select(F.explode(around).alias("own"), "cell", "n")
    own = cell_at(F.col("lat"), F.col("lon"), radius_m)
    pairs = balanced_join(here.withColumn("own", own), reached, ["own"], spread_by=["lat", "lon"])
    pairs = pairs.select("_key", "lat", "lon", F.lit(float(radius_m)).alias("far"), "cell", "n")
    found = []
    for level in range(MAX_LEVEL + 1):
        pairs = materialize(_bounded(_dealt(pairs, tasks), radius_m, level))
        small = F.lit(True) if level == MAX_LEVEL else F.col("n") <= LEAF
        found.append(_met(pairs.filter(small), marks, radius_m, level))
        pairs = pairs.filter(~small)
        if level == MAX_LEVEL or pairs.isEmpty():
            break
        parts = _cells(marks, radius_m, level + 1)
        pairs = pairs.select("_key", "lat", "lon", "far", F.col("cell").alias("parent"))
        pairs = balanced_join(pairs, parts, ["parent"], spread_by=["lat", "lon"]).drop("parent")
    met = found[0]
    for part in found[1:]:
        met = met.unionByName(part)
    first = F.min(F.struct("_far", "_mark"))["_mark"]
    nearest = _dealt(met, tasks).groupBy("_key", "lat", "lon").agg(first.alias("_mark")).drop("_key")
    return balanced_join(nearest, values.select("_mark", value), ["_mark"], spread_by=["lat", "lon"]).drop("_mark")


def _met(pairs: DataFrame, marks: DataFrame, radius_m: float, level: int) -> DataFrame:
    """The marks of each pair's cell that are no farther than the place's bound."""
    celled = marks.withColumn("cell", cell_at(F.col("m_lat"), F.col("m_lon"), radius_m, level))
    met = balanced_join(pairs.select("_key", "lat", "lon", "far", "cell"), celled, ["cell"], spread_by=["lat", "lon"])
    distance = haversine_m(F.col("lat"), F.col("lon"), F.col("m_lat"), F.col("m_lon"))
    met = met.withColumn("_far", distance).filter(F.col("_far") <= F.col("far"))
    return met.select("_key", "lat", "lon", "_far", "_mark")

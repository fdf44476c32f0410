"""Joins of accidents, roads, map ways, addresses and weather."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import ROAD_KEY
from .nearest import nearest_marks
from .relational import first_per_group
from .skew import balanced_join


def name_road_key(roads: DataFrame) -> DataFrame:
    """Rename the input_* key columns of the road table to the accident table's names."""
    return roads.withColumnsRenamed({f"input_{k.lower()}": k for k in ROAD_KEY})


def assert_unique(df: DataFrame, on: list[str]) -> DataFrame:
    """Fail the query when a key occurs twice; the check rides on the same rows."""
    repeated = df.groupBy(*on).count().filter("count > 1")
    found = repeated.limit(1).agg(F.count(F.lit(1))).scalar()
    problem = F.raise_error(F.lit(f"duplicate key in {on}")).cast("boolean")
    return df.filter(F.when(found == 0, F.lit(True)).otherwise(problem))


def join_roads(accidents: DataFrame, roads: DataFrame, unique: bool = False) -> DataFrame:
    """Inner join on the road key. Null keys never match; a repeated road repeats its rows."""
    roads = name_road_key(roads).select(*ROAD_KEY, "highway")
    if unique:
        roads = assert_unique(roads, ROAD_KEY)
    return balanced_join(accidents, roads, ROAD_KEY)


def way_attributes(ways: DataFrame) -> DataFrame:
    """way_id, highway and name from a way's id and tag map; other columns stay."""
    rest = [c for c in ways.columns if c not in ("id", "tags")]
    return ways.select(
        F.col("id").alias("way_id"),
        F.col("tags")["highway"].alias("highway"),
        F.col("tags")["name"].alias("name"),
        *rest,
    )


def way_nodes(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row per (way, node) in way order: way_id, pos, node_id, lat, lon.

    A node a closed way lists twice counts once, at its first place. Copies of a way are
    one way.
    """
    distinct = ways.select("way_id", F.array_distinct("nodes").alias("nodes")).distinct()
    steps = distinct.select("way_id", F.posexplode("nodes").alias("pos", "node_id"))
    return balanced_join(
        steps, nodes.select("node_id", "lat", "lon"), ["node_id"], spread_by=["way_id", "pos"]
    ).select("way_id", "pos", "node_id", "lat", "lon")


def way_segments(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """The lines of ways: way_id, lat1, lon1, lat2, lon2, each segment of a way once.

    A segment goes from a node to the next one in the way's list, also from the last to the
    first of a closed way. A node whose next one is not located, or is itself, is a segment
    of one place; so every located node is on its way's line.
    """
    steps = F.transform(
        F.col("nodes"),
        lambda node, i: F.struct(node.alias("node_id"), F.get(F.col("nodes"), i + 1).alias("next_id")),
    )
    listed = ways.select("way_id", F.explode(F.array_distinct(steps)).alias("step")).select("way_id", "step.*").distinct()
    places = nodes.select("node_id", F.col("lat").alias("lat1"), F.col("lon").alias("lon1"))
    ends = nodes.select(F.col("node_id").alias("next_id"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    located = balanced_join(listed, places, ["node_id"], spread_by=["way_id", "next_id"])
    joined = balanced_join(located, ends, ["next_id"], "left", spread_by=["way_id", "node_id"])
    alone = F.col("lat2").isNull() | F.col("lon2").isNull()
    to = [F.when(alone, F.col(f"{c}1")).otherwise(F.col(f"{c}2")).alias(f"{c}2") for c in ("lat", "lon")]
    return joined.select("way_id", "lat1", "lon1", *to).distinct()


def first_node(road_nodes: DataFrame) -> DataFrame:
    """The first located node of every way."""
    return first_per_group(road_nodes, ["way_id"], [F.col("pos"), F.col("node_id")])


def geocode(addresses: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Add lat, lon of the best-ranked gazetteer entry; addresses without one are left out.

    Only entries of these addresses are looked at; they are reduced to one row per address
    before the join.
    """
    wanted = addresses.select("address").distinct()
    best = first_per_group(
        balanced_join(gazetteer, wanted, ["address"], "left_semi").select("address", "rank", "lat", "lon"),
        ["address"],
        [F.col("rank"), F.col("lat"), F.col("lon")],
    ).drop("rank")
    return balanced_join(addresses, best, ["address"])


def latest_weather(observations: DataFrame, by: list[str]) -> DataFrame:
    """The newest observation with a non-empty weather list per place.

    ``observations``: the place columns and ``weather_info``.
    """
    usable = observations.filter(F.size("weather_info.weather") > 0)
    newest = F.max_by("weather_info", F.struct("weather_info.dt", "weather_info"))
    return usable.groupBy(*by).agg(newest.alias("weather_info"))


def nearest_weather(roads: DataFrame, observations: DataFrame, radius_m: float) -> DataFrame:
    """Add the weather observed nearest to a road's place; roads without one are left out.

    ``roads``: any columns and ``first_lat``, ``first_lon``; ``observations``: lat, lon and
    ``weather_info``. Observations without a weather list do not count, nor do those farther
    than ``radius_m``. Of equally near ones the newest counts. Only the newest observation
    of a coordinate and each place once are compared, by :func:`nearest.nearest_marks`.
    """
    newest = latest_weather(observations, ["lat", "lon"])
    places = roads.select(F.col("first_lat").alias("lat"), F.col("first_lon").alias("lon"))
    order = F.struct(-F.col("weather_info.dt"), F.col("weather_info"))
    best = nearest_marks(places, newest, radius_m, order, "weather_info")
    best = best.withColumnsRenamed({"lat": "first_lat", "lon": "first_lon"})
    return balanced_join(roads, best, ["first_lat", "first_lon"])


def attach_weather(roads: DataFrame, observations: DataFrame, by: list[str]) -> DataFrame:
    """Add the newest weather of a road's place; roads without weather are left out."""
    return balanced_join(roads, latest_weather(observations, by), by)

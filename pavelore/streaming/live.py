"""Live weather: the newest observation per station is kept, and a road hears from its nearest one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import cell_at, cells_touched
from ..operators.nearest import nearest_marks
from ..operators.skew import balanced_join

PLACE = ["lat", "lon"]


def newest_observations(known: DataFrame | None, updates: DataFrame) -> DataFrame:
    """``lat, lon, weather_info, fresh``: the newest observation per station, and whether an update brought it.

    ``known``: the table after the batch before, or None. Observations without a weather
    list or a place do not count. Of equal times the update counts, of several updates with
    one time that with the largest values; an older observation that arrives late does not
    replace a newer one.
    """
    usable = updates.filter(F.size("weather_info.weather") > 0).dropna(subset=PLACE)
    rows = usable.select(*PLACE, "weather_info", F.lit(True).alias("fresh"))
    if known is not None:
        rows = rows.unionByName(known.select(*PLACE, "weather_info", F.lit(False).alias("fresh")))
    newest = F.max_by(F.struct("weather_info", "fresh"), F.struct("weather_info.dt", "fresh", "weather_info"))
    return rows.groupBy(*PLACE).agg(newest.alias("_newest")).select(*PLACE, "_newest.*")


def refreshed_roads(roads: DataFrame, stations: DataFrame, radius_m: float) -> DataFrame:
    """Roads whose nearest station in the radius has a fresh observation, with ``weather_info``.

    ``roads``: any columns with ``first_lat`` and ``first_lon``; ``stations`` as from
    :func:`newest_observations`. A road comes once: from its nearest station, of equally near
    ones from that with the newest observation. Only roads in cells that the circles of
    fresh stations touch are looked at.
    """
    lat, lon = F.col("lat"), F.col("lon")
    fresh = stations.filter("fresh")
    touched = fresh.select(F.explode(cells_touched(lat, lon, F.lit(radius_m), radius_m)).alias("cell")).distinct()
    places = roads.select(F.col("first_lat").alias("lat"), F.col("first_lon").alias("lon")).dropna().distinct()
    around = balanced_join(places.withColumn("cell", cell_at(lat, lon, radius_m)), touched, ["cell"], "left_semi")
    value = F.struct("weather_info", "fresh").alias("station")
    order = F.struct(-F.col("station.weather_info.dt"), F.col("station.weather_info"))
    nearest = nearest_marks(around.drop("cell"), stations.select(*PLACE, value), radius_m, order, "station")
    heard = nearest.filter("station.fresh").select(
        F.col("lat").alias("first_lat"), F.col("lon").alias("first_lon"), "station.weather_info"
    )
    return balanced_join(roads, heard, ["first_lat", "first_lon"])

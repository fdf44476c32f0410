"""From nested road documents to flat point messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nested import decimal_number, path, whole_number
from ..functions.times import epoch_to_timestamp, to_iso8601
from ..operators.relational import extract, whitelist
from ..schemas import POINT_FLAG_ORDER, POINT_WHOLE_FIELDS

# Flat field -> place in the nested document.
PATHS = {
    "Temperature_C": "weather_info.main.temp",
    "Humidity_%": "weather_info.main.humidity",
    "pressure_hPa": "weather_info.main.pressure",
    "wind_speed_meterSec": "weather_info.wind.speed",
    "weather_icon": "weather_info.weather[0].icon",
    **{flag: f"node_info.{flag}" for flag in POINT_FLAG_ORDER},
    "lat": "node_info.lat",
    "lon": "node_info.lon",
    "weather_timestamp": "weather_info.dt",
}
KEPT = ["way_id", "highway", "name", *PATHS]
DECIMAL_FIELDS = ["pressure_hPa", "wind_speed_meterSec", "lat", "lon"]


def convert_types(df: DataFrame) -> DataFrame:
    """Whole-number and decimal fields as numbers; unreadable values become null."""
    whole = {c: whole_number(F.col(f"`{c}`")) for c in POINT_WHOLE_FIELDS}
    decimal = {c: decimal_number(F.col(f"`{c}`")) for c in DECIMAL_FIELDS}
    return df.withColumns(whole | decimal)


def flatten_documents(documents: DataFrame) -> DataFrame:
    """One flat row per road point; a document without points gives no row."""
    points = documents.withColumn("node_info", F.explode("nodes_info"))
    flat = whitelist(extract(points, {name: path(p) for name, p in PATHS.items()}), KEPT)
    observed = epoch_to_timestamp(F.col("weather_timestamp"))
    return convert_types(flat).withColumn("weather_timestamp_iso8601", to_iso8601(observed))

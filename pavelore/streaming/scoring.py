"""From point messages to scored points."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conditions import day_night, icon_class
from ..functions.geo import z_cell
from ..functions.nested import location, relaxed, whole_number
from ..functions.strings import decode_value
from ..functions.times import parse_iso_or_epoch
from ..functions.units import hpa_to_inhg, mps_to_mph
from ..operators.model import known_categories
from ..schemas import POINT_EVENT, POINT_WHOLE_FIELDS, SCORED_COLUMNS

_BROKEN = "_broken"


def _parsed(messages: DataFrame) -> DataFrame:
    """Message text and its fields. Every message is parsed once, by a generator, so no
    filter on the fields can repeat the parsing below it."""
    schema = T.StructType(
        [*relaxed(POINT_EVENT, POINT_WHOLE_FIELDS).fields, T.StructField(_BROKEN, T.StringType())]
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    texts = messages.select(decode_value(F.col("value")).alias("value"))
    return texts.select("value", F.inline(F.array(F.from_json("value", schema, options))))


def _points(parsed: DataFrame) -> DataFrame:
    fields = {c: whole_number(F.col(f"`{c}`")) for c in POINT_WHOLE_FIELDS}
    return parsed.drop("value", _BROKEN).withColumns(fields)


def _unreadable() -> Column:
    no_document = F.coalesce(F.trim("value").isin("", "null"), F.lit(True))
    return no_document | F.col(_BROKEN).isNotNull()


def parse(messages: DataFrame) -> DataFrame:
    """Messages with their fields, for :func:`readable` and :func:`unreadable`."""
    return _parsed(messages)


def readable(parsed: DataFrame) -> DataFrame:
    """Typed point rows of parsed messages, without the broken ones."""
    return _points(parsed.filter(~_unreadable()))


def unreadable(parsed: DataFrame) -> DataFrame:
    """The parsed messages that are null or not a readable document."""
    return parsed.filter(_unreadable()).select("value")


def decode(messages: DataFrame) -> DataFrame:
    """Messages as typed point rows; an unreadable message gives a row of nulls."""
    return _points(_parsed(messages))


def decode_readable(messages: DataFrame) -> DataFrame:
    """Messages as typed point rows, without the broken ones."""
    return readable(_parsed(messages))


def broken(messages: DataFrame) -> DataFrame:
    """Messages that are null or not a readable document."""
    return unreadable(_parsed(messages))


def derive_conditions(points: DataFrame, mode: str = "truncate") -> DataFrame:
    """Model inputs from raw units and icon; the raw columns are dropped."""
    icon = F.col("weather_icon")
    return (
        points.withColumnsRenamed(
            {"Temperature_C": "Temperature(C)", "Humidity_%": "Humidity(%)"}
        )
        .withColumns(
            {
                "Pressure(in)": hpa_to_inhg(F.col("pressure_hPa"), mode),
                "Wind_Speed(mph)": mps_to_mph(F.col("wind_speed_meterSec"), mode),
                "Sunrise_Sunset": day_night(icon),
                "Weather_Condition": icon_class(icon),
            }
        )
        .drop("pressure_hPa", "wind_speed_meterSec", "weather_icon")
    )


def shape_scored(predictions: DataFrame) -> DataFrame:
    """The 21 output columns, with a location struct and a typed time."""
    return (
        predictions.withColumn("location", location(F.col("lat"), F.col("lon")))
        .withColumn(
            "weather_timestamp_iso8601", parse_iso_or_epoch(F.col("weather_timestamp_iso8601"))
        )
        .withColumnRenamed("prediction", "danger_index")
        .select(*[F.col(f"`{c}`") for c in SCORED_COLUMNS])
    )


def scoreable(points: DataFrame, model: PipelineModel) -> DataFrame:
    """Derived rows whose categories and numbers the model accepts."""
    return points.filter(_accepted(model))


def unscoreable(points: DataFrame, model: PipelineModel) -> DataFrame:
    """The derived rows :func:`scoreable` leaves out."""
    return points.filter(~_accepted(model))


def _accepted(model: PipelineModel) -> Column:
    complete = known_categories(model)
    for column in model.stages[1].getInputCols():
        if not column.endswith("_indexed"):
            complete = complete & F.col(f"`{column}`").isNotNull()
    return complete


def score_points(points: DataFrame, model: PipelineModel, mode: str = "truncate") -> DataFrame:
    """Derive, predict and shape."""
    return shape_scored(model.transform(derive_conditions(points, mode)))


def with_event_date(scored: DataFrame) -> DataFrame:
    """Add the partition column of the scored table, so time filters skip old files."""
    return scored.withColumn("event_date", F.to_date("weather_timestamp_iso8601"))


def with_cell(scored: DataFrame) -> DataFrame:
    """Add the Z-order cell of the location, by which map rectangles skip files."""
    return scored.withColumn("cell", z_cell(F.col("location.lat"), F.col("location.lon")))


def by_cell(scored: DataFrame) -> DataFrame:
    """The same rows, with neighbouring cells of a day in one task and in order."""
    return scored.repartitionByRange("event_date", "cell").sortWithinPartitions("event_date", "cell")

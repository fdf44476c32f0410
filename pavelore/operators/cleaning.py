"""Cleaning of accident rows and classification of weather text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import FLAGS, UNKNOWN_CLASS, WEATHER_CLASSES, WEATHER_NUMBERS
from ..functions.conditions import bool_to_int
from ..functions.units import f_to_c, round_int
from .relational import require_not_null
from .skew import balanced_join

# Columns without which an accident is left out.
REQUIRED = [
    "Temperature(F)", "Humidity(%)", "Pressure(in)", "Wind_Speed(mph)", "Weather_Condition",
    *FLAGS, "Sunrise_Sunset",
]


def weather_dimension(spark: SparkSession) -> DataFrame:
    """raw text -> class. A text listed under two classes keeps the first."""
    rows = {}
    for name, texts in WEATHER_CLASSES.items():
        for text in texts:
            rows.setdefault(text, name)
    entries = F.create_map(*[F.lit(text) for pair in rows.items() for text in pair])
    return spark.range(1).select(F.explode(entries).alias("raw", "class"))


def classify(
    df: DataFrame, column: str, dimension: DataFrame, default: str = UNKNOWN_CLASS
) -> DataFrame:
    """Replace a text column by its class; null and unlisted texts get the default.

    ``dimension`` (raw, class) holds each text once; a short list is broadcast.
    """
    order = df.columns
    lookup = dimension.withColumnsRenamed({"raw": column, "class": "_class"})
    joined = balanced_join(df, lookup, [column], "left")
    replaced = F.coalesce(F.col("_class"), F.lit(default)).alias(column)
    return joined.select(*[replaced if c == column else F.col(f"`{c}`") for c in order])


def clean_accidents(accidents: DataFrame) -> DataFrame:
    """Complete rows only, weather classed, numbers rounded, flags 0/1, temperature in C."""
    complete = require_not_null(accidents, REQUIRED)
    classed = classify(complete, "Weather_Condition", weather_dimension(accidents.sparkSession))
    celsius = classed.withColumn("Temperature(C)", f_to_c(F.col("Temperature(F)")))
    return celsius.withColumns(
        {c: round_int(F.col(c)) for c in WEATHER_NUMBERS}
        | {f: bool_to_int(F.col(f)) for f in FLAGS}
    ).drop("Temperature(F)")

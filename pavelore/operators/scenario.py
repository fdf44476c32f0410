"""The demonstration weather grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import (
    SCENARIO_HUMIDITY, SCENARIO_ICONS, SCENARIO_PRESSURE, SCENARIO_TEMPERATURE, SCENARIO_WIND,
)


def _values(values: Sequence) -> Column:
    return F.explode(F.array(*[F.lit(v) for v in values]))


def set_first_icon(weather: Column, icon: Column) -> Column:
    """Overwrite the icon of the first element of a weather list."""
    return F.transform(
        weather, lambda el, i: F.when(i == 0, el.withField("icon", icon)).otherwise(el)
    )


def scenario_rows(df: DataFrame) -> DataFrame:
    """Every row once per weather setting: generated in place, there is no join.

    The rows are dealt to all tasks first: a small file of roads, read by one task, makes 648
    times as many rows.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        df.repartition(parts)
        .withColumn("humidity", _values(SCENARIO_HUMIDITY))
        .withColumn("temp", _values(SCENARIO_TEMPERATURE))
        .withColumn("icon", _values(SCENARIO_ICONS))
        .withColumn("speed", _values(SCENARIO_WIND))
        .withColumn("pressure", _values(SCENARIO_PRESSURE))
    )


def replaced_weather(dt: Column | None = None) -> Column:
    """``weather_info`` with the setting's five fields, and the time where one is given."""
    info = F.col("weather_info")
    main = (
        info.getField("main")
        .withField("humidity", F.col("humidity").cast("double"))
        .withField("temp", F.col("temp").cast("double"))
        .withField("pressure", F.col("pressure").cast("double"))
    )
    wind = info.getField("wind").withField("speed", F.col("speed").cast("double"))
    replaced = (
        info.withField("main", main)
        .withField("wind", wind)
        .withField("weather", set_first_icon(info.getField("weather"), F.col("icon")))
    )
    return replaced if dt is None else replaced.withField("dt", dt.cast("long"))


def scenario_events(events: DataFrame, dt: Column | None = None) -> DataFrame:
    """Road events under all weather settings."""
    settings = scenario_rows(events)
    return settings.withColumn("weather_info", replaced_weather(dt)).select(*events.columns)

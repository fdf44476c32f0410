"""Functions over nested documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def path(dotted: str) -> Column:
    """Column for a dotted path; ``[0]`` takes an array element, null when absent."""
    column = None
    for step in dotted.split("."):
        name, _, index = step.partition("[")
        column = F.col(f"`{name}`") if column is None else column.getField(name)
        if index:
            column = F.get(column, F.lit(int(index.rstrip("]"))))
    return column


def whole_number(value: Column) -> Column:
    """Text or number to int, dropping a fraction; unreadable values give null."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number).try_cast("int")


def decimal_number(value: Column) -> Column:
    """Text or number to double; unreadable values give null."""
    return value.try_cast("double")


def location(lat: Column, lon: Column) -> Column:
    return F.struct(lat.alias("lat"), lon.alias("lon"))


def relaxed(schema: T.StructType, whole: list[str]) -> T.StructType:
    """The schema with the named whole-number fields read as double."""
    return T.StructType(
        [
            T.StructField(f.name, T.DoubleType() if f.name in whole else f.dataType, True)
            for f in schema.fields
        ]
    )

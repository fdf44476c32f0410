"""Weather updates as a stream joined to static roads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = 16


def refresh(
    updates: DataFrame,
    roads: DataFrame,
    by: list[str],
    spread_by: list[str] | None = None,
    pieces: int = SPREAD,
    keep: list[str] = [],
) -> DataFrame:
    """Every road of an updated place with its fresh weather, once per update.

    ``updates``: the place columns and ``weather_info`` (few rows); ``roads``: static, many
    rows per place. Roads are cut into pieces by a hash of ``spread_by`` (default: the
    whole row) and each update is repeated per piece, so a place with a large share of the
    roads is handled by many tasks. ``keep`` names further columns of the updates.
    """
    piece = F.pmod(F.xxhash64(*(spread_by or roads.columns)), F.lit(pieces)).cast("int")
    usable = updates.filter(F.size("weather_info.weather") > 0).select(*by, *keep, "weather_info")
    repeated = usable.withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)))
    )
    return repeated.join(roads.withColumn("_piece", piece), on=[*by, "_piece"]).select(
        *roads.columns, *keep, "weather_info"
    )

"""Report: recent points inside a map rectangle and the roads of highest risk.

    spark-submit -m pavelore.plans.report --scored FOLDER --out FOLDER
"""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import RECENT_MINUTES
from ..operators.report import in_bounds, recent, top_roads
from ..session import prepare
from ..sources.files import read_scored

TIME = "weather_timestamp_iso8601"


def recent_points(scored: DataFrame, now: Column, minutes: int = RECENT_MINUTES) -> DataFrame:
    """Points of the last minutes; files of other event dates are not read."""
    start = now - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    days = F.col("event_date").between(F.to_date(start), F.to_date(now))
    return recent(scored.filter(days), TIME, now, minutes)


def map_points(scored: DataFrame, now: Column, **bounds) -> DataFrame:
    """Recent points inside the map rectangle."""
    flat = recent_points(scored, now).select("*", "location.lat", "location.lon")
    return in_bounds(flat, **bounds)


def risk_table(scored: DataFrame, now: Column) -> DataFrame:
    """Top roads by average risk among the recent points."""
    return top_roads(recent_points(scored, now))


def write_report(scored: DataFrame, now: Column, out: str) -> None:
    """Write all map points and the table of roads; a report of the same folder is replaced."""
    map_points(scored, now).write.mode("overwrite").parquet(f"{out}/points")
    risk_table(scored, now).write.mode("overwrite").parquet(f"{out}/roads")


def main() -> None:
    options = argparse.ArgumentParser(description=__doc__)
    options.add_argument("--scored", required=True)
    options.add_argument("--out", required=True, help="points/ and roads/ are written below")
    options.add_argument("--now", help="ISO time; default: the present")
    args = options.parse_args()
    spark = SparkSession.builder.appName("pavelore-report").getOrCreate()
    prepare(spark)
    now = F.lit(args.now).cast("timestamp") if args.now else F.current_timestamp()
    write_report(read_scored(spark, args.scored), now, args.out)


if __name__ == "__main__":
    main()

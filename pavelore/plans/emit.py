"""Emit: road documents with weather as point messages, live or for all weather settings.

    spark-submit -m pavelore.plans.emit live --roads FOLDER --weather FOLDER \\
        --out FOLDER --checkpoint FOLDER [--format kafka --servers HOSTS --topic NAME]
    spark-submit -m pavelore.plans.emit scenarios --documents FILE.jsonl --out FOLDER
"""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..fixed import WEATHER_REFRESH_SECONDS
from ..operators.scenario import scenario_events
from ..schemas import ROAD_EVENT, WEATHER_INFO
from ..session import prepare
from ..sources.files import read_jsonl
from ..sources.streams import as_messages, each_batch, read_documents, remove, write_batch
from ..streaming.live import newest_observations, refreshed_roads
from ..streaming.points import flatten_documents
from .enrich import WEATHER_RADIUS_M

# Weather updates as they arrive: a coordinate and its current weather.
UPDATE = T.StructType(
    [
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("weather_info", WEATHER_INFO),
    ]
)


def live_messages(
    stations: DataFrame, documents: DataFrame, radius_m: float = WEATHER_RADIUS_M
) -> DataFrame:
    """Point messages of every road whose nearest station has a fresh observation.

    ``stations`` as from :func:`newest_observations`; ``documents``: road documents with the
    first node's place, as the enrich job writes them.
    """
    return as_messages(flatten_documents(refreshed_roads(documents, stations, radius_m)))


def scenario_messages(documents: DataFrame, now: Column | None = None) -> DataFrame:
    """Point messages of documents under each of the 648 weather settings."""
    now = F.unix_seconds(F.current_timestamp()) if now is None else now
    return as_messages(flatten_documents(scenario_events(documents, now)))


def start_live(
    updates: DataFrame,
    documents: DataFrame,
    out: str,
    checkpoint: str,
    format: str = "text",
    every_seconds: int | None = WEATHER_REFRESH_SECONDS,
    radius_m: float = WEATHER_RADIUS_M,
    **options,
) -> StreamingQuery:
    """Start sending; a road gets one message per batch in which its nearest station reports.

    The newest observation per station is kept beside the checkpoint, a version for each batch,
    made from the version before. So a batch that comes again after a crash finds the same
    stations and replaces its own messages; a topic may get them twice. Versions older than
    the last two are removed.
    """
    spark = updates.sparkSession

    def handle(rows: DataFrame, number: int, batch: str) -> None:
        folder = f"{checkpoint}/stations"
        known = spark.read.parquet(f"{folder}/{number - 1}") if number else None
        newest_observations(known, rows).write.mode("overwrite").parquet(f"{folder}/{number}")
        messages = live_messages(spark.read.parquet(f"{folder}/{number}"), documents, radius_m)
        if format == "kafka":
            messages.write.format(format).options(topic=out, **options).save()
        else:
            write_batch(messages, out, batch, format)
        remove(spark, f"{folder}/{number - 2}")

    return each_batch(updates, checkpoint, handle, every_seconds)


def topic_options(servers: str, topic: str) -> dict[str, str]:
    """Writer options of a Kafka topic."""
    if not servers or not topic:
        raise ValueError("a topic needs --servers and --topic")
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def main() -> None:
    options = argparse.ArgumentParser(description=__doc__)
    modes = options.add_subparsers(dest="mode", required=True)
    live, scenarios = modes.add_parser("live"), modes.add_parser("scenarios")
    for name in ("roads", "weather", "out", "checkpoint"):
        live.add_argument(f"--{name}", required=True)
    live.add_argument("--format", default="text", choices=["text", "kafka"])
    live.add_argument("--servers", default="")
    live.add_argument("--topic", default="")
    for name in ("documents", "out"):
        scenarios.add_argument(f"--{name}", required=True)
    args = options.parse_args()
    spark = SparkSession.builder.appName("pavelore-emit").getOrCreate()
    prepare(spark)
    if args.mode == "live":
        updates = read_documents(spark, args.weather, UPDATE)
        settings = topic_options(args.servers, args.topic) if args.format == "kafka" else {}
        documents = spark.read.parquet(args.roads)
        start_live(
            updates, documents, args.out, args.checkpoint, args.format, **settings
        ).awaitTermination()
    else:
        documents = read_jsonl(spark, args.documents, ROAD_EVENT)
        scenario_messages(documents).write.mode("append").text(args.out)


if __name__ == "__main__":
    main()

"""Stream sources and sinks. The same job body runs on files or on a message broker."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_messages(spark: SparkSession, kind: str, place: str, **options) -> DataFrame:
    """A stream of messages with one ``value`` column.

    ``kind="kafka"``: ``place`` is the topic and ``options`` hold ``kafka.*`` settings; it
    needs the connector jar. ``kind="text"``: ``place`` is a folder, one message per line.
    """
    reader = spark.readStream.options(**options)
    if kind == "kafka":
        reader = reader.format("kafka").option("subscribe", place)
        return reader.option("startingOffsets", "earliest").load().select("value")
    if kind == "text":
        return reader.format("text").load(place).select("value")
    raise ValueError(f"unknown stream kind {kind!r}")


def read_documents(
    spark: SparkSession, folder: str, schema: T.StructType, **options
) -> DataFrame:
    """A stream of JSON documents arriving as files."""
    return spark.readStream.schema(schema).options(**options).json(folder)


def as_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """One JSON message per row, with an optional message key."""
    value = F.to_json(F.struct("*")).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).cast("string").alias("key"), value)


def append_stream(
    df: DataFrame,
    target: str,
    checkpoint: str,
    format: str = "parquet",
    partition_by: list[str] | None = None,
    every_seconds: int | None = None,
    **options,
) -> StreamingQuery:
    """Start appending a stream to files, a topic or an index.

    Each stream has its own checkpoint folder, so a restart goes on where the last run
    ended. Without ``every_seconds`` the stream takes what is there and stops.
    """
    writer = df.writeStream.outputMode("append").format(format)
    writer = writer.option("checkpointLocation", checkpoint).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if every_seconds is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{every_seconds} seconds")
    if format == "kafka":
        return writer.option("topic", target).start()
    return writer.start(target)


BATCH = "batch"  # partition column that names the micro-batch a row came with


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """A name that stays with a checkpoint folder, so that another one never replaces its batches."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/run")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(path):
        file = system.open(path)
        try:
            return file.readUTF()
        finally:
            file.close()
    name = uuid.uuid4().hex[:12]
    file = system.create(path, False)
    file.writeUTF(name)
    file.close()
    return name


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder that a job made for itself, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_batch(
    df: DataFrame, target: str, batch: str, format: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Write the rows of a micro-batch to files; written again, it replaces itself alone."""
    rows = df.withColumn(BATCH, F.lit(batch))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by, BATCH).format(format).save(target)


def each_batch(
    df: DataFrame,
    checkpoint: str,
    handle: Callable[[DataFrame, int, str], None],
    every_seconds: int | None = None,
) -> StreamingQuery:
    """Start handling a stream batch by batch: ``handle(rows, number, name)``.

    Numbers count from 0 and go on after a restart; a batch that was not finished comes again
    with its number, rows and name. So what is written under its name is written once.
    Without ``every_seconds`` the stream takes what is there and stops.
    """
    run = run_name(df.sparkSession, checkpoint)

    def one(rows: DataFrame, number: int) -> None:
        handle(rows, number, f"{run}-{number:09d}")

    writer = df.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    if every_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{every_seconds} seconds").start()

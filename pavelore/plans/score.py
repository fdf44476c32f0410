"""Score: point messages to scored points, as a stream.

    spark-submit -m pavelore.plans.score --models FOLDER --version V \\
        --source text --place FOLDER --out FOLDER --checkpoint FOLDER
"""

from __future__ import annotations

import argparse

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.model import keep_invalid, load_model
from ..schemas import SCORED
from ..session import prepare
from ..sources.files import check_contract, ensure_table, replace_partitions
from ..sources.streams import BATCH, each_batch, read_messages, write_batch
from ..streaming import scoring

ON_INVALID = ("error", "keep", "reject")
EVENT_DATE = T.StructField("event_date", T.DateType())
#: The scored table: the contract's columns, the map cell, and the partitions that the job writes.
SCORED_TABLE = T.StructType([*SCORED.fields, T.StructField("cell", T.LongType()), EVENT_DATE, T.StructField(BATCH, T.StringType())])
PARTITIONS = ["event_date", BATCH]


def scored_points(
    points: DataFrame, model: PipelineModel, on_invalid: str = "error", mode: str = "truncate"
) -> DataFrame:
    """Scored rows of decoded points.

    A category the model has not seen, or a missing number, stops the query with
    ``on_invalid="error"``. With ``"keep"`` the row is scored as far as its other values go;
    with ``"reject"`` such rows are left to :func:`rejected_points`.
    """
    if on_invalid not in ON_INVALID:
        raise ValueError(f"on_invalid must be one of {ON_INVALID}")
    points = scoring.derive_conditions(points, mode)
    if on_invalid == "reject":
        points = scoring.scoreable(points, model)
    if on_invalid == "keep":
        model = keep_invalid(model)
    return check_contract(scoring.shape_scored(model.transform(points)), SCORED)


def scored_messages(
    messages: DataFrame, model: PipelineModel, on_invalid: str = "error", mode: str = "truncate"
) -> DataFrame:
    """Scored rows of the readable messages; see :func:`scored_points`."""
    return scored_points(scoring.decode_readable(messages), model, on_invalid, mode)


def rejected_points(points: DataFrame, model: PipelineModel, mode: str = "truncate") -> DataFrame:
    """Decoded points the model cannot score."""
    return scoring.unscoreable(scoring.derive_conditions(points, mode), model)


def start(
    messages: DataFrame,
    model: PipelineModel,
    out: str,
    checkpoint: str,
    on_invalid: str = "error",
    every_seconds: int | None = None,
    table: str | None = None,
) -> list[StreamingQuery]:
    """Start the one stream that scores messages; in a list, to be waited for.

    Each micro-batch is parsed once and kept while its outputs are written: ``scored`` by
    event date, ``broken`` and, with ``"reject"``, ``rejected``. Every output is a folder of
    batches; one that is written again, after a crash between two outputs, replaces itself.

    ``table`` names a catalog table over the scored folder. It is created if need be; one that
    is there must have the contract's columns, types and partitions, and may have more
    columns. This is checked before the stream starts.
    """
    spark = messages.sparkSession
    if table is not None:
        ensure_table(spark, table, SCORED_TABLE, f"{out}/scored", PARTITIONS)

    def handle(rows: DataFrame, number: int, batch: str) -> None:
        parsed = scoring.parse(rows).persist()
        try:
            points = scoring.readable(parsed)
            scored = scoring.with_cell(scoring.with_event_date(scored_points(points, model, on_invalid)))
            scored = scoring.by_cell(scored)
            if table is None:
                write_batch(scored, f"{out}/scored", batch, partition_by=["event_date"])
            else:
                replace_partitions(scored.withColumn(BATCH, F.lit(batch)), table)
            write_batch(scoring.unreadable(parsed), f"{out}/broken", batch)
            if on_invalid == "reject":
                write_batch(rejected_points(points, model), f"{out}/rejected", batch)
        finally:
            parsed.unpersist()

    return [each_batch(messages, f"{checkpoint}/score", handle, every_seconds)]


def wait(spark: SparkSession, running: list[StreamingQuery]) -> None:
    """Wait until one stream ends, then stop the others; its failure is raised."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in running:
            query.stop()


def main() -> None:
    options = argparse.ArgumentParser(description=__doc__)
    for name in ("models", "version", "place", "out", "checkpoint"):
        options.add_argument(f"--{name}", required=True)
    options.add_argument("--source", default="text", choices=["text", "kafka"])
    options.add_argument("--servers", default="")
    options.add_argument("--on-invalid", default="error", choices=ON_INVALID)
    options.add_argument("--every-seconds", type=int)
    options.add_argument("--table", help="catalog table over the scored points")
    args = options.parse_args()
    spark = SparkSession.builder.appName("pavelore-score").getOrCreate()
    prepare(spark)
    settings = {"kafka.bootstrap.servers": args.servers} if args.source == "kafka" else {}
    messages = read_messages(spark, args.source, args.place, **settings)
    model = load_model(args.models, args.version)
    running = start(
        messages, model, args.out, args.checkpoint, args.on_invalid, args.every_seconds, args.table
    )
    wait(spark, running)


if __name__ == "__main__":
    main()

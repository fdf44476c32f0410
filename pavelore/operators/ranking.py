"""Global order: explicit ranks, top n, per-group top k, category codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

HEAP_LIMIT = 10_000  # up to this many rows a top-n is kept in each task's heap


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Number the rows 1, 2, ... in a total order, without a single-task sort.

    The range-sorted rows are checkpointed so that their partitions stay as they are; each
    row's rank is its place in its partition plus the rows of the partitions before it.
    Only the per-partition row counts pass through one task.
    """
    ordered = materialize(df.orderBy(*order)).withColumns(
        {"_part": F.spark_partition_id(), "_id": F.monotonically_increasing_id()}
    )
    sizes = ordered.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first")
    )
    before = F.sum("_rows").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select("_part", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    rank = (F.col("_id") - F.col("_first") + F.col("_before") + 1).cast("long")
    return (
        ordered.join(F.broadcast(offsets), on="_part")
        .withColumn(name, rank)
        .select(*df.columns, name)
    )


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows of a total order, in this order at every ``n``.

    ``HEAP_LIMIT`` only decides how they are found.
    """
    if n <= HEAP_LIMIT:
        return df.orderBy(*order).limit(n)
    found = global_rank(df, order, "_rank").filter(F.col("_rank") <= n)
    return found.orderBy("_rank").drop("_rank")


def top_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int
) -> DataFrame:
    """The first ``k`` rows of every group.

    Spark keeps no more than ``k`` rows per group and task before the shuffle.
    """
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= k).drop("_place")


def frequency_index(
    df: DataFrame, column: str, index: str | None = None, weight: str | None = None
) -> DataFrame:
    """Code per distinct value: 0 for the most frequent, ties in alphabetical order.

    ``weight`` names a column of row counts where the rows were counted before.
    """
    index = index or f"{column}_indexed"
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    sizes = df.filter(F.col(column).isNotNull()).groupBy(column).agg(size.alias("frequency"))
    ranked = global_rank(sizes, [F.desc("frequency"), F.asc(column)], "_rank")
    return ranked.select(
        column, "frequency", (F.col("_rank") - 1).cast("double").alias(index)
    )

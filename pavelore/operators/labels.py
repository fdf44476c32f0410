"""Condition counts and the 0-1 risk label."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..fixed import CONDITIONS, LABEL, MAX_TRAINING_CONDITIONS, ROAD_KEY
from ..functions.units import boxcox
from ..session import materialize
from .ranking import HEAP_LIMIT, top_n
from .roads import name_road_key
from .skew import fits_broadcast

GRID = 17  # exponents per round of the search
PIECES = 8  # tasks that the accidents of a street are dealt to
DEALT_ROWS = 250_000  # accidents that one task counts, about


def count_conditions(df: DataFrame, columns: Sequence[str] = CONDITIONS) -> DataFrame:
    """Rows per combination of the condition columns."""
    return df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(
        F.count(F.lit(1)).alias("count")
    )


def count_joined_conditions(
    accidents: DataFrame,
    roads: DataFrame,
    key: Sequence[str] = ROAD_KEY,
    columns: Sequence[str] = CONDITIONS,
) -> DataFrame:
    """Condition counts of accidents joined to roads.

    Equal to ``count_conditions(join_roads(...))``. Roads shrink to counts per key and type
    first, so a road listed many times never multiplies rows. Small roads are broadcast
    and the accidents shuffle once, for the count. Otherwise the accidents are dealt by key
    once, shrink to counts per key and condition where they lie, and meet the roads there.
    Every street is dealt in ``PIECES``, as one may have a large share of them. The number of
    tasks follows from the counted accidents, so what one task holds does not grow with them.
    """
    key = list(key)
    at_accident = [c for c in columns if c != "highway"]
    per_road = (
        name_road_key(roads)
        .dropna(subset=key)
        .groupBy(*key, "highway")
        .agg(F.count(F.lit(1)).alias("_roads"))
    )
    if fits_broadcast(per_road):
        joined = accidents.join(F.broadcast(per_road), on=key).withColumn("_accidents", F.lit(1))
    else:
        condition = [F.col(f"`{c}`") for c in at_accident]
        # by the split that a row is read from: it stays with a task that runs again, and a hash of
        # the columns would make the scan's code too long to be compiled
        piece = (F.spark_partition_id() % PIECES).alias("_piece")
        accidents = accidents.dropna(subset=key)
        least = int(accidents.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # also for many roads
        tasks = max(least, -(-accidents.count() // DEALT_ROWS))
        per_place = (
            accidents.select(*key, *condition, piece)
            .repartition(tasks, *key, "_piece")
            .groupBy(*key, "_piece", *condition)
            .agg(F.count(F.lit(1)).alias("_accidents"))
        )
        pieces = F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1)))
        joined = per_place.join(per_road.withColumn("_piece", pieces).hint("merge"), [*key, "_piece"])
    return joined.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(
        F.sum(F.col("_accidents") * F.col("_roads")).alias("count")
    )


def most_frequent(
    counts: DataFrame,
    n: int = MAX_TRAINING_CONDITIONS,
    tie_break: Sequence[str] = CONDITIONS,
) -> DataFrame:
    """The ``n`` most frequent conditions; ties are cut in the order of the other columns."""
    order = [F.col("count").desc(), *[F.col(f"`{c}`").asc() for c in tie_break]]
    if n <= HEAP_LIMIT:
        return top_n(counts, n, order)
    counts = materialize(counts)
    if counts.count() <= n:
        return counts
    return top_n(counts.filter(F.col("count") >= _lowest_kept(counts, n)), n, order)


def _lowest_kept(counts: DataFrame, n: int) -> int:
    """The count of the n-th most frequent condition.

    One row per distinct count passes through the window. Distinct counts add up to no
    more than the number of accidents, so there are few of them.
    """
    sizes = counts.groupBy("count").agg(F.count(F.lit(1)).alias("rows"))
    upto = F.sum("rows").over(
        Window.orderBy(F.desc("count")).rowsBetween(Window.unboundedPreceding, 0)
    )
    reached = sizes.withColumn("upto", upto).filter(F.col("upto") >= n)
    return reached.agg(F.max("count")).first()[0]


def boxcox_lambda(
    df: DataFrame,
    column: str,
    low: float = -4.0,
    high: float = 4.0,
    precision: float = 1e-7,
) -> float:
    """Maximum-likelihood exponent of the power transform of a positive column.

    The column is reduced to (value, weight) pairs. Each round evaluates a grid of
    exponents in one aggregate with one row per exponent. A grid whose best point lies on
    its edge moves outward; otherwise the next grid is a finer one around the vertex of
    the parabola through the best point and its neighbours.
    """
    pairs = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("x"))
        .agg(F.count(F.lit(1)).cast("double").alias("w"))
        .select("w", F.log("x").alias("lx"))
        .persist()
    )
    try:
        shape = pairs.agg(
            (F.sum(F.col("w") * F.col("lx")) / F.sum("w")).alias("mean"),
            F.count(F.lit(1)).alias("distinct"),
        ).first()
        if shape["distinct"] < 2:
            raise ValueError(f"all values of {column!r} are equal: no exponent can be fitted")
        centred = pairs.select("w", (F.col("lx") - F.lit(shape["mean"])).alias("t"))
        while True:
            step = (high - low) / (GRID - 1)
            grid = [low + i * step for i in range(GRID)]
            loss = _boxcox_loss(centred, grid)
            best = min(range(GRID), key=loss.__getitem__)
            if best in (0, GRID - 1):
                width = high - low
                low, high = grid[best] - width, grid[best] + width
                if max(abs(low), abs(high)) > 1e3:
                    return grid[best]
                continue
            before, at, after = loss[best - 1 : best + 2]
            bend = before - 2 * at + after
            vertex = grid[best] + (0.5 * step * (before - after) / bend if bend > 0 else 0.0)
            if step <= precision * 1e4 or bend <= 0:
                return vertex
            low, high = vertex - step / 8, vertex + step / 8
    finally:
        pairs.unpersist()


def _boxcox_loss(centred: DataFrame, grid: list[float]) -> list[float]:
    """Log variance of the transformed values per exponent, in grid order.

    With values scaled by their geometric mean the likelihood is -n/2 times this.
    """
    lam, t, w = F.col("lam"), F.col("t"), F.col("w")
    y = F.when(F.abs(lam) < 1e-9, t).otherwise(F.expm1(lam * t) / lam)
    rows = (
        centred.withColumn("lam", F.explode(F.array(*[F.lit(v) for v in grid])))
        .select("lam", "w", y.alias("y"))
        .groupBy("lam")
        .agg(F.sum("w").alias("n"), F.sum(w * F.col("y")).alias("s"), F.sum(w * F.col("y") ** 2).alias("q"))
        .select("lam", F.log(F.col("q") / F.col("n") - F.pow(F.col("s") / F.col("n"), 2)).alias("loss"))
    )
    found = {row["lam"]: row["loss"] for row in rows.collect()}
    return [found[v] if found[v] is not None else math.inf for v in grid]


def add_boxcox(df: DataFrame, column: str, lam: float, output: str, shift: float = 1) -> DataFrame:
    """Power-transform ``column + shift`` into ``output``."""
    return df.withColumn(output, boxcox(F.col(column) + F.lit(shift), lam))


def add_minmax(df: DataFrame, column: str, output: str = LABEL) -> DataFrame:
    """Scale a column to 0-1 by its smallest and largest value; null when they are equal."""
    ends = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    lo, hi = ends.getField("lo"), ends.getField("hi")
    return df.withColumn(output, (F.col(column) - lo) / F.nullif(hi - lo, F.lit(0.0)))


def risk_label(conditions: DataFrame) -> tuple[DataFrame, float]:
    """Add ``count_bc`` and the label to a condition table; also returns the exponent."""
    lam = boxcox_lambda(conditions.select((F.col("count") + 1).alias("x")), "x")
    return add_minmax(add_boxcox(conditions, "count", lam, "count_bc"), "count_bc"), lam

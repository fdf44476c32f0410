"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_SHARE = 1 / 256  # a key with more than this share of all rows is hot: at most 256 keys
SPREAD = 32  # pieces a hot key is cut into


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a DataFrame; None where it cannot be read."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:
        return None


def broadcast_limit(spark: SparkSession) -> int:
    return as_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB"))


def looks_small(df: DataFrame) -> bool:
    """Whether Catalyst's estimate is below the session's broadcast threshold."""
    size = estimated_bytes(df)
    return size is not None and 0 <= size <= broadcast_limit(df.sparkSession)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the rows are below the session's broadcast threshold.

    The estimate goes by the bytes of files, which may be packed a hundred times smaller than
    their rows, and does not see how many rows ``explode`` makes; so what looks small is counted.
    """
    if not looks_small(df):
        return False
    return df.count() * df._jdf.schema().defaultSize() <= broadcast_limit(df.sparkSession)


def as_bytes(setting: str) -> int:
    """Bytes of a size setting such as ``10485760b``, ``10MB`` or ``-1``."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)i?b?", setting.strip().lower()).groups()
    return int(number) * 1024 ** " kmgtp".index(unit or " ")


def splits_hot_partitions(spark: SparkSession) -> bool:
    """Whether adaptive execution cuts oversized join partitions by itself."""
    on = [
        spark.conf.get(f"spark.sql.adaptive.{name}", "true").lower() == "true"
        for name in ("enabled", "skewJoin.enabled")
    ]
    return all(on)


def hot_keys(df: DataFrame, on: list[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold more than ``share`` of all rows; no more than ``1/share`` rows.

    The rows are counted once, combined on the map side; the keys are small enough for the
    driver by definition.
    """
    sizes = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    limit = df.agg((F.count(F.lit(1)) * F.lit(share)).alias("_limit")).scalar()
    rows = sizes.filter(F.col("_rows") > limit).select(*on).collect()
    return df.sparkSession.createDataFrame(rows, df.select(*on).schema)


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    spread_by: list[str | Column] | None = None,
    salt: bool | None = None,
) -> DataFrame:
    """Equi-join of a possibly skewed left side.

    A right side below the broadcast threshold is broadcast. Beyond it the join shuffles,
    and a key with a large share of the rows is handled by many tasks: by adaptive
    execution where the session has it on, else (or with ``salt=True``) by salting.
    """
    if how not in ("inner", "left", "left_anti", "left_semi"):
        raise ValueError(f"unsupported join type {how!r}")
    if salt is None:
        if fits_broadcast(right):
            return left.join(F.broadcast(right), on=on, how=how)
        if looks_small(right) or looks_small(left):  # Catalyst would broadcast it by its estimate
            right = right.hint("merge")
        salt = not splits_hot_partitions(left.sparkSession)
    if not salt:
        return left.join(right, on=on, how=how)
    return salted_join(left, right, on, how, spread_by)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    spread_by: list[str | Column] | None = None,
    share: float = HOT_SHARE,
    pieces: int = SPREAD,
) -> DataFrame:
    """Equi-join that cuts the left rows of hot keys into pieces.

    Pieces follow a hash of ``spread_by`` (default: the whole row); only the right rows of
    hot keys are repeated per piece. The hash depends on row content alone, so a task that
    runs again produces the same pieces.
    """
    hot = F.broadcast(hot_keys(left.select(*on), on, share).withColumn("_hot", F.lit(True)))
    no_key = F.lit(False)
    for key in on:
        no_key = no_key | F.col(key).isNull()
    spread = [F.col(c) if isinstance(c, str) else c for c in spread_by or left.columns]
    piece = F.pmod(F.xxhash64(*spread), F.lit(pieces)).cast("int")
    cut_left = (
        left.join(hot, on=on, how="left")
        .withColumn("_piece", F.when(F.col("_hot") | no_key, piece).otherwise(0))
        .drop("_hot")
    )
    every_piece = F.sequence(F.lit(0), F.lit(pieces - 1))
    cut_right = (
        right.join(hot, on=on, how="left")
        .withColumn(
            "_piece", F.explode(F.when(F.col("_hot"), every_piece).otherwise(F.array(F.lit(0))))
        )
        .drop("_hot")
    )
    return cut_left.join(cut_right, on=[*on, "_piece"], how=how).drop("_piece")

"""Helpers that several operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


EDGES_TOGETHER = 100_000  # edges of a component search that one task keeps, about


def small_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Bound the bytes of an Arrow batch, so that a batch of long texts fits in memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def fold(key: str, folds: int) -> Column:
    """Number of the fold of a row: crc32 of the key as text, modulo the folds."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``a, b``; a component is its smallest node.

    Alternates two steps until nothing changes: every node hands its smallest neighbour to
    its larger neighbours, then to its smaller ones. Each step shuffles the edges once, by
    node; the minimum is combined before the shuffle, so a node with very many edges
    costs no more than its edges. Null nodes and loops are left out.
    """
    kept = F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    edges = materialize(edges.select("a", "b").filter(kept).distinct())
    # Rounds are many and edges only get fewer: few edges are kept in few files.
    parts = 1 + edges.count() // EDGES_TOGETHER
    edges, before = edges.coalesce(parts), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(
            small.unionByName(least.select("a", F.col("m").alias("b")))
            .filter("a != b")
            .distinct()
            .coalesce(parts)
        )
        state = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_003).alias("h")
        ).first()
        if before == tuple(state):
            break
        before = tuple(state)
    found = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return found.unionByName(roots.join(found.select("node"), "node", "left_anti"))

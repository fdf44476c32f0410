"""Near-duplicate documents from band buckets, with links confirmed on whole sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import connected_components, small_batches
from .shingles import set_id, shingle_set

TOGETHER = 1_500  # documents of a block that are compared with those of another one


def sketched(
    docs: DataFrame, bands: Callable[[np.ndarray], np.ndarray], width: int, id_col: str, text_col: str
) -> DataFrame:
    """``doc_id, n_shingles, high, low, bands`` of every row; the set's name and its bands.

    ``bands`` maps a set of shingles to 64-bit numbers. A text without words has null there.
    """
    small_batches(docs.sparkSession)
    key_type = docs.schema[id_col].dataType
    long = T.LongType()
    fields = [("doc_id", key_type), ("n_shingles", long), ("high", long), ("low", long), ("bands", T.ArrayType(long))]
    schema = T.StructType([T.StructField(*f) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names, found = [], [], []
            for text in batch.column(1).to_pylist():
                shingles = shingle_set(text, width)
                sizes.append(len(shingles))
                names.append(set_id(shingles) if len(shingles) else (None, None))
                found.append(bands(shingles).view(np.int64) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()),
                    pa.array([n[0] for n in names], pa.int64()),
                    pa.array([n[1] for n in names], pa.int64()),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                names=schema.names,
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def whole_sets(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``node, shingles``: the whole shingle set of every row."""
    fields = [T.StructField("node", docs.schema[id_col].dataType), T.StructField("shingles", T.ArrayType(T.LongType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t, width).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "shingles"]
            )

    return docs.select(id_col, text_col).mapInArrow(run, T.StructType(fields))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets have ``100 * intersection >= percent * union``."""
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("in_b"))
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("in_a"))
    both = pairs.join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("in_a", "in_b")).cast("long")
    union = F.size("in_a") + F.size("in_b") - shared
    return both.filter(shared * 100 >= union * percent).select("a", "b").distinct()


def open_buckets(buckets: DataFrame, links: DataFrame) -> DataFrame:
    """``key, node, component`` of the buckets with members in several components."""
    joined = connected_components(links)
    members = buckets.select("key", "node").join(joined, "node", "left")
    members = members.select("key", "node", F.coalesce("component", "node").alias("component"))
    ends = members.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    return members.join(ends.filter("x != y").select("key"), "key")


def _cross_links(percent: int):
    """Links between a left and a right block that join components, and no others."""

    def run(table: pa.Table) -> pa.Table:
        node, component = (table.column(c).to_pylist() for c in ("node", "component"))
        left = table.column("left").to_pylist()
        shingles = table.column("shingles").combine_chunks()
        shingles = shingles.combine_chunks() if isinstance(shingles, pa.ChunkedArray) else shingles
        starts, values = shingles.offsets.to_numpy(), shingles.values.to_numpy()
        sizes = np.diff(starts)
        owner = np.repeat(np.arange(len(node)), sizes)
        order = np.argsort(values, kind="stable")
        sorted_values, sorted_owner = values[order], owner[order]
        parent: dict = {}

        def root(x):
            while x in parent:
                x = parent[x]
            return x

        a, b = [], []
        for i in np.flatnonzero(left):
            own = values[starts[i] : starts[i + 1]]
            low = np.searchsorted(sorted_values, own, "left")
            count = np.searchsorted(sorted_values, own, "right") - low
            at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
            shared = np.bincount(sorted_owner[at], minlength=len(node))
            near = shared * 100 >= (sizes + sizes[i] - shared) * percent
            for j in np.flatnonzero(near):
                x, y = root(component[i]), root(component[j])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    a.append(node[i])
                    b.append(node[j])
        kind = table.column("node").type
        return pa.table({"a": pa.array(a, kind), "b": pa.array(b, kind)})

    return run


def remaining_links(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the components that still share a bucket; enough of them to join those.

    Nodes that may link, directly or by others, are a family. Its largest component is the
    major one. All minor nodes are compared with all others of the family, in tasks of a
    block of minor nodes and a block of major or minor ones. So a family of any size is
    cut into tasks of bounded size, pairs stay inside them, and a large component costs
    no more than its size for every block of nodes that are not in it.
    """
    hub = buckets.groupBy("key").agg(F.min("node").alias("a"))
    edges = buckets.join(hub, "key").select("a", F.col("node").alias("b"))
    families = connected_components(edges).withColumnRenamed("component", "family")
    nodes = buckets.select("node", "component").distinct().join(families, "node")
    sizes = nodes.groupBy("family", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("family").agg(
        F.max(F.struct("size", "component")).alias("major"), F.sum("size").alias("all")
    )
    blocks = lambda n: F.ceil(n / F.lit(TOGETHER)).cast("int")
    nodes = nodes.join(largest, "family").select(
        "node", "component", "family",
        (F.col("component") != F.col("major.component")).alias("minor"),
        blocks(F.col("all") - F.col("major.size")).alias("minors"),
        blocks(F.col("major.size")).alias("majors"),
    )
    place = F.pmod(F.xxhash64("node", F.lit(9)), F.when(F.col("minor"), F.col("minors")).otherwise(F.col("majors")))
    nodes = nodes.withColumn("block", place.cast("int"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)

    def task(i, major, j, left):
        return F.struct(i.alias("i"), F.lit(major).alias("with_major"), j.alias("j"), left.alias("left"))

    own = F.col("block")
    with_majors = F.transform(upto("majors"), lambda j: task(own, True, j, F.lit(True)))
    with_minors = F.transform(upto("minors"), lambda j: task(F.least(own, j), False, F.greatest(own, j), own <= j))
    as_major = F.transform(upto("minors"), lambda i: task(i, True, own, F.lit(False)))
    tasks = F.explode(F.when(F.col("minor"), F.concat(with_majors, with_minors)).otherwise(as_major))
    dealt = nodes.join(sets, "node").select("node", "component", "family", "shingles", tasks.alias("task"))
    dealt = dealt.select("node", "component", "shingles", "family", "task.*")
    kind = buckets.schema["node"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    return dealt.groupBy("family", "i", "with_major", "j").applyInArrow(_cross_links(percent), schema)


def link(
    docs: DataFrame,
    bands: Callable[[np.ndarray], np.ndarray],
    width: int,
    percent: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per input row.

    Equal sets are one class, named by its smallest id, before anything else is done; so a
    group of copies of any size is one row from there on. Classes that share a band are
    candidates. Not every pair of a bucket is formed: first each member is compared with
    one hub of its bucket (the smallest, then the member with most links), and
    what is joined already needs no further test. Where a bucket still has several
    components then, all that is left is compared block by block, inside tasks. So the
    components are those of all links between candidates.

    Hot buckets are safe: minima are combined before the shuffle, joins may be split.
    """
    sketch = materialize(sketched(docs, bands, width, id_col, text_col))
    first = F.min(F.struct("doc_id", "bands")).alias("first")
    classes = sketch.filter("bands IS NOT NULL AND doc_id IS NOT NULL").groupBy("high", "low").agg(first)
    classes = materialize(classes.select("high", "low", F.col("first.doc_id").alias("node"), "first.bands"))
    rows = classes.select("node", F.explode("bands").alias("key"))
    crowded = rows.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("most"))
    buckets = rows.join(crowded.filter("hub < most").select("key", "hub"), "key")
    buckets = materialize(buckets.select("key", "node", "hub"))
    named = buckets.select(F.col("node").alias(id_col)).distinct()
    texts = docs.select(id_col, text_col).join(named, id_col, "left_semi")
    sets = materialize(whole_sets(texts, width, id_col, text_col))

    hubs = buckets.filter("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    links = materialize(confirmed(hubs.distinct(), sets, percent))
    buckets = materialize(open_buckets(buckets, links))
    if not buckets.isEmpty():
        ends = links.select(F.col("a").alias("node")).unionAll(links.select("b"))
        degree = ends.groupBy("node").agg(F.count(F.lit(1)).alias("links"))
        strength = F.struct(F.coalesce("links", F.lit(0)).alias("links"), "node", "component")
        best = buckets.join(degree, "node", "left").groupBy("key").agg(F.max(strength).alias("hub"))
        pairs = buckets.join(best, "key").filter("component != hub.component")
        pairs = pairs.select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct()
        links = materialize(links.unionByName(confirmed(pairs, sets, percent)))
        buckets = materialize(open_buckets(buckets, links))
        if not buckets.isEmpty():
            links = materialize(links.unionByName(remaining_links(buckets, sets, percent)))
    joined = connected_components(links)
    named = classes.select("high", "low", "node").join(joined, "node", "left")
    named = named.select("high", "low", F.coalesce("component", "node").alias("component"))
    found = sketch.select("doc_id", "n_shingles", "high", "low").join(named, ["high", "low"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"))

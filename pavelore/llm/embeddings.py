"""Near-duplicate vectors by small-world graphs per shard."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import hnsw
from .common import connected_components

LEAST = 0.95
SHARDS = 4  # at least
SHARD_VECTORS = 50_000  # different vectors of a graph, about
ASKED_TOGETHER = 8_192  # queries that ask a graph at a time
GROUPS = 24  # of a graph and the queries that ask it, at least where there are queries enough
GRAPH_ROW = 1 << 20  # bytes of a graph in one row
BEAM = 48
AUDITED = 256  # queries asked at a time that are compared with all vectors of its shard
RECALL = 0.99  # of their links; below it the beam is doubled


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one, in double precision."""
    vectors = vectors.astype(np.float64)  # a copy; its rows are changed a part at a time
    for at in range(0, len(vectors), 4096):
        some = vectors[at : at + 4096]
        some /= np.abs(some).max(axis=1, keepdims=True)
        some /= np.linalg.norm(some, axis=1, keepdims=True)
    return vectors


def _matrix(table: pa.Table) -> np.ndarray:
    column = table.column("embedding").combine_chunks()
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(table), -1)


def _saved(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def pack_graph(vectors: np.ndarray, **more: np.ndarray) -> bytes:
    """A shard's vectors, as they came, with their graph, as bytes."""
    graph = hnsw.build(unit(vectors).astype(np.float32))
    layers = {}
    for level, (nodes, _, edges) in enumerate(graph.layers):
        layers |= {f"nodes{level}": nodes.astype(np.int32), f"edges{level}": edges.astype(np.int32)}
    return _saved(vectors=vectors, levels=np.array(len(graph.layers)), **layers, **more)


def unpack_graph(packed: bytes) -> tuple[hnsw.Graph, np.ndarray, dict]:
    """The graph, the unit vectors in double precision, and all arrays."""
    arrays = dict(np.load(io.BytesIO(packed)))
    exact = unit(arrays["vectors"])
    layers = []
    for level in range(int(arrays["levels"])):
        nodes, edges = (arrays[f"{k}{level}"].astype(np.int64) for k in ("nodes", "edges"))
        slot = np.full(len(exact), -1, dtype=np.int64)
        slot[nodes] = np.arange(len(nodes))
        layers.append((nodes, slot, edges))
    return hnsw.Graph(exact.astype(np.float32), layers), exact, arrays


def ask(graph: hnsw.Graph, exact: np.ndarray, queries: np.ndarray, least: float, beam: int = BEAM) -> list[np.ndarray]:
    """Nodes with a cosine of ``least`` or more per query; the beam widens until audits pass.

    ``queries`` are unit vectors in double precision, as is ``exact``; what the walk finds is
    verified with these. An audit compares an evenly spread part of the queries with all
    vectors of the shard. Once the beam is as wide as the shard the walk sees all it reaches.
    """
    audited = np.unique(np.linspace(0, len(queries) - 1, min(AUDITED, len(queries))).astype(int))
    true = [np.flatnonzero(row >= least) for at in range(0, len(audited), 16) for row in queries[audited[at : at + 16]] @ exact.T]
    wanted = sum(map(len, true))
    while True:
        loose = hnsw.search(graph, queries.astype(np.float32), least - 1e-4, beam)
        found = [f[exact[f] @ q >= least] for f, q in zip(loose, queries)]
        got = sum(len(np.intersect1d(t, found[a])) for t, a in zip(true, audited))
        if got >= RECALL * wanted or beam >= len(exact):
            return found
        beam *= 2


def near_vectors(vectors: DataFrame, least: float = LEAST, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per input row.

    Vectors with a cosine of ``least`` or more are linked; a component is named by its
    smallest id, whose row is kept. Equal vectors are one node with a weight, so a group of
    copies costs no more than one of them. Nodes are dealt to shards by a hash, each
    with a graph of its own. All nodes ask every shard, as many nodes as a shard has (fewer where tasks
    would be few) by a copy of its graph, in blocks. They give back
    the number of links per node and only so many links as join their components, not
    all pairs of a group. A graph travels in rows of ``GRAPH_ROW`` bytes.

    A vector that is null, empty, zero or has a null or non-finite component is linked with
    nothing, as is a row without id (which has no component and is kept). Vectors of
    different lengths are not compared. Rows that share an id are vectors of their own. Other
    columns are not looked at; no rows give no rows.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    named = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    name = {"x": F.xxhash64("embedding"), "y": F.xxhash64(F.lit(7), F.col("embedding"))}
    first = F.min(F.struct("vec_id", "embedding")).alias("first")
    classes = named.filter("usable").withColumns(name).groupBy("x", "y").agg(first, F.count(F.lit(1)).alias("weight"))
    classes = materialize(
        classes.select("x", "y", "weight", F.col("first.vec_id").alias("node"), "first.embedding", F.size("first.embedding").alias("width"))
    )
    n = classes.count()
    shards = max(SHARDS, -(-n // SHARD_VECTORS))
    pieces = max(1, -(-n // max(SHARD_VECTORS, ASKED_TOGETHER)), min(-(-n // ASKED_TOGETHER), -(-GROUPS // shards)))
    together, row_bytes = ASKED_TOGETHER, GRAPH_ROW
    part = lambda seed, parts: F.pmod(F.xxhash64("x", "y", F.lit(seed)), F.lit(parts)).cast("int")
    node_type = classes.schema["node"].dataType

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        nodes, weight = (table.column(c).to_numpy() for c in ("node", "weight"))
        packed = memoryview(pack_graph(_matrix(table), node=nodes, weight=weight))
        rows = [packed[at : at + row_bytes] for at in range(0, len(packed), row_bytes)]
        own = [pa.repeat(table.column(c)[0], len(rows)) for c in ("width", "shard")]
        return pa.table([*own, pa.array(range(len(rows)), pa.int32()), pa.array(map(bytes, rows), pa.binary())], names=["width", "shard", "seq", "packed"])

    dealt = classes.withColumn("shard", part(1, shards))
    graphs = materialize(dealt.groupBy("width", "shard").applyInArrow(build, "width int, shard int, seq int, packed binary"))

    def links(asking: pa.Table, shard: pa.Table) -> pa.Table:
        if not len(asking) or not len(shard):
            return pa.table({"a": pa.nulls(0, kind), "b": pa.nulls(0, kind), "n": pa.nulls(0, pa.int64())})
        asking = asking.sort_by("node")
        nodes, vectors = asking.column("node").to_numpy(), _matrix(asking)
        graph, exact, arrays = unpack_graph(b"".join(shard.sort_by("seq").column("packed").to_pylist()))
        parent: dict = {}

        def root(x):
            while x in parent:
                x = parent[x]
            return x

        a, b, counts = [], [], []
        for at in range(0, len(nodes), together):
            found = ask(graph, exact, unit(vectors[at : at + together]), least)
            for node, near in zip(nodes[at : at + together].tolist(), found):
                other = arrays["node"][near]
                near = near[other != node]
                counts.append(int(arrays["weight"][near].sum()))
                for far in arrays["node"][near].tolist():
                    x, y = root(node), root(far)
                    if x != y:
                        parent[max(x, y)] = min(x, y)
                        a.append(node)
                        b.append(far)
        joined = [*nodes.tolist(), *a], [None] * len(nodes) + b, counts + [None] * len(a)
        return pa.table([pa.array(joined[0], kind), pa.array(joined[1], kind), pa.array(joined[2], pa.int64())], names=["a", "b", "n"])

    kind = pa.int64() if isinstance(node_type, T.LongType) else pa.int32()
    schema = T.StructType([T.StructField("a", node_type), T.StructField("b", node_type), T.StructField("n", T.LongType())])
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    asking = classes.select("node", "embedding", "width", part(2, pieces).alias("piece"), everywhere)
    copies = graphs.select("*", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("piece"))
    by = ["width", "shard", "piece"]
    found = materialize(asking.groupBy(*by).cogroup(copies.groupBy(*by)).applyInArrow(links, schema))
    components = connected_components(found.filter("b IS NOT NULL"))
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    known = classes.select("x", "y", "weight", "node").join(counts, "node", "left").join(components, "node", "left")
    known = known.select(
        "x", "y", F.lit(True).alias("usable"), (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n"),
        F.coalesce("component", "node").alias("component"),
    )
    result = named.withColumns(name).join(known, ["x", "y", "usable"], "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    )
    kept = F.col("vec_id").isNull() | (F.col("vec_id") == F.col("component_id"))
    return result.withColumn("kept", kept)

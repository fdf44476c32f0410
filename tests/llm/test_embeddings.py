import numpy as np
import pytest

from pavelore.llm import embeddings, hnsw
from pavelore.llm.queries import QUERIES
from pavelore.session import materialize

SCHEMA = "vec_id long, embedding array<float>, node string, label int"


def brute(rows, least=0.95):
    """Links and component of each row, from the cosines of all pairs."""
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    parent = {i: i for i, _ in rows}
    links = dict.fromkeys(parent, 0)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(good):
        for j, y in good[:a]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                links[i] += 1
                links[j] += 1
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    return {i: (links[i], i if i is None else root(i)) for i in parent}


def corpus(n=300, width=24):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(n):
        base = rng.normal(size=width)
        rows.append(base)
        if i % 10 == 0:
            rows += [base + rng.normal(size=width) * s for s in rng.uniform(0, 0.4, 6)]
        if i % 50 == 0:
            rows += [base, base * 2, -base]
    rows += [rows[0] + rng.normal(size=width) * 0.05 for _ in range(120)] + [rows[5]] * 60
    return [(int(i), rows[j].astype(np.float32).tolist()) for i, j in enumerate(rng.permutation(len(rows)))]


@pytest.mark.parametrize("shard,asked", [(50_000, 8192), (60, 100)])
def test_links_equal_brute_force(spark, monkeypatch, shard, asked):
    monkeypatch.setattr(embeddings, "SHARD_VECTORS", shard)
    monkeypatch.setattr(embeddings, "ASKED_TOGETHER", asked)
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = embeddings.near_vectors(docs).collect()
    want = brute(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_graphs_travel_in_small_rows(spark, monkeypatch):
    """No row holds a whole graph, and a graph is copied for many blocks of queries at once."""
    rows = []

    def kept(df):
        df = materialize(df)
        if "packed" in df.columns:
            rows.extend(df.selectExpr("shard", "seq", "length(packed) AS n").collect())
        return df

    for name, value in (("materialize", kept), ("GRAPH_ROW", 5000), ("ASKED_TOGETHER", 10), ("GROUPS", 8)):
        monkeypatch.setattr(embeddings, name, value)
    some = corpus(100)
    docs = spark.createDataFrame([(*r, "x", 1) for r in some], SCHEMA)
    got = embeddings.near_vectors(docs)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got.collect()} == brute(some)
    assert len(rows) > 2 * embeddings.SHARDS and max(r.n for r in rows) == 5000


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, nan]), (6, [inf, 1.0]), (7, [1.0, 1.0]),
            (8, [1e38, 1e38]), (9, [1e-38, 1e-38]), (10, [-1.0, -1.0]), (11, [1.0, 1.0, 1.0]), (12, [2.0, 2.0, 2.0])]
    docs = spark.createDataFrame([(*r, "x", None) for r in [*rows, (None, [1.0, 1.0])]], SCHEMA)
    got = {r.vec_id: r for r in embeddings.near_vectors(docs).collect()}
    assert len(got) == len(rows) + 1
    assert {i: (r.n_links, r.component_id) for i, r in got.items() if i} == brute(rows)
    assert got[None].n_links == 0 and got[None].component_id is None and got[None].kept
    assert embeddings.near_vectors(docs.limit(0)).collect() == []


def test_repeated_rows_are_vectors_of_their_own(spark):
    docs = spark.createDataFrame([(1, [1.0, 2.0])] * 3 + [(2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    got = embeddings.near_vectors(docs).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 3, 1)] * 3 + [(2, 3, 1)]


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = embeddings.unit(np.array([r.embedding for r in rows], dtype=np.float32))
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    want = {r.vec_id: int(n) for r, n in zip(rows, near.sum(1))}
    got = {r.vec_id: r.n_links for r in QUERIES["op2_near_vectors"](spark, sf).collect()}
    assert all(got[i] <= n for i, n in want.items())
    assert sum(got.values()) >= 0.99 * sum(want.values())


@pytest.mark.parametrize("n", [1, 2, 5, 100, 1500])
def test_graph_finds_neighbours(n):
    rng = np.random.default_rng(n)
    x = embeddings.unit(rng.normal(size=(n, 16))).astype(np.float32)
    graph, exact, _ = embeddings.unpack_graph(embeddings.pack_graph(x))
    assert all(graph.layers[0][2].shape == (n, hnsw.NEIGHBOURS) for _ in "1")
    least = 0.75
    found = embeddings.ask(graph, exact, exact, least)
    true = (exact @ exact.T >= least).sum()
    assert 0.95 * true <= sum(map(len, found)) <= true

import random
import re

import numpy as np
import pytest

from pavelore.llm import linking
from pavelore.llm.neardup import band_hashes, near_duplicates, sketch
from pavelore.llm.queries import QUERIES
from pavelore.llm.shingles import shingle_set


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def plain_set(text, width):
    w = words(text)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, width, percent=80):
    """Component per row: smallest id reachable over links, all pairs compared."""
    nodes = [(i, plain_set(t, width)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for at, (i, a) in enumerate(nodes):
        for j, b in nodes[:at]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i, _ in nodes}


def family(rng, base, n, changes):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rng.randint(0, changes)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(1000)}"
        out.append(" ".join(w))
    return out


def corpus():
    rng = random.Random(5)
    fresh = lambda n: " ".join(f"w{rng.randrange(60)}" for _ in range(n))
    texts = [fresh(rng.randint(1, 80)) for _ in range(60)]
    texts += family(rng, fresh(60), 60, 8) + family(rng, fresh(200), 40, 20) + family(rng, fresh(12), 20, 1)
    texts += ["the same text again"] * 30 + ["The SAME\ttext again", "same", "same", "SAME", "a b", "a b c"]
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("width", [2, 5])
def test_components_equal_brute_force(spark, width):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, key string, node int")
    want = brute(rows, width)
    got = near_duplicates(docs, width).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    texts = dict(rows)
    for r in got:
        assert r.n_shingles == len(plain_set(texts[r.doc_id], width))
        assert r.kept == (r.doc_id == r.component_id)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(None, "a b c d e f"), (None, None), (1, None), (2, ""), (3, " \n\t"), (4, "a b c d e f"), (4, "a b c d e f"),
            (5, "A B C D E F"), (6, long), (7, long + " z"), (8, "q"), (9, "q"), (9, "a b c d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} == {
        (None, None), (1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 6), (7, 6), (8, 8), (9, 8), (9, 4),
    }
    assert all(r.kept for r in got if r.doc_id in (None, 1, 2, 3, 4, 6))
    assert near_duplicates(docs.limit(0)).collect() == []


@pytest.mark.parametrize("n", [1, 3, 40, 300, 5000])
def test_sketch_is_full_and_estimates_jaccard(n):
    rng = np.random.default_rng(n)
    pool = rng.integers(0, 2**63, 3 * n + 3, dtype=np.uint64)
    total, agree, jaccard = 0, 0, 0
    for _ in range(12):
        a = np.unique(rng.permutation(pool)[: 2 * n + 1])
        b = np.unique(np.concatenate([a[: len(a) * 3 // 4], rng.permutation(pool)[:n]]))
        x, y = sketch(a), sketch(b)
        assert len(x) == 160 and (x > 0).all()
        agree += (x == y).sum()
        total += len(x)
        jaccard += len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs(agree / total - jaccard / 12) < 0.12
    assert len(band_hashes(x)) == 32


def test_sketch_ignores_order_and_repeats():
    assert (sketch(shingle_set("a b c a b c", 2)) == sketch(shingle_set("a b c a b c a b", 2))).all()


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op8_near_duplicates"](spark, sf).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(texts, 2)


@pytest.mark.parametrize("together", [3, 1500])
def test_many_copies_that_just_miss_each_other(spark, monkeypatch, together):
    """A family around the threshold, whose hubs do not join all that is linked."""
    monkeypatch.setattr(linking, "TOGETHER", together)
    calls, blocks = [], linking.remaining_links
    monkeypatch.setattr(linking, "remaining_links", lambda *a: calls.append(a) or blocks(*a))
    rng = random.Random(11)
    base = " ".join(f"v{i}" for i in range(60))
    rows = list(enumerate(family(rng, base, 80, 9) + family(rng, base, 40, 4)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 2)
    assert 1 < len(set(want.values())) < 100
    got = near_duplicates(docs, 2).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert calls


def test_clashing_columns_are_not_looked_at(spark):
    rows = corpus()[:40]
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    names = ["n_shingles", "component_id", "kept", "key", "node", "bucket", "id", "shingles"]
    clashing = spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    assert sorted(near_duplicates(clashing).collect()) == sorted(near_duplicates(plain).collect())

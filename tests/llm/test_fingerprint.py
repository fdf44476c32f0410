import hashlib
import random

import numpy as np
import pytest
from test_neardup import brute, corpus, plain_set

from pavelore.llm import fingerprint
from pavelore.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def check(rows, texts):
    """``texts`` in their order: id, text. Digests must match; likeness must be near Jaccard."""
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts)
    for i, (key, text) in enumerate(texts):
        following = texts[(i + 1) % len(texts)][1] or ""
        text = text or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        r = got[key]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for value, other in ((r.near_edited, edited), (r.near_next, following)):
            a, b = plain_set(text, 5), plain_set(other, 5)
            jaccard = len(a & b) / len(a | b) if a | b else 1.0
            assert value == pytest.approx(jaccard, abs=0.23)
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 512


def test_whole_table(spark):
    texts = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    check(QUERIES["op6_fingerprint"](spark, SF).collect(), texts)


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_any_order_and_number_of_partitions(spark, n):
    rng = random.Random(n)
    texts = [(i * 7 - 50, " ".join(f"é{rng.randrange(50)}" for _ in range(rng.choice([0, 3, 60])))) for i in range(n)]
    mixed = rng.sample(texts, n)
    docs = spark.createDataFrame([(*r, "x") for r in mixed], "doc_id long, text string, guest string").repartition(5)
    check(fingerprint.edited_pairs(docs).collect(), texts)


def test_odd_rows(spark):
    rows = [(None, "x y"), (1, None), (1, None), (2, ""), (3, "a " * 60_000), (4, "same"), (5, "same")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = fingerprint.edited_pairs(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[4].fingerprint == by[5].fingerprint and by[4].near_next == 1.0
    assert by[1].fingerprint == by[2].fingerprint and by[2].near_edited == 1.0
    assert by[None].n_chars == 3
    assert fingerprint.edited_pairs(docs.limit(0)).collect() == []


def test_near_duplicates_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in fingerprint.near_duplicates(docs).collect()}
    assert got == brute(rows, 5)


def test_signature_is_the_least_hash():
    x = np.random.default_rng(0).integers(0, 2**32, 1300, dtype=np.uint64)
    for row in (0, 17, 127):
        a, b = int(fingerprint._A[row, 0]), int(fingerprint._B[row, 0])
        least = min((a * int(v) + b) % 2**64 for v in x)
        assert int(fingerprint.signature(x)[row]) == least >> 32


def test_clashing_columns_are_not_looked_at(spark):
    rows = corpus()[:40]
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    names = ["fingerprint", "edited_fingerprint", "_key", "_range", "guest", "place", "n_chars", "key"]
    clashing = spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    assert sorted(fingerprint.edited_pairs(clashing).collect()) == sorted(fingerprint.edited_pairs(plain).collect())
    assert sorted(fingerprint.near_duplicates(clashing).collect()) == sorted(fingerprint.near_duplicates(plain).collect())

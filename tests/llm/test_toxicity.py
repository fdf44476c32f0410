import random

import numpy as np
import pytest

from pavelore.llm import toxicity
from pavelore.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op4_toxicity"](spark, SF).join(labels, "doc_id").filter("held_out").collect()
    toxic = [r for r in rows if r.toxic]
    assert len(toxic) > 50
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) > 0.95
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.8
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def made(n, share, seed):
    """Feature sets in which numbers below 5 mark class 1, and the classes."""
    rng = random.Random(seed)
    y = [rng.random() < share for _ in range(n)]
    sets = [{*rng.sample(range(100, 400), 30), *(rng.sample(range(5), 2) if t else ())} for t in y]
    return [np.array(sorted(s)) for s in sets], np.array(y)


def test_finds_the_class_from_positives_and_unlabelled_only():
    x, y = made(4000, 0.2, 1)
    positive = [f for f, t in zip(x[:2000], y) if t][:200]
    model = toxicity.fit(positive, x[:2000], prior=0.2)
    again = toxicity.fit(positive, x[:2000], prior=0.2)
    assert model == again
    z = np.array([model.bias + sum(model.weight.get(int(f), 0) for f in fs) for fs in x[2000:]])
    assert np.mean((z > 0) == y[2000:]) > 0.97


def test_no_positives_no_model(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, "c"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    assert toxicity.learn(docs, labels) is None
    got = toxicity.score(docs, None).collect()
    assert [(r.score, r.predicted) for r in got] == [(0.0, 0)] * 3
    assert toxicity.learn(docs.limit(0), labels) is None
    assert toxicity.score(docs.limit(0), None).collect() == []


@pytest.mark.parametrize("text", [None, "", "  \n", "a " * 100_000, "Loser!"])
def test_odd_texts_and_clashing_columns(spark, text):
    model = toxicity.Model({f: 9.0 for f in toxicity.features("loser")}, -2.0)
    docs = spark.createDataFrame([(1, text, "x"), (1, text, "x")], "doc_id long, text string, score string")
    got = toxicity.score(docs, model)
    assert got.columns == ["doc_id", "text", "score", "predicted"]
    assert [r.predicted for r in got.collect()] == [int(text == "Loser!")] * 2


def test_whole_text_counts():
    model = toxicity.Model({f: 9.0 for f in toxicity.features("loser")}, -2.0)
    assert model.score("word " * 50_000 + "loser") > 0.9 > model.score("word " * 50_000)

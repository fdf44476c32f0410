"""Every registered query against its SQL twin at the smallest scale."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    ok, note = compare(spark, duck, name, SF)
    assert ok, note


@pytest.mark.parametrize("name", ["ml_train", "ml_score", "stream_score"])
def test_predictions_are_shares(spark, name):
    df = queries()[name](spark, SF)
    column = "danger_index" if "danger_index" in df.columns else "prediction"
    values = [r[0] for r in df.select(column).collect()]
    assert values and all(0 <= v <= 1 for v in values)


def test_saved_model_predicts_the_same(spark):
    row = queries()["ml_save_load"](spark, SF).first()
    assert row["rows"] > 0 and row["different"] == 0


def test_entry(spark):
    assert "row_count_norm" in entry(spark).columns


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())

"""Each stage of the pipeline against a brute-force version, on the stage's own input."""

import pytest
import test_lines
import test_mixing
import test_neardup
import test_packing

import corpus_pipeline
from pavelore.llm import language
from pavelore.llm.lines import BLANK

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found, columns = [docs], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, found[-1], SF).write.parquet(path)
        found.append(spark.read.parquet(path))
        if name != "packing":
            assert found[-1].columns == columns
    return found


def test_language_stage(spark, steps):
    by_hand = language.Compressors(language.dictionaries(steps[0]), language.LEVEL, language.CHUNK)
    want = {r.doc_id for r in steps[0].collect() if by_hand.choose(r.text)[1] >= language.MARGIN}
    assert {r.doc_id for r in steps[1].collect()} == want
    assert len(want) > 190


def test_line_stage(steps):
    rows = [(r.doc_id, r.text) for r in steps[1].collect()]
    removed = test_lines.brute(rows, 2)
    want = {}
    for i, text in rows:
        parts = text.split("\n")
        full = [at for at, p in enumerate(parts) if p.strip(BLANK)]
        if not full or len(removed[i]) < len(full):
            want[i] = "\n".join(p for at, p in enumerate(parts) if at not in removed[i])
    got = steps[2].collect()
    assert {r.doc_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_near_duplicate_stage(steps):
    component = test_neardup.brute([(r.doc_id, r.text) for r in steps[2].collect()], 5)
    assert {r.doc_id for r in steps[3].collect()} == {i for i, c in component.items() if i == c}


def test_mixing_stage(steps):
    rows = [(r.doc_id, r.text, r.source) for r in steps[3].collect()]
    _, taken = test_mixing.brute(rows)
    want = {i: taken[(i, s, t)] // max(1, len(t.split())) for i, t, s in rows}
    got: dict = {}
    for r in steps[4].collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {i: n for i, n in want.items() if n}


def test_packing_stage(steps):
    texts: dict = {}
    for r in steps[4].collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    ids: dict = {}
    for r in steps[5].collect():
        ids.setdefault(r.doc_id, []).append(r)
    assert set(ids) == set(texts)
    for key, pieces in ids.items():
        want = test_packing.direct(texts[key][0])
        assert sum(r.length for r in pieces) == len(want) * len(texts[key])


def test_run_gives_the_stages_result(spark, steps):
    assert corpus_pipeline.run(spark, SF).count() == steps[5].count()


def odd_documents(spark):
    """Null, empty, letterless, very long, repeated and tied rows beside the table's own, and clashing columns."""
    own = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    text = own[0][1]
    rows = [(None, text + " and more of it", "en", "web", 1), (9001, None, "en", "web", None), (9002, "", None, None, 0),
            (9003, "12 -- !!", "en", "web", 8), (9004, text * 300, None, None, 1), (9005, text, "en", "web", 1), (9005, text, "en", "web", 1),
            (9006, "word " * 30_000, "en", None, 1), (9007, " \n\n ", "en", "web", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, removed int, size double, kept boolean"
    return spark.createDataFrame([(*r, "s", i, 1.5, False) for i, r in enumerate(own[:60] + rows)], schema), len(rows) + 60


def test_stages_with_odd_rows_and_clashing_columns(spark, tmp_path):
    docs, n = odd_documents(spark)
    first = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SF)
        path = str(tmp_path / name)
        found.write.parquet(path)
        if name == "packing":
            assert spark.read.parquet(path).count() >= docs.count()
            break
        found = spark.read.schema(docs.schema).parquet(path)
        assert found.columns == docs.columns
        rows = found.collect()
        assert 0 < len(rows) and all(r.score == "s" and r.size == 1.5 and r.kept is False for r in rows)
        assert all(r.removed == first[r.doc_id].removed for r in rows if r.doc_id != 9005)
        assert not {9001, 9002, 9003, 9007} & {r.doc_id for r in rows}
        docs = found


def test_stages_of_no_rows(spark):
    docs, _ = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name


def test_stages_with_texts_that_are_null_or_empty_alone(spark):
    docs, _ = odd_documents(spark)
    bare = docs.filter("text IS NULL OR text = '' OR doc_id = 9003")
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, bare, SF).collect()
        assert len(rows) <= 6, name

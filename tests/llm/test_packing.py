import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from pavelore.llm.packing import Levels, pack
from pavelore.llm.queries import QUERIES, tokenizer_file
from pavelore.llm.tokens import KEPT_WORDS

SF = "/root/testdata/sf0.001"
PATH = tokenizer_file("word_bpe_49k.json")
ODD = [
    None, "", " \t\n", "a", "It's, well., 'S X.Y, 3.5, ... <|endoftext|> end", "É È ǰ J̌ İ  x y",
    "word " * 9000, "same", "same",
]


TOKENIZER = Tokenizer.from_file(PATH)
TOKENIZER.encode_special_tokens = True


def direct(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, texts, window=4096):
    """Every id in one piece; sequences gapless, full or of a power of two."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for key, pieces in by_doc.items():
        want = direct(texts[key])
        pieces.sort(key=lambda r: r.start)
        got = np.concatenate([np.frombuffer(r.ids, "<u4") for r in pieces]).tolist()
        assert got == want
        assert [r.start for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1]]
        assert {r.doc_tokens for r in pieces} == {len(want)}
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in pieces]).tolist()
        assert [r.offset for r in pieces] == [0, *ends[:-1]]
        assert ends[-1] == window or ends[-1] & (ends[-1] - 1) == 0 and ends[-1] < window


def test_round_trip_on_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    check(pack(docs.repartition(3, "doc_id"), PATH).collect(), texts)


def test_odd_texts_and_clashing_columns(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, length int")
    check(pack(docs.coalesce(1), PATH, window=512).collect(), dict(enumerate(ODD)), 512)


def test_null_ids_and_repeated_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "c"), (1, "c")], "doc_id long, text string")
    rows = pack(docs, PATH).collect()
    tokens = {k: sum(r.length for r in rows if r.doc_id == k) for k in (None, 1)}
    assert tokens == {None: len(direct("a b")), 1: 2 * len(direct("c"))}


def test_many_words_are_let_go_when_a_task_ends(spark):
    made = "concat_ws(' ', transform(sequence(1, 6000), j -> concat('w', id, 'x', j)))"
    docs = spark.range(20).selectExpr("id AS doc_id", f"{made} AS text")
    assert pack(docs.coalesce(1), PATH).selectExpr("sum(length) AS n").first().n > KEPT_WORDS

    def held(batches):
        import pyarrow as pa

        from pavelore.llm.tokens import word_ids

        for _ in batches:
            encoder = word_ids(PATH)
            yield pa.RecordBatch.from_pydict({"n": [len(encoder.words) + len(encoder.older)]})

    rows = spark.range(8, numPartitions=8).mapInArrow(held, "n long").collect()
    assert len(rows) == 8 and max(r.n for r in rows) <= KEPT_WORDS


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack(docs, PATH).collect() == []


def test_level_choice_equals_trying_all():
    rng = np.random.default_rng(1)
    levels, window = Levels(64), 64

    def squares(count):
        return int((count[1:window] ** 2).sum())

    for size in rng.integers(1, 64, 600):
        results = {}
        for level in range(0, window - size + 1):
            if level and not levels.count[level]:
                continue
            trial = levels.count.copy()
            trial[level] -= 1 if level else 0
            trial[level + size] += 1
            results[level] = squares(trial)
        assert results[levels.choose(int(size))] == min(results.values())
        levels.place(None, int(size))


def test_query_digests(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op1_pack"](spark, SF).collect():
        ids = np.array(direct(docs[r.doc_id])[r.start : r.start + r.length], dtype="<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32


@pytest.mark.parametrize("column", ["doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"])
def test_query_types(spark, column):
    assert dict(QUERIES["op1_pack"](spark, SF).dtypes)[column] == "bigint"

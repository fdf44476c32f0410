import hashlib
import random
import re

import pytest

from pavelore.llm import infilling
from pavelore.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", "a", "ab", "é", "漢字 and letters", "x <P> y", "<M>", "< P><", "tail <", "<S", "P>S>M>", "\x00\n\r\n ", "\U0001f600\U0001f600 ok",
    "word " * 20_000, "ab" * 300_000, "é" * 200_000, "same text here", "same text here",
]


def brute(key, text, plain=10, spm=20):
    """The contract by string operations."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digits = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[i : i + 8], 16) for i in (0, 8, 16, 24))
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(part) for part in (units[:low], units[low:high], units[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100 - plain:
        return n, "plain", None, None, text
    if h4 % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def compare(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(r.doc_id, texts[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == want[:4]
        assert r.output_sha256 == sha(want[4]) and r.restored_sha256 == sha(texts[r.doc_id])
    return {r.form for r in rows}


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert compare(QUERIES["op11_fill_in_middle"](spark, SF).collect(), texts) == {"plain", "psm", "spm"}
    assert "op11_fill_in_middle" in ORACLES


@pytest.mark.parametrize("shift", [0, 100, 200, 300])
def test_odd_texts_round_trip(spark, shift):
    texts = {i + shift: t for i, t in enumerate(ODD)}
    docs = spark.createDataFrame([(*r, "x", 1.5) for r in texts.items()], "doc_id long, text string, form string, n double")
    got = infilling.fill_in_middle(docs.repartition(3))
    compare(got.collect(), texts)
    for r in infilling.restore(got).collect():
        assert r.restored == (texts[r.doc_id] or "") and r.output == brute(r.doc_id, texts[r.doc_id])[4]


def test_null_ids_repeats_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "some words"), (1, "c d"), (1, "c d")], "doc_id long, text string")
    got = infilling.fill_in_middle(docs).collect()
    assert len(got) == 3
    for r in got:
        want = brute(r.doc_id, "c d" if r.doc_id else "some words")
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == want
    assert infilling.fill_in_middle(docs.limit(0)).collect() == []


def test_shares_are_parameters(spark):
    docs = spark.createDataFrame([(i, f"text {i} of some words") for i in range(60)], "doc_id long, text string")
    for plain, spm in ((100, 0), (0, 100), (0, 0)):
        rows = infilling.fill_in_middle(docs, plain, spm).collect()
        assert {r.form for r in rows} == {"plain" if plain else "spm" if spm else "psm"}
        assert all((r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.doc_id, f"text {r.doc_id} of some words", plain, spm) for r in rows)


def test_restore_of_odd_outputs(spark):
    rows = [("psm", "<P>a<S>b"), ("psm", "x<P>a<S>b<M>c"), ("other", "a"), (None, "a"), ("plain", None), ("psm", None), ("plain", "<P>"), ("spm", "<S><P><M>")]
    docs = spark.createDataFrame([(*r, "q") for r in rows], "form string, output string, restored string")
    assert [r.restored for r in infilling.restore(docs.coalesce(1)).collect()] == [None, None, None, None, None, None, "<P>", ""]


def test_cut_descriptors():
    rng = random.Random(3)
    for _ in range(500):
        text = bytes(rng.choices(b"abc", k=rng.randint(0, 12)))
        table = infilling.Pieces((memoryview(text),), [(0, 0, len(text))])
        x, y = sorted(rng.choices(range(len(text) + 1), k=2))
        cut = table.cut(x, y)
        assert [bytes(text[s : s + n]) for _, s, n in cut.parts] == [text[:x], text[x:y], text[y:]]
        again = cut.cut(rng.randint(0, len(text)))
        assert b"".join(again.stream()) == text and len(again.parts) == 4

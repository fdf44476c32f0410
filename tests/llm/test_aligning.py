import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from pavelore.llm import aligning
from pavelore.llm.queries import QUERIES, tokenizer_file

SF = "/root/testdata/sf0.001"
A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
TOKENIZER = Tokenizer.from_file(A)
TOKENIZER.encode_special_tokens = True
PIECES = SentencePieceProcessor(model_file=B)
SCHEMA = "doc_id long, text string"
ODD = [
    None, "", " ", "  two  spaces ", "a\n\nb ", "tabs\t and more　 ", "it's 3.5, <|endoftext|> <s> <0x41>", "▁x y",
    "漢字かな交じり文", "word " * 3000, "x" * 5000, "same text", "same text", "é é ퟿ \U0001f600\U0001f600", "\x00 \x1c \x85 .",
    " \n", "end\n", "a \nb", "‘quotes’ — dashes…", "zz​ zz",
]


def first_bytes(i):
    return b"".join(aligning.BYTES.get(c, c.encode()) for c in TOKENIZER.id_to_token(i))


def second_bytes(i):
    name = PIECES.id_to_piece(i)
    return bytes([int(name[3:5], 16)]) if PIECES.is_byte(i) else name.replace("▁", " ").encode()


def plain(text):
    """Both token lists with their ends, each tokenizer on the whole text."""
    if not text:
        return [], []
    found = []
    for ids, name in (
        (TOKENIZER.encode(" " + text, add_special_tokens=False).ids, first_bytes),
        (PIECES.encode(text), second_bytes),
    ):
        parts = [name(i) for i in ids]
        if b"".join(parts) != (" " + text).encode():
            return [], []
        found.append(list(zip(ids, np.cumsum([len(p) for p in parts]).tolist())))
    return found


def brute(rows):
    """The contract's columns, by comparing all ends of a text."""
    links, notes = {}, {}
    for key, text in rows:
        a, b = plain(text)
        links[key] = [(x, y) for x, s in a for y, e in b if s == e] if len(a) * len(b) < 10**6 else [
            (x, dict((e, y) for y, e in b)[s]) for x, s in a if s in {e for _, e in b}
        ]
        cuts, groups, low = sorted({s for _, s in a} & {e for _, e in b}), [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(x) for x, s in side if low < s <= cut) for side in (a, b)))
            low = cut
        notes[key] = (len(a), len(b), len(groups), ";".join(groups))
    counts = Counter(pair for found in links.values() for pair in found)
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return {
        key: (*notes[key][:3], len(found), sum(counts[p] == most[p[1]] for p in found), sum(counts[p] for p in found),
              hashlib.sha256(notes[key][3].encode()).hexdigest() if notes[key][0] else "")
        for key, found in links.items()
    }


def by_id(rows):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows}


def test_odd_texts_equal_brute_force(spark):
    rows = [(i, t if t is None or len(t) < 3000 else t[:900]) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame([(*r, 5) for r in rows], SCHEMA + ", n_a int").repartition(3)
    got = aligning.align_tokenizers(docs, A, B).collect()
    assert by_id(got) == brute(rows)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("n_chars").collect()
    short = [(r.doc_id, r.text) for r in docs if len(r.text or "") < 3000]
    got = by_id(QUERIES["op12_align"](spark, SF).collect())
    assert len(got) == len(docs)
    whole = spark.createDataFrame(short, SCHEMA)
    assert by_id(aligning.align_tokenizers(whole, A, B).collect()) == brute(short)
    for key, text in ((r.doc_id, r.text) for r in docs):
        a, b = plain(text)
        ends = {s for _, s in a} & {e for _, e in b}
        assert got[key][:4] == (len(a), len(b), len(ends), len(ends))


def test_both_libraries_give_the_ids_of_the_first_tokenizer(spark, monkeypatch):
    both = aligning.encoders(A, B)
    assert both.ranks is not None
    texts = [t for t in ODD if t] + [" " * 3000 + "x", "\n" * 2000, "a1b22'llz'S ''tis", "x  y   \n\n z \t"]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect() if r.text]
    want = [TOKENIZER.encode(" " + t, add_special_tokens=False).ids for t in texts]
    assert [both._first(" " + t) for t in texts] == want
    assert len(both._first(" " * 2_000_000)) > 1000
    monkeypatch.setattr(both, "ranks", None)
    assert [both._first(" " + t) for t in texts] == want


def test_null_ids_repeated_rows_and_no_rows(spark):
    rows = [(None, "a b"), (1, "c"), (1, "c")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = aligning.align_tokenizers(docs, A, B).collect()
    assert sorted((r.doc_id or 0, r.n_links) for r in got) == [(0, 2), (1, 1), (1, 1)]
    assert {r.count_sum for r in got if r.doc_id} == {2}
    assert aligning.align_tokenizers(docs.limit(0), A, B).collect() == []


@pytest.mark.parametrize("density", [0.02, 0.3, 0.9])
def test_stretches_find_all_common_ends(density):
    rng = random.Random(density)
    for _ in range(300):
        n = rng.randint(1, 200)
        a, b = ({k for k in range(1, n) if rng.random() > density} | {n} for _ in range(2))
        a, b = np.array(sorted(a)), np.array(sorted(b))
        runs = aligning.stretches(a, b)
        got = [(i + t, j + t) for i, j, size in runs for t in range(size)]
        place = {int(e): j for j, e in enumerate(b)}
        assert got == [(i, place[int(e)]) for i, e in enumerate(a) if int(e) in place]


def test_all_linked_pairs_are_in_the_vocabularies_pairs():
    v = aligning.encoders(A, B).vocabularies
    assert len(v.pairs) < v.first_size.sum() + 2 * v.second_size.sum()
    a, b = TOKENIZER.encode(" sentence", add_special_tokens=False).ids[-1], PIECES.encode("sentence")[-1]
    assert v.pairs[v.pair(np.array([a]), np.array([b]))[0]] == a * len(v.second) + b


def test_notation_column(spark):
    docs = spark.createDataFrame([(1, "Hello tokenization world")], SCHEMA)
    r = aligning.aligned_documents(docs, A, B, groups=True).first()
    assert hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256
    assert r.groups.count(";") + 1 == r.n_groups == len(r.links) // 4

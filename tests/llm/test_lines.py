import random

import numpy as np
import pytest

from pavelore.llm import lines
from pavelore.llm.queries import QUERIES


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        fresh = [i]
        for j, y in enumerate(b, 1):
            fresh.append(min(row[j] + 1, fresh[-1] + 1, row[j - 1] + (x != y)))
        row = fresh
    return row[-1]


def change(rng, line, edits, letters="abc é"):
    out = list(line)
    for _ in range(edits):
        i, how = rng.randrange(len(out) + 1), rng.random()
        if how < 0.34:
            out.insert(i, rng.choice(letters))
        elif out:
            i = min(i, len(out) - 1)
            out[i : i + 1] = [] if how < 0.67 else [rng.choice(letters)]
    return "".join(out)


def brute(rows, edits):
    """Numbers of the lines that go, per document, with every pair of lines compared."""

    def alike(a, b):
        if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
            return True
        x, y = a.split(), b.split()
        most = min(len(x), len(y)) // 20
        return abs(len(x) - len(y)) <= most and most > 0 and len(set(x) - set(y)) <= most and distance(x, y) <= most

    first = {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for at, line in enumerate((text or "").split("\n")):
            if line.strip(lines.BLANK):
                first.setdefault(line, (i is None, i, at))
    order = list(first)
    gone = {
        b for k, b in enumerate(order) for a in order[:k]
        if min(len(a), len(b)) >= lines.LEAST_CHARS and alike(a, b)
    }
    removed = {}
    for i, text in rows:
        parts = (text or "").split("\n")
        removed[i] = [
            at for at, line in enumerate(parts)
            if line.strip(lines.BLANK) and (line in gone or first[line][1:] != (i, at))
        ]
    return removed


def corpus(n=40):
    rng = random.Random(n)
    bases = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(20, 70))) for _ in range(12)]
    rows = []
    for i in range(n):
        text = [rng.choice(["", " ", "short", change(rng, rng.choice(bases), rng.choice([0, 0, 1, 2, 3]))]) for _ in range(6)]
        rows.append((i, "\n".join(text)))
    return rows


@pytest.mark.parametrize("edits,most", [(2, 20_000), (2, 5), (1, 20_000), (3, 4)])
def test_lines_equal_brute_force(spark, monkeypatch, edits, most):
    monkeypatch.setattr(lines, "MOST_TOGETHER", most)
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, at string").repartition(3)
    got = lines.deduplicate_lines(docs, edits).collect()
    want = brute(rows, edits)
    assert {r.doc_id: r.removed for r in got} == want
    texts = dict(rows)
    for r in got:
        parts = texts[r.doc_id].split("\n")
        assert r.text == "\n".join(p for i, p in enumerate(parts) if i not in want[r.doc_id])
        assert r.n_lines == sum(bool(p.strip(lines.BLANK)) for p in parts)
    assert any(want.values())


def test_odd_rows(spark):
    line = "a line that is long enough to be compared"
    rows = [(None, line), (1, None), (2, ""), (3, " \n\t\n"), (4, line + "\n" + line), (5, line + "!"), (6, "漢字" * 20_000 + "\n" + line[:-1]),
            (7, "short"), (8, "short"), (8, "short"), (9, line[2:] + "zz")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_lines int")
    got = lines.deduplicate_lines(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[None].text == "" and by[1].text is None and by[1].n_lines == 0
    assert by[3].text == " \n\t\n" and by[4].removed == [1] and by[5].text == "" and by[6].removed == [1]
    assert by[7].text == "short" and by[8].text == "" and by[9].removed == []
    assert lines.deduplicate_lines(docs.limit(0)).collect() == []


@pytest.mark.parametrize("edits", [1, 2, 3, 5])
def test_banded_distance(edits):
    rng = random.Random(edits)
    for _ in range(3000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 30)))
        b = change(rng, a, rng.randint(0, edits + 2), "abc")
        assert lines.within(a, b, edits) == (distance(a, b) <= edits)


def keys_of(line, edits=2, words=False):
    """Indexed keys, all keys and counts of a line."""
    _, keys, marks = lines.line_keys([line, "x" * 30], edits)
    own = lines.line_keys([line], edits)
    assert set(own[1].tolist()) <= set(keys.tolist())
    chosen = ((own[2] & np.uint64(lines.INDEXED - 1)) >> np.uint64(32) > 0) == words
    keys, marks = own[1][chosen], own[2][chosen]
    return set(keys[marks >= lines.INDEXED].tolist()), set(keys.tolist()), marks[:1] & np.uint64(lines.COUNTS)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_near_lines_share_a_key_and_have_near_letter_counts(edits):
    rng = random.Random(edits)
    for _ in range(3000):
        a = "".join(rng.choice("abcdef") for _ in range(rng.randint(24, 60)))
        b = change(rng, a, rng.randint(0, edits), "abcdef")
        if len(b) < lines.LEAST_CHARS:
            continue
        x, y = keys_of(a, edits), keys_of(b, edits)
        assert x[0] & y[1] or y[0] & x[1]
        assert lines.counts_apart(x[2], y[2])[0] <= 2 * edits


def test_query_returns_every_document(spark):
    got = QUERIES["op3_lines"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 200 and sum(r.n_removed for r in got) > 0
    assert all(len(r.removed) == r.n_removed <= r.n_lines for r in got)


def altered(rng, line, edits):
    words = line.split()
    for _ in range(edits):
        i, how = rng.randrange(len(words)), rng.random()
        words[i : i + 1] = [] if how < 0.25 else [words[i], "added"] if how < 0.5 else [str(rng.randint(1000, 99999))]
    return " ".join(words)


@pytest.mark.parametrize("most", [20_000, 4])
def test_changed_words_of_long_lines_equal_brute_force(spark, monkeypatch, most):
    """Lines of 200 to 1,000 characters with whole words changed, added or dropped."""
    monkeypatch.setattr(lines, "MOST_TOGETHER", most)
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghik") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    bases = [" ".join(rng.choice(words) for _ in range(rng.randint(36, 160))) for _ in range(14)]
    texts = []
    for i in range(90):
        base = rng.choice(bases)
        texts.append(altered(rng, base, rng.randint(0, lines.word_edits(len(base.split())) + 3)))
    gone = set()
    for k, b in enumerate(texts):
        for a in texts[:k]:
            x, y = a.split(), b.split()
            if a == b or distance(x, y) <= min(len(x), len(y)) // 20:
                gone.add(k)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id for r in lines.deduplicate_lines(docs).collect() if r.removed}
    assert got == gone and 20 < len(gone) < 85


def test_near_word_runs_share_a_key():
    rng = random.Random(6)
    for _ in range(1500):
        a = " ".join(rng.choice("abcdefghik") for _ in range(rng.randint(20, 210)))
        b = altered(rng, a, rng.randint(0, lines.word_edits(len(a.split()))))
        if not lines.near(a, b, 0):
            continue
        x, y = keys_of(a, words=True), keys_of(b, words=True)
        assert x[0] & y[1] or y[0] & x[1]
        most = lines.word_edits(min(len(a.split()), len(b.split())))
        assert lines.counts_apart(x[2], y[2])[0] <= 2 * most


def test_character_edits_of_many_words_are_word_edits():
    """Lines of so many words have no character keys; each edit changes two words at most."""
    rng = random.Random(9)
    least = 2 * lines.MAX_EDITS * (lines.WORDS_PER_EDIT + 1)
    for _ in range(500):
        a = " ".join(rng.choice(["ab", "c", "def"]) for _ in range(rng.randint(least, least + 12)))
        b = change(rng, a, lines.MAX_EDITS, "ab  ")
        if len(b.split()) < least - 4:
            continue
        x, y = keys_of(a, words=True), keys_of(b, words=True)
        assert x[0] & y[1] or y[0] & x[1]
        assert lines.near(a, b, 0)
    assert not keys_of(a)[1] and keys_of(" ".join(["ab"] * (least - 1)))[1]


def test_keys_grow_with_the_words():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghik") for _ in range(5)) for _ in range(5000)]
    for n in (100, 1000, 20_000):
        line = " ".join(rng.choice(words) for _ in range(n))
        assert len(lines.line_keys([line], 2)[1]) < 0.6 * n


def test_very_long_lines(spark):
    """Lines of 20,000 words: near with up to 1,000 words changed."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghik") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    base = [rng.choice(words) for _ in range(20_000)]
    changed, far = base[:], base[:]
    for i in rng.sample(range(20_000), 900):
        changed[i] = "other"
    for i in rng.sample(range(20_000), 1100):
        far[i] = "another"
    texts = [" ".join(t) for t in (base, far, changed, base[:-940], base[500:], base[2000:])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id for r in lines.deduplicate_lines(docs).collect() if r.removed}
    assert got == {2, 3, 4}


@pytest.mark.parametrize("short", [2000, 10])
def test_many_variants_of_a_line(spark, monkeypatch, short):
    """5,000 numbered variants: far fewer pairs than all, and what brute force keeps."""
    made = []
    verify = lines.verified

    def counted(pairs, *rest):
        made.append(pairs.count())
        return verify(pairs, *rest)

    monkeypatch.setattr(lines, "verified", counted)
    monkeypatch.setattr(lines, "MOST_TOGETHER", 1500)
    monkeypatch.setattr(lines, "SHORT", short)
    texts = [f"This is notice number {i:04d} of our long list of notices." for i in range(5000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = [r.doc_id for r in lines.deduplicate_lines(docs).collect() if not r.removed]

    def apart(i, j):
        return lines.within(f"{i:04d}", f"{j:04d}", 2)

    assert got == [i for i in range(5000) if not any(apart(i, j) for j in range(i))]
    assert sum(made) < (5000 if short == 2000 else 5000 * 200)


@pytest.mark.parametrize("edits", [0, 1, 2, 3, 5])
def test_few_edits_are_found_along_diagonals(edits):
    rng = random.Random(edits)
    for _ in range(300):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(1, 25)))
        b = change(rng, a, rng.randint(0, edits + 2), "ab") or "a"
        want = distance(a, b) <= edits
        if len(b) > len(a):
            a, b = b, a
        assert lines.on_diagonals(a, b, edits) == lines.on_diagonals([*a], [*b], edits) == want


def test_few_edits_take_no_step_per_character(monkeypatch):
    monkeypatch.setattr(lines, "banded", None)
    rng = random.Random(1)
    same = "".join(rng.choice("ab ") for _ in range(2000))
    assert lines.within("x" + same + "y", "u" + same + "v", 2) and lines.within("x" + same, same + "y", 2)
    assert not lines.within("xx" + same + "y", "u" + same + "v", 2)
    assert lines.within(["x", *same, "y"], ["u", *same], 2)


def test_small_buckets_give_the_same_pairs_at_once():
    rng = np.random.default_rng(5)
    for of_words in (0, 40 << 32):
        sizes = rng.integers(2, lines.FEW + 1, 400)
        ends = np.cumsum(sizes)
        name = rng.integers(0, 12, ends[-1]).astype(np.uint64)  # a line may come twice in a bucket
        counts = rng.integers(0, 1 << 4, 12).astype(np.uint64) | np.uint64(of_words)
        marks = counts[name] | np.where(rng.random(len(name)) < 0.3, np.uint64(lines.INDEXED), np.uint64(0))
        got = {
            (min(p), max(p)) for x, y in lines._alike_of_small(ends - sizes, ends, name, marks, 1)
            for p in zip(x.tolist(), y.tolist())
        }
        want = set()
        for start, end in zip((ends - sizes).tolist(), ends.tolist()):
            x, y = lines._alike(name[start:end], marks[start:end], 1)
            want |= {(min(p), max(p)) for p in zip(x.tolist(), y.tolist())}
        assert got == want and want


def test_small_buckets_are_not_taken_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(lines, "_alike", None)
    rows = corpus(20)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    assert {r.doc_id: r.removed for r in lines.deduplicate_lines(docs).collect()} == brute(rows, 2)

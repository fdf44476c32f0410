import random

import pytest
import regex

from pavelore.llm.licenses import NOTICES, band_count, scan


def shingles(text):
    w = regex.sub(r"[^\p{L}\p{N}]+", " ", (text or "").lower()).split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, notices):
    found = set()
    for key, text in rows:
        own = shingles(text)
        for name, notice in notices:
            wanted = shingles(notice)
            if wanted and 100 * len(own & wanted) >= 80 * len(wanted):
                found.add((key, name, len(own & wanted), len(wanted), len(own & wanted) / len(wanted)))
    return found


def corpus():
    rng = random.Random(8)
    filler = lambda n: " ".join(rng.choice("alpha beta gamma delta license the of under".split()) for _ in range(n))
    rows = [(i, filler(rng.randint(0, 60))) for i in range(40)]
    for i in range(40, 130):
        words = rng.choice(NOTICES)[1].split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            words[rng.choice([0, -1, rng.randrange(len(words))])] = "changed"
        rows.append((i, filler(rng.randint(0, 40)) + "\n" + " ".join(words).upper() + "\n" + filler(rng.randint(0, 40))))
    return rows


def test_scan_equals_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, template_id string, band int")
    want = brute(rows, NOTICES)
    assert len({w[1] for w in want}) > 6
    assert {tuple(r) for r in scan(docs).collect()} == want


def test_odd_rows_and_notices(spark):
    notices = [("empty", " .. "), ("short", "Two words"), ("five", "one two three four five"), ("long", " ".join(f"w{i}" for i in range(60)))]
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(None, long), (1, None), (2, ""), (3, "--"), (4, "two WORDS!"), (5, "with two words"), (6, "x " * 60_000 + long), (7, "one-two three, four (five)"),
            (7, "one two three four five"), (8, " ".join(long.split()[3:])), (9, " ".join(long.split()[15:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in scan(docs, notices).collect()}
    assert got == brute(rows, notices)
    assert {(g[0], g[1]) for g in got} == {(None, "long"), (4, "short"), (6, "long"), (7, "five"), (8, "long")}
    assert scan(docs.limit(0), notices).collect() == []
    assert scan(docs, [("none", "")]).collect() == []


@pytest.mark.parametrize("alike,missed", [(0.5, 1e-4), (0.6, 1e-4), (0.9, 1e-6)])
def test_band_settings(alike, missed):
    n = band_count(alike, missed)
    assert (1 - alike) ** n <= missed < (1 - alike) ** (n - 1)


def test_clashing_columns_are_not_looked_at(spark):
    rows = corpus()[:60]
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    names = ["template_id", "n_shared", "key", "shingles", "band", "containment"]
    clashing = spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    assert sorted(scan(clashing).collect()) == sorted(scan(plain).collect()) != []

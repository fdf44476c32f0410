import base64
import gzip
import hashlib

import pytest

from pavelore.llm import warc
from pavelore.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string"
TRICKY = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n\n\n\r"
ROWS = [
    (1, "http://a/", "one payload"), (2, "http://b/", "one payload"), (3, None, "one payload"), (4, "http://d/\r\nX: y é", TRICKY),
    (5, "u", None), (6, "u", ""), (7, "", "é漢字\U0001f600" * 50), (8, "u", "x" * 10_000), (9, "u", "\n"), (10, "u", "\r\n\r\n"),
    (None, "u", "one payload"), (None, "v", "no id"), (11, "same", "same row"), (11, "same", "same row"), (11, "other", "same id"),
    (-3, "u", "é漢字\U0001f600" * 50),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows, least=0):
    largest = {}
    for key, _, text in rows:
        largest.setdefault(text or "", []).append(key)
    found = []
    for key, _, text in rows:
        raw = (text or "").encode()
        known = [k for k in largest[text or ""] if k is not None]
        response = max(known) if known else None
        revisit = len(raw) >= least and len(largest[text or ""]) > 1 and key != response
        found.append((key, len(raw), digest(text), "revisit" if revisit else "response", response if revisit else None))
    return sorted(found, key=str)


def seen(rows):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)


def archive(path):
    """All bytes of the archives of a folder."""
    return [gzip.decompress(f.read_bytes()) for f in sorted(path.glob("part-*.gz"))]


def plain_records(data):
    """Headers and block of each record, by the lengths that they give."""
    found, at = [], 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        assert version == "WARC/1.1"
        head = dict(line.split(": ", 1) for line in lines)
        size = int(head["Content-Length"])
        found.append((head, data[end + 4 : end + 4 + size]))
        at = end + 4 + size + 4
        assert data[at - 4 : at] == b"\r\n\r\n"
    return found


@pytest.mark.parametrize("chunk,least", [(1 << 20, 0), (7, 0), (64, 9), (1, 12)])
def test_round_trip_equals_brute_force(spark, tmp_path, chunk, least):
    path = str(tmp_path / "out")
    rows = [r for r in ROWS if chunk > 1 or len(r[2] or "") < 500]
    pages = spark.createDataFrame([(*r, "z") for r in rows], SCHEMA + ", digest string").repartition(3)
    warc.write_archives(pages, path, chunk, least)
    read = warc.read_archives(spark, path, chunk)
    got = warc.records(read).collect()
    assert seen(got) == brute(rows, least)
    assert all(r.verified for r in got if r.record_type == "response")
    texts = {}
    for r in sorted(read.collect(), key=lambda r: r.chunk_no):
        if r.record_type == "response":
            texts.setdefault((r.record_id, r.page_id), []).append(r.payload)
            assert len(r.payload) <= chunk
            assert r.payload_bytes == sum(map(len, texts[r.record_id, r.page_id])) or (r.page_id == 11)
    wanted = {text or "" for _, _, text in rows}
    assert {b"".join(parts).decode() for (_, key), parts in texts.items() if key != 11} >= wanted - {"same row", "same id"}


def test_written_archives_are_valid(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    warc.write_archives(pages.repartition(2), str(tmp_path / "out"), chunk=16)
    found = [r for data in archive(tmp_path / "out") for r in plain_records(data)]
    kinds = [head["WARC-Type"] for head, _ in found]
    assert kinds.count("response") + kinds.count("revisit") == len(ROWS) and "continuation" in kinds
    by_id = {head["WARC-Record-ID"]: head for head, _ in found}
    for head, block in found:
        if head["WARC-Type"] == "revisit":
            target = by_id[head["WARC-Refers-To"]]
            assert target["WARC-Type"] == "response" and target["Page-ID"] == head["Refers-To-Page-ID"]
            assert target["WARC-Payload-Digest"] == head["WARC-Payload-Digest"] and block.endswith(b"\r\n\r\n")
        if head["WARC-Type"] == "continuation":
            assert int(head["WARC-Segment-Number"]) > 1 and by_id[head["WARC-Segment-Origin-ID"]]["WARC-Segment-Number"] == "1"


def test_whole_table(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    got = QUERIES["op13_warc"](spark, SF)
    assert seen(got.collect()) == brute(pages)
    assert got.columns[:5] == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert "op13_warc" in ORACLES


def foreign(*blocks, kind="resource"):
    return [b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:x:%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (kind.encode(), i, len(b), b)
            for i, b in enumerate(blocks)]


def test_archives_compressed_record_by_record(spark, tmp_path):
    blocks = [b"first\n\n", b"", bytes(range(256)) * 40, TRICKY.encode()]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in foreign(*blocks) + foreign(b"left out", kind="request")))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(b"".join(foreign(b"other"))))
    got = warc.read_archives(spark, str(tmp_path), chunk=1000).collect()
    parts = {}
    for r in got:
        parts.setdefault((r.record_id, r.payload_digest if r.last else None), []).append(r)
    last = sorted((r.payload_bytes, r.payload_digest) for r in got if r.last)
    assert last == sorted((len(b), base64.b32encode(hashlib.sha1(b).digest()).decode()) for b in [*blocks, b"other"])
    assert b"".join(r.payload for r in got if r.record_id == "<urn:x:2>") == blocks[2]
    assert all(r.verified is None for r in got)


@pytest.mark.parametrize("data", [b"".join(foreign(b"whole"))[:-9], b"no record\r\n\r\n", b"".join(foreign(b"x")).replace(b"\r\n\r\nx", b"\r\n\r\nxy")])
def test_broken_archives_are_errors(spark, tmp_path, data):
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(data))
    with pytest.raises(Exception, match="record"):
        warc.read_archives(spark, str(tmp_path)).collect()


def test_altered_payload_is_not_verified(spark, tmp_path):
    warc.write_archives(spark.createDataFrame(ROWS[:1], SCHEMA).coalesce(1), str(tmp_path / "out"))
    data = b"".join(archive(tmp_path / "out")).replace(b"one payload", b"two payload")
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(data))
    rows = warc.records(warc.read_archives(spark, str(tmp_path / "b.warc.gz")))
    assert [r.verified for r in rows.collect()] == [False]
    assert rows.filter(~warc.is_whole(rows)).count() == 1


def test_no_rows(spark, tmp_path):
    pages = spark.createDataFrame([], SCHEMA)
    warc.write_archives(pages, str(tmp_path / "out"))
    assert warc.read_archives(spark, str(tmp_path / "out")).collect() == []

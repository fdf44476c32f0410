"""Web archives (WARC 1.1) written from and read into tables of record chunks."""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import balanced_join
from ..session import materialize
from .common import small_batches

CHUNK = 1 << 20  # bytes of payload in a row, and in a segment of an archive
PIECES = 32  # pieces that rows without id are dealt out by
DATE = "1970-01-01T00:00:00Z"  # of the records, unless given: a fixed one keeps reruns alike
MOST_HEAD = 1 << 20  # bytes of a record's headers
GAP = b"\r\n\r\n"
INFO = b"software: pavelore\r\nformat: WARC File Format 1.1\r\n"


def chunks(pages: DataFrame, chunk: int = CHUNK, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """The chunked record table: a row per record and part of its payload, in order.

    ``page_id, url, x, y`` (two hashes of the payload), ``row, chunk_no, n_chunks, n_bytes,
    payload``. A null or empty payload is one empty chunk. ``row`` is the row's number
    within its partition of the scan, so it is the same when a task runs again.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
        F.coalesce(F.col(text_col).cast("binary"), F.expr("X''")).alias("whole"),
    )
    rows = rows.select(
        "*", F.xxhash64("whole").alias("x"), F.xxhash64(F.lit(7), "whole").alias("y"),
        F.monotonically_increasing_id().alias("row"), F.octet_length("whole").cast("long").alias("n_bytes"),
    )
    n_chunks = F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / chunk)).cast("int")
    rows = rows.withColumn("n_chunks", n_chunks)
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)).alias("chunk_no"))
    payload = F.col("whole").substr(F.col("chunk_no") * chunk + 1, F.lit(chunk))
    return rows.select("page_id", "url", "x", "y", "row", "chunk_no", "n_chunks", "n_bytes", payload.alias("payload"))


def digests(rows: DataFrame) -> DataFrame:
    """``page_id, x, y, n_bytes, digest`` per record: the chunks of a record go into one running digest."""
    names = ["page_id", "x", "y", "n_bytes", "chunk_no", "n_chunks", "payload"]
    schema = T.StructType([*rows.select(*names[:4]).schema, T.StructField("digest", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running = hashlib.sha1()
        for batch in batches:
            last, found = [], []
            for number, size, payload in zip(*(c.to_pylist() for c in batch.columns[4:])):
                if not number:
                    running = hashlib.sha1()
                running.update(payload)
                last.append(number == size - 1)
                if last[-1]:
                    found.append(base32(running))
            own = pa.RecordBatch.from_arrays(batch.columns[:4], names=names[:4]).filter(pa.array(last, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(found, pa.string())], names=schema.names)

    return rows.select(*names).mapInArrow(run, schema)


def base32(digest) -> str:
    return base64.b32encode(digest.digest()).decode()


def kinds(found: DataFrame, least_bytes: int) -> DataFrame:
    """``page_id, x, y, digest, refers_to, revisit`` once per id and payload.

    Of equal payloads of ``least_bytes`` or more the largest id is the response, the others
    revisit it. Only payloads that come more than once are joined; a payload with a large
    share of all rows is handled by many tasks.
    """
    several = found.groupBy("digest", "n_bytes").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
    several = several.filter((F.col("n") > 1) & (F.col("n_bytes") >= least_bytes)).select("digest", "response", F.lit(True).alias("repeated"))
    once = found.select("page_id", "x", "y", "digest").dropDuplicates(["page_id", "x", "y"])
    joined = balanced_join(once, several, ["digest"], "left", spread_by=["page_id"])
    revisit = F.coalesce(F.col("repeated") & ~F.col("page_id").eqNullSafe(F.col("response")), F.lit(False))
    return joined.select("page_id", "x", "y", "digest", F.when(revisit, F.col("response")).alias("refers_to"), revisit.alias("revisit"))


def record_id(page_id: int | None, digest: str) -> bytes:
    """A record's identifier; it follows from the page's id and payload."""
    return b"<urn:uuid:%s>" % str(uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {digest}")).encode()


def _target(url: str | None, page_id: int | None) -> bytes:
    """The URL with blanks and control characters escaped: a header is one line."""
    raw = (url or f"urn:page:{'' if page_id is None else page_id}").encode()
    return b"".join(b"%%%02X" % c if c <= 32 or c == 127 else bytes([c]) for c in raw) if min(raw) <= 32 or 127 in raw else raw


def _head(fields: list[tuple[bytes, bytes | None]]) -> bytes:
    return b"WARC/1.1\r\n" + b"\r\n".join(b"%s: %s" % f for f in fields if f[1] is not None)


class Writer:
    """Turns the chunks of records into archive records, one for each chunk.

    A record of several chunks is segmented: a response and its continuations.
    """

    def __init__(self, date: str):
        self.date = date.encode()
        self.kind: tuple = ()
        self.id = b""

    def info(self) -> bytes:
        head = [(b"WARC-Type", b"warcinfo"), (b"WARC-Record-ID", b"<urn:uuid:%s>" % str(uuid.uuid5(uuid.NAMESPACE_URL, "info")).encode()),
                (b"WARC-Date", self.date), (b"Content-Type", b"application/warc-fields"), (b"Content-Length", b"%d" % len(INFO))]
        return _head(head) + GAP + INFO

    def decide(self, digest: str, refers_to: int | None, revisit: bool) -> None:
        """What holds for the record whose chunks follow."""
        self.kind = (digest, refers_to, revisit)

    def record(self, page_id: int | None, url: str | None, chunk_no: int, n_chunks: int, n_bytes: int, payload: bytes) -> bytes | None:
        digest, refers_to, revisit = self.kind
        if not chunk_no:
            self.id = record_id(page_id, digest)
        elif revisit:
            return None
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % n_bytes + GAP
        block = (b"" if chunk_no else http) + (b"" if revisit else payload)
        head = [(b"WARC-Type", b"continuation" if chunk_no else b"revisit" if revisit else b"response")]
        own = self.id if not chunk_no else b"<urn:uuid:%s>" % str(uuid.uuid5(uuid.NAMESPACE_URL, f"{self.id.decode()} {chunk_no}")).encode()
        head += [(b"WARC-Record-ID", own), (b"WARC-Date", self.date), (b"WARC-Target-URI", _target(url, page_id))]
        if not chunk_no:
            head += [(b"Content-Type", b"application/http; msgtype=response"), (b"WARC-Payload-Digest", b"sha1:" + digest.encode()),
                     (b"Page-ID", None if page_id is None else b"%d" % page_id)]
        if revisit:
            head += [(b"WARC-Profile", b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                     (b"WARC-Refers-To", record_id(refers_to, digest)), (b"Refers-To-Page-ID", b"%d" % refers_to)]
        elif n_chunks > 1:
            head.append((b"WARC-Segment-Number", b"%d" % (chunk_no + 1)))
            if chunk_no:
                head.append((b"WARC-Segment-Origin-ID", self.id))
            if chunk_no == n_chunks - 1:
                head.append((b"WARC-Segment-Total-Length", b"%d" % (len(http) + n_bytes)))
        head.append((b"Content-Length", b"%d" % len(block)))
        return _head(head) + GAP + block


def write_archives(
    pages: DataFrame,
    path: str,
    chunk: int = CHUNK,
    least_bytes: int = 0,
    date: str = DATE,
    id_col: str = "page_id",
    url_col: str = "url",
    text_col: str = "html",
) -> None:
    """Write a WARC record per row into compressed archives, one per task, in a new folder.

    Payloads are texts in UTF-8; null is empty. Of records with equal payloads of
    ``least_bytes`` or more, that with the largest id is a response and the others revisit
    it without payload; smaller ones are responses. A null id is the smallest and has no
    ``Page-ID`` header; a null URL becomes ``urn:page:`` and the id. Rows that repeat id and
    payload are records with one identifier and of one type. Other columns are not looked
    at; no rows give no records. Ids are whole numbers.

    Payloads are cut into chunks before they leave the scan. A record's chunks, after a row
    that says what kind it is, are dealt by its id and sorted, so a task streams them and
    holds one chunk and a batch at a time. What archives hold does not depend on the order
    in which rows arrive; lost tasks write the same again.
    """
    small_batches(pages.sparkSession)
    rows = chunks(pages, chunk, id_col, url_col, text_col)
    found = kinds(materialize(digests(rows)), least_bytes)
    no_id = F.col("page_id").isNull()
    piece = F.when(no_id, F.pmod("row", F.lit(PIECES))).otherwise(0).cast("int")
    every = F.when(no_id, F.sequence(F.lit(0), F.lit(PIECES - 1))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("piece", piece)
    found = found.select("*", F.lit(-1).cast("long").alias("row"), F.lit(-1).alias("chunk_no"), F.explode(every).alias("piece"))
    both = rows.unionByName(found, allowMissingColumns=True)
    both = both.repartition("page_id", "piece").sortWithinPartitions("page_id", "x", "y", "row", "chunk_no")
    names = ["page_id", "url", "chunk_no", "n_chunks", "n_bytes", "payload", "digest", "refers_to", "revisit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, begun = Writer(date), False
        for batch in batches:
            found, columns = [], [c.to_pylist() for c in batch.columns]
            for values in zip(*columns):
                if values[2] < 0:
                    writer.decide(*values[6:])
                    continue
                if not begun:
                    found.append(writer.info())
                    begun = True
                record = writer.record(*values[:6])
                if record is not None:
                    found.append(record)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["value"])

    records = both.select(*names).mapInArrow(run, "value binary")
    # The writer of text puts the two empty lines that end a record after each row.
    records.select(F.col("value").cast("string")).write.option("lineSep", GAP.decode()).option("compression", "gzip").text(path)


class Reader:
    """A stream of archive bytes to rows of record chunks.

    Holds the headers of one record and at most a chunk of its payload, and the running
    digest of the record that is open: that of a segmented one goes on in its continuations.
    """

    def __init__(self, chunk: int, payloads: bool):
        self.chunk, self.payloads = chunk, payloads
        self.held, self.at = b"", 0
        self.state = "head"
        self.left = 0  # bytes of the block not read yet
        self.record: dict = {}

    def feed(self, data: bytes) -> Iterator[tuple]:
        self.held = self.held[self.at :] + data
        self.at = 0
        step = {"head": self._headers, "http": self._http, "body": self._body, "skip": self._skip, "gap": self._gap}
        while (found := step[self.state]()) is not None:
            yield from found

    def close(self) -> None:
        if self.state != "head" or self.held[self.at :].strip(b"\r\n"):
            raise ValueError("an archive ends within a record")
        if self.record.get("segmented"):
            raise ValueError("the last segment of a record is missing")

    def _until_gap(self, limit: int) -> bytes | None:
        end = self.held.find(GAP, self.at)
        if end < 0:
            if len(self.held) - self.at > limit:
                raise ValueError("the headers of a record do not end")
            return None
        found, self.at = self.held[self.at : end], end + 4
        return found

    @staticmethod
    def _fields(lines: list[bytes]) -> dict[str, str]:
        pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
        return {k.strip().lower(): v.strip() for k, _, v in pairs}

    def _headers(self) -> tuple | None:
        while self.held[self.at : self.at + 2] == b"\r\n":
            self.at += 2
        head = self._until_gap(MOST_HEAD)
        if head is None:
            return None
        version, *lines = head.split(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {version[:40]!r}")
        h = self._fields(lines)
        self.left = int(h["content-length"])
        kind = h["warc-type"]
        if kind == "continuation":
            if self.record.get("id") != h["warc-segment-origin-id"] or not self.record["segmented"]:
                raise ValueError("a continuation does not follow its record")
            self.record["segmented"] = "warc-segment-total-length" not in h
            self.state = "body"
            return ()
        if self.record.get("segmented"):
            raise ValueError("the last segment of a record is missing")
        if kind not in ("response", "revisit", "resource"):
            self.state = "skip"
            return ()
        number = lambda name: int(h[name]) if name in h else None
        declared = h.get("warc-payload-digest", "")
        self.record = {
            "id": h["warc-record-id"], "kind": kind, "target": h.get("warc-target-uri"), "page": number("page-id"),
            "refers": number("refers-to-page-id"), "digest": declared.removeprefix("sha1:") if declared.startswith("sha1:") else None,
            "segmented": "warc-segment-number" in h, "running": hashlib.sha1(), "bytes": 0, "chunks": 0,
        }
        self.state = "http" if h.get("content-type", "").startswith("application/http") else "body"
        return ()

    def _http(self) -> tuple | None:
        before = self.at
        head = self._until_gap(min(self.left, MOST_HEAD) + 4)
        if head is None:
            return None
        if self.at - before > self.left:
            raise ValueError("a block has no end of its HTTP headers")
        self.left -= self.at - before
        if self.record["kind"] == "revisit":
            size = self._fields(head.split(b"\r\n")[1:]).get("content-length")
            self.record["bytes"] = int(size) if size and size.isdigit() else None
        self.state = "body"
        return ()

    def _body(self) -> tuple | None:
        size = min(self.left, self.chunk)
        if len(self.held) - self.at < size:
            return None
        r, payload = self.record, self.held[self.at : self.at + size]
        self.at += size
        self.left -= size
        done = not self.left and not r["segmented"]
        if not self.left:
            self.state = "gap"
        revisit = r["kind"] == "revisit"
        if not revisit:
            r["running"].update(payload)
            r["bytes"] += size
        digest = r["digest"] if revisit else base32(r["running"])
        row = (r["id"], r["chunks"], r["page"], r["kind"], r["target"], r["bytes"], digest, r["refers"], done,
               digest == r["digest"] if done and not revisit and r["digest"] else None, payload if self.payloads else None)
        r["chunks"] += 1
        return (row,)

    def _skip(self) -> tuple | None:
        here = min(self.left, len(self.held) - self.at)
        self.at += here
        self.left -= here
        if self.left:
            return None
        self.state = "gap"
        return ()

    def _gap(self) -> tuple | None:
        if len(self.held) - self.at < 4:
            return None
        if self.held[self.at : self.at + 4] != GAP:
            raise ValueError("a record does not end with two empty lines")
        self.at += 4
        self.state = "head"
        return ()


CHUNKS = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("chunk_no", T.LongType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("last", T.BooleanType()),
        T.StructField("verified", T.BooleanType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def read_archives(spark: SparkSession, path: str, chunk: int = CHUNK, payloads: bool = True) -> DataFrame:
    """The responses, resources and revisits of archives as rows of record and chunk number.

    ``payload_bytes`` and ``payload_digest`` (SHA-1 in base32) are those of the payload up to
    and including the chunk; in the ``last`` row they are the whole payload's, and
    ``verified`` says whether the digest is the one in the headers (null without one). A
    revisit is one row with the length and digest that its headers give. ``payload`` is null
    unless wanted. Other types are left out.

    Any compressed archives (``.gz``, whole or record by record) are read, one task for each,
    as a stream of lines: no more than a line and a chunk is held. A file that Spark would
    split, cut short or without record heads is an error. An empty folder gives no rows.
    """
    small_batches(spark)
    lines = spark.read.option("lineSep", "\n").text(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(chunk, payloads)
        names = CHUNKS.names
        for batch in batches:
            if not batch.num_rows:
                continue
            if pc.max(batch.column(1)).as_py():
                raise ValueError("archives are read whole: compress them with gzip")
            found, size = [], 0
            for row in reader.feed(b"\n".join(batch.column(0).to_pylist()) + b"\n"):
                found.append(row)
                size += len(row[-1] or b"")
                if size > 4 * chunk:
                    yield _rows(found, names)
                    found, size = [], 0
            if found:
                yield _rows(found, names)
        reader.close()

    return lines.select(F.col("value").cast("binary"), F.input_file_block_start().alias("from")).mapInArrow(run, CHUNKS)


def _rows(found: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds_ = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds_)], names=names)


def records(rows: DataFrame) -> DataFrame:
    """One row per record, from its last chunk: all that needs no payload."""
    return rows.filter("last").drop("chunk_no", "last", "payload")


def is_whole(rows: DataFrame) -> Column:
    """Whether a record's digest is right; revisits and records without one count as right."""
    return F.coalesce(F.col("verified"), F.lit(True))

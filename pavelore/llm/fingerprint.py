"""MinHash fingerprints of documents, and of a document edited with its successor's text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches
from .linking import link
from .shingles import U64, shingle_set

WIDTH = 5
PERMUTATIONS = 128
BAND_ROWS = 4
BLOCK = 512  # shingles that are hashed by all permutations at a time
_RANDOM = np.random.default_rng(20)
_A = _RANDOM.integers(0, 2**63, (PERMUTATIONS, 1), dtype=U64) * U64(2) + U64(1)
_B = _RANDOM.integers(0, 2**63, (PERMUTATIONS, 1), dtype=U64) * U64(2)
LAST = 2**63 - 1


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash of a set under universal hashes ``(a x + b) mod 2^64``, highest bits first.

    A coordinate is the top half of the least value; all ones for an empty set. Two sets
    agree in a coordinate with a chance equal to their Jaccard similarity.
    """
    least = np.full(PERMUTATIONS, 2**64 - 1, dtype=U64)
    x = shingles & U64(2**32 - 1)
    for at in range(0, len(x), BLOCK):
        hashed = _A * x[None, at : at + BLOCK]
        hashed += _B
        np.minimum(least, hashed.min(axis=1), out=least)
    return (least >> U64(32)).astype(np.uint32)


def bands(shingles: np.ndarray) -> np.ndarray:
    """One number per band of ``BAND_ROWS`` coordinates."""
    rows = signature(shingles).reshape(-1, BAND_ROWS).astype(U64)
    found = np.arange(1, len(rows) + 1, dtype=U64)
    for at in range(BAND_ROWS):
        found = (found * U64(0x9E3779B97F4A7C15) + rows[:, at]) * U64(0xFF51AFD7ED558CCD)
        found ^= found >> U64(29)
    return found


def text_signature(text: str) -> np.ndarray:
    """The part of the signature that a fingerprint shows: 16 bits a coordinate."""
    return signature(shingle_set(text, WIDTH)).astype(np.uint16)


def shown(signature_: np.ndarray) -> str:
    return signature_.astype(">u2").tobytes().hex()


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Share of equal coordinates: an estimate of the Jaccard similarity."""
    return float(np.count_nonzero(one == other) / len(one))


def near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``: documents whose fingerprints share a band.

    The bands of all documents are joined in Spark; a pair is linked if the Jaccard
    similarity of its whole five-word shingle sets is ``percent`` or more.
    """
    return link(docs, bands, WIDTH, percent, id_col, text_col)


def _range_of(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are less than the key, by binary search."""
    if not bounds:
        return F.lit(0)
    steps, step = [], 1 << (len(bounds).bit_length() - 1)
    while step:
        steps.append(step)
        step >>= 1
    known = F.lit(bounds)

    def go(at: Column, step: Column) -> Column:
        further = (at + step <= len(bounds)) & (F.get(known, at + step - 1) < key)
        return F.when(further, at + step).otherwise(at)

    return F.aggregate(F.lit(steps), F.lit(0), go)


def with_successor(docs: DataFrame, id_col: str, text_col: str, rows) -> DataFrame:
    """Apply ``rows`` to ``(id, text, next text)`` of each document in order of its id.

    The successor of the last document is the first one. Documents are dealt out by ranges
    of ids of about equal size and sorted within; the first document of a range also goes
    to the range before it. So each text is shuffled once, and no task sees more than its
    range. Documents that share an id are ordered by a hash of their text, those without
    id come last. ``rows`` is a generator over batches of lists and gives record batches.
    """
    spark = docs.sparkSession
    pieces = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("_key"),
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
    )
    shares = [i / pieces for i in range(1, pieces)]
    bounds = []
    if shares:
        bounds = keyed.agg(F.percentile_approx("_key", shares, 10_000)).first()[0] or []
    ranged = keyed.withColumn("_range", _range_of(F.col("_key"), sorted(set(bounds))))
    first = {r[0]: r[1] for r in ranged.groupBy("_range").agg(F.min("_key")).collect()}
    order = sorted(first)
    before = [(first[r], order[i - 1]) for i, r in enumerate(order)]  # of the first range: the last
    starts = spark.createDataFrame(before, "_key long, _before int")  # a row per range
    place = F.array(
        F.struct(F.col("_range").alias("at"), F.lit(False).alias("guest")),
        F.struct(F.col("_before").alias("at"), F.lit(True).alias("guest")),
    )
    dealt = (
        ranged.join(F.broadcast(starts), "_key", "left")
        .select("_key", "doc_id", "text", F.explode(place).alias("place"))
        .filter("place.at IS NOT NULL")
        .select("_key", "doc_id", "text", "place.at", "place.guest")
        .repartitionById(pieces, F.col("at"))
        .sortWithinPartitions("guest", "_key", F.xxhash64("text"))
    )
    return rows(dealt.select("doc_id", "text", "guest"))


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has its last quarter of code points replaced by the beginning of the
    next document in order of ids. Returns ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``, one row per input row.

    A null text is empty. Texts with fewer than five words are one shingle; all texts
    without words have the same fingerprint. Equal texts have equal fingerprints. Other
    columns are not looked at; no rows give no rows.
    """
    small_batches(docs.sparkSession)
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited_sha256", T.StringType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("edited_fingerprint", T.StringType()),
            T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, over, made = None, False, []

        def row(one, other):
            key, text, own = one
            _, next_text, next_own = other
            quarter = len(text) // 4
            edited = text[: len(text) - quarter] + next_text[:quarter]
            new = text_signature(edited)
            return (
                key, len(text), hashlib.sha256(edited.encode()).hexdigest(), shown(own),
                shown(new), likeness(own, new), likeness(own, next_own),
            )

        def packed():
            columns = list(zip(*made))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _ARROW)], names=schema.names
            )

        for batch in batches:
            for key, text, guest in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if guest and over:
                    continue
                text = text or ""
                one = (key, text, text_signature(text))
                if waiting is not None:
                    made.append(row(waiting, one))
                waiting, over = one, guest
            if len(made) >= 128:
                yield packed()
                made = []
        if made:
            yield packed()

    return with_successor(docs, id_col, text_col, lambda dealt: dealt.mapInArrow(run, schema))


_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
)

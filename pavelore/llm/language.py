"""Language identification by compression with one dictionary per language."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

DICTIONARY_BYTES = 112_640
PIECE_CHARS = 512  # characters of a piece of text in a dictionary
SURPLUS = 8  # times as many pieces as fit are compared by hash, where a language has more
CHUNK = 2_048  # bytes that are compressed at a time
LEVEL = 6
FILLER = bytes(64)  # before every text: a very short input alone would be stored as it is
MARGIN = 0.01
UNKNOWN = "und"


def dictionaries(
    docs: DataFrame, dictionary_bytes: int = DICTIONARY_BYTES, piece_chars: int = PIECE_CHARS
) -> dict[str, bytes]:
    """Raw dictionary content per language, learned from ``text, lang`` rows.

    A bounded sample from whole texts: every text is cut into pieces, and a language's
    dictionary holds the pieces with the smallest hashes, as many as fit, each once. Every
    label gets one, so the driver holds ``dictionary_bytes`` for each. Of a language with very
    many pieces only those below a hash that leaves a few times as many as fit are sorted.
    Rows without label or text are left out, and labels with less than 8 bytes.
    """
    rows = docs.filter(F.col("lang").isNotNull() & (F.length("text") > 0)).select("lang", "text")
    fitting = -(-dictionary_bytes // piece_chars)
    pieces = F.ceil(F.length("text") / piece_chars).cast("int")
    counts = rows.groupBy("lang").agg(F.sum(pieces).alias("n"))
    # all hashes are below 2 to the power of 63; so many times the wanted share of them
    least = F.least(F.lit(1.0), F.lit(float(SURPLUS * fitting)) / F.col("n")) * F.lit(2.0**63)
    counts = counts.select("lang", least.alias("most"))
    parts = rows.select("lang", "text", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("i"))
    part = F.lower(F.substring("text", F.col("i") * piece_chars + 1, F.lit(piece_chars)))
    parts = parts.select("lang", part.alias("part")).withColumn("hash", F.xxhash64("part").bitwiseAND(F.lit((1 << 63) - 1)))
    # one row per label, fewer than the driver holds dictionaries
    parts = parts.join(F.broadcast(counts), "lang").filter(F.col("hash") <= F.col("most")).select("lang", "hash", "part").distinct()
    place = Window.partitionBy("lang").orderBy("hash", "part")
    sample = parts.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= fitting)
    found: dict[str, list[bytes]] = {}
    for r in sample.orderBy("lang", "place").collect():
        found.setdefault(r.lang, []).append(r.part.encode())
    joined = {lang: _fitting(texts, dictionary_bytes) for lang, texts in sorted(found.items())}
    return {lang: content for lang, content in joined.items() if len(content) >= 8}


def _fitting(texts: list[bytes], most: int) -> bytes:
    """As many of the texts as fit, with a line end between two; the first one if none does."""
    content = texts[0][:most]
    for text in texts[1:]:
        if len(content) + 1 + len(text) <= most:
            content += b"\n" + text
    return content


class Compressors:
    """Compressed size of a text under each language's dictionary."""

    def __init__(self, content: dict[str, bytes], level: int, chunk: int):
        import zstandard as zstd

        self.chunk = chunk
        self.langs = sorted(content)
        self.compress = []
        for lang in self.langs:
            known = zstd.ZstdCompressionDict(content[lang], dict_type=zstd.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=level)
            made = zstd.ZstdCompressor(
                level=level, dict_data=known, write_content_size=False, write_dict_id=False
            )
            self.compress.append(made.compress)

    def sizes(self, text: str) -> list[int]:
        data, chunk = FILLER + text.lower().encode(), self.chunk
        parts = [data[at : at + chunk] for at in range(0, len(data), chunk)]
        return [sum(len(compress(part)) for part in parts) for compress in self.compress]

    def choose(self, text: str | None) -> tuple[str, float]:
        """The language and the margin: how much smaller than the second, as a share."""
        if not self.langs or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        ranked = sorted(zip(self.sizes(text), self.langs))
        if len(ranked) == 1:
            return ranked[0][1], 1.0
        return ranked[0][1], 1.0 - ranked[0][0] / ranked[1][0]


def identify(
    docs: DataFrame,
    content: dict[str, bytes],
    margin: float = MARGIN,
    level: int = LEVEL,
    chunk: int = CHUNK,
    text_col: str = "text",
) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``rejected`` to every row.

    The whole text, in lower case, is compressed chunk by chunk with each language's
    dictionary; the smallest sum wins, ties by name. ``score`` (0 to 1) is the margin: the
    share by which the second smallest is larger. ``rejected`` is a margin below
    ``margin``. A null text, or one without a letter, is ``und``, scores 0 and is rejected,
    as is every text if there is no dictionary. Columns of these three names are replaced;
    all others, their order and repeated rows stay.
    """
    small_batches(docs.sparkSession)
    new = ["lang_pred", "score", "rejected"]
    kept = [c for c in docs.columns if c not in new]
    schema = T.StructType(
        [docs.schema[c] for c in kept]
        + [
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_language = Compressors(content, level, chunk)
        for batch in batches:
            found = [by_language.choose(t) for t in batch.column(kept.index(text_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([share for _, share in found], pa.float64()),
                    pa.array([share < margin for _, share in found], pa.bool_()),
                ],
                names=schema.names,
            )

    return docs.select(*kept).mapInArrow(run, schema)

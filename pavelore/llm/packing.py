"""Sum-of-squares packing of token sequences into windows of a fixed length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import small_batches
from .tokens import word_ids

WINDOW = 4096
END_ID = 2
ID_BYTES = 4


class Levels:
    """Open windows by fill level, and the online choice of the level for a piece.

    ``count[h]`` is the number of open windows filled to ``h``. A piece goes where the sum
    of the squared counts of partially filled windows grows least: into a window of level
    ``h`` with room for it, or into a new one. Ties go to the fullest window.
    """

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, dtype=np.int64)
        self.at: list[list[list]] = [[] for _ in range(window)]

    def choose(self, size: int) -> int:
        count, room = self.count, self.window - size
        best, level = 2 * int(count[size]) + 1, 0
        if room:
            here = count[1 : room + 1]
            grows = 2 * (count[1 + size : self.window + 1] - here) + 2
            grows[-1] = 1 - 2 * here[-1]  # a filled window leaves the sum
            grows[here == 0] = np.iinfo(np.int64).max
            last = len(grows) - 1 - int(np.argmin(grows[::-1]))
            if grows[last] <= best:
                level = last + 1
        return level

    def place(self, piece, size: int) -> list | None:
        """Place a piece; return the pieces of the window if that filled it."""
        level = self.choose(size)
        pieces = []
        if level:
            pieces = self.at[level].pop()
            self.count[level] -= 1
        pieces.append(piece)
        if level + size == self.window:
            return pieces
        self.at[level + size].append(pieces)
        self.count[level + size] += 1
        return None

    def open(self) -> list[list]:
        """The open windows, fullest first."""
        return [pieces for level in reversed(self.at) for pieces in level]


def pack_stream(documents: Iterator[tuple], window: int) -> Iterator[list[tuple]]:
    """Windows, each a list of ``(id, start, ids, doc_tokens)``, of ``(id, ids)`` documents.

    ``ids`` are bytes, four per token. Whole windows are cut off a long document first; its
    rest is placed by ``Levels``. In the end the pieces of all open windows are strung
    together and cut anew: whole windows, and a last rest of power-of-two lengths.
    """
    levels, width = Levels(window), window * ID_BYTES
    for key, ids in documents:
        total = len(ids) // ID_BYTES
        whole = len(ids) - len(ids) % width
        for at in range(0, whole, width):
            yield [(key, at // ID_BYTES, ids[at : at + width], total)]
        if whole < len(ids):
            piece = (key, whole // ID_BYTES, ids[whole:], total)
            if filled := levels.place(piece, total - piece[1]):
                yield filled
    left = [piece for pieces in levels.open() for piece in pieces]
    tokens = sum(len(piece[2]) for piece in left) // ID_BYTES
    place = 0
    while tokens:
        size = window if tokens >= window else 1 << (tokens.bit_length() - 1)
        tokens -= size
        need, made = size * ID_BYTES, []
        while need:
            key, start, ids, total = left[place]
            made.append((key, start, ids[:need], total))
            if len(ids) > need:
                left[place] = (key, start + need // ID_BYTES, ids[need:], total)
            else:
                place += 1
            need -= len(made[-1][2])
        yield made


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack the token ids of every document into windows of ``window`` tokens.

    One row per piece: the id column, ``start`` (the document's tokens before it),
    ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id``,
    ``offset`` (its place in the sequence). A document is its ids and then ``end_id``.
    Sequences are full, but for at most ``log2(window)`` per task, whose lengths are the
    powers of two that make up the task's last rest; nothing is padded.

    Each task packs its own rows in one pass and holds only open windows, so there is no
    shuffle. A null or empty text is the end id alone. A null id is carried as it is;
    repeated rows are packed each for itself; other columns are not looked at; no rows
    give no pieces.
    """
    small_batches(docs.sparkSession)
    key_type = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField(id_col, key_type),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer)
        end = int(end_id).to_bytes(ID_BYTES, "little")
        keys: list[pa.DataType] = []

        def documents():
            for batch in batches:
                keys[:] = [batch.column(0).type]
                texts = batch.column(1).to_pylist()
                ids = encoder.encode(texts)
                yield from zip(batch.column(0).to_pylist(), (x + end for x in ids))
            encoder.forget()

        def rows(made: list[tuple]) -> pa.RecordBatch:
            key, start, ids, total, sequence, offset = zip(*made)
            length = [len(x) // ID_BYTES for x in ids]
            long = pa.int64()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(key, keys[0]), pa.array(start, long), pa.array(length, long),
                    pa.array(ids, pa.binary()), pa.array(total, long),
                    pa.array(sequence, long), pa.array(offset, long),
                ],
                names=schema.names,
            )

        sequence = TaskContext.get().partitionId() << 33
        made: list[tuple] = []
        for pieces in pack_stream(documents(), window):
            offset = 0
            for key, start, ids, total in pieces:
                made.append((key, start, ids, total, sequence, offset))
                offset += len(ids) // ID_BYTES
            sequence += 1
            if len(made) >= 1024:
                yield rows(made)
                made = []
        if made:
            yield rows(made)

    return docs.select(id_col, text_col).mapInArrow(run, schema)

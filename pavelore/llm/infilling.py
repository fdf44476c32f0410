"""Fill-in-the-middle documents as piece tables: descriptors over buffers that never change."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import small_batches

SEED = "1:"  # stands before the id whose hash decides cuts and form
PLAIN_PERCENT = 10
SPM_PERCENT = 20
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE  # the second buffer
TEXT, MARKS = 0, 1  # numbers of the buffers
BLOCK = 1 << 20  # bytes handed to a hash at a time
#: Order of the descriptors of each form: sentinels are -1 (prefix), -2 (suffix), -3 (middle).
FORMS = {"plain": (0, 1, 2), "psm": (-1, 0, -2, 2, -3, 1), "spm": (-2, 2, -1, 0, -3, 1)}


class Pieces:
    """A document as descriptors ``(buffer, start, length)``; the buffers are shared and never copied."""

    __slots__ = ("buffers", "parts")

    def __init__(self, buffers: tuple[memoryview, ...], parts: list[tuple[int, int, int]]):
        self.buffers, self.parts = buffers, parts

    def cut(self, *places: int) -> "Pieces":
        """Split descriptors at rising byte places of the document, so that each place is a border."""
        parts, at = [], 0
        todo = list(places)
        for buffer, start, length in self.parts:
            while todo and todo[0] <= at + length:
                here = todo.pop(0) - at
                parts.append((buffer, start, here))
                at, start, length = at + here, start + here, length - here
            parts.append((buffer, start, length))
            at += length
        return Pieces(self.buffers, parts)

    def arranged(self, order: tuple[int, ...]) -> "Pieces":
        """Descriptors in another order, sentinels between them."""
        return Pieces(self.buffers, [self.parts[i] if i >= 0 else (MARKS, 3 * (-i - 1), 3) for i in order])

    def returned(self, order: tuple[int, ...]) -> "Pieces":
        """The inverse: descriptors where ``order`` took them from, sentinels left out."""
        place = {i: part for i, part in zip(order, self.parts) if i >= 0}
        return Pieces(self.buffers, [place[i] for i in range(3)])

    def stream(self) -> Iterator[memoryview]:
        """The document's bytes in blocks, descriptor by descriptor."""
        for buffer, start, length in self.parts:
            for at in range(start, start + length, BLOCK):
                yield self.buffers[buffer][at : min(at + BLOCK, start + length)]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for block in self.stream():
            digest.update(block)
        return digest.hexdigest()


def numbers(key: object) -> list[int]:
    """The first four 8-digit groups of the hash of the seed and an id; a null id is empty."""
    found = hashlib.sha256(f"{SEED}{'' if key is None else key}".encode()).hexdigest()
    return [int(found[i : i + 8], 16) for i in range(0, 32, 8)]


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column without copies, and where each text starts and ends; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, places, data = column.buffers()
    ends = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), ends.astype(np.int64)


def _units(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the tokens of all texts start, and the first token of each text (and the end)."""
    inside = data[bounds[0] : bounds[-1]]
    letter = ((inside | 32) - np.uint8(97)) < 26
    starts = (inside & 0xC0) != 0x80  # of code points
    again = letter[1:] & letter[:-1]
    borders = bounds[1:-1] - bounds[0]
    borders = borders[(borders > 0) & (borders < len(inside))]
    again[borders - 1] = False
    starts[1:] &= ~again
    at = np.flatnonzero(starts) + bounds[0]
    return at, np.searchsorted(at, bounds)


def _found(output: bytes, low: int, high: int, form: str) -> list[int] | None:
    """Borders of the sentinels within ``output[low:high]``, in order; None if it is not of the form."""
    at, borders = low, []
    for i in FORMS[form]:
        if i >= 0:
            continue
        mark = SENTINELS[3 * (-i - 1) :][:3]
        place = output.find(mark, at, high)
        if place < 0 or (not borders and place != low):
            return None
        borders += [place - low, place - low + 3]
        at = place + 3
    return borders


def rebuilt(output: bytes, low: int, high: int, form: str | None) -> Pieces | None:
    """The text of the output ``output[low:high]`` as descriptors; None if it is not of its form.

    Only the output and the form are looked at. The first sentinel of each kind, in the
    order of the form, is the border: no text with a sentinel inside has a form but plain.
    """
    whole = Pieces((memoryview(output), memoryview(SENTINELS)), [(TEXT, low, high - low)])
    if form == "plain":
        return whole
    borders = _found(output, low, high, form) if form in FORMS else None
    if borders is None:
        return None
    cut = whole.cut(*borders).parts[1:]  # nothing stands before the first sentinel
    return Pieces(whole.buffers, cut).returned(FORMS[form])


def fill_in_middle(
    docs: DataFrame,
    plain_percent: int = PLAIN_PERCENT,
    spm_percent: int = SPM_PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    texts: bool = True,
) -> DataFrame:
    """Cut each text into prefix, middle and suffix and write them in the order of its form.

    A text's units are runs of ASCII letters and single other code points. Where it is cut
    and its form follow from a hash of its id alone: ``plain`` (as it is; also empty texts and
    those that hold a sentinel), ``psm`` or ``spm``. Returns ``doc_id, n, form,
    prefix_chars, middle_chars, output_sha256, restored_sha256``; the last is the hash of the
    text that ``rebuilt`` makes from output and form. With ``texts`` the ``output`` follows,
    which ``restore`` takes back.

    Null texts are empty. A null id is hashed as an empty one and carried; repeated rows
    come out alike; other columns are not looked at; no rows give no rows. One pass without
    a shuffle; a task holds a batch of texts and its outputs once.
    """
    small_batches(docs.sparkSession)
    long, text = T.LongType(), T.StringType()
    fields = [("doc_id", docs.schema[id_col].dataType), ("n", long), ("form", text), ("prefix_chars", long),
              ("middle_chars", long), ("output_sha256", text), ("restored_sha256", text)]
    schema = T.StructType([T.StructField(*f) for f in [*fields, *([("output", text)] if texts else [])]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = _buffer(batch.column(1))
            starts, first = _units(data, bounds)
            own = (memoryview(data), memoryview(SENTINELS))
            columns: list[list] = [[] for _ in schema.fields[1:]]
            outputs: list[memoryview] = []  # slices of the buffers, in the order of the outputs
            sizes, forms = [0], []
            for key, low, high, a, b in zip(
                batch.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), first[:-1].tolist(), first[1:].tolist()
            ):
                n = b - a
                h1, h2, h3, h4 = numbers(key)
                whole = Pieces(own, [(TEXT, low, high - low)])
                raw = own[0][low:high].tobytes()
                if not n or h3 % 100 >= 100 - plain_percent or any(m in raw for m in (PREFIX, SUFFIX, MIDDLE)):
                    form, chars, arranged = "plain", (None, None), whole
                else:
                    form = "spm" if h4 % 100 < spm_percent else "psm"
                    cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
                    x, y = (int(starts[a + k]) - low if k < n else high - low for k in cuts)
                    chars = [int(np.count_nonzero((data[low + s : low + e] & 0xC0) != 0x80)) for s, e in ((0, x), (x, y))]
                    arranged = whole.cut(x, y).arranged(FORMS[form])
                outputs += arranged.stream()
                forms.append(form)
                sizes.append(sum(length for _, _, length in arranged.parts))
                for column, value in zip(columns, (n, form, *chars, arranged.sha256())):
                    column.append(value)
            written = b"".join(outputs)
            ends = np.cumsum(sizes)
            for low, high, form in zip(ends[:-1].tolist(), ends[1:].tolist(), forms):
                text = rebuilt(written, low, high, form)
                columns[5].append(text.sha256() if text else None)
                if texts:
                    columns[6].append(written[low:high].decode())
            arrays = [pa.array(c, pa.int64() if f.dataType == long else pa.string()) for c, f in zip(columns, schema.fields[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def restore(docs: DataFrame, form_col: str = "form", output_col: str = "output") -> DataFrame:
    """All rows with ``restored``, the text before ``fill_in_middle``; a column of this name is replaced.

    Null where the form is not known or the output has not its sentinels; a null output of a
    plain form stays null.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("restored")
    at, of = docs.columns.index(output_col), docs.columns.index(form_col)
    schema = T.StructType([*docs.schema, T.StructField("restored", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for form, output in zip(batch.column(of).to_pylist(), batch.column(at).to_pylist()):
                raw = None if output is None else output.encode()
                text = None if raw is None else rebuilt(raw, 0, len(raw), form)
                found.append(None if text is None else b"".join(text.stream()).decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=schema.names)

    return docs.mapInArrow(run, schema)

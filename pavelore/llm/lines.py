"""Removal of repeated and nearly repeated lines by a segment-partition edit join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import balanced_join
from ..session import materialize
from .common import small_batches

MAX_EDITS = 2
WORDS_PER_EDIT = 20  # words of the shorter line for each word that may be changed, added or dropped
LEAST_CHARS = 24  # shorter lines are equal or not alike
RUN = 6  # words of the run that stands for a segment of words
RUN_CHARS = 16  # characters of the run that stands for a segment of a line
LONG = 72  # characters from which it does
BROADCAST_LINES = 2_000_000  # up to so many counted line numbers of 8 bytes are broadcast
BLOCK = 1024  # bucket rows compared with as many at a time
MOST_TOGETHER = 20_000  # larger buckets are dealt out in blocks
PARTNERS = 8  # candidate pairs for each line of a bucket, beyond which lines are compared in rounds
FEW = 2 * PARTNERS + 1  # rows of a bucket that cannot have more of them
SHORT = 2_000  # characters of lines whose texts go to the tasks that compare full buckets
ROUNDS = (1, 16, None)  # earlier lines that a longer line is compared with in each round; the last has the rest
CACHED_LINES = 500_000
CHARS_TOGETHER = 200_000  # characters of lines whose keys are made at a time
INDEXED = 1 << 63  # mark of a row that stands for a segment, not for a looked-up substring
COUNTS = (1 << 32) - 1  # bits of a mark that hold counts; those between hold the number of words
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses
_OF_WORDS, _OF_CHARS = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA5A5A5A5)
_SPACE = np.array([chr(i).isspace() for i in range(0x3001)])
_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def word_edits(words: int) -> int:
    """Words that may differ from a line of so many words, or from a longer one."""
    return words // WORDS_PER_EDIT


def near(x: str, y: str, edits: int) -> bool:
    """Whether two lines are within ``edits`` character edits or the word edits of the shorter one."""
    if within(x, y, edits):
        return True
    x, y = x.split(), y.split()
    most = word_edits(min(len(x), len(y)))
    return most > 0 and within(x, y, most)


def counts_apart(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """At most twice the edit distance of each pair, from packed counts.

    Counts are modulo 4 and in Gray code, so differing bits are steps around the circle.
    """
    return np.bitwise_count(one ^ other)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) <= size:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(size, CHARS_TOGETHER) + 1, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS


def _packed_counts(owner: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
    """Counts of codes in 16 buckets, modulo 4, in Gray code, packed into 32 bits, per owner."""
    places = owner * 16 + (codes & codes.dtype.type(15)).astype(np.int64)
    counts = np.bincount(places, minlength=16 * n).reshape(n, 16) & 3
    gray = (counts ^ (counts >> 1)).astype(np.uint64)
    return (gray << np.arange(0, 32, 2, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


class Block:
    """Some lines as one array of characters, with hashes of any substring and the words."""

    def __init__(self, lines: list[str]):
        self.codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        self.size = np.array([len(x) for x in lines], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        powers, self.inverse = _powers(len(self.codes))
        rising = (self.codes.astype(np.uint64) + np.uint64(1)) * powers[: len(self.codes)]
        self.upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(rising, dtype=np.uint64)])
        self.line = np.repeat(np.arange(len(lines)), self.size)
        # a word begins where no white space follows white space or the start of a line
        wide = self.codes < len(_SPACE)
        solid = ~(wide & _SPACE[np.where(wide, self.codes, 0)])
        first = np.zeros(len(self.codes), dtype=bool)
        first[self.start[self.size > 0]] = True
        begins = solid.copy()
        begins[1:] &= ~solid[:-1] | first[1:]
        ends = solid.copy()
        ends[:-1] &= ~solid[1:] | first[1:]
        begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.word = _mixed(self.hashed(begin, end))
        self.word_line = self.line[begin]
        self.words = np.bincount(self.word_line, minlength=len(lines))
        self.word_start = np.cumsum(self.words) - self.words

    def hashed(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of substrings; equal ones have equal hashes wherever they stand."""
        return (self.upto[end] - self.upto[start]) * self.inverse[start]


def _char_keys(b: Block, edits: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Lines, keys and whether indexed, of segments and of the substrings to look up.

    A line has ``edits + 1`` segments, the last ones longer by one. A line at most ``edits``
    shorter or as long has a segment in common with one of a line's substrings: of the first
    segments that hold in all no more edits than their last one's number, the last is
    unchanged and moved by no more than the edits left and right of it. For a line of
    ``LONG`` characters or more the run of ``RUN_CHARS`` of least hash stands for a segment
    or a looked-up substring; those that are moved by little mostly have the same. Lines of
    so many words that the word edits of both exceed what character edits can do are left
    out: an edit of a character changes two words at most.
    """
    parts = edits + 1
    wanted = (b.size >= LEAST_CHARS) & (b.words < WORDS_PER_EDIT * 2 * edits + 2 * edits)
    lines = np.flatnonzero(wanted)
    long: list[list[np.ndarray]] = [[], [], [], []]
    for apart in range(edits + 1):
        other = b.size[lines] - apart
        short, longer = np.divmod(other, parts)
        for i in range(parts):
            size = short + (i >= parts - longer)
            start = i * short + np.maximum(0, i - (parts - longer))
            seed = _mixed((other * 64 + i).astype(np.uint64))
            for shift in range(max(-i, apart - (edits - i)), min(i, apart + (edits - i)) + 1):
                at, own = start + shift, not (shift or apart)
                fits = (other >= LEAST_CHARS) & (at >= 0) & (at <= b.size[lines] - size)
                ok = fits & (other < LONG)
                chosen = lines[ok]
                low = b.start[chosen] + at[ok]
                yield chosen, _mixed(b.hashed(low, low + size[ok]) ^ seed[ok]), own
                ok = fits & (other >= LONG)
                chosen = lines[ok]
                low = b.start[chosen] + at[ok]
                for held, value in zip(long, (chosen, low, size[ok], np.full(len(chosen), 2 * i + (not own)))):
                    held.append(value)
    line, low, size, kind = map(np.concatenate, long) if long[0] else [np.zeros(0, np.int64)] * 4
    if not len(line):
        return
    n = len(b.codes) - RUN_CHARS + 1
    runs = np.append((b.upto[RUN_CHARS:] - b.upto[:n]) * b.inverse[:n], np.uint64(2**64 - 1))
    order = np.argsort(kind & 1, kind="stable")  # segments first
    line, low, size, kind = line[order], low[order], size[order], kind[order]
    ends = np.stack([low, low + size - RUN_CHARS + 1], axis=1).ravel()
    key = _mixed(np.minimum.reduceat(runs, ends)[::2] ^ _mixed((kind >> 1).astype(np.uint64) + _OF_CHARS))
    once = _first_of_each(line, key)
    for own in (True, False):
        some = once[(kind[once] & 1) != own]
        yield line[some], key[some], own


def _first_of_each(line: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Places of the first row of each line and key."""
    return np.unique(_mixed(key ^ _mixed(line.astype(np.uint64))), return_index=True)[1]


def segment_words(edits: int) -> int:
    """Words of each of the ``edits + 1`` segments of lines with so many word edits."""
    return edits * WORDS_PER_EDIT // (edits + 1)


def _word_keys(b: Block) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Lines, keys and whether indexed, of the segments of words and of the substrings to look up.

    Lines of as many word edits ``k`` have ``k + 1`` segments of the same places and size, the
    last of which are looked up in longer lines as character segments are. A run of ``RUN``
    words, the one of least hash, stands for a segment or a looked-up substring; neighbouring
    substrings mostly have the same, so a line has far fewer keys than words. Only few sizes
    of segments occur, so the keys grow in proportion to the words.
    """
    own = b.words // WORDS_PER_EDIT
    if not own.any():
        return
    runs = np.zeros(len(b.word), dtype=np.uint64)
    for k in range(RUN):
        runs[: len(runs) - k] += b.word[k:] * np.uint64(pow(_BASE, k, 1 << 64))
    runs = _mixed(runs ^ _OF_WORDS)
    # the fewest edits that a line may have which is as long or shorter by no more than them
    least = np.maximum(1, -((WORDS_PER_EDIT - 1 - b.words) // (WORDS_PER_EDIT + 1)))
    most_edits = int(own.max())
    edits = np.arange(1, min(most_edits, WORDS_PER_EDIT) + 1)
    size_of = segment_words(edits)
    for size in np.unique(size_of).tolist():
        some = edits[size_of == size]
        low, high = int(some[0]), int(some[-1]) if some[-1] < WORDS_PER_EDIT else most_edits
        top = np.minimum(own, high)  # the most edits of this size that a line meets
        lines = np.flatnonzero((own > 0) & (top >= np.maximum(low, least)))
        if not len(lines):
            continue
        places = b.words[lines] - size + 1
        line = np.repeat(lines, places)
        where = np.arange(len(line)) - np.repeat(np.cumsum(places) - places, places)  # place within the line
        # segment i may stand from i * size - i to i * size + i
        open_ = -(-where // (size + 1)) <= np.minimum(where // (size - 1), top[line])
        line, where = line[open_], where[open_]
        place = b.word_start[line] + where
        best = runs[place].copy()
        for k in range(1, size - RUN + 1):
            np.minimum(best, runs[place + k], out=best)
        segment = (where % size == 0) & (where // size <= own[line]) & (own[line] >= low) & (own[line] <= high)
        order = np.argsort(~segment, kind="stable")  # segments first
        line, best, segment = line[order], best[order], segment[order]
        once = _first_of_each(line, best)
        for indexed in (True, False):
            some = once[segment[once] == indexed]
            yield line[some], best[some], indexed


def line_keys(lines: list[str], edits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``line, key, mark`` of all keys of some lines; ``line`` is a place in the list."""
    b = Block(lines)
    indexed = np.uint64(INDEXED)
    letters = _packed_counts(b.line, b.codes, len(lines))
    words = _packed_counts(b.word_line, b.word >> np.uint64(8), len(lines)) | b.words.astype(np.uint64) << np.uint64(32)
    found = []
    for marks, keys in ((letters, _char_keys(b, edits)), (words, _word_keys(b))):
        for line, key, own in keys:
            found.append((line, key, marks[line] | indexed if own else marks[line]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(map(np.concatenate, zip(*found)))


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is ``edits`` or less.

    What both begin and end with is left out. Few edits are looked for along the diagonals of
    the distance matrix, many for the length by bit-parallel steps on its band.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    if len(a) < len(b):
        a, b = b, a
    start, end = _in_common(a, b), len(b)
    if start == end:
        return len(a) - end <= edits
    tail = _in_common(a[start:][::-1], b[start:][::-1])
    a, b = a[start : len(a) - tail], b[start : end - tail]
    if not b:
        return len(a) <= edits
    if edits * edits <= 2 * len(b):
        return on_diagonals(a, b, edits)
    return banded(a, b, edits) <= edits


def on_diagonals(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is ``edits`` or less; ``a`` is as long as ``b`` or longer.

    After each edit the farthest row that each diagonal reaches follows from those of its
    neighbours, and from there as far as both texts go on alike. Diagonals from which the
    edits left do not lead to the last one are left out.
    """
    n, m = len(a), len(b)
    apart = n - m
    if apart > edits:
        return False
    nowhere = -2 * n - 2
    far = [nowhere] * (2 * edits + 3)  # row by diagonal, from -edits - 1
    middle = edits + 1
    far[middle] = _alike_from(a, 0, b, 0, m)
    if not apart and far[middle] == n:
        return True
    for edit in range(1, edits + 1):
        left = edits - edit
        before = far.copy()
        for d in range(max(-edit, apart - left), min(edit, apart + left) + 1):
            at = d + middle
            row, last = max(before[at] + 1, before[at - 1] + 1, before[at + 1]), min(n, m + d)
            if row < last:
                row += _alike_from(a, row, b, row - d, last - row)
            far[at] = row = min(row, last)
            if d == apart and row == n:
                return True
    return False


def _alike_from(a: str, i: int, b: str, j: int, most: int) -> int:
    """How many characters are alike from two places on, up to ``most``, by blocks of doubled, then halved lengths."""
    if a[i] != b[j]:
        return 0
    done, step = 1, 16
    while done + step <= most and a[i + done : i + done + step] == b[j + done : j + done + step]:
        done += step
        step *= 2
    while step > 1:
        step //= 2
        if done + step <= most and a[i + done : i + done + step] == b[j + done : j + done + step]:
            done += step
    return done


def _in_common(a: str, b: str) -> int:
    """How many characters both texts begin with."""
    most = min(len(a), len(b))
    return _alike_from(a, 0, b, 0, most) if most else 0


def banded(a: str, b: str, edits: int) -> int:
    """Edit distance of ``a`` and ``b`` if it is ``edits`` or less, else some larger number.

    Of the column of the distance matrix only the band of ``2 * edits + 1`` cells around
    the diagonal is kept, as two bit vectors of vertical steps up and down. The score
    follows the lower edge of the band down the diagonal and in the end along the last row.
    """
    rows, width = len(a), 2 * edits + 1
    full = (1 << width) - 1
    where: dict[str, int] = {}
    for i, char in enumerate(a):
        where[char] = where.get(char, 0) | 1 << i
    up = full >> edits << edits  # vertical +1 steps of the band's cells; row j + i - edits
    down = 0
    score = edits  # of the band's lowest cell
    for j, char in enumerate(b):
        mask = where.get(char, 0)
        first = j - edits  # row of the band's top cell
        match = (mask >> first if first >= 0 else mask << -first) & full
        same = match | down
        diagonal = ((((same & up) + up) ^ up) | same) & full
        right = down | ~(diagonal | up) & full
        left = diagonal & up
        beside = diagonal >> 1
        up = left | ~(beside | right) & full
        down = right & beside
        if j + edits < rows:
            score += not diagonal >> (width - 1) & 1
        else:  # the lower edge has left the matrix: follow its last row
            at = rows - 1 - first
            score += (right >> at & 1) - (left >> at & 1)
        if score > 2 * edits + 1:
            return score
    return score


def segment_rows(docs: DataFrame, edits: int, text_col: str) -> DataFrame:
    """``key, line, marks``: the segment index and its probes, for lines long enough.

    ``line`` is the line's hash, ``marks`` its letter counts and whether the key is a segment
    of its own; keys of runs of words have counts of words and their number. A task gives a
    line's rows once, however often the line comes.
    """
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("key", "line", "marks")])

    def made(names: list[int], lines: list[str]) -> pa.RecordBatch:
        line, key, marks = line_keys(lines, edits)
        return _longs(schema, key, np.array(names, dtype=np.uint64)[line], marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        names, lines, size = [], [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for line in (text or "").split("\n"):
                    if len(line) < LEAST_CHARS or not line.strip(BLANK):
                        continue
                    name = xxhash.xxh64_intdigest(line.encode(), 42)
                    if name in seen:
                        continue
                    if len(seen) >= CACHED_LINES:
                        seen.clear()
                    seen.add(name)
                    names.append(name)
                    lines.append(line)
                    size += len(line)
                    if size >= CHARS_TOGETHER:
                        yield made(names, lines)
                        names, lines, size = [], [], 0
        if names:
            yield made(names, lines)

    return docs.select(text_col).mapInArrow(run, schema)


def _longs(schema: T.StructType, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names=schema.names)


def _may_be_near(x: np.ndarray, y: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether marks of one bucket leave it open that their lines are near, and how far counts are apart."""
    low = np.uint64(COUNTS)
    apart = counts_apart(x & low, y & low)
    words = int(x.flat[0] & np.uint64(INDEXED - 1)) >> 32  # none in all of a bucket, or some in all
    open_ = ((x | y) & np.uint64(INDEXED)) > 0
    if not words:
        return open_ & (apart <= 2 * edits), apart
    m, n = ((z & np.uint64(INDEXED - 1)) >> np.uint64(32) for z in (x, y))
    most = np.minimum(m, n) // np.uint64(WORDS_PER_EDIT)
    return open_ & (apart <= 2 * most) & (np.maximum(m, n) - np.minimum(m, n) <= most), apart


def _alike(lines: np.ndarray, marks: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Pairs of different lines of one bucket that may be near; None if they are too many."""
    order = np.lexsort((~marks, lines))  # a line once, indexed if it is in one row
    lines, marks = lines[order], marks[order]
    once = np.append(True, lines[1:] != lines[:-1])
    lines, marks = lines[once], marks[once]
    found, n = [], 0
    for i in range(0, len(lines), BLOCK):
        for j in range(i, len(lines), BLOCK):
            x, y = slice(i, i + BLOCK), slice(j, j + BLOCK)
            alike, _ = _may_be_near(marks[x, None], marks[None, y], edits)
            if i == j:
                alike = np.triu(alike, 1)
            a, b = np.nonzero(alike)
            n += len(a)
            if n > PARTNERS * len(lines):
                return None
            if len(a):
                found.append((lines[x][a], lines[y][b]))
    return tuple(map(np.concatenate, zip(*found))) if found else (lines[:0], lines[:0])


def _alike_of_small(
    starts: np.ndarray, ends: np.ndarray, lines: np.ndarray, marks: np.ndarray, edits: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """What ``_alike`` finds in buckets of ``FEW`` rows at most, all of one size at once; pairs may repeat."""
    sizes = ends - starts
    of_words = marks[starts] & np.uint64(INDEXED - 1) > np.uint64(COUNTS)
    for size in np.unique(sizes).tolist():
        one, other = np.triu_indices(size, 1)
        for kind in (True, False):
            first = starts[(sizes == size) & (of_words == kind)]
            if not len(first):
                continue
            a, b = (first[:, None] + one).ravel(), (first[:, None] + other).ravel()
            differ = lines[a] != lines[b]
            a, b = a[differ], b[differ]
            if len(a):
                alike, _ = _may_be_near(marks[a], marks[b], edits)
                yield lines[a[alike]], lines[b[alike]]


def bucket_pairs(rows: DataFrame, edits: int, most: int) -> DataFrame:
    """Candidate pairs ``a < b`` of the rows that share a key.

    Rows come sorted by key, so a task holds one bucket at a time. A bucket of more than
    ``most`` rows, or of more than ``PARTNERS`` pairs for each line, gives no pairs: its
    rows are given back, with their key.
    """
    fields = [T.StructField(c, T.LongType()) for c in ("a", "b", "key", "marks")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in fields]

        def pairs(found):
            a = np.concatenate([p[0] for p in found]).view(np.int64)
            b = np.concatenate([p[1] for p in found]).view(np.int64)
            none = pa.nulls(len(a), pa.int64())
            low, high = pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))
            return pa.RecordBatch.from_arrays([low, high, none, none], names=names)

        def given_back(key, line, marks):
            columns = [pa.array(line.view(np.int64)), pa.nulls(len(key), pa.int64())]
            columns += [pa.array(key.view(np.int64)), pa.array(marks.view(np.int64))]
            return pa.RecordBatch.from_arrays(columns, names=names)

        held, crowded = [np.zeros(0, np.uint64)] * 3, None
        last = pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, names=["key", "line", "marks"])
        for batch, more in _then(batches, last):
            fresh = [c.to_numpy(zero_copy_only=False).view(np.uint64) for c in batch.columns]
            key, line, marks = (np.concatenate(p) for p in zip(held, fresh))
            ends = np.flatnonzero(np.append(key[1:] != key[:-1], not more)) + 1 if len(key) else key
            starts = np.append(0, ends[:-1])[: len(ends)].astype(np.int64)
            found, size = [], 0
            if len(starts):
                done = slice(0, ends[-1])
                several = np.minimum.reduceat(line[done], starts) != np.maximum.reduceat(line[done], starts)
                several &= np.maximum.reduceat(marks[done], starts) >= INDEXED
                several |= key[starts] == crowded if crowded is not None else False
                starts, ends_ = starts[several], ends[several]
                small = ends_ - starts <= min(most, FEW)
                if crowded is not None:
                    small &= key[starts] != crowded
                if small.any():
                    found = [x for x in _alike_of_small(starts[small], ends_[small], line, marks, edits) if len(x[0])]
                    size = sum(len(x[0]) for x in found)
                for start, end in zip(starts[~small].tolist(), ends_[~small].tolist()):
                    own = slice(start, end)
                    alike = None
                    if key[start] != crowded and end - start <= most:
                        alike = _alike(line[own], marks[own], edits)
                    if alike is None:
                        yield given_back(key[own], line[own], marks[own])
                    elif len(alike[0]):
                        found.append(alike)
                        size += len(alike[0])
                    if size >= 100_000:
                        yield pairs(found)
                        found, size = [], 0
            if found:
                yield pairs(found)
            rest = ends[-1] if len(ends) else 0
            held = [key[rest:], line[rest:], marks[rest:]]
            if len(held[0]) > most:  # all of one key: let go what is known to be too much
                crowded = held[0][0]
                yield given_back(*held)
                held = [np.zeros(0, np.uint64)] * 3

    together = rows.select("key", "line", "marks").repartition("key").sortWithinPartitions("key")
    return together.mapInArrow(run, T.StructType(fields))


def _then(batches, last):
    """Each batch, and whether another follows; an empty one comes last."""
    for batch in batches:
        yield batch, True
    yield last, False


def dealt(rows: DataFrame, most: int) -> DataFrame:
    """Rows of full buckets with ``low, high, piece``: the groups in which they are compared.

    A bucket of more than ``most`` lines is cut into pieces by line; each two pieces, and
    each with itself, are a group. So no group has more than about twice that many rows.
    """
    once = rows.groupBy("key", "line").agg(F.min("marks").alias("marks"))  # the mark of a segment is the sign
    sizes = once.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("pieces")).filter("pieces > 1")
    joined = balanced_join(once, sizes, ["key"], "left", spread_by=["line"])
    pieces = F.coalesce("pieces", F.lit(1))
    piece = F.pmod(F.xxhash64("line", "key"), pieces).cast("int")
    joined = joined.select("key", "line", "marks", piece.alias("piece"), F.explode(F.sequence(F.lit(0), pieces - 1)).alias("with"))
    return joined.select("key", "line", "marks", "piece", F.least("piece", "with").alias("low"), F.greatest("piece", "with").alias("high"))


def _groups(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[list]:
    """The columns of each group of rows with equal first three columns; texts as lists."""
    held = None
    last = pa.RecordBatch.from_arrays([pa.nulls(0, f.type) for f in schema], schema=schema)
    for batch, more in _then(batches, last):
        table = pa.Table.from_batches([batch.cast(schema)] if held is None else [held, batch.cast(schema)])
        held = table.combine_chunks().to_batches(max_chunksize=None)
        held = held[0] if held else last
        if not held.num_rows:
            continue
        key, low, high = (held.column(i).to_numpy() for i in range(3))
        new = (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        ends, start = np.flatnonzero(np.append(new, not more)) + 1, 0
        for end in ends.tolist():
            yield held.slice(start, end - start).columns
            start = end
        held = held.slice(start)


_ROW = ["key", "low", "high", "line", "marks", "piece", "open", "x", "y", "text"]
_ROW_SCHEMA = pa.schema([(c, pa.bool_() if c == "open" else pa.string() if c == "text" else pa.int64()) for c in _ROW])


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows of full buckets, group by group, in the order of their lines' places."""
    ordered = rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "p", "line")
    columns = {"open": F.coalesce("open", F.lit(False)), "x": F.col("name.x"), "y": F.col("name.y"), "text": F.col("text")}
    return ordered.select(*[columns.get(c, F.col(c).cast("long") if c not in columns else None).alias(c) for c in _ROW])


def _earlier(columns: list, edits: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each open row of a group and the rows before it that may be near, those with near counts first."""
    low, high, line, marks, piece, open_ = (c.to_numpy(zero_copy_only=False) for c in columns[1:7])
    line, marks = line.view(np.uint64), marks.view(np.uint64)
    crossing = low[0] != high[0]
    for j in np.flatnonzero(open_).tolist():
        if not j:
            continue
        alike, apart = _may_be_near(marks[j : j + 1], marks[:j], edits)
        alike &= line[:j] != line[j]
        if crossing:
            alike &= piece[:j] != piece[j]
        at = np.flatnonzero(alike)
        if len(at):
            # ties by a mix of both lines, so that no line is every other one's first choice
            yield j, at[np.lexsort((_mixed(line[at] ^ line[j]), apart[at]))]


def later_in_groups(rows: DataFrame, edits: int) -> DataFrame:
    """``line, name`` of open lines that are near an earlier one of a group; both have their texts.

    A line is compared with earlier ones until one is near, in the task that holds the
    group, so no row is made for a pair.
    """
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("line", "x", "y")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gone: set[int] = set()  # lines that the task has found in another group
        for columns in _groups(batches, _ROW_SCHEMA):
            texts, lines, found = columns[9].to_pylist(), columns[3].to_pylist(), []
            of_words = (columns[4][0].as_py() & (INDEXED - 1)) >> 32 > 0
            if of_words:  # what is near by characters alone has keys of characters
                texts = [None if t is None else t.split() for t in texts]
            for j, at in _earlier(columns, edits):
                y = texts[j]
                if y is None or lines[j] in gone:
                    continue
                for i in at.tolist():
                    x = texts[i]
                    if x is not None and within(x, y, word_edits(min(len(x), len(y))) if of_words else edits):
                        found.append(j)
                        break
            if found:
                if len(gone) > CACHED_LINES:
                    gone.clear()
                gone.update(lines[j] for j in found)
                place = pa.array(found)
                yield pa.RecordBatch.from_arrays([columns[c].take(place) for c in (3, 7, 8)], names=schema.names)

    found = _ordered(rows).mapInArrow(run, schema)
    return found.select("line", F.struct("x", "y").alias("name")).distinct()


def earlier_pairs(rows: DataFrame, edits: int, skip: int, limit: int | None) -> DataFrame:
    """``a, b``: for each open line some earlier ones of its groups that may be near, one of both without text.

    Of the earlier lines ``skip`` are left out and ``limit`` are given; ``b`` is null where there are more.
    """
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _groups(batches, _ROW_SCHEMA):
            line, bare = columns[3].to_numpy(), columns[9].is_null().to_numpy(zero_copy_only=False)
            a, b, size = [], [], 0
            for j, at in _earlier(columns, edits):
                at = at if bare[j] else at[bare[at]]
                chosen = at[skip:] if limit is None else at[skip : skip + limit]
                if len(chosen):
                    more = limit is not None and len(at) > skip + limit
                    b.append(line[np.append(chosen, j) if more else chosen])
                    a.append(np.full(len(b[-1]), line[j]))
                    size += len(b[-1])
                if size >= 100_000:
                    yield _pair_batch(a, b, schema)
                    a, b, size = [], [], 0
            if a:
                yield _pair_batch(a, b, schema)

    return _ordered(rows).mapInArrow(run, schema)


def _pair_batch(a: list[np.ndarray], b: list[np.ndarray], schema: T.StructType) -> pa.RecordBatch:
    """Pairs; a line beside itself stands for more to come and becomes a null."""
    x, y = np.concatenate(a), np.concatenate(b)
    return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y, mask=x == y)], names=schema.names)


def verified(pairs: DataFrame, lines: DataFrame, edits: int) -> DataFrame:
    """``line, name`` of lines of which an earlier one is ``near``; ``lines`` has their texts and places."""
    left = lines.select(F.col("line").alias("a"), F.col("name").alias("one"), F.col("text").alias("x"), "p")
    right = lines.select(F.col("line").alias("b"), F.col("name").alias("other"), F.col("text").alias("y"), F.col("p").alias("q"))
    both = pairs.join(left, "a").join(right, "b")
    first = F.col("p") < F.col("q")
    both = both.select(
        F.when(first, F.col("b")).otherwise(F.col("a")).alias("line"),
        F.when(first, F.col("other")).otherwise(F.col("one")).alias("name"), "x", "y",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            alike = pa.array([near(x, y, edits) for x, y in texts], pa.bool_())
            yield batch.select([0, 1]).filter(alike)

    return both.mapInArrow(run, both.select("line", "name").schema).distinct()


def later_lines(docs: DataFrame, first: DataFrame, edits: int, text_col: str) -> DataFrame:
    """``line, name`` of the lines that are ``near`` an earlier one; ``first`` has names and first places.

    A line's name is a struct of two hashes. Buckets with few candidates give pairs. The lines
    of all others go with their texts to the tasks that compare them with earlier ones as
    long as none is near; those without text, of more than ``SHORT`` characters, are paired in
    rounds with few earlier lines, with more, and with all the rest. So many variants of a line
    make few pairs. Texts are fetched by a second look at the documents, and every pair is
    verified.
    """
    found = materialize(bucket_pairs(segment_rows(docs, edits, text_col), edits, MOST_TOGETHER))
    pairs = materialize(found.filter("b IS NOT NULL").select("a", "b").distinct())
    full = found.filter("b IS NULL").select("key", F.col("a").alias("line"), "marks")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("line")).unionByName(full.select("line"))
    wanted = materialize(wanted.distinct())
    if wanted.count() <= BROADCAST_LINES:
        wanted = F.broadcast(wanted)
    lines = exploded(docs.select(text_col), text_col).filter(F.length("text") >= LEAST_CHARS)
    lines = lines.withColumn("line", F.xxhash64("text")).join(wanted, "line", "left_semi")
    lines = lines.select("line", name("text").alias("name"), "text").distinct()
    lines = materialize(lines.join(first.withColumnRenamed("key", "p"), "name"))
    gone = materialize(verified(pairs, lines, edits))
    if full.isEmpty():
        return gone
    short = F.when(F.length("text") <= SHORT, F.col("text")).alias("text")
    rows = dealt(full, MOST_TOGETHER).join(lines.select("line", "name", "p", short), "line")
    left = lines.select("line").join(gone.select("line"), "line", "left_anti").withColumn("open", F.lit(True))
    rows = materialize(rows.join(left.distinct(), "line", "left"))
    gone = gone.unionByName(materialize(later_in_groups(rows, edits)))
    rows, skip = rows.drop("open"), 0
    for limit in ROUNDS if not rows.filter("text IS NULL").isEmpty() else ():
        left = materialize(rows.select("line").distinct() if not skip else left)
        left = left.join(gone.select("line").distinct(), "line", "left_anti").withColumn("open", F.lit(True))
        asked = materialize(earlier_pairs(rows.join(left, "line", "left"), edits, skip, limit))
        gone = gone.unionByName(materialize(verified(asked.filter("b IS NOT NULL").distinct(), lines, edits)))
        left = asked.filter("b IS NULL").select(F.col("a").alias("line")).distinct()
        if left.isEmpty():
            break
        skip += limit or 0
    return materialize(gone.distinct())


BLANK = " \t\r\x0b\x0c"


def exploded(docs: DataFrame, text_col: str) -> DataFrame:
    """A row per line: the other columns, ``at`` (its number from 0) and ``text``."""
    others = [c for c in docs.columns if c != text_col]
    parts = F.posexplode(F.split(F.col(text_col), "\n")).alias("at", "text")
    rows = docs.select(*others, parts)
    return rows.filter(F.length(F.trim(F.col("text"), F.lit(BLANK))) > 0)


def name(line) -> F.Column:
    """128 bits that stand for a line's text."""
    return F.struct(F.xxhash64(line).alias("x"), F.xxhash64(F.lit(7), F.col(line)).alias("y"))


def deduplicate_lines(
    docs: DataFrame, edits: int = MAX_EDITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Keep each line where it comes first; drop its copies and later near copies.

    Lines are ordered by document id (null last) and place. A line goes if an equal line
    comes earlier, or a near one, both of 24 characters or more, whose first place is
    earlier. Near are lines within ``edits`` character edits, or that differ by at most one
    word (changed, added or dropped) in ``WORDS_PER_EDIT`` of the shorter line. Blank lines stay. Returns all rows and columns with the
    text that is left, ``n_lines`` (not blank) and ``removed`` (numbers of the lines that
    went, from 0); columns of these two names are replaced.

    A null text stays null, with no lines. Rows that share an id are one document: each
    keeps the lines whose first place has this id and number. Repeated rows stay as they
    are among themselves. No rows give no rows.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("n_lines", "removed")
    key = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("at").alias("at"))
    lines = exploded(docs.select(F.col(id_col).alias("id"), text_col), text_col)
    first = materialize(lines.select(name("text").alias("name"), key.alias("key")).groupBy("name").agg(F.min("key").alias("key")))
    kept = first.join(later_lines(docs, first, edits, text_col).select("name"), "name", "left_anti")
    kept = kept.groupBy(F.col("key.id").alias("_id")).agg(F.collect_list("key.at").alias("_kept"))
    joined = docs.join(kept, docs[id_col].eqNullSafe(kept["_id"]), "left").drop("_id")
    names = docs.columns
    schema = T.StructType(
        [*docs.schema, T.StructField("n_lines", T.IntegerType()), T.StructField("removed", T.ArrayType(T.IntegerType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text_col)
        for batch in batches:
            texts, sizes, removed = [], [], []
            for text, keep in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()):
                keep = set(keep or ())
                parts = [] if text is None else text.split("\n")
                full = [i for i, line in enumerate(parts) if line.strip(BLANK)]
                gone = {i for i in full if i not in keep}
                left = [line for i, line in enumerate(parts) if i not in gone]
                texts.append(None if text is None else "\n".join(left))
                sizes.append(len(full))
                removed.append(sorted(gone))
            columns = batch.columns[: len(names)]
            columns[at] = pa.array(texts, columns[at].type)
            columns += [pa.array(sizes, pa.int32()), pa.array(removed, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return joined.mapInArrow(run, schema)

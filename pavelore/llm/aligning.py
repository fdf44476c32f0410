"""Alignment of two tokenizations of the same text by skipping runs along a diagonal."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .common import small_batches
from .tokens import _HIDDEN

PROBE = 8  # ends compared first on a diagonal
MARK = "▁"  # how the second tokenizer writes a space
#: How byte-level tokenizers of this kind cut a text before they merge (fixed value).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
BYTES = {chr(b): bytes([b]) for b in range(256) if b not in _HIDDEN} | {c: bytes([b]) for b, c in _HIDDEN.items()}


class Vocabularies:
    """The tokens of both tokenizers as bytes, and the id pairs that can end together.

    Of two tokens that end at the same byte the shorter one's bytes are a suffix of the
    longer one's. So the pairs are at most the summed lengths of all tokens, times the ids
    that share bytes; ``pairs`` holds them in order as ``a * len(second) + b``.
    """

    def __init__(self, first: list[bytes], second: list[bytes]):
        self.first, self.second = first, second
        self.first_size = np.array([len(x) for x in first], dtype=np.int64)
        self.second_size = np.array([len(x) for x in second], dtype=np.int64)
        found = [a * len(second) + b for a, ids in self._suffixes(first, second) for b in ids]
        found += [a * len(second) + b for b, ids in self._suffixes(second, first) for a in ids]
        self.pairs = np.unique(np.array(found, dtype=np.int64))

    @staticmethod
    def _suffixes(longer: list[bytes], shorter: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """The ids of ``shorter`` whose bytes end each token of ``longer``."""
        where: dict[bytes, list[int]] = {}
        for i, token in enumerate(shorter):
            where.setdefault(token, []).append(i)
        for i, token in enumerate(longer):
            for at in range(len(token)):
                if ids := where.get(token[at:]):
                    yield i, ids

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Numbers of id pairs within ``pairs``."""
        return np.searchsorted(self.pairs, a * len(self.second) + b)


class Encoders:
    """Both tokenizers, each applied to whole texts.

    The first is a byte-level one. Where its merges make ids in their order, as published
    ones do, a merge by least id is the same, and the faster library is used.
    """

    def __init__(self, first_path: str, second_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(first_path)
        self.tokenizer.encode_special_tokens = True
        self.pieces = SentencePieceProcessor(model_file=second_path)
        names = self.tokenizer.get_vocab()
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        first = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            first[i] = name.encode() if name in special else b"".join(BYTES.get(c, c.encode()) for c in name)
        second = []
        for i in range(self.pieces.get_piece_size()):
            name = self.pieces.id_to_piece(i)
            second.append(bytes([int(name[3:-1], 16)]) if self.pieces.is_byte(i) else name.replace(MARK, " ").encode())
        self.vocabularies = Vocabularies(first, second)
        self.ranks = self._ranked(first_path, names, special)

    def _ranked(self, path: str, names: dict[str, int], special: set[str]):
        """The first tokenizer by ranks; None if its file is not of that kind."""
        import tiktoken

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, cut = told["model"], told.get("pre_tokenizer") or {}
        plain = told.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
        if model.get("type") != "BPE" or not plain or cut.get("add_prefix_space") or model.get("ignore_merges"):
            return None
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [names.get("".join(pair), -1) for pair in pairs]
        if made != sorted(set(made)) or any(max(names[x], names[y]) >= i for (x, y), i in zip(pairs, made)):
            return None
        tokens = {self.vocabularies.first[i]: i for name, i in names.items() if name not in special}
        if len(made) + 256 != len(tokens):
            return None
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=tokens, special_tokens={})

    def _first(self, text: str) -> list[int]:
        if self.ranks is not None:
            try:
                return self.ranks.encode_ordinary(text)
            except BaseException as error:  # its pattern search gives up on very long runs of white space
                if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids by both tokenizers; None for texts that have no tokens."""
        a_bytes, b_bytes = (v.__getitem__ for v in (self.vocabularies.first, self.vocabularies.second))
        found: list[tuple[np.ndarray, np.ndarray] | None] = []
        for text in texts:
            if not text:
                found.append(None)
                continue
            x, y = self._first(" " + text), self.pieces.encode(text)
            want = (" " + text).encode()
            # tokens by ranks hold all single bytes, so they always rebuild the text
            same = b"".join(map(b_bytes, y)) == want
            same = same and (self.ranks is not None or b"".join(map(a_bytes, x)) == want)
            found.append((np.array(x, dtype=np.int64), np.array(y, dtype=np.int64)) if same else None)
        return found


_LOADED: dict[tuple[str, str], Encoders] = {}


def encoders(first_path: str, second_path: str) -> Encoders:
    """The worker's encoders; kept between tasks."""
    key = (first_path, second_path)
    if key not in _LOADED:
        _LOADED[key] = Encoders(*key)
    return _LOADED[key]


def stretches(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int]]:
    """Maximal stretches ``i, j, length`` where ends of ``a`` from ``i`` equal those of ``b`` from ``j``.

    Both arrays rise and have their last end in common. At the current shift ``j - i``
    blocks of doubled lengths, ``PROBE`` ends first, are compared until one differs, then
    halves of it and its last ends one by one, so a stretch of one-to-one tokens is jumped
    in a logarithmic number of comparisons. Where it ends, the array that lags goes ahead until both meet again: the irregular group,
    which sets the new shift.
    """
    n, m = len(a), len(b)
    x, y = a.tolist(), b.tolist()
    found = []
    i = j = 0
    while i < n and j < m:
        while x[i] != y[j]:
            if x[i] < y[j]:
                i += 1
            else:
                j += 1
        most = min(n - i, m - j)
        length, step = 1, PROBE
        while length + step <= most and x[i + length : i + length + step] == y[j + length : j + length + step]:
            length += step
            step *= 2
        while step > PROBE:
            step //= 2
            if length + step <= most and x[i + length : i + length + step] == y[j + length : j + length + step]:
                length += step
        while length < most and x[i + length] == y[j + length]:
            length += 1
        found.append((i, j, length))
        i += length
        j += length
    return found


@dataclass
class Aligned:
    """The groups of a batch of texts: the last token of each on both sides."""

    first: np.ndarray  # ids of all texts, one after another
    second: np.ndarray
    last_first: np.ndarray  # index of each group's last token
    last_second: np.ndarray


def align(first: np.ndarray, second: np.ndarray, v: Vocabularies) -> Aligned:
    """Groups of the tokens of one or more texts; each text's last tokens end together."""
    runs = stretches(np.cumsum(v.first_size[first]), np.cumsum(v.second_size[second]))
    i, j, length = np.array(runs, dtype=np.int64).reshape(-1, 3).T
    along = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    return Aligned(first, second, np.repeat(i, length) + along, np.repeat(j, length) + along)


def written(x: Aligned, names: np.ndarray, v: Vocabularies) -> list[bytes]:
    """All tokens in the order of the group notation, each with the mark that follows it.

    A group is the first tokenizer's ids, ``|`` and the second's, with commas between them;
    groups end with ``;``. ``names`` are four tables of texts, one after another.
    """
    n_a, n_b = len(v.first), len(v.second)
    ends_a, ends_b = np.zeros(len(x.first), dtype=np.int64), np.zeros(len(x.second), dtype=np.int64)
    ends_a[x.last_first] = 1
    ends_b[x.last_second] = 1
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    before_b = np.append(0, x.last_second + 1)[group_a]
    before_a = (x.last_first + 1)[group_b]
    codes = np.empty(len(x.first) + len(x.second), dtype=np.int64)
    codes[np.arange(len(x.first)) + before_b] = x.first + n_a * ends_a
    codes[np.arange(len(x.second)) + before_a] = 2 * n_a + x.second + n_b * ends_b
    return names[codes].tolist()


def decimals(v: Vocabularies) -> np.ndarray:
    """Tables for ``written``: ids before a comma and before a mark, for both sides."""
    parts = [(len(v.first), b","), (len(v.first), b"|"), (len(v.second), b","), (len(v.second), b";")]
    found = np.empty(sum(n for n, _ in parts), dtype=object)
    found[:] = [b"%d%s" % (i, mark) for n, mark in parts for i in range(n)]
    return found


_GROUPS = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups")]
    + [T.StructField("groups_sha256", T.StringType()), T.StructField("links", T.BinaryType())]
)


def aligned_documents(
    docs: DataFrame, first_path: str, second_path: str, id_col: str = "doc_id", text_col: str = "text", groups: bool = False
) -> DataFrame:
    """Per document the groups of its two tokenizations and their links.

    Returns ``doc_id, n_a, n_b, n_groups, groups_sha256, links``; ``links`` are unsigned
    little-endian 32-bit numbers of id pairs (``Vocabularies.pairs``), one per group: its
    last two tokens end together. With ``groups`` the notation itself follows as ``groups``.
    Texts that are null, empty or not rebuilt by both tokenizers have no tokens: zeros, an
    empty notation, no links. A null id is carried; repeated rows stay; other columns are
    not looked at; no rows give no rows.
    """
    small_batches(docs.sparkSession)
    fields = [T.StructField("doc_id", docs.schema[id_col].dataType), *_GROUPS.fields]
    schema = T.StructType([*fields, *([T.StructField("groups", T.StringType())] if groups else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = encoders(first_path, second_path)
        v = both.vocabularies
        names = decimals(v)
        for batch in batches:
            found = both.encode(batch.column(1).to_pylist())
            sizes = np.array([(len(x[0]), len(x[1])) if x else (0, 0) for x in found], dtype=np.int64).reshape(-1, 2)
            none = np.zeros(0, dtype=np.int64)
            first, second = (np.concatenate([none, *(x[k] for x in found if x)]) for k in (0, 1))
            x = align(first, second, v)
            tokens = written(x, names, v)
            links = v.pair(first[x.last_first], second[x.last_second]).astype("<u4")
            text_ends = np.cumsum(sizes[:, 0])
            n_groups = np.diff(np.searchsorted(x.last_first, text_ends), prepend=0)
            hashes, parts, notes, at, link_at = [], [], [], 0, 0
            for n, size in zip(n_groups.tolist(), sizes.sum(axis=1).tolist()):
                note = b"".join(tokens[at : at + size])[:-1]
                hashes.append(hashlib.sha256(note).hexdigest() if size else "")
                parts.append(links[link_at : link_at + n].tobytes())
                if groups:
                    notes.append(note.decode())
                at, link_at = at + size, link_at + n
            columns = [
                batch.column(0), pa.array(sizes[:, 0]), pa.array(sizes[:, 1]), pa.array(n_groups),
                pa.array(hashes, pa.string()), pa.array(parts, pa.binary()),
            ]
            if groups:
                columns.append(pa.array(notes, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def link_counts(found: DataFrame, size: int) -> np.ndarray:
    """How many links of all documents hold each pair; a task gives each pair once.

    ``size``, the number of pairs of the vocabularies, bounds what a task holds and what
    the driver gets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, dtype=np.int64)
        for batch in batches:
            links = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4")
            counts += np.bincount(links, minlength=size)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["pair", "n"])

    rows = found.select("links").mapInArrow(run, "pair long, n long")
    table = rows.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size, dtype=np.int64)
    counts[table.column("pair").to_numpy()] = table.column("n").to_numpy()
    return counts


def best_pairs(counts: np.ndarray, v: Vocabularies) -> np.ndarray:
    """Whether each pair's count is the highest of all pairs with its second id."""
    ids = v.pairs % len(v.second)
    most = np.zeros(len(v.second), dtype=np.int64)
    np.maximum.at(most, ids, counts)
    return counts == most[ids]


def align_tokenizers(
    docs: DataFrame, first_path: str, second_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Align two tokenizations of every text and rate the links by all texts' counts.

    Returns ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``. A
    link is a pair of tokens that end together, the last ones of a group; ``n_best`` are
    links whose pair has its second id's highest count, ties included; ``count_sum`` sums
    the counts of a document's links. Odd rows are as in ``aligned_documents``.

    Texts are tokenized once; links are written to the shared folder, counted, and read
    again beside the counts, which the vocabularies bound (under 10 MB).
    """
    spark = docs.sparkSession
    v = encoders(first_path, second_path).vocabularies
    path = scratch_path(spark, "links")
    aligned_documents(docs, first_path, second_path, id_col, text_col).write.option("compression", "zstd").parquet(path)
    found = spark.read.parquet(path)
    counts = link_counts(found, len(v.pairs))
    shared = spark.sparkContext.broadcast((counts, best_pairs(counts, v)))
    schema = T.StructType([*found.drop("links").schema, *(T.StructField(c, T.LongType()) for c in ("n_links", "n_best", "count_sum"))])
    at = found.columns.index("links")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = shared.value
        for batch in batches:
            links = batch.column(at).to_pylist()
            sizes = np.array([len(x) // 4 for x in links], dtype=np.int64)
            pairs = np.frombuffer(b"".join(links), "<u4")
            upto = [np.append(0, np.cumsum(part[pairs])) for part in (best, counts)]
            ends = np.cumsum(sizes)
            columns = [c for i, c in enumerate(batch.columns) if i != at] + [pa.array(sizes)]
            columns += [pa.array(part[ends] - part[ends - sizes]) for part in upto]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return found.mapInArrow(run, schema).select(*names)

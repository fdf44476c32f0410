"""Non-negative positive-unlabelled learning of a toxicity classifier."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

BITS = 18
MOST_POSITIVE = 4_000  # confirmed toxic texts that are learned from, at most (expected)
MOST_UNLABELLED = 16_000  # other texts that are learned from, at most (expected)
LEAST_TEXTS = 5  # a feature is in so many sample texts at least
LEAST_Z = 5.0  # and its shares differ by so many standard errors
EPOCHS = 10
BATCH = 256
RATE = 0.2
DECAY = 1e-4
CACHED_WORDS = 200_000
EDGES = b".,!?;:()[]{}\"'*_-"


class Features(dict):
    """Feature number of a word; bounded, kept per Python worker."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        number = self[word] = zlib.crc32(word.strip(EDGES)) & ((1 << BITS) - 1)
        return number


_FEATURES = Features()


def features(text: str | None) -> set[int]:
    """Distinct hashed words of the whole text, in lower case and without punctuation around."""
    return set(map(_FEATURES.__getitem__, text.lower().encode().split())) if text else set()


@dataclass
class Model:
    """``weight`` per feature (few are not zero) and the bias of a logistic classifier."""

    weight: dict[int, float]
    bias: float

    def score(self, text: str | None) -> float:
        get = self.weight.get
        z = self.bias + sum(sorted(get(f, 0.0) for f in features(text)))
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def _stack(texts: list[np.ndarray], keep: np.ndarray) -> list[np.ndarray]:
    """Numbers of the kept features of each text, in the order of ``keep``."""
    return [np.searchsorted(keep, x[np.isin(x, keep)]) for x in texts]


def _rows(texts: list[np.ndarray], chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts = [texts[i] for i in chosen]
    return np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def fit(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    epochs: int = EPOCHS,
    batch: int = BATCH,
    rate: float = RATE,
    decay: float = DECAY,
    seed: int = 0,
) -> Model | None:
    """Train on feature sets with the non-negative risk estimator.

    With prior ``p`` the risk is ``p R+(positive) + max(0, R-(unlabelled) - p R-(positive))``,
    R+ and R- being mean logistic losses for label 1 and 0. Where a batch's second part is
    negative, the step goes the other way, which keeps the classifier from fitting
    unlabelled positives as negatives. Equal positive sets count once. In the end the bias is
    moved so that the share ``p`` of the unlabelled set scores 0.5 or more. None if either
    set is empty.
    """
    if not positive or not unlabelled:
        return None
    positive = list({x.tobytes(): x for x in positive}.values())
    size = 1 << BITS
    in_p = np.bincount(np.concatenate(positive), minlength=size)
    in_u = np.bincount(np.concatenate(unlabelled), minlength=size)
    n_p, n_u = len(positive), len(unlabelled)
    share = (in_p + in_u) / (n_p + n_u)
    error = np.sqrt(np.maximum(share * (1 - share) * (1 / n_p + 1 / n_u), 1e-12))
    apart = np.abs(in_p / n_p - in_u / n_u) / error
    keep = np.flatnonzero((apart >= LEAST_Z) & (in_p + in_u >= LEAST_TEXTS))
    value = np.minimum(np.log((n_p + n_u) / np.maximum((in_p + in_u)[keep], 1)), 8) / 8
    p, u = _stack(positive, keep), _stack(unlabelled, keep)
    rng = np.random.default_rng(seed)
    w, bias = np.zeros(len(keep)), 0.0
    squares, bias_squares = np.full(len(keep), 1e-4), 1e-4
    turns = max(1, n_u // batch)
    for _ in range(epochs):
        order_u = np.array_split(rng.permutation(n_u), turns)
        order_p = np.array_split(rng.permutation(max(n_p, turns)) % n_p, turns)
        for iu, ip in zip(order_u, order_p):
            fp, rp = _rows(p, ip)
            fu, ru = _rows(u, iu)
            zp = np.bincount(rp, w[fp] * value[fp], len(ip)) + bias
            zu = np.bincount(ru, w[fu] * value[fu], len(iu)) + bias
            rest = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
            if rest >= 0:
                dp, du = prior * (sp - 1 - sp) / len(ip), su / len(iu)
            else:
                dp, du = prior * sp / len(ip), -su / len(iu)
            step = np.bincount(fp, dp[rp] * value[fp], len(keep))
            step += np.bincount(fu, du[ru] * value[fu], len(keep)) + decay * w
            squares += step * step
            w -= rate * step / np.sqrt(squares)
            step = dp.sum() + du.sum()
            bias_squares += step * step
            bias -= rate * step / np.sqrt(bias_squares)
    fu, ru = _rows(u, np.arange(n_u))
    bias = -np.quantile(np.bincount(ru, w[fu] * value[fu], n_u), 1 - prior) - 1e-9
    return Model(dict(zip(keep.tolist(), (w * value).tolist())), float(bias))


def _feature_sets(texts: DataFrame) -> list[np.ndarray]:
    """Feature sets of a bounded sample, in an order that its content fixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(features(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], names=["f"])

    schema = T.StructType([T.StructField("f", T.ArrayType(T.IntegerType()))])
    rows = texts.select("text").mapInArrow(run, schema).toArrow().column("f").to_pylist()
    return [np.array(x, dtype=np.int64) for x in sorted(rows)]


def _below(share: float):
    """Whether the hash of the id is within this share of all hashes."""
    return F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, share))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    most_positive: int = MOST_POSITIVE,
    most_unlabelled: int = MOST_UNLABELLED,
    prior: float | None = None,
) -> Model | None:
    """Learn from the confirmed toxic ones and a sample of all texts, taken as unlabelled.

    Both samples are those with a low hash of the id, so they do not depend on the order of
    rows; their expected sizes are bounded by the two parameters. ``prior`` is the share of
    toxic texts, by default that among the labelled ones. Of several labels of a document
    the highest counts. None (no model) without any confirmed toxic text.
    """
    small_batches(docs.sparkSession)
    marks = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, toxic = marks.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not toxic:
        return None
    prior = min(0.99, toxic / n) if prior is None else prior
    named = docs.filter("doc_id IS NOT NULL")
    few = marks.filter("toxic = 1").filter(_below(most_positive / toxic)).select("doc_id")
    positive = named.join(F.broadcast(few), "doc_id", "left_semi")
    unlabelled = named.filter(_below(most_unlabelled / max(1, named.count())))
    return fit(_feature_sets(positive), _feature_sets(unlabelled), prior)


def score(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 if the score is 0.5 or more, else 0).

    The whole text counts; a null text is an empty one and scores the model's bias. With
    no model every score is 0. Columns of these two names are replaced; all others and
    repeated rows stay.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = T.StructType(
        [docs.schema[c] for c in kept]
        + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(kept.index(text_col)).to_pylist()
            got = [model.score(t) if model else 0.0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns, pa.array(got, pa.float64()),
                    pa.array([int(s >= 0.5) for s in got], pa.int32()),
                ],
                names=schema.names,
            )

    return docs.select(*kept).mapInArrow(run, schema)

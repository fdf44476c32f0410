"""Near-duplicate documents by fast similarity sketches."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linking import link
from .shingles import U64, scramble

COORDINATES = 160
BAND_ROWS = 5
WIDTH = 5
PERCENT = 80
BLOCK = 1024  # hashes that one step sorts
_VALUE_BITS = 40
_SEEDS = scramble(np.arange(1, 513, dtype=U64) * U64(0x9E3779B97F4A7C15))


def sketch(shingles: np.ndarray, size: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketch of a set: ``size`` coordinates, every one filled.

    Round by round each element is hashed to a bin and a value; a bin keeps the least value
    of the first round that reaches it. After ``size`` rounds a round of its own, with
    all elements, fills each bin that is still empty. Two sets agree in a coordinate with a
    chance equal to their Jaccard similarity. Small sets take many rounds at a time.
    """
    if not 0 < size <= 256:
        raise ValueError("a sketch has 1 to 256 coordinates")
    out = np.zeros(size, dtype=U64)
    empty = np.ones(size, dtype=bool)
    starts = np.arange(size, dtype=U64) << U64(56)
    done = 0
    while done < size and empty.any():
        rounds = min(size - done, max(1, BLOCK // len(shingles)))
        h = scramble(shingles[None, :] + _SEEDS[done : done + rounds, None])
        place = ((h >> U64(_VALUE_BITS)) * U64(size)) >> U64(64 - _VALUE_BITS)
        turn = np.arange(rounds, dtype=U64)[:, None]
        keys = (place << U64(56)) | (turn << U64(48)) | ((h & U64(2**_VALUE_BITS - 1)) << U64(8))
        keys = np.sort(keys, axis=None)
        at = np.searchsorted(keys, starts)
        least = keys[np.minimum(at, len(keys) - 1)]
        fresh = empty & (at < len(keys)) & (least >> U64(56) == starts >> U64(56))
        out[fresh] = (least[fresh] & U64(2**56 - 1)) + (U64(done) << U64(48))
        empty &= ~fresh
        done += rounds
    for b in np.flatnonzero(empty):
        least = scramble(shingles + _SEEDS[size + b]).min()
        out[b] = (U64(size + b) << U64(48)) | (least >> U64(64 - _VALUE_BITS)) << U64(8)
    return out


def band_hashes(coordinates: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One number per band of ``rows`` coordinates."""
    bands = coordinates[: len(coordinates) // rows * rows].reshape(-1, rows)
    found = np.arange(1, len(bands) + 1, dtype=U64)
    for at in range(rows):
        found = scramble((found + bands[:, at]) * U64(0x9E3779B97F4A7C15))
    return found


def bands(shingles: np.ndarray) -> np.ndarray:
    return band_hashes(sketch(shingles))


def near_duplicates(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per input row.

    Documents with a Jaccard similarity of ``percent`` or more on their shingles of
    ``width`` words are linked; a component is named by its smallest id, whose row is kept.
    32 bands of 5 coordinates miss a pair at the threshold with a chance of 3 in a million
    and fewer above; each link is confirmed on the whole sets.

    A text without words is linked with nothing. Rows that share an id have the component of
    their own text each. A row without id is linked with nothing, has no component and is
    kept. Other columns are not looked at; no rows give no rows.
    """
    found = link(docs, bands, width, percent, id_col, text_col)
    kept = F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))
    return found.withColumn("kept", kept)

"""Mixing sources to target weights with thresholds on a hash of the document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import global_rank
from ..session import materialize
from .common import WORD

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
HASH_DIGITS = 15  # hexadecimal digits of the hash: 60 bits
LEVEL_DIGITS = 3  # digits that one histogram resolves: 4,096 buckets a source
BROADCAST_SOURCES = 10_000  # up to so many counted sources are joined by broadcast


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(key: Column) -> Column:
    """The first 60 bits of the md5 of the id as text; 0 for a null id."""
    digits = F.substring(F.md5(key.cast("string").cast("binary")), 1, HASH_DIGITS)
    return F.coalesce(F.conv(digits, 16, 10).cast("long"), F.lit(0).cast("long"))


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
) -> DataFrame:
    """Add ``target`` to one row per source of ``source, source_size``.

    Sources in code point order, null last, weigh ``weights`` in turn. They share ``share``
    times all sizes; a target stops at ``epochs`` times its source, and the excess is
    shared again by weight until none is above. A round is one aggregate; two numbers come
    back from it.
    """
    place = global_rank(sizes, [F.col("source").asc_nulls_last()], "_rank")
    turn = F.element_at(
        F.array(*map(F.lit, weights)), (F.pmod(F.col("_rank") - 1, len(weights)) + 1).cast("int")
    )
    held = materialize(place.withColumn("_weight", turn.cast("double")))
    total = held.agg(F.sum("source_size")).first()[0] or 0
    most = F.col("source_size") * float(epochs)
    rate, full = 0.0, None
    while True:
        above = F.col("_weight") * rate >= most
        state = held.agg(
            F.coalesce(F.sum(F.when(above, most)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("_weight"))), F.lit(0.0)),
            F.count(F.when(above, 1)),
        ).first()
        if state[2] == full or not state[1]:
            break
        full, rate = state[2], (share * total - state[0]) / state[1]
    target = F.when(F.col("_weight") * rate >= most, most).otherwise(F.col("_weight") * rate)
    return held.select("source", "source_size", target.alias("target"))


def _join_sources(docs: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    """Left join on ``source``, null equal to null; ``sources`` has one row per source."""
    right = sources.withColumnRenamed("source", "_source")
    right = F.broadcast(right) if few else right
    return docs.join(right, docs["source"].eqNullSafe(right["_source"]), "left").drop("_source")


def hash_thresholds(sized: DataFrame, budgets: DataFrame, few: bool) -> DataFrame:
    """``source, limit``: documents with a hash below the limit hold about ``budget`` words.

    Level by level the words are summed by source and hash bucket, combined before the
    shuffle. Running sums over a source's buckets find the one that the budget falls in;
    only its rows are looked at on the next level, in buckets 4,096 times finer, until each
    source's boundary bucket is one hash value. That value's rows are taken if this comes
    nearer to the budget. ``limit`` is null where all rows fit.
    """
    base = 16**LEVEL_DIGITS
    levels = HASH_DIGITS // LEVEL_DIGITS
    state = materialize(
        budgets.select(
            "source", "budget", F.lit(0).cast("long").alias("low"),
            F.lit(0.0).alias("taken"), F.lit(False).alias("done"),
        )
    )
    for level in range(levels):
        width = base ** (levels - 1 - level)  # hashes in a bucket of this level
        open_ = state.filter(~F.col("done"))
        rows = _join_sources(sized, open_, few).filter(F.col("budget").isNotNull())
        if level:
            rows = rows.filter(F.expr(f"hash div {width * base} = low div {width * base}"))
        bucket = F.expr(f"hash div {width}")
        sums = rows.groupBy("source", bucket.alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("hash").alias("least"), F.max("hash").alias("most")
        )
        state = materialize(_boundary(sums, state, width))
        if state.filter(~F.col("done")).isEmpty():
            break
    return state.select("source", F.when(F.col("low") < 16**HASH_DIGITS, F.col("low")).alias("limit"))


def _boundary(sums: DataFrame, state: DataFrame, width: int) -> DataFrame:
    """Move every open source's ``low`` to the start of the bucket its budget falls in."""
    by = Window.partitionBy("source").orderBy("bucket")
    upto = F.sum("words").over(by.rowsBetween(Window.unboundedPreceding, 0))
    marked = sums.withColumn("upto", upto)
    right = state.withColumnRenamed("source", "_source")
    joined = marked.join(right, marked["source"].eqNullSafe(right["_source"]))
    crossing = joined.filter(F.col("taken") + F.col("upto") > F.col("budget"))
    first = crossing.groupBy("source").agg(
        F.min(F.struct("bucket", "words", "upto", "least", "most")).alias("at")
    )
    found = first.select(F.col("source").alias("_source"), "at.*")
    s = state.join(found, state["source"].eqNullSafe(found["_source"]), "left")
    before = F.col("taken") + F.col("upto") - F.col("words")
    single = (F.col("least") == F.col("most")) | F.lit(width == 1)
    nearer = F.col("budget") - before > before + F.col("words") - F.col("budget")
    low = (
        F.when(F.col("done"), F.col("low"))
        .when(F.col("bucket").isNull(), F.lit(16**HASH_DIGITS))  # all rows fit
        .when(single, F.col("least") + nearer.cast("long"))
        .otherwise(F.col("bucket") * F.lit(width))
    )
    return s.select(
        "source",
        "budget",
        low.cast("long").alias("low"),
        F.when(F.col("done") | F.col("bucket").isNull(), F.col("taken")).otherwise(before).alias("taken"),
        (F.col("done") | F.col("bucket").isNull() | single).alias("done"),
    )


def mix_plan(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``source, source_size, target, limit`` of ``source, size, hash`` rows, one per source."""
    sized = materialize(sized.select("source", "size", "hash"))
    sources = materialize(
        source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share)
    )
    few = sources.count() <= BROADCAST_SOURCES
    size = F.col("source_size")
    budget = F.when(F.col("target") >= size, F.col("target") - size).otherwise(F.col("target"))
    limits = hash_thresholds(sized, sources.select("source", budget.alias("budget")), few)
    return materialize(_join_sources(sources, limits, few))


def apply_plan(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """Add ``source_size``, ``target`` and ``times`` to rows with ``source`` and ``hash``."""
    joined = _join_sources(docs, plan, plan.count() <= BROADCAST_SOURCES)
    chosen = F.col("limit").isNull() | (F.col("hash") < F.col("limit"))
    whole = F.col("target") >= F.col("source_size")
    return joined.withColumn("times", whole.cast("long") + chosen.cast("long")).drop("limit")


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How many words of each document a weighted mix of the sources takes.

    Returns ``doc_id, source, size, source_size, target, taken``, one row per input row.
    A target of one whole source or less takes each document once or not at all; a higher
    one takes all once and some twice. Documents are chosen by whether a hash of their id
    lies below a threshold, so runs agree, and a higher target takes all that a lower one
    takes. No row is sorted; one pass computes sizes, the others read ids and sizes only.

    A null or empty text has size 0. Null sources are one source; a null id has hash 0, so
    it is chosen first. Repeated rows and ties in the hash are taken together. Other
    columns are not looked at; no rows give no rows.
    """
    sized = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            document_hash(F.col(id_col)).alias("hash"),
        )
    )
    mixed = apply_plan(sized, mix_plan(sized, weights, share))
    taken = (F.col("size") * F.col("times")).alias("taken")
    return mixed.select("doc_id", "source", "size", "source_size", "target", taken)


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The rows of the mix itself: each document once, twice or not at all, as in ``mix``.

    Columns stay as they are. The texts are not shuffled: the plan has a row per source.
    """
    key = {"source": F.col(source_col), "hash": document_hash(F.col(id_col))}
    sized = docs.select(word_count(F.col(text_col)).alias("size"), *[c.alias(n) for n, c in key.items()])
    row = docs.select(F.struct(*docs.columns).alias("row"), *[c.alias(n) for n, c in key.items()])
    mixed = apply_plan(row, mix_plan(sized, weights, share)).filter("times > 0")
    copies = F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))
    return mixed.select("row", copies.alias("copy")).select("row.*")

"""Licence notices in documents: MinHash bands of windows find them, containment proves them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

WIDTH = 5  # words of a shingle
SHORT, LONG = 1, 8  # shingles of a window
STRIDE = 7  # from one long window to the next
LEAST_ALIKE = 0.6  # long windows at least so similar are found
MISSED = 1e-4  # with this chance of a miss at most
PERCENT = 80
BROADCAST_ROWS = 1_000_000  # up to so many counted rows of two numbers are broadcast

# Widely used licence notices, by SPDX identifier.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0 International."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    (
        "MIT-grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software.",
    ),
    (
        "Apache-2.0-notice",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    (
        "GPL-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation.",
    ),
)


def band_count(alike: float = LEAST_ALIKE, missed: float = MISSED) -> int:
    """Bands of one row that leave two sets of this similarity unmatched with this chance."""
    return math.ceil(math.log(missed) / math.log(1 - alike))


def with_shingles(rows: DataFrame, text_col: str) -> DataFrame:
    """Add ``shingles``: hashes of the runs of five words, in order.

    Words are runs of letters and digits, in lower case. A text with fewer than five words
    is one shingle, one without words has none.
    """
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    none = F.array().cast("array<bigint>")
    words = F.when(F.col("_plain") == "", none).otherwise(F.transform(F.split("_plain", " "), lambda w: F.xxhash64(w)))
    rows = rows.withColumn("_plain", plain).withColumn("_words", words).drop("_plain")
    starts = F.sequence(F.lit(1), F.greatest(F.size("_words") - WIDTH + 1, F.lit(1)))
    runs = F.transform(starts, lambda i: F.xxhash64(F.slice("_words", i, WIDTH)))
    return rows.withColumn("shingles", F.when(F.size("_words") == 0, none).otherwise(runs)).drop("_words")


def bands(rows: DataFrame, stride: int, short: bool = True, long: bool = True) -> DataFrame:
    """``key, band``: band numbers of the windows of rows with ``key, shingles``.

    A short window is one shingle, whose least hash is its own; so one band finds all that
    are equal. Long windows start every ``stride`` shingles and at the last place; each has
    ``band_count()`` bands. A row without shingles has no window.
    """
    last = F.greatest(F.size("shingles") - LONG, F.lit(0))
    places = F.sequence(F.lit(0), F.ceil(last / stride).cast("int"))
    windows = F.transform(places, lambda k: F.slice("shingles", F.least(k * stride, last) + 1, LONG))
    windows = F.when(F.size("shingles") > 0, windows).otherwise(F.array().cast("array<array<bigint>>"))

    def band(number: int) -> Column:
        least = lambda w: F.array_min(F.transform(w, lambda x: F.xxhash64(x, F.lit(number))))
        return F.transform("windows", lambda w: F.xxhash64(least(w), F.lit(-number)))

    found = [F.transform("shingles", lambda x: F.xxhash64(x, F.lit(0)))] if short else []
    if long:  # windows are a column of their own, so that they are made once for all bands
        rows = rows.withColumn("windows", windows)
        found += [band(number) for number in range(1, band_count() + 1)]
    return rows.select("key", F.explode(F.concat(*found)).alias("band"))


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def scan(
    docs: DataFrame,
    notices: Sequence[tuple[str, str]] = NOTICES,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, template_id, n_shared, n_template, containment`` of the notices in documents.

    A notice is in a document if the document holds ``percent`` or more of its distinct
    five-word shingles. Notices of fewer than 15 shingles are looked up by windows of one
    shingle, longer ones by overlapping windows of eight: the notice's at every place, the
    document's at every seventh. Of windows with a similarity of 0.6 or more 1 in 10,000
    at most share no band. Then whole shingle sets are compared.

    The bands of notices are broadcast after a count, so no text is shuffled. A null text
    is empty; texts without words match nothing, nor do notices without words. A null id is
    carried; rows that share an id are compared each for itself, equal results count once.
    Other columns are not looked at; no rows give no rows.
    """
    spark = docs.sparkSession
    given = spark.createDataFrame(list(notices), "key string, text string")
    known = materialize(with_shingles(given, "text").select("key", "shingles").filter(F.size("shingles") > 0))
    small = F.size("shingles") < LONG + STRIDE
    index = bands(known.filter(small), 1, long=False).unionByName(bands(known.filter(~small), 1, short=False))
    index = materialize(index.distinct().withColumnRenamed("key", "template_id"))
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    shingled = with_shingles(texts, "text").select("key", "shingles")
    hits = bands(shingled, STRIDE).join(_few(index), "band").select("key", "template_id").distinct()
    hits = materialize(hits.groupBy("key").agg(F.collect_set("template_id").alias("templates")))
    few = _few(hits).withColumnRenamed("key", "_key")
    found = shingled.join(few, F.col("key").eqNullSafe(F.col("_key"))).drop("_key")
    found = found.withColumn("template_id", F.explode("templates"))
    wanted = known.select(F.col("key").alias("template_id"), F.array_distinct("shingles").alias("wanted"))
    shared = F.size(F.array_intersect("wanted", "shingles")).cast("long")
    sized = found.join(_few(wanted), "template_id").select(
        F.col("key").alias("doc_id"), "template_id", shared.alias("n_shared"),
        F.size("wanted").cast("long").alias("n_template"),
    )
    kept = sized.filter(F.col("n_shared") * 100 >= F.col("n_template") * percent).distinct()
    return kept.withColumn("containment", F.col("n_shared") / F.col("n_template"))

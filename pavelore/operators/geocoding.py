"""Places of free address texts, by a weighted inverted index of their words."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .relational import first_per_group
from .skew import balanced_join

MIN_COVERAGE = 60  # percent of an address's weight that an entry must hold
ABBREVIATIONS = {
    "ave": "avenue", "av": "avenue", "blvd": "boulevard", "ct": "court", "dr": "drive", "hwy": "highway",
    "ln": "lane", "pl": "place", "rd": "road", "sq": "square", "st": "street", "str": "street",
    "e": "east", "n": "north", "s": "south", "w": "west",
}


def text_tokens(text: Column, abbreviations: Mapping[str, str] = ABBREVIATIONS) -> Column:
    """The distinct words of a text in lower case, abbreviations written out."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")
    words = F.filter(words, lambda w: w != "")
    if abbreviations:
        table = F.create_map(*[F.lit(x) for pair in abbreviations.items() for x in pair])
        words = F.transform(words, lambda w: F.coalesce(table[w], w))
    return F.array_distinct(words)


def _weight(df: Column, n: int) -> Column:
    """A word's weight in whole numbers: the fewer texts hold it, the more it says."""
    return F.round(F.lit(1000.0) * F.log(F.lit(1.0) + F.lit(float(n)) / df)).cast("long")


def geocode_text(
    addresses: DataFrame,
    gazetteer: DataFrame,
    min_coverage: int = MIN_COVERAGE,
    abbreviations: Mapping[str, str] = ABBREVIATIONS,
) -> DataFrame:
    """Add found, coverage, lat, lon of the gazetteer entry that covers an address best.

    ``addresses`` (address and any columns but those four); ``gazetteer`` (address, rank,
    lat, lon). Words count, not their order; a word weighs more the fewer entries hold it, and
    most if none does. The entry with the greatest weight in common is taken, of equal ones
    that of best rank, then the first in alphabetical order; of entries with one text the
    best ranked. Addresses of which no entry covers ``min_coverage`` percent are left out.

    An entry that covers enough holds one of the rarest words, those without which the rest
    would weigh too little. Only these meet the index, so the words that most texts have in
    common ("street", a city) seldom do. Whole numbers as weights keep ties exact.
    """
    best = first_per_group(
        gazetteer.select("address", "rank", "lat", "lon").dropna(subset=["address"]),
        ["address"], [F.col("rank"), F.col("lat"), F.col("lon")],
    )
    entries = materialize(best.withColumn("has", text_tokens(F.col("address"), abbreviations)))
    n = entries.count()
    index = entries.select(F.explode("has").alias("word"), F.col("address").alias("found"), "rank", "lat", "lon", "has")
    frequency = index.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    texts = addresses.select("address").dropna().distinct()
    words = texts.select("address", F.explode(text_tokens(F.col("address"), abbreviations)).alias("word"))
    weighed = balanced_join(words, frequency, ["word"], "left", spread_by=["address"])
    pair = F.struct(_weight(F.coalesce("df", F.lit(1)), n).alias("weight"), "word", F.col("df").isNotNull().alias("known"))
    asked = weighed.groupBy("address").agg(F.sort_array(F.collect_list(pair), asc=False).alias("words"))

    def weight_of(words: Column) -> Column:
        return F.aggregate(words, F.lit(0).cast("long"), lambda total, w: total + w["weight"])

    asked = asked.withColumn("total", weight_of(F.col("words")))

    def rare(word: Column, i: Column) -> Column:
        rest = weight_of(F.slice("words", i + 1, F.size("words")))
        return word["known"] & (rest * 100 >= F.col("total") * min_coverage)

    probes = asked.withColumn("word", F.explode(F.filter("words", rare))).withColumn("word", F.col("word.word"))
    met = balanced_join(probes, index, ["word"], spread_by=["address"])
    shared = weight_of(F.filter("words", lambda w: F.array_contains("has", w["word"])))
    met = met.withColumn("shared", shared).filter(F.col("shared") * 100 >= F.col("total") * min_coverage)
    order = F.struct(-F.col("shared"), F.col("rank"), F.col("found"))
    value = F.struct("found", (F.col("shared") / F.col("total")).alias("coverage"), "lat", "lon")
    chosen = met.groupBy("address").agg(F.min_by(value, order).alias("_best")).select("address", "_best.*")
    return balanced_join(addresses, chosen, ["address"])

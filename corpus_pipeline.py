"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept.
All but the last return the columns of ``documents``.

Null, empty and letterless texts have no clear language and leave in the first stage; in a
later one they are as the stage's operator defines them. Very long texts are handled whole.
A null id is carried; rows that share an id are handled as one document by the line stage and stay
or go together in the near-duplicate stage; repeated rows are mixed and packed each for itself.
Ties go by hash or id, as the operators state. Further columns stay as they are, whatever
their names. A table without rows gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavelore.llm.common import documents
from pavelore.llm.language import dictionaries, identify
from pavelore.llm.lines import deduplicate_lines
from pavelore.llm.mixing import mixed_documents
from pavelore.llm.neardup import near_duplicates
from pavelore.llm.packing import pack
from pavelore.llm.queries import tokenizer_file
from pavelore.session import scratch_path


def _aside(docs: DataFrame, *names: str) -> DataFrame:
    """The rows with columns renamed whose names an operator uses for its own."""
    return docs.withColumnsRenamed({n: f"_own {n}" for n in names if n in docs.columns})


def _back(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with their names, in their order."""
    aside = {f"_own {n}": n for n in docs.columns if f"_own {n}" in found.columns}
    return found.drop(*aside.values()).withColumnsRenamed(aside).select(*docs.columns)


def in_a_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; those without a letter or a clear language go."""
    content = dictionaries(docs)
    found = identify(_aside(docs, "lang_pred", "score", "rejected"), content).filter("NOT rejected")
    return _back(found, docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the lines that come first in them; one that keeps no line goes."""
    found = deduplicate_lines(_aside(docs, "n_lines", "removed"))
    left = found.filter((F.col("n_lines") == 0) | (F.size("removed") < F.col("n_lines")))
    return _back(left.withColumn("n_chars", F.length("text").cast("long")), docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; rows of one id stay or go together."""
    found = near_duplicates(docs).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    return docs.join(found.filter("NOT kept").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix of sources takes it."""
    return mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences that hold every document that is left."""
    return pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("language", in_a_known_language),
    ("lines", without_repeated_lines),
    ("near_duplicates", one_of_each_group),
    ("mixing", mixed),
    ("packing", packed),
]

#: Compression, edit distances and the tokenizer are outside of SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language, lm, toxicity
from .aligning import align_tokenizers
from ..session import scratch_path
from .common import documents, fold
from .embeddings import near_vectors
from .fingerprint import edited_pairs
from .infilling import fill_in_middle
from .licenses import NOTICES, scan
from .lines import deduplicate_lines
from .mixing import mix
from .neardup import near_duplicates
from .packing import pack
from .warc import read_archives, records, write_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its DuckDB twin."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_pack")
def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


MIX_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    coalesce(('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT, 0) AS hash
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2e0 * sum(size)::DOUBLE AS most,
    [5e0, 2e0, 1e0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM d GROUP BY source),
r(turn, rate) AS (
  SELECT 0, 0e0
  UNION ALL
  SELECT turn + 1, (
    SELECT (1.5e0 * sum(source_size)::DOUBLE - coalesce(sum(most) FILTER (weight * rate >= most), 0e0))
      / coalesce(sum(weight) FILTER (NOT weight * rate >= most), 1e0) FROM s)
  FROM r WHERE turn < 40),
t AS (
  SELECT source, source_size,
    CASE WHEN weight * rate >= most THEN most ELSE weight * rate END AS target
  FROM s, (SELECT rate FROM r ORDER BY turn DESC LIMIT 1)),
b AS (
  SELECT source, source_size, target, target >= source_size AS whole,
    CASE WHEN target >= source_size THEN target - source_size ELSE target END AS budget FROM t),
h AS (
  SELECT source, hash, sum(size) AS words,
    sum(sum(size)) OVER (PARTITION BY source ORDER BY hash)::DOUBLE AS upto
  FROM d GROUP BY source, hash),
c AS (
  SELECT h.source, min(h.hash) AS hash, min_by(words::DOUBLE, h.hash) AS words, min_by(upto, h.hash) AS upto,
    any_value(budget) AS budget
  FROM h JOIN b ON h.source IS NOT DISTINCT FROM b.source WHERE upto > budget GROUP BY h.source),
l AS (
  SELECT source, hash + CASE WHEN budget - (upto - words) > upto - budget THEN 1 ELSE 0 END AS least FROM c)
SELECT doc_id, size, source_size, target,
  size * (whole::BIGINT + (least IS NULL OR hash < least)::BIGINT) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
LEFT JOIN l ON d.source IS NOT DISTINCT FROM l.source
"""


@query("op5_mix", MIX_SQL)
def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold("doc_id", 5) == 0
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.learn(docs.filter(~held_out), labels.filter(~held_out))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op7_language")
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold("doc_id", 4) == 2
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    content = language.dictionaries(docs.filter(~held_out))
    found = language.identify(docs.select("doc_id", "text"), content)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query("op8_near_duplicates")
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), width=2, percent=80)


@query("op6_fingerprint")
def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_pairs(documents(spark, sf_dir))


@query("op3_lines")
def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicate_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_lines", F.size("removed").alias("n_removed"), "removed", "text")


@query("op10_lm_scores")
def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold("doc_id", 5) == 1
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = lm.score(docs, ~held_out, tokenizer_file("word_bpe_49k.json"))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query("op2_near_vectors")
def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


LICENSE_SQL = """
WITH t(template_id, text) AS (VALUES {notices}),
plain AS (
  SELECT NULL::BIGINT AS doc_id, template_id, trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS text FROM t
  UNION ALL
  SELECT doc_id, NULL, trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) FROM documents),
words AS (SELECT doc_id, template_id, string_split(text, ' ') AS w FROM plain WHERE text <> ''),
starts AS (SELECT doc_id, template_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words),
shingles AS (SELECT DISTINCT doc_id, template_id, array_to_string(w[i:i + 4], ' ') AS s FROM starts),
sizes AS (SELECT template_id, count(*) AS n_template FROM shingles WHERE template_id IS NOT NULL GROUP BY 1),
shared AS (
  SELECT d.doc_id, t.template_id, count(*) AS n_shared
  FROM shingles d JOIN shingles t ON d.s = t.s
  WHERE d.template_id IS NULL AND t.template_id IS NOT NULL GROUP BY 1, 2)
SELECT doc_id, template_id, n_shared, n_template, n_shared::DOUBLE / n_template::DOUBLE AS containment
FROM shared JOIN sizes USING (template_id) WHERE n_shared * 100 >= n_template * 80
""".format(notices=", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in NOTICES))


@query("op9_licenses", LICENSE_SQL)
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


@query("op12_align")
def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("byte_bpe_50k.json", "piece_bpe_32k.model")
    return align_tokenizers(documents(spark, sf_dir), *map(tokenizer_file, names))


FIM_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digits FROM documents),
h AS (
  SELECT *, len(units)::BIGINT AS n, ('0x' || substr(digits, 1, 8))::BIGINT AS h1, ('0x' || substr(digits, 9, 8))::BIGINT AS h2,
    ('0x' || substr(digits, 17, 8))::BIGINT AS h3, ('0x' || substr(digits, 25, 8))::BIGINT AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT *, array_to_string(units[1:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle,
    array_to_string(units[high + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(prefix || middle || suffix) AS restored_sha256
FROM p
"""


@query("op11_fill_in_middle", FIM_SQL)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(documents(spark, sf_dir), texts=False)


#: Base32 of a digest: five hexadecimal digits are four letters.
WARC_SQL = """
WITH d AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS digits FROM pages),
g AS (
  SELECT *, count(*) OVER (PARTITION BY digits) AS n, max(page_id) OVER (PARTITION BY digits) AS response,
    list_transform(range(8), lambda i: ('0x' || substr(digits, (5 * i + 1)::INT, 5))::BIGINT) AS parts FROM d)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((parts[(i // 4 + 1)::INT] >> (15 - 5 * (i % 4))::INT) % 32 + 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN n > 1 AND page_id IS DISTINCT FROM response THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n > 1 AND page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM g
"""


@query("op13_warc", WARC_SQL)
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    found = records(read_archives(spark, path, payloads=False))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

"""The registered queries of this package: each applies its operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqscore.sources.tables import read_table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates
    return near_duplicates(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                           words_per_shingle=3, max_distance=2)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity
    return toxicity(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                    read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))


def op3_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc_zip import archive_round_trip
    return archive_round_trip(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents
    return pack_documents(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .difference_sketch import document_fingerprints
    return document_fingerprints(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .raking import mix
    mixed = mix(read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source"]))
    plain = lambda c: F.when(F.col(c) != "null", F.substring(c, 2, 1 << 20))
    return mixed.select("doc_id", plain("mix_source").alias("source"), plain("mix_lang").alias("lang"),
                        plain("mix_topic").alias("topic"), F.col("mix_tokens").alias("tokens"),
                        F.col("mix_weight").alias("weight"), F.col("mix_probability").alias("probability"),
                        F.col("mix_sampled").alias("sampled"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import language_id
    return language_id(read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"]))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import token_file_round_trip
    return token_file_round_trip(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op9_metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .metric_join import range_join
    return range_join(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]), min_cosine=0.95)


def op10_quality_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality
    return quality(read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"]),
                   read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .wrapper import main_text
    return main_text(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fill_in_middle import fill_in_middle, restored
    moved = fill_in_middle(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), rate=50, spm_rate=80, seed=42)
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return moved.select("doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
                        sha(F.col("fim.output")).alias("output_sha256"),
                        sha(restored(F.col("fim.output"), F.col("fim.form"))).alias("restored_sha256"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .phrases import collocations
    return collocations(read_table(spark, sf_dir, "documents", ["lang", "text"]), min_count=30, max_words=4, top=2000)


QUERIES = {f.__name__: f for f in (
    op1_simhash_near_dedup, op2_toxicity, op3_warc_zip, op4_best_fit_packing, op5_document_fingerprints,
    op6_source_mixing, op7_language_id, op8_token_files, op9_metric_range_join, op10_quality_perplexity,
    op11_html_extraction, op12_fill_in_middle, op13_phrase_collocations)}

# Plain statements of the contracts: every text cut by one regular expression,
# every phrase counted with all others.
ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op12_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
u AS (
  SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
         CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM d),
c AS (
  SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a,
         greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50
              THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM u),
s AS (
  SELECT *, array_to_string(w[1:a], '') AS pre, array_to_string(w[a + 1:b], '') AS mid,
         array_to_string(w[b + 1:n], '') AS suf
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s"""

ORACLE_SQL["op13_phrase_collocations"] = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL)),
places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
spans AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM places, (VALUES (1), (2), (3), (4)) AS lengths(k) WHERE i + k - 1 <= len(w)),
f AS (
  SELECT lang, k, phrase, count(*) AS f FROM spans GROUP BY ALL),
totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.a, j, x.f AS l, y.f AS r,
         CAST(CAST(2000000 AS HUGEINT) * c.a // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) c
  JOIN f x ON x.lang = c.lang AND x.k = j AND x.phrase = array_to_string(c.w[1:j], ' ')
  JOIN f y ON y.lang = c.lang AND y.k = c.k - j AND y.phrase = array_to_string(c.w[j + 1:c.k], ' ')),
best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i
        FROM (SELECT *, unnest(range(2, k)) AS m FROM cand)) GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank,
       b.phrase, a, l, r, n, score
FROM best b JOIN totals t ON t.lang = b.lang LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT)
QUALIFY rank <= 2000"""

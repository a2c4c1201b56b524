"""The registered queries over the synthetic tables, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paylake.llm import (
    decontaminate,
    fingerprints,
    html_text,
    hyperminhash,
    periodic_runs,
    phrases,
    piece_encoding,
    pii,
    quality,
    secret_scan,
    token_counts,
    token_files,
    toxicity,
)
from paylake.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read_table(spark, sf_dir, "pages"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(read_table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.new_folder(spark)
    docs = read_table(spark, sf_dir, "documents")
    token_files.write_token_files(docs, token_files.public_tokenizer(), folder)
    return token_files.TokenFiles(spark, folder).digests()


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = piece_encoding.public_model()
    encoded = piece_encoding.encode_documents(read_table(spark, sf_dir, "documents"), path)
    return piece_encoding.digests(encoded, path)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return quality.score_quality(docs, quality.learn(docs, labels))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return hyperminhash.near_duplicates(docs, width=2, percent=80)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return decontaminate.find_passages(docs, read_table(spark, sf_dir, "benchmark"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(read_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return toxicity.score_toxicity(docs, toxicity.learn(docs, labels))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(read_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(read_table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.find_runs(docs))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(read_table(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, token_counts.public_tokenizer())


def queries() -> dict[str, Query]:
    return {
        "op1_html_text": op1_html_text,
        "op2_secrets": op2_secrets,
        "op3_token_files": op3_token_files,
        "op4_pieces": op4_pieces,
        "op5_quality": op5_quality,
        "op6_near_duplicates": op6_near_duplicates,
        "op7_decontamination": op7_decontamination,
        "op8_fingerprints": op8_fingerprints,
        "op9_toxicity": op9_toxicity,
        "op10_pii": op10_pii,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_phrases": op12_phrases,
        "op13_token_counts": op13_token_counts,
    }


# Every pair of documents that share a shingle, in full; components by following all links.
_NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE
    list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id
    AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other
), roots AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN roots USING (doc_id)"""


# Every phrase of one to three words is counted by itself; sums of products as 128-bit numbers.
_PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, 1 AS size, unnest(w) AS phrase FROM words
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
  FROM words
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1),
    lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words
), f AS (
  SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w
  FROM f WHERE size > 1 AND n >= 10
), cuts AS (
  SELECT *, 1 AS k, w[1] AS first_part, array_to_string(w[2:], ' ') AS rest FROM candidates
  UNION ALL
  SELECT *, 2, w[1] || ' ' || w[2], w[3] FROM candidates WHERE size = 3
), scored AS (
  SELECT c.*, x.n AS l, y.n AS r,
    CAST((1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first_part
    JOIN f y ON y.lang = c.lang AND y.phrase = c.rest
), best AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), free AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM candidates c WHERE b.size = 2 AND c.size = 3 AND c.lang = b.lang
      AND (c.w[1] || ' ' || c.w[2] = b.phrase OR c.w[2] || ' ' || c.w[3] = b.phrase)
      AND 100 * c.a >= 50 * b.a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM free
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    """SQL where it can express an operator; the others are tested against plain versions."""
    return {"op6_near_duplicates": _NEAR_DUPLICATES, "op12_phrases": _PHRASES}

"""The queries of this subpackage: (spark, directory of the tables) to DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from callmeter.llm import (
    decontaminate,
    langid,
    lexical,
    lm,
    ngram_join,
    packing,
    page_text,
    periodic,
    quality,
    topk,
    toxicity,
    trie_counts,
    warc,
)
from callmeter.llm.text import bound_batches

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bound_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_scores(_table(spark, sf_dir, "documents"))


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.pack_documents(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(_table(spark, sf_dir, "documents"))


def similar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = ngram_join.similar_documents(_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "n_links")


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.main_text(_table(spark, sf_dir, "pages"))


def web_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(_table(spark, sf_dir, "pages"))


def top_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.embedding_neighbours(_table(spark, sf_dir, "embeddings"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.benchmark_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.repeats(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_main_text": main_text,
    "op2_top_inner_products": top_neighbours,
    "op3_packing": packed,
    "op4_web_archives": web_archives,
    "op5_quality_classifier": quality_classifier,
    "op6_language_id": language_id,
    "op7_language_model": language_model,
    "op8_ngram_jaccard": similar_documents,
    "op9_token_counts": token_counts,
    "op10_decontamination": contamination,
    "op11_ranked_search": ranked_search,
    "op12_toxicity": toxic_documents,
    "op13_word_runs": word_runs,
}

TOP_INNER_PRODUCTS_SQL = """
WITH whole AS (
  SELECT vec_id, row_number() OVER () AS line, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scores AS (
  SELECT q.line, q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.line <> c.line
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY line ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

WEB_ARCHIVES_SQL = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS sha,
    row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST) AS place,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last_id
  FROM pages
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (CAST('0x' || substr(sha, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) % 32, 1)), '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN last_id END AS refers_to
FROM payloads
"""

NGRAM_JACCARD_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, row_number() OVER () AS line, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\\x{80}-\\x{10ffff}]+') AS w
  FROM documents
), grams AS (
  SELECT DISTINCT line, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS gram
  FROM words
), sizes AS (
  SELECT line, count(*) AS size FROM grams GROUP BY line
), common AS (
  SELECT a.line AS a, b.line AS b, count(*) AS shared FROM grams a JOIN grams b ON a.gram = b.gram AND a.line <> b.line GROUP BY a.line, b.line
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.line = a JOIN sizes y ON y.line = b WHERE 10 * shared >= 8 * (x.size + y.size - shared)
), reach AS (
  SELECT line AS a, line AS b FROM words UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), classes AS (
  SELECT reach.a AS line, min(doc_id) AS class_id FROM reach JOIN words ON words.line = reach.b GROUP BY reach.a
)
SELECT doc_id, class_id, (SELECT count(*) FROM links WHERE links.a = words.line) AS n_links FROM words JOIN classes USING (line)
"""

RANKED_SEARCH_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS line, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10ffff}]+') AS terms
  FROM documents
), totals AS (
  SELECT CAST(count(*) FILTER (len(terms) > 0) AS BIGINT) AS total, CAST(coalesce(sum(len(terms)), 0) AS BIGINT) AS tokens FROM docs
), asked AS (
  SELECT line, item_id, term, CAST(count(*) AS BIGINT) AS times FROM (
    SELECT row_number() OVER () AS line, item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10ffff}]+')) AS term
    FROM benchmark) GROUP BY ALL
), postings AS (
  SELECT line, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT line, doc_id, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM docs) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * total + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM postings, totals GROUP BY term, total
), scores AS (
  SELECT a.line AS item, a.item_id, p.line, p.doc_id,
    CAST(sum(a.times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * total) // tokens)))) AS BIGINT) AS score
  FROM asked a JOIN postings p USING (term) JOIN weights USING (term), totals GROUP BY ALL
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op2_top_inner_products": TOP_INNER_PRODUCTS_SQL,
    "op4_web_archives": WEB_ARCHIVES_SQL,
    "op8_ngram_jaccard": NGRAM_JACCARD_SQL,
    "op11_ranked_search": RANKED_SEARCH_SQL,
}

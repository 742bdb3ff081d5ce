"""Registered queries of the corpus operators, one per operator, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontamination, hard_negatives, jaccard_join, maxent_lm, near_dedup, packing, pu_classifier, quality_rules, sstable, substring_dedup, token_counts, warc
from .common import CONTENT


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_sstable_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.token_table(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op2_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.lm_scores(_read(spark, sf_dir, "documents"))


def op3_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=0, capacity=2048)


def op4_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_read(spark, sf_dir, "documents")).drop(*CONTENT)


def op5_llr_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")).drop(*CONTENT)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


def op7_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).drop("matches", "longest_match", *CONTENT)


def op8_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_classifier.quality_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op9_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_read(spark, sf_dir, "documents"))


def op10_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(_read(spark, sf_dir, "pages")).drop("archive", "offset")


def op11_vertical_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_read(spark, sf_dir, "documents"))


def op12_vptree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(_read(spark, sf_dir, "embeddings"))


def op13_vertical_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: lambda spark, sf_dir, f=f: f(spark, sf_dir) for f in (op1_sstable_tokens, op2_maxent_lm, op3_bestfit_packing, op4_setsketch_dedup, op5_llr_quality, op6_token_counts, op7_suffix_decontamination, op8_pu_quality, op9_bwt_dedup, op10_warc_chain, op11_vertical_jaccard, op12_vptree_negatives, op13_vertical_phrases, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op4_setsketch_dedup": _OP4, "op7_suffix_decontamination": _OP7, "op10_warc_chain": _OP10, "op11_vertical_jaccard": _OP11, "op12_vptree_negatives": _OP12, "op13_vertical_phrases": _OP13}


_OP4 = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
pair AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.x, pair.y FROM reach JOIN pair ON reach.y = pair.x)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least_id AS component_id, doc_id = least_id AS kept
FROM (SELECT x AS doc_id, min(y) AS least_id FROM reach GROUP BY x) LEFT JOIN n USING (doc_id)
"""

_OP7 = """
WITH dw AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
iw AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS g, least(13, len(w)) AS n
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dwin AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM dw, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, d.n, item_id FROM dwin d JOIN win USING (g, n)),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM hit) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

_OP10 = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> least_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> least_id THEN least_id END AS refers_to
FROM m
"""

_OP11 = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM (SELECT * FROM s JOIN n USING (doc_id)) a JOIN (SELECT * FROM s JOIN n USING (doc_id)) b
  ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n GROUP BY ALL),
link AS (SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 90 * (a.n + b.n - k)),
pair AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.x, pair.y FROM reach JOIN pair ON reach.y = pair.x)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least_id AS component_id
FROM (SELECT x AS doc_id, min(y) AS least_id FROM reach GROUP BY x) LEFT JOIN n USING (doc_id)
"""

_OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 10
"""

_OP13 = """
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
f AS (
  SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS g, count(*) AS f
  FROM (SELECT lang, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM pieces, (VALUES (1), (2), (3), (4)) t(m) WHERE len(w) >= m) GROUP BY ALL HAVING count(*) >= 30),
total AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
cut AS (
  SELECT lang, g, f AS a, k, array_to_string(string_split(g, ' ')[1 : k], ' ') AS head, array_to_string(string_split(g, ' ')[k + 1 :], ' ') AS rest
  FROM (SELECT lang, g, f, unnest(generate_series(1, m - 1)) AS k FROM f WHERE m > 1)),
scored AS (
  SELECT c.lang, c.g, c.a, x.f AS l, y.f AS r, (CAST(2000000 AS HUGEINT) * c.a) // (CAST(x.f AS HUGEINT) + y.f) AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.g = c.head JOIN f y ON y.lang = c.lang AND y.g = c.rest
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.g ORDER BY score, c.k) = 1),
part AS (
  SELECT lang, array_to_string(string_split(g, ' ')[b : b + k - 1], ' ') AS g, max(f) AS longer
  FROM (SELECT lang, g, f, m, k, unnest(generate_series(1, m - k + 1)) AS b FROM f, (VALUES (2), (3)) t(k) WHERE m > k) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM scored LEFT JOIN part USING (lang, g) JOIN total USING (lang)
WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) <= 2000
"""

"""The registered queries of this subpackage: ``name -> (build(spark, sf_dir), DuckDB SQL or None)``."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from sluice.llm import centroids, chat, html, line_dedup, minhash, mixing, nearest, packing, pieces, pii, quality, ranked, token_files

Build = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(_table(spark, sf_dir, "embeddings"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digest(_table(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip_digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end=2)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents")).drop("rule")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(_table(spark, sf_dir, "conversations")).drop("lead", "start")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digest(_table(spark, sf_dir, "documents"))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score(_table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(_table(spark, sf_dir, "embeddings"))


OP10_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM lines
), repeated AS (
  SELECT line_key, min(doc_id) AS holder FROM keyed WHERE length(line_key) >= 10
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.*, r.line_key IS NOT NULL AND k.doc_id <> r.holder AS gone
  FROM keyed k LEFT JOIN repeated r ON k.line_key = r.line_key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN w ELSE w[i:i + 4] END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * k >= 75 * (p.n + q.n - k)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other
)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.other) AS component_id,
       d.doc_id = min(r.other) AS kept
FROM documents d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
GROUP BY d.doc_id
"""

OP2_SQL = r"""
WITH v AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), n AS (
  SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS norm FROM v
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(c.e, q.e) / (c.norm * q.norm) AS score
  FROM n q JOIN n c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 5
"""

OP9_SQL = r"""
WITH said AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), rendered AS (
  SELECT s.conv_id, p.role AS perspective, coalesce(CAST(floor(turn / 64) AS BIGINT), -1) AS segment, turn, s.role, text,
         s.role <> 'system' AND s.role = p.role AS mine,
         CASE WHEN s.role = 'system' THEN '<|im_start|>system' WHEN s.role = p.role THEN '<|im_start|>assistant'
              ELSE '<|im_start|>user name=' || replace(s.role, '<|', '< |') END || chr(10) AS head,
         replace(text, '<|', '< |') || '<|im_end|>' AS body
  FROM said s JOIN (SELECT DISTINCT conv_id, role FROM said WHERE role <> 'system') p ON p.conv_id = s.conv_id
), placed AS (
  SELECT *, CAST(sum(length(head) + length(body) + 1) OVER w AS BIGINT) - length(body) - 1 AS s,
         row_number() OVER w AS k
  FROM rendered WINDOW w AS (PARTITION BY conv_id, perspective, segment ORDER BY turn NULLS FIRST, role, text
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT conv_id, perspective, segment, count(*) AS n_turns, string_agg(head || body || chr(10), '' ORDER BY k) AS text,
       coalesce(string_agg(s || '-' || (s + length(body)), ',' ORDER BY k) FILTER (WHERE mine), '') AS mask,
       coalesce(CAST(sum(length(body)) FILTER (WHERE mine) AS BIGINT), 0) AS n_masked,
       CAST(0 AS BIGINT) AS part
FROM placed GROUP BY conv_id, perspective, segment
"""

OP8_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), windows AS (
  SELECT doc_id, i, w[i:i + 4] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)
), counted AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS k FROM windows
), repeats AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM counted, range(0, 5) AS t(j) WHERE k > 1 GROUP BY doc_id
), measures AS (
  SELECT doc_id, text, w, len(w) AS n_words, len(l) AS n_text_lines,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM words LEFT JOIN repeats USING (doc_id)
), failed AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measures
)
SELECT doc_id, n_words, word_chars, n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_text_lines
            OR word_chars < 2 * n_words OR word_chars > 16 * n_words
            OR 5 * (length(text) - length(replace(text, '!', ''))) > n_words
            OR NOT regexp_matches(text, '\p{L}')
            OR (n_words >= 50 AND len(list_distinct(w)) * len(list_distinct(w)) < 4 * n_words)) AS kept
FROM failed
"""

OP12_SQL = r"""
WITH found AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents
), counted AS (
  SELECT r, any_value(doc_id) AS doc_id, any_value(len(w)) AS n, term, count(*) AS tf
  FROM (SELECT r, doc_id, w, unnest(w) AS term FROM found) GROUP BY r, term
), whole AS (
  SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM found WHERE len(w) > 0
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM counted, whole GROUP BY term
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL
), scored AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id,
         CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // terms))))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN counted USING (term), whole GROUP BY item_id, r
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""


def _op13_sql(rounds: int = 3) -> str:
    """The rounds of assigning and moving, one after the other."""
    with_ = [r"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(64 * x) AS BIGINT)) AS e
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, e) - 1 AS k, e AS c
  FROM (SELECT sha256('1:' || vec_id) AS h, e FROM v WHERE vec_id IS NOT NULL ORDER BY h, e LIMIT 16)
)"""]
    for i in range(rounds + 1):
        with_.append(f"""d{i} AS (
  SELECT r, vec_id, e, k, c, CAST(list_sum(list_transform(list_zip(e, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
  FROM v, c{i}
), a{i} AS MATERIALIZED (
  SELECT r, vec_id, e, k, c, distance FROM d{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, k) = 1
)""")
        with_.append(f"""s{i} AS (
  SELECT k, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT k, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM a{i}) GROUP BY k, i
), c{i + 1} AS MATERIALIZED (
  SELECT c{i}.k, coalesce(m.c, c{i}.c) AS c
  FROM c{i} LEFT JOIN (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{i} GROUP BY k) m ON m.k = c{i}.k
)""") if i < rounds else None
    return "WITH " + ", ".join(with_) + f"""
SELECT vec_id, CAST(k AS INT) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds}
"""


OP13_SQL = _op13_sql()

QUERIES: dict[str, tuple[Build, str | None]] = {
    "op1_minhash_dedup": (op1_minhash_dedup, OP1_SQL),
    "op2_nearest_neighbours": (op2_nearest_neighbours, OP2_SQL),
    "op3_pii": (op3_pii, None),
    "op4_html_text": (op4_html_text, None),
    "op5_best_fit_packing": (op5_best_fit_packing, None),
    "op6_sentencepiece": (op6_sentencepiece, None),
    "op7_token_files": (op7_token_files, None),
    "op8_quality_rules": (op8_quality_rules, OP8_SQL),
    "op9_chat_format": (op9_chat_format, OP9_SQL),
    "op10_line_dedup": (op10_line_dedup, OP10_SQL),
    "op11_lm_scoring": (op11_lm_scoring, None),
    "op12_ranked_search": (op12_ranked_search, OP12_SQL),
    "op13_centroids": (op13_centroids, OP13_SQL),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}

"""One query for each operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicator_lake.llm import (
    byte_pairs,
    cotraining,
    embeddings,
    interactions,
    jaccard,
    mixing,
    negatives,
    packing,
    quality,
    secrets,
    style_tree,
    token_counts,
    warc,
)
from indicator_lake.llm.shipping import ship
from indicator_lake.session import work_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), encode_special_tokens=False)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    ledger = secrets.record(docs, work_folder(spark, "secret-ledger"))
    return secrets.digest(secrets.findings(docs, ledger, complete=True)).drop("blob")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.main_text(_table(spark, sf_dir, "pages"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_components(_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivative_digests(_table(spark, sf_dir, "pages"))


def op11_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = negatives.prepared(_table(spark, sf_dir, "embeddings"), negatives.relabelled())
    return negatives.mine(rows, F.col("vec_id") % 50 == 0)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_pairs.round_trip_digests(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing, op2_token_counts, op3_cotraining, op4_secret_scan, op5_main_text, op6_ngram_jaccard,
        op7_quality_rules, op8_mixing, op9_vector_dedup, op10_warc_derivatives, op11_filter_interactions,
        op12_hard_negatives, op13_byte_bpe,
    )
}

ORACLES: dict[str, str] = {
    "op4_secret_scan": r"""
WITH rules(kind, name, pattern, least, part) AS (VALUES
  (0, 'assign', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 8, 2),
  (1, 'access', 'AKIA[A-Z0-9]+', 16, 0),
  (2, 'hex', '[0-9a-f]+', 32, 0),
  (3, 'keyblock', '-----BEGIN [A-Z ]*PRIVATE KEY-----', 0, 0)),
hits AS (
  SELECT doc_id, h.kind, h.name, length(h.value) AS size, h.least, h.hit, h.gap, h.place FROM (
    SELECT d.doc_id, unnest(a.list) AS h FROM documents d,
      LATERAL (
        SELECT list({'kind': kind, 'name': name, 'least': least, 'hit': hit, 'value': value, 'gap': gap, 'place': place}) AS list
        FROM (
          SELECT kind, name, least,
            unnest(regexp_extract_all(coalesce(d.text, ''), pattern, 0)) AS hit,
            unnest(CASE part WHEN 2 THEN regexp_extract_all(coalesce(d.text, ''), pattern, 2) ELSE regexp_extract_all(coalesce(d.text, ''), pattern, 0) END) AS value,
            unnest(regexp_split_to_array(coalesce(d.text, ''), pattern)[:-2]) AS gap,
            unnest(range(len(regexp_extract_all(coalesce(d.text, ''), pattern, 0)))) AS place
          FROM rules)) a)),
placed AS (
  SELECT doc_id, kind, name, size, least,
    sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, kind ORDER BY place) AS stop,
    sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, kind ORDER BY place) - length(hit) AS start
  FROM hits),
spans AS (SELECT *, name || ':' || start || ':' || stop AS span FROM placed WHERE size >= least),
found AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY start, kind) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN found f ON d.doc_id = f.doc_id
""",
    "op6_ngram_jaccard": r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
      WHEN len(w) > 0 THEN ['#' || array_to_string(w, ' ')] ELSE [] END) AS s FROM worded)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reached(node, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id
JOIN (SELECT node, min(other) AS component_id FROM reached GROUP BY node) m ON m.node = d.doc_id
""",
    "op9_vector_dedup": r"""
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reached(node, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.other),
grouped AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node)
SELECT v.vec_id, coalesce(n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM embeddings v JOIN grouped g ON g.node = v.vec_id LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) c ON c.a = v.vec_id
""",
    "op11_filter_interactions": r"""
WITH worded AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
marked AS (
  SELECT doc_id, part, len(w) < 200 AS A, 100 * len(list_distinct(w)) < 50 * len(w) AS B,
    100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 3 * length(body) AS C,
    regexp_matches(body, '[#$%&*|]') AS D, coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false) AS E FROM worded),
label_of AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
states AS (
  SELECT part, [A, B, C, D, E] AS fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
  FROM marked LEFT JOIN label_of USING (doc_id) GROUP BY ALL),
names AS (SELECT unnest(range(1, 6)) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM names a, names b, names c, names d, names e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (SELECT o, i AS step, o[i] AS f FROM orders, names),
seen AS (
  SELECT part, o, step, f, n, good, toxic, fails[f] AS here,
    len(list_filter(o[1:step - 1], lambda x: fails[x])) > 0 AS gone, len(list_filter(fails, lambda x: x)) AS n_fails
  FROM states, steps),
counted AS (
  SELECT part, array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order, step, f,
    coalesce(sum(n) FILTER (NOT gone AND NOT here), 0) AS kept, coalesce(sum(n) FILTER (here AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (here AND gone), 0) AS redundant, coalesce(sum(n) FILTER (here AND n_fails = 1), 0) AS unique_fails,
    coalesce(sum(n) FILTER (here AND NOT gone AND good), 0) AS good_lost,
    coalesce(sum(n) FILTER (here AND NOT gone AND toxic), 0) AS toxic_lost
  FROM seen GROUP BY part, o, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
""",
    "op12_hard_negatives": r"""
WITH usable AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS other_id, b.label AS label,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE label <> own AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 3
""",
}

"""DuckDB SQL for the queries that SQL can express."""

MIXING = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(ceil(coalesce(strlen(text), 0) / 4.0) AS BIGINT) AS n_tokens,
         md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM documents),
t AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM d GROUP BY source),
g AS (SELECT CAST(sum(tokens) AS DOUBLE) AS total, 0.995 * ln(count(*) FILTER (tokens > 0)) AS goal FROM t),
p AS (SELECT tokens / total AS p FROM t, g WHERE tokens > 0),
h AS (
  SELECT 0 AS step, CAST(0 AS DOUBLE) AS lo, CAST(1 AS DOUBLE) AS hi, CAST(0 AS DOUBLE) AS lo2, CAST(1 AS DOUBLE) AS hi2
  UNION ALL
  SELECT step + 1,
    CASE WHEN ln(e.z) - (lo + hi) / 2 * e.d / e.z >= e.goal THEN (lo + hi) / 2 ELSE lo END,
    CASE WHEN ln(e.z) - (lo + hi) / 2 * e.d / e.z >= e.goal THEN hi ELSE (lo + hi) / 2 END,
    CASE WHEN pow(e.least, (lo2 + hi2) / 2 - 1) / e.z2 > 4 THEN (lo2 + hi2) / 2 ELSE lo2 END,
    CASE WHEN pow(e.least, (lo2 + hi2) / 2 - 1) / e.z2 > 4 THEN hi2 ELSE (lo2 + hi2) / 2 END
  FROM (
    SELECT step, lo, hi, lo2, hi2, min(p) AS least, any_value(goal) AS goal,
           sum(pow(p, (lo + hi) / 2)) AS z, sum(pow(p, (lo + hi) / 2) * ln(p)) AS d, sum(pow(p, (lo2 + hi2) / 2)) AS z2
    FROM h, p, g WHERE step < 40 GROUP BY step, lo, hi, lo2, hi2) e),
a AS (
  SELECT greatest(
    CASE WHEN (SELECT -sum(p * ln(p)) FROM p) >= (SELECT goal FROM g) THEN 1 ELSE (lo + hi) / 2 END,
    (lo2 + hi2) / 2) AS a
  FROM h WHERE step = 40),
w AS (
  SELECT source, tokens,
    CASE WHEN tokens > 0 THEN round(pow(tokens / total, a) / (SELECT sum(pow(p, a)) FROM p, a), 9) ELSE 0 END AS weight, total
  FROM t, g, a),
s AS (SELECT source, weight, tokens, CAST(floor(weight * total) AS BIGINT) AS want FROM w),
q AS (SELECT source, weight, CASE WHEN tokens > 0 THEN want // tokens ELSE 1 END AS passes, CASE WHEN tokens > 0 THEN want % tokens ELSE 0 END AS rest FROM s),
r AS (
  SELECT d.*, q.weight, q.passes, q.rest, sum(n_tokens) OVER (PARTITION BY d.source ORDER BY place) AS so_far
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, source, n_tokens, weight, CAST(passes + CASE WHEN so_far <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies FROM r
"""

NEGATIVES = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

COPIES = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM d WINDOW same AS (PARTITION BY norm)
"""

ORACLES: dict[str, str] = {"op10_temperature_mixing": MIXING, "op12_hard_negatives": NEGATIVES, "op13_exact_dedup": COPIES}

"""DuckDB SQL for the package's queries wherever SQL gives the same rows."""

from __future__ import annotations

#: Exact duplicates: white space deleted, longest original first, then smallest doc_id.
OP8 = r"""
WITH norm AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY normal) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       sha256(normal) AS text_sha256
FROM norm
WINDOW w AS (PARTITION BY normal ORDER BY n_chars DESC, doc_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""


#: Repeated 100-byte strings: every window of every document by its bytes in hex digits.
OP7 = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT doc_id, i, substr(h, CAST(2 * i + 1 AS BIGINT), 200) AS s
  FROM (SELECT doc_id, h, unnest(range(0, greatest(0, length(h) // 2 - 99))) AS i FROM d)),
again AS (
  SELECT doc_id, i
  FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS nth FROM w)
  WHERE nth > 1),
marked AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS opens
  FROM again),
numbered AS (
  SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM marked),
runs AS (
  SELECT doc_id, run, min(i) AS b, max(i) + 100 AS e FROM numbered GROUP BY doc_id, run),
pieces AS (
  SELECT r.doc_id, r.b, r.e,
         substr(d.h, CAST(2 * coalesce(lag(r.e) OVER v, 0) + 1 AS BIGINT),
                CAST(2 * (r.b - coalesce(lag(r.e) OVER v, 0)) AS BIGINT)) AS kept
  FROM runs r JOIN d USING (doc_id)
  WINDOW v AS (PARTITION BY r.doc_id ORDER BY r.b)),
docs AS (
  SELECT doc_id, sum(e - b) AS n_removed, count(*) AS n_spans, max(e) AS e,
         string_agg(kept, '' ORDER BY b) AS kept
  FROM pieces GROUP BY doc_id)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(d.h, CAST(2 * coalesce(e, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM d LEFT JOIN docs USING (doc_id)
"""


#: Jaccard similarity of all pairs that share a shingle, then the least id reachable.
OP12 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
alike AS (SELECT md5(array_to_string(list_sort(s), chr(10))) AS class, min(doc_id) AS least, any_value(s) AS s, any_value(len(s)) AS n
          FROM sets WHERE len(s) > 0 GROUP BY 1),
shingles AS MATERIALIZED (SELECT least, n, md5_number_lower(x) AS x FROM (SELECT least, n, unnest(s) AS x FROM alike)),
links AS MATERIALIZED (
  SELECT a.least AS u, b.least AS v FROM shingles a JOIN shingles b ON a.x = b.x AND a.least <> b.least
  GROUP BY a.least, b.least, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
  SELECT least AS node, least AS met FROM alike
  UNION
  SELECT reach.node, links.v FROM reach JOIN links ON links.u = reach.met),
roots AS (SELECT node, min(met) AS root FROM reach GROUP BY node)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(roots.root, sets.doc_id) AS component_id,
       sets.doc_id = coalesce(roots.root, sets.doc_id) AS kept
FROM sets LEFT JOIN alike ON len(sets.s) > 0 AND alike.class = md5(array_to_string(list_sort(sets.s), chr(10)))
LEFT JOIN roots ON roots.node = alike.least
"""

#: All inner products of the anchors.
OP13 = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id,
       p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_substring_dedup": OP7, "op8_exact_dedup": OP8, "op12_minhash_dedup": OP12, "op13_hard_negatives": OP13}

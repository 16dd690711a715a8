"""SQL twins of the numbered queries that SQL can express, over the raw tables."""

from __future__ import annotations

from placaflow.llm import mixing

WORDS = r"[^\x20\x09-\x0D]+"

OP2 = """
WITH bodies AS (
  SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n FROM pages
), last AS (
  SELECT body, max(page_id) AS refers FROM bodies WHERE n >= 1000 GROUP BY body
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(bodies.body) AS payload_digest,
  CASE WHEN refers IS NULL OR refers = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN refers <> page_id THEN refers END AS refers_to
FROM bodies LEFT JOIN last ON bodies.n >= 1000 AND bodies.body = last.body
"""

OP3 = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORDS}')), 0) AS size,
    md5('{mixing.SEED}' || coalesce('|' || doc_id, '')) AS perm
  FROM documents
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)
), weighed AS (SELECT *, rank % 3 + 1 AS weight FROM ranked
), levels AS (
  SELECT *, 3 * source_size / weight AS fills,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
      ORDER BY 3 * source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY 3 * source_size / weight, rank
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), targets AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), weight * (
    SELECT level FROM levels WHERE fills >= level ORDER BY fills, rank LIMIT 1)) AS target
  FROM levels
), placed AS (
  SELECT sized.*, source_size, target,
    CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS rounds,
    sum(size) OVER (PARTITION BY sized.source ORDER BY perm, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), needed AS (SELECT *, target - rounds * source_size AS need FROM placed
), gaps AS (
  SELECT *, need - coalesce(max(CASE WHEN upto <= need AND size > 0 THEN upto END)
    OVER (PARTITION BY source), 0) AS gap
  FROM needed
), later AS (SELECT source, size, upto FROM gaps WHERE upto > need AND size > 0
), fitted AS (
  SELECT DISTINCT source, gap AS rest, CAST(need AS DOUBLE) AS upto FROM gaps
  UNION ALL
  SELECT f.source, f.rest - arg_min(later.size, later.upto), CAST(min(later.upto) AS DOUBLE)
  FROM fitted AS f JOIN later ON f.source IS NOT DISTINCT FROM later.source
    AND later.upto > f.upto AND later.size <= f.rest
  GROUP BY f.source, f.rest, f.upto
), rests AS (SELECT source, min(rest) AS rest FROM fitted GROUP BY source
), closed AS (
  SELECT gaps.*, fitted.upto IS NOT NULL AND gaps.upto > need AS fits, rests.rest
  FROM gaps JOIN rests ON gaps.source IS NOT DISTINCT FROM rests.source
  LEFT JOIN fitted ON gaps.source IS NOT DISTINCT FROM fitted.source AND gaps.upto = fitted.upto AND gaps.size > 0
), fillers AS (
  SELECT *, CASE WHEN upto > need AND NOT fits AND size > 0 AND abs(size - rest) < rest THEN
    row_number() OVER (PARTITION BY source, upto > need AND NOT fits AND size > 0 AND abs(size - rest) < rest
      ORDER BY abs(size - rest), upto) END AS place
  FROM closed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(CASE WHEN size = 0 THEN 0 ELSE size * (rounds
    + CASE WHEN upto <= need OR fits OR place = 1 THEN 1 ELSE 0 END) END AS BIGINT) AS taken
FROM fillers
"""

OP5 = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM worded
), grams AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS common
  FROM grams AS a JOIN grams AS b ON a.g = b.g AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY ALL
), links AS (
  SELECT a, b FROM shared WHERE 100 * common >= 90 * (na + nb - common)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT a AS doc_id, b AS other FROM edges
  UNION
  SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.other = edges.a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(least_other, doc_id)) AS component_id
FROM sets LEFT JOIN (SELECT doc_id, min(other) AS least_other FROM reach GROUP BY doc_id) USING (doc_id)
"""

OP11 = """
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), held AS (SELECT row_id, doc_id, CAST(len(terms) AS BIGINT) AS n, terms FROM texts WHERE len(terms) > 0
), total AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM held
), counted AS (
  SELECT row_id, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT row_id, doc_id, n, unnest(terms) AS term FROM held) GROUP BY ALL
), weighed AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * nn + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), total
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, row_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll)))) AS BIGINT) AS score
  FROM asked JOIN weighed USING (term) JOIN counted USING (term), total
  GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 50
"""

OP13 = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM usable AS a JOIN usable AS c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS place
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE place <= 3
"""

ORACLES = {"op2_warc": OP2, "op3_mix": OP3, "op5_jaccard": OP5, "op11_lexical": OP11, "op13_hard_negatives": OP13}

"""DuckDB SQL of the corpus queries that SQL can express in reasonable time."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(
        CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
             ELSE w END) AS s
    FROM docs
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * c >= 80 * (p.n + q.n - c)
), pairs AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT doc_id, doc_id AS other FROM docs
    UNION
    SELECT reach.doc_id, pairs.b FROM reach JOIN pairs ON pairs.a = reach.other
)
SELECT docs.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles,
    min(other) AS component_id, docs.doc_id = min(other) AS kept
FROM docs JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY docs.doc_id
"""

DECONTAMINATION = f"""
WITH docs AS (
    SELECT doc_id, coalesce({_ALNUM_WORDS}, []) AS w FROM documents
), items AS (
    SELECT item_id, coalesce({_ALNUM_WORDS}, []) AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS width, array_to_string(w[k:k + 12], ' ') AS s
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k
          FROM items WHERE len(w) > 0)
), places AS (
    SELECT doc_id, width, p, array_to_string(w[p:p + width - 1], ' ') AS s
    FROM (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS p
          FROM docs, (SELECT DISTINCT width FROM windows) WHERE len(w) >= width)
), found AS (
    SELECT doc_id, item_id, p, width FROM places JOIN windows USING (width, s)
), hit AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit
    FROM (SELECT doc_id, unnest(range(p, p + width)) AS j FROM found) GROUP BY doc_id
), matched AS (
    SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN matched USING (doc_id)
"""

HARD_NEGATIVES = """
WITH usable AS (
    SELECT row_number() OVER () AS nr, vec_id,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.nr AS anchor, a.vec_id AS anchor_id, b.nr, b.vec_id, a.label = b.label AS same,
        list_inner_product(a.v, b.v)::BIGINT AS score
    FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.nr <> b.nr
), positives AS (
    SELECT anchor, anchor_id, nr, vec_id AS positive_id, score AS positive_score FROM scored
    WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5
), negatives AS (
    SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id,
        s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor, p.nr ORDER BY s.score DESC, s.vec_id) AS rank
    FROM positives p JOIN scored s ON p.anchor = s.anchor AND NOT s.same
        AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 3
"""

ORACLES = {
    "op8_near_duplicates": NEAR_DUPLICATES,
    "op10_decontamination": DECONTAMINATION,
    "op11_hard_negatives": HARD_NEGATIVES,
}

"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from salesmill.llm.ball_tree import op9_exact_top_k
from salesmill.llm.hard_negatives import op12_hard_negatives
from salesmill.llm.language import op8_language
from salesmill.llm.near_copies import op6_near_copies
from salesmill.llm.nearest import op2_nearest
from salesmill.llm.packing import op4_best_fit_packing
from salesmill.llm.quality import op11_quality
from salesmill.llm.sentence_pieces import op10_sentencepiece
from salesmill.llm.suffix_arrays import op7_repeated_passages
from salesmill.llm.surrogates import op3_surrogates
from salesmill.llm.token_alignment import op13_token_alignment
from salesmill.llm.token_codes import op1_token_codes
from salesmill.llm.toxicity import op5_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_token_codes,
        op2_nearest,
        op3_surrogates,
        op4_best_fit_packing,
        op5_toxicity,
        op6_near_copies,
        op7_repeated_passages,
        op8_language,
        op9_exact_top_k,
        op10_sentencepiece,
        op11_quality,
        op12_hard_negatives,
        op13_token_alignment,
    )
}

# Whole components, then every query against all rows but its own.
EXACT_TOP_K = """
WITH v AS (
  SELECT row_number() OVER () AS row_no, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.row_no, q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.row_no <> c.row_no AND len(q.w) = len(c.w)
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY row_no ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

# Anchors against all other rows, then each positive's window of the rows of other labels.
HARD_NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS row_no, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.row_no, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.row_no <> c.row_no AND len(a.w) = len(c.w)
  WHERE a.vec_id % 50 = 0
), p AS (
  SELECT row_no, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY row_no ORDER BY score DESC, vec_id) AS place
  FROM s WHERE same QUALIFY place <= 5
)
SELECT s.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
       CAST(row_number() OVER (PARTITION BY s.row_no, p.place ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
FROM p JOIN s ON s.row_no = p.row_no AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""

ORACLES: dict[str, str] = {"op9_exact_top_k": EXACT_TOP_K, "op12_hard_negatives": HARD_NEGATIVES}

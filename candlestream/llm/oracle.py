"""The results of the queries as SQL, where SQL can express them."""

_QUALITY = r"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), grams AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM split WHERE len(w) >= 3
), counted AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS c FROM grams
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS p FROM counted WHERE c > 1
  ) GROUP BY r
), facts AS (
  SELECT doc_id, t, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (r)
), judged AS (
  SELECT *, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed
  FROM facts
)
"""

QUALITY_KEPT = """
NOT base_failed AND n_symbols * 10 <= n_words AND word_chars BETWEEN n_words * 2 AND n_words * 20
  AND n_dup_lines * 10 <= len(lines) * 6 AND n_upper * 2 <= word_chars
"""

HARD_NEGATIVES = """
WITH vectors AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.id AS anchor_id, r.id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM vectors a JOIN vectors r ON a.id % 100 = 0 AND r.id <> a.id
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT same
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

ORACLE: dict[str, str] = {
    "op8_quality_cascade": f"""{_QUALITY}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  {QUALITY_KEPT} AS kept FROM judged""",
    "op11_hard_negatives": HARD_NEGATIVES,
}

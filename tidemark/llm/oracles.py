"""SQL for the operators that SQL can express, for DuckDB on the same tables."""

from __future__ import annotations

from tidemark.llm.chat import BEGIN, END, PART
from tidemark.llm.common import LOWER, UPPER
from tidemark.llm.quality import RULES, STOP_WORDS, Rule

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWERED = f"translate({{}}, '{UPPER}', '{LOWER}')"

MIXING = f"""
WITH d AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, 'null') || '|' || coalesce(text, '')) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank,
         sum(source_size) OVER ()::DOUBLE AS total, (3 * source_size)::DOUBLE AS cap FROM s),
w AS (SELECT *, CASE rank % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END
        AS weight FROM r),
f AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, rank) AS place,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, rank
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)::DOUBLE AS used,
    sum(weight) OVER (ORDER BY cap / weight, rank
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS rest
  FROM w),
o AS (SELECT min(place) AS place FROM f WHERE weight * (total - used) / rest <= cap),
l AS (SELECT f.place, f.used, f.rest FROM f JOIN o USING (place)),
t AS (
  SELECT f.source, f.source_size,
    CASE WHEN l.place IS NULL OR f.place < l.place THEN f.cap
         ELSE f.weight * (f.total - l.used) / l.rest END AS target
  FROM f LEFT JOIN l ON true),
p AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS earlier FROM d)
SELECT p.doc_id, p.size, t.source_size, t.target,
  CASE WHEN p.size = 0 THEN 0 ELSE p.size * greatest(0, least(3,
    floor((2 * t.target - 2 * p.earlier - p.size) / (2 * t.source_size)) + 1)) END::BIGINT AS taken
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
"""

LINES = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (SELECT *, {LOWERED.format(f"trim(line, {WHITE})")} AS key FROM l),
often AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT k.doc_id, count(*)::BIGINT AS n_lines, count(often.key)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (often.key IS NULL), ''))
    AS kept_sha256
FROM k LEFT JOIN often USING (key) GROUP BY k.doc_id
"""

TOP_K = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT a.vec_id AS anchor_id, a.label AS a_label, a.v AS a_v, c.vec_id, c.label, c.v,
    list_inner_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND len(a.v) = len(c.v)
    AND NOT (a.vec_id = c.vec_id AND a.label = c.label AND a.v = c.v)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id, a_label, a_v ORDER BY score DESC, vec_id) AS place
  FROM p WHERE label = a_label),
n AS (
  SELECT r.anchor_id, r.a_label, r.a_v, r.place, r.vec_id AS positive_id, r.score AS positive_score,
    p.vec_id AS negative_id, p.score AS negative_score,
    row_number() OVER (PARTITION BY r.anchor_id, r.a_label, r.a_v, r.place
      ORDER BY p.score DESC, p.vec_id) AS rank
  FROM r JOIN p ON r.anchor_id = p.anchor_id AND r.a_label = p.a_label AND r.a_v = p.a_v
    AND p.label <> r.a_label AND 50 * r.score <= 100 * p.score AND 100 * p.score <= 95 * r.score
  WHERE r.place <= 5)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3
"""


def _rule(rule: Rule) -> str:
    """The rule as a condition over the counts."""
    tests = ["true"]
    if rule.low is not None:
        tests.append(f"{rule.numerator} >= {rule.low}::DOUBLE * {rule.denominator}")
    if rule.high is not None:
        tests.append(f"{rule.numerator} <= {rule.high}::DOUBLE * {rule.denominator}")
    return f"(n_words < {rule.from_words} OR {rule.denominator} = 0 OR ({' AND '.join(tests)}))"


_STOP = ", ".join(f"'{w}'" for w in sorted({*STOP_WORDS}))

QUALITY = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS words FROM documents),
w AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], chr(31)) AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM d WHERE len(words) > 4)),
rep AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM w),
cov AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(5)) AS k)
  WHERE rep.n > 1 GROUP BY doc_id),
l AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x, {WHITE}) <> '') AS lines
  FROM d),
c AS (
  SELECT d.doc_id, len(words) AS n_words, list_sum(list_transform(words, lambda x: length(x))) AS chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(cov.n, 0) AS n_repeat_words,
    len(list_filter(words, lambda x: list_contains([{_STOP}], lower(x)))) AS n_stop_words
  FROM d JOIN l USING (doc_id) LEFT JOIN cov USING (doc_id)),
j AS (
  SELECT *, coalesce(chars, 0) AS word_chars,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND {' AND '.join(_rule(r) for r in RULES)} AS kept
FROM j
"""

NEAR_DUPS = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_transform({WORDS}, lambda x: {LOWERED.format('x')}) AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], chr(31)) AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i
        FROM d WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(a, b) AS (
  SELECT a, b FROM both_ways
  UNION
  SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
least AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
  coalesce(least.c, d.doc_id) AS component_id, d.doc_id = coalesce(least.c, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least ON least.a = d.doc_id
"""

CHAT = f"""
WITH t AS (
  SELECT conv_id, turn,
    replace(regexp_replace(coalesce(role, 'unknown'), '\\s', ' ', 'g'), '<|', '< |') AS speaker,
    replace(coalesce(text, ''), '<|', '< |') AS words FROM conversations),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, speaker, words) - 1
    AS position FROM t),
p AS (SELECT DISTINCT conv_id AS c, speaker AS perspective FROM t WHERE lower(speaker) <> 'system'),
e AS (
  SELECT o.conv_id, p.perspective, position // {PART} AS part, position,
    speaker = perspective AS trained, words,
    '{BEGIN}' || CASE WHEN lower(speaker) = 'system' THEN 'system'
      WHEN speaker = perspective THEN 'assistant' ELSE 'user name=' || speaker END || chr(10) AS head
  FROM o JOIN p ON o.conv_id IS NOT DISTINCT FROM p.c),
f AS (
  SELECT *, head || words || '{END}' || chr(10) AS piece,
    coalesce(sum(length(head) + length(words) + {len(END) + 1}) OVER (
      PARTITION BY conv_id, perspective, part ORDER BY position
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
  FROM e)
SELECT conv_id, perspective, part::BIGINT AS part, count(*)::BIGINT AS n_turns,
  count(*) FILTER (trained)::BIGINT AS n_trained, string_agg(piece, '' ORDER BY position) AS text,
  coalesce(string_agg((place + length(head))::VARCHAR || ':' || (place + length(piece) - 1)::VARCHAR, ','
    ORDER BY position) FILTER (trained), '') AS mask
FROM f GROUP BY conv_id, perspective, part
"""

ORACLES = {
    "op1_mixing": MIXING,
    "op2_line_dedup": LINES,
    "op3_top_k": TOP_K,
    "op5_quality": QUALITY,
    "op7_near_dups": NEAR_DUPS,
    "op10_chat": CHAT,
    "op12_hard_negatives": HARD_NEGATIVES,
}

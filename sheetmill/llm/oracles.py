"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from sheetmill.llm.licenses import license_sql
from sheetmill.llm.quality import RULES, RiskControl

_C = RiskControl()
_STRATA = ", ".join(f"'{s}'" for s in _C.strata)

QUALITY_CTES = f"""
d AS (SELECT doc_id, coalesce(text, '') AS t, CASE WHEN lang IN ({_STRATA}) THEN lang ELSE 'other' END AS stratum FROM documents),
w AS (SELECT *, [x FOR x IN regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+') IF x <> ''] AS ws,
             [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS ls FROM d),
tri AS (SELECT doc_id, i, ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] AS g FROM (SELECT doc_id, ws, unnest(range(len(ws) - 2)) AS i FROM w)),
dup AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM dup) GROUP BY doc_id),
base AS (SELECT w.doc_id, w.t, w.stratum, len(ws)::BIGINT AS n_words,
    (length(t) - length(regexp_replace(t, '[^\\x20\\x09-\\x0D]+', '', 'g')))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    (length(t) - length(regexp_replace(t, '[!?]+', '', 'g')))::BIGINT AS n_shouts,
    (length(t) - length(regexp_replace(t, '\\p{{Lu}}+', '', 'g')))::BIGINT AS n_upper,
    (length(t) - length(regexp_replace(t, '[0-9]+', '', 'g')))::BIGINT AS n_digits
    FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
m AS (SELECT doc_id, t, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
    CASE WHEN n_words > 0 THEN n_symbols::DOUBLE / n_words ELSE 0 END AS symbol_rate,
    CASE WHEN n_words > 0 THEN n_shouts::DOUBLE / n_words ELSE 0 END AS shout_rate,
    CASE WHEN word_chars > 0 THEN n_upper::DOUBLE / word_chars ELSE 0 END AS upper_share,
    CASE WHEN word_chars > 0 THEN n_digits::DOUBLE / word_chars ELSE 0 END AS digit_share,
    CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END AS dup_line_share,
    CASE WHEN n_words > 0 THEN n_repeat_words::DOUBLE / n_words ELSE 0 END AS repeat_share FROM base),
lab AS (SELECT stratum, t, max(l.quality) AS quality, {", ".join(f"max({r}) AS {r}" for r in RULES)} FROM m JOIN labels l ON l.doc_id = m.doc_id
        WHERE NOT base_failed AND l.quality IN (0, 1) GROUP BY stratum, t),
long AS ({" UNION ALL ".join(f"SELECT stratum, '{r}' AS rule, quality, ceil({r} / {_C.step}::DOUBLE) AS bin FROM lab" for r in RULES)}),
counts AS (SELECT stratum, rule, c, count(*) FILTER (quality = 1) AS n_good, count(*) FILTER (quality = 0) AS n_bad,
    count(*) FILTER (quality = 1 AND bin > c) AS k, count(*) FILTER (quality = 0 AND bin > c) AS b
    FROM long, range(1, {_C.steps + 1}) AS g(c) GROUP BY ALL),
tested AS (SELECT *, n_good > 0 AND k <= n_good * {_C.alpha_rule!r}::DOUBLE AND
    list_sum([exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln({_C.alpha_rule!r}::DOUBLE) + (n_good - i) * ln(1 - {_C.alpha_rule!r}::DOUBLE)) FOR i IN range(k + 1)]) <= {_C.level!r}::DOUBLE AS passes,
    CASE WHEN n_bad > 0 THEN b::DOUBLE / n_bad ELSE 0 END - {_C.penalty}::DOUBLE * CASE WHEN n_good > 0 THEN k::DOUBLE / n_good ELSE 0 END AS gain FROM counts),
certified AS (SELECT * FROM (SELECT *, bool_and(passes) OVER (PARTITION BY stratum, rule ORDER BY c DESC) AS ok FROM tested) WHERE ok AND gain > 1e-9),
cut AS (SELECT stratum, rule, c FROM certified QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY round(gain, 9) DESC, c DESC) = 1),
verdict AS (SELECT m.*, NOT base_failed AND NOT EXISTS (SELECT 1 FROM cut WHERE cut.stratum = m.stratum AND
    ceil(CASE cut.rule {" ".join(f"WHEN '{r}' THEN m.{r}" for r in RULES)} END / {_C.step}::DOUBLE) > cut.c) AS kept FROM m)
"""



def _code_round(r: int) -> str:
    """Assignment to the codebook b{r} and the codebook after it."""
    return f"""
a{r} AS (SELECT p.k, p.part, p.x, min(list_sum([(p.x[i] - b.x[i]) ** 2 FOR i IN range(1, len(p.x) + 1)])::BIGINT * 64 + b.e) AS best
       FROM p JOIN b{r} b USING (part) GROUP BY p.k, p.part, p.x),
c{r} AS (SELECT part, e, list(m ORDER BY i) AS x FROM (
    SELECT part, best % 64 AS e, i, floor(sum(x[i])::DOUBLE / count(*))::BIGINT AS m FROM a{r}, (SELECT unnest(range(1, 1 + (SELECT any_value(len(x)) FROM p))) AS i) GROUP BY ALL) GROUP BY part, e),
b{r + 1} AS (SELECT b.part, b.e, coalesce(c.x, b.x) AS x FROM b{r} b LEFT JOIN c{r} c ON c.part = b.part AND c.e = b.e),"""


_CODES = f"""
WITH v AS (SELECT row_number() OVER () AS k, vec_id, label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT k, vec_id, part, v[(part * len(v) // 16 + 1)::INT : ((part + 1) * len(v) // 16)::INT] AS x FROM (SELECT *, unnest(range(16)) AS part FROM v)),
b0 AS (SELECT part, e, x FROM (SELECT part, x, row_number() OVER (PARTITION BY part ORDER BY vec_id NULLS LAST, k) - 1 AS e FROM p) WHERE e < 64),{_code_round(0)}{_code_round(1)}{_code_round(2)}
digest AS (SELECT sha256(string_agg(n::VARCHAR, ',' ORDER BY part, e, i)) AS d FROM (SELECT part, e, unnest(x) AS n, unnest(range(len(x))) AS i FROM b2)),
r AS (SELECT k, string_agg(format('{{:02x}}', best % 64), '' ORDER BY part) AS code, sum(best // 64)::BIGINT AS error FROM a2 GROUP BY k),
l AS (SELECT v.vec_id, v.label, r.code, r.error FROM v JOIN r USING (k))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT d FROM digest) AS codebooks_sha256 FROM l"""

ORACLES: dict[str, str] = {
    "op11_vector_codes": _CODES,
    "op13_hard_negatives": """
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id, embedding, label) AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.k AS anchor, a.vec_id AS anchor_id, c.k, c.vec_id, c.label = a.label AS same, list_sum([a.v[i] * c.v[i] FOR i IN range(1, len(a.v) + 1)])::BIGINT AS score
      FROM v a JOIN v c ON a.vec_id % 50 = 0 AND c.k <> a.k),
p AS (SELECT anchor, k AS positive, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, k) <= 5),
n AS (SELECT s.anchor_id, p.positive_id, (row_number() OVER (PARTITION BY anchor, positive ORDER BY score DESC, vec_id, s.k))::INTEGER AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
      FROM s JOIN p USING (anchor) WHERE NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT * FROM n WHERE rank <= 3""",
    "op2_quality_rules": f"WITH {QUALITY_CTES} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, stratum, {', '.join(RULES)} FROM verdict",
    "op10_exact_topk": """
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS k, vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.k, q.vec_id AS query_id, c.vec_id, list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.k <> q.k)
SELECT query_id, rank, vec_id, score FROM (SELECT *, (row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s) WHERE rank <= 5""",
    "op1_chat_formatting": """
WITH t AS (SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list([turn::VARCHAR, role, text] ORDER BY turn, role, text) AS l FROM t GROUP BY conv_id),
p AS (SELECT DISTINCT l[1:k] AS l FROM (SELECT l, unnest(range(1, len(l))) AS k FROM c)),
kept AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies FROM c WHERE l NOT IN (SELECT l FROM p) GROUP BY l)
SELECT conv_id, (turn // 1024)::BIGINT AS block, 0::BIGINT AS part, count(*) AS n_turns, n_copies,
       string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY turn, role, text) AS text
FROM t JOIN kept USING (conv_id) GROUP BY conv_id, turn // 1024, n_copies""",
    "op3_license_scans": license_sql(),
}

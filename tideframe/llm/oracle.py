"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from tideframe.llm import line_templates as L
from tideframe.llm import poisson_mix as P

EXACT = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

MIX = f"""
WITH sizes AS (
  SELECT source, sum(length(coalesce(text, '')) + 1)::DOUBLE AS size FROM documents GROUP BY source
), rates AS (
  SELECT source, pow(size, {P.EXPONENT}) / (SELECT sum(pow(size, {P.EXPONENT})) FROM sizes)
         * (SELECT sum(size) FROM sizes) / size AS rate
  FROM sizes
), steps AS (
  SELECT source, rate, k,
         sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf
  FROM (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 24)::BIGINT + 1)) AS k FROM rates)
), lists AS (
  SELECT source, any_value(rate) AS rate, list(cdf ORDER BY k) AS cdfs FROM steps GROUP BY source
), keyed AS (
  SELECT *, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS key FROM documents
), drawn AS (
  SELECT d.*, rate, cdfs,
         ('0x' || substr(md5('{P.SEED}|' || key), 1, {P.DIGITS}))::BIGINT / {float(16**P.DIGITS)} AS draw
  FROM keyed d JOIN lists r ON d.source IS NOT DISTINCT FROM r.source
), counted AS (
  SELECT *, len(list_filter(cdfs, lambda c: c <= draw))::INTEGER AS n FROM drawn
), copied AS (
  SELECT *, unnest(range(1, n + 1))::INTEGER AS copy FROM counted WHERE n > 0
)
SELECT doc_id, source, text, round(rate, 6) AS mix_rate, n AS mix_copies, copy AS mix_copy,
       md5('{P.SEED}|order|' || key || '|' || copy) AS mix_order
FROM copied
"""

LINES = f"""
WITH RECURSIVE split AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT r, doc_id, i, lines[i] AS line,
         regexp_replace(trim(regexp_replace(lines[i], '{L.BLANKS}', ' ', 'g')), '{L.FIELD}', '<*>', 'g') AS mask
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM split)
), tokens AS (
  SELECT *, string_split(mask, ' ') AS t FROM lines
), masks AS (
  SELECT mask, any_value(t) AS t, count(DISTINCT r) AS n_docs, min(doc_id) AS low, max(doc_id) AS high
  FROM tokens WHERE len(t) >= {L.MIN_TOKENS} GROUP BY mask
), named AS (
  SELECT *, len(t) AS n, t[1:{L.DEPTH}] AS lead, {{'n': n_docs, 'm': md5(mask)}} AS rank,
         len(t) - ceil({L.SIMILAR} * len(t))::INTEGER + 1 AS parts
  FROM masks
), blocks AS (
  SELECT mask, n, lead, rank, b,
         t[{L.DEPTH} + b * (n - {L.DEPTH}) // parts + 1 : {L.DEPTH} + (b + 1) * (n - {L.DEPTH}) // parts] AS block
  FROM (SELECT *, unnest(range(0, parts)) AS b FROM named)
), tops AS (
  SELECT n, lead, b, block, arg_max(mask, rank) AS top FROM blocks GROUP BY ALL
), met AS (
  SELECT DISTINCT mask, top FROM blocks JOIN tops USING (n, lead, b, block)
), parents AS (
  SELECT met.mask, arg_max(top, its.rank) AS parent
  FROM met JOIN named own ON own.mask = met.mask JOIN named its ON its.mask = top
  WHERE its.rank > own.rank
    AND len(list_filter(list_zip(own.t, its.t), lambda p: p[1] = p[2])) >= ceil({L.SIMILAR} * own.n)
  GROUP BY met.mask
), chain AS (
  SELECT mask, mask AS last FROM named
  UNION ALL
  SELECT chain.mask, parent FROM chain JOIN parents ON parents.mask = last
), placed AS (
  SELECT m.*, last AS template
  FROM named m JOIN chain USING (mask) WHERE last NOT IN (SELECT mask FROM parents)
), several AS (
  SELECT template, min(low) AS first_doc FROM placed GROUP BY template HAVING min(low) <> max(high)
), gone AS (
  SELECT mask, first_doc FROM placed JOIN several USING (template)
)
SELECT doc_id, count(*)::INTEGER AS n_lines, count(first_doc)::INTEGER AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (first_doc IS NULL), '') AS text
FROM (
  SELECT r, doc_id, i, line, CASE WHEN doc_id IS DISTINCT FROM first_doc THEN first_doc END AS first_doc
  FROM tokens LEFT JOIN gone USING (mask)
)
GROUP BY r, doc_id
"""

ORACLE: dict[str, str] = {
    "op4_poisson_mix": MIX,
    "op5_exact_dedup": EXACT,
    "op9_line_templates": LINES,
}

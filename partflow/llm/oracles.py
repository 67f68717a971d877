"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# measures and rules of each document, as views of the host rules
_MEASURED = r"""
w AS (SELECT doc_id, source, coalesce(text, '') AS t,
        list_filter(string_split_regex(coalesce(text, ''), '[ \x09-\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \x09-\x0D]')) AS ls,
        row_number() OVER () AS rn FROM documents),
win AS (SELECT rn, unnest(range(0, len(ws) - 7)) AS i, unnest(list_transform(range(0, len(ws) - 7),
        lambda k: array_to_string(ws[k + 1:k + 8], ' '))) AS x FROM w WHERE len(ws) >= 8),
rep AS (SELECT rn, i FROM (SELECT *, count(*) OVER (PARTITION BY rn, x) AS c FROM win) WHERE c > 1),
cov AS (SELECT rn, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS c FROM
        (SELECT rn, i, lead(i) OVER (PARTITION BY rn ORDER BY i) AS nxt FROM rep) GROUP BY rn),
m AS (SELECT w.rn, doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c, 0)::BIGINT AS n_repeat_words,
        len(ls)::BIGINT AS n_lines FROM w LEFT JOIN cov ON cov.rn = w.rn),
r AS (SELECT *, n_words < 20 AS r1, 100 * n_repeat_words > 30 * n_words AS r2, 10 * n_symbols > n_words AS r3,
        10 * n_dup_lines > 4 * n_lines AS r4, word_chars < 2 * n_words OR word_chars > 15 * n_words AS r5 FROM m),
long AS (SELECT source, unnest([1, 2, 3, 4, 5]) AS k, unnest([r1, r2, r3, r4, r5]) AS f FROM r),
h AS (SELECT source, k, count(*) AS n, sum(f::INT) AS f FROM long GROUP BY ALL),
p AS (SELECT k, avg(f / n) AS mean, var_pop(f / n) AS v FROM h GROUP BY k),
q AS (SELECT k, mean, CASE WHEN v > 0 THEN least(1e6, greatest(1, mean * (1 - mean) / v - 1)) ELSE 1e6 END AS wt FROM p),
bad AS (SELECT DISTINCT source FROM h JOIN q USING (k) WHERE (f + mean * wt) / (n + wt) > 0.5),
judged AS (SELECT r.*, r1 OR r2 AS base_failed, NOT (r1 OR r2 OR r3 OR r4 OR r5) AND NOT EXISTS
        (SELECT 1 FROM bad WHERE bad.source IS NOT DISTINCT FROM r.source) AS kept FROM r)
"""

ORACLES["op7_host_rules"] = f"""
WITH {_MEASURED}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged
"""

"""DuckDB SQL of the quality rules query: measures, certified cutoffs, verdicts."""

from __future__ import annotations

from .quality_rules import ERROR, RISK, RULES

_SPACE = r"\x20\x09-\x0D"


def quality_sql(risk: float = RISK, error: float = ERROR, rules: dict = RULES) -> str:
    """The rows of ``op8_quality_rules`` over the views ``documents`` and ``labels``."""
    share = risk / len(rules)
    measured = " UNION ALL ".join(f"SELECT d, stratum, '{name}' AS rule, ({measure})::DOUBLE AS v FROM m" for name, (measure, _) in rules.items())
    grid = ", ".join(f"('{name}', {k}, {c}::DOUBLE)" for name, (_, cutoffs) in rules.items() for k, c in enumerate(cutoffs))
    return f"""
WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, lang AS stratum, coalesce(text, '') AS text FROM documents),
split AS MATERIALIZED (SELECT *, regexp_extract_all(text, '[^{_SPACE}]+') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{_SPACE}]')) AS lines FROM texts),
windows AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY r),
m AS MATERIALIZED (SELECT doc_id, r AS d, stratum, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
  len(words) < 50 OR 100 * coalesce(n, 0) > 50 * len(words) AS base_failed
  FROM split LEFT JOIN covered USING (r)),
known AS (SELECT doc_id, max(quality) = 1 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
grid(rule, k, cutoff) AS (VALUES {grid}),
measured AS ({measured}),
tried AS (SELECT measured.stratum, rule, k, any_value(cutoff) AS cutoff, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE NOT good) AS n_bad,
  count(*) FILTER (WHERE good AND v > cutoff) AS good_rejected, count(*) FILTER (WHERE NOT good AND v > cutoff) AS bad_rejected
  FROM measured JOIN m USING (d) JOIN known USING (doc_id) JOIN grid USING (rule) WHERE NOT base_failed GROUP BY ALL),
tails AS (SELECT *, CASE WHEN n_good > 0 AND good_rejected < n_good * {share}::DOUBLE THEN list_sum(list_transform(range(0, good_rejected + 1),
    lambda i: exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln({share}::DOUBLE) + (n_good - i) * ln(1 - {share}::DOUBLE))))
  ELSE 1 END AS tail, (SELECT count(*) FROM (SELECT DISTINCT stratum, rule FROM tried)) AS families FROM tried),
fit AS (SELECT *, bad_rejected / greatest(n_bad, 1) - good_rejected / greatest(n_good, 1) AS value,
  max(CASE WHEN tail > {error}::DOUBLE / families THEN k END) OVER (PARTITION BY stratum, rule) AS failed FROM tails),
best AS (SELECT stratum, rule, arg_max(cutoff, (value, k)) AS cutoff FROM fit WHERE k > coalesce(failed, -1) AND value > 0 GROUP BY ALL),
gone AS (SELECT DISTINCT d FROM measured JOIN best ON measured.rule = best.rule AND measured.stratum IS NOT DISTINCT FROM best.stratum WHERE v > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND d NOT IN (SELECT d FROM gone) AS kept
FROM m
"""

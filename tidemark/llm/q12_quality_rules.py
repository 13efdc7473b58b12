"""op12: line-first quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import quality
from tidemark.llm.common import table


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars"]
    return quality.judge(table(spark, sf_dir, "documents")).select(*base)


def _sql() -> str:
    quoted = lambda pattern: "'" + pattern.replace("'", "''") + "'"
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    words = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
    in_words = r"length(regexp_replace({}, '[\x20\x09-\x0D]', '', 'g'))"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, {words.format("text")} AS w FROM d),
g AS (SELECT r, i, [w[i], w[i + 1], w[i + 2]] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice CROSS JOIN (VALUES (0), (1), (2)) AS k(k) GROUP BY r),
l AS (SELECT r, line, trim(line, {space}) AS bare FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)),
j AS (
  SELECT r, line, bare, {words.format("bare")} AS w FROM l WHERE bare <> ''),
n AS (
  SELECT r, line, bare, len(w) AS n, len(list_filter(w, lambda x: regexp_full_match(x, {quoted(quality.SEPARATOR)}))) AS alone,
         len(regexp_extract_all(bare, {quoted(quality.NOISE)})) AS noise FROM j),
f AS (
  SELECT r, line, {in_words.format("line")} AS chars,
         (alone >= 2 AND 5 * alone > n) OR (n <= {quality.NAV_WORDS} AND NOT regexp_matches(bare, {quoted(quality.SENTENCE_END)}))
         OR 5 * noise > n OR (n < {quality.SHORT_LINE} AND NOT regexp_matches(bare, {quoted(quality.SENTENCE_MARK)}))
         OR (n <= {quality.BOILER_WORDS} AND regexp_matches(bare, {quoted(quality.BOILER)})) AS fails FROM n),
lines AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines, coalesce(sum(chars) FILTER (WHERE fails), 0) AS lost FROM f GROUP BY r),
x AS (
  SELECT doc_id, len(w) AS n_words, {in_words.format("text")} AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, CAST(coalesce(lost, 0) AS BIGINT) AS lost_chars
  FROM d JOIN w USING (r) LEFT JOIN lines USING (r) LEFT JOIN covered USING (r))
SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed,
       NOT (n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words OR 100 * lost_chars > {quality.MOST_LOST} * word_chars) AS kept
FROM x
"""


QUERIES = {"op12_quality_rules": op12_quality_rules}
ORACLES = {"op12_quality_rules": _sql()}

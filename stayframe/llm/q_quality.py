"""Registered query of the quality rules, with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.llm import quality
from stayframe.llm.common import table

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its base measures and verdicts."""
    judged = quality.judge(table(spark, sf_dir, "documents", "doc_id", "text"))
    q = F.col("quality")
    return judged.select("doc_id", *[q[c].alias(c) for c in COUNTS], q["base_failed"].alias("base_failed"),
                         q["kept"].alias("kept"))


def _rule_sql(r: quality.Rule) -> str:
    ratio = f"(CASE WHEN {r.den} = 0 THEN 0.0 ELSE CAST({r.num} AS DOUBLE) / {r.den} END)"
    bad = [f"{ratio} < {r.lo}"] if r.lo > 0 else []
    bad += [f"{ratio} > {r.hi}"] if r.hi != float("inf") else []
    return f"(({' OR '.join(bad)}) AND n_words >= {r.min_words})"


_STOP = ", ".join(f"'{w}'" for w in sorted({w for ws in quality.STOP_WORDS.values() for w in ws}))
_K = quality.WINDOW

ORACLE_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS id FROM documents),
w AS (SELECT id, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM t),
win AS (SELECT id, i, ws[i:i + {_K - 1}] AS win
        FROM (SELECT id, ws, unnest(range(1, len(ws) - {_K - 2})) AS i FROM w WHERE len(ws) >= {_K})),
dup AS (SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, win) AS n FROM win) WHERE n > 1),
rep AS (SELECT id, count(DISTINCT i + o) AS n_repeat_words FROM dup, (SELECT unnest(range(0, {_K})) AS o) GROUP BY id),
m AS (SELECT t.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words,
  CAST(coalesce(list_sum(list_transform(w.ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(t.text) - length(regexp_replace(t.text, '[{quality.SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(w.ls) - len(list_distinct(w.ls)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(rep.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
  len(list_filter(w.ws, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words,
  len(w.ls) AS n_lines,
  len(list_filter(w.ls, lambda x: NOT regexp_matches(x, '\\p{{Ll}}') AND regexp_matches(x, '\\p{{Lu}}'))) AS n_shout_lines,
  len(list_filter(w.ls, lambda x: length(x) - length(replace(x, '|', '')) >= 3)) AS n_bar_lines
  FROM t JOIN w ON t.id = w.id LEFT JOIN rep ON rep.id = t.id),
v AS (SELECT *, (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words)
      AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({' OR '.join(_rule_sql(r) for r in quality.RULES)}) AS kept
FROM v"""

QUERIES = {"op8_quality_rules": op8_quality_rules}
ORACLE = {"op8_quality_rules": ORACLE_SQL}

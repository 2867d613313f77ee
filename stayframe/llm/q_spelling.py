"""Registered query of spelling variants, with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayframe.llm import spelling, sqltext
from stayframe.llm.common import table


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word with its form, root and near words."""
    words = spelling.word_counts(table(spark, sf_dir, "documents", "doc_id", "text"))
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE_SQL = f"""
WITH RECURSIVE o AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents),
d AS (SELECT doc_id, run, count(*) AS n FROM o GROUP BY doc_id, run),
h AS (SELECT run, n, {sqltext.crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM d),
s AS (SELECT CASE WHEN h % {spelling.LOSS} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
  ELSE run END AS word, n FROM h),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM s WHERE length(word) >= {spelling.LEAST_LENGTH} GROUP BY word
  HAVING sum(n) >= {spelling.LEAST_COUNT}),
g AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
x AS (SELECT word, n, i, left(word, i - 1) || '*' || substr(word, i + 1) AS hole, left(word, i - 1) || substr(word, i + 1) AS less FROM g),
p AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM x a JOIN x b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT x.word, w.word, w.n FROM x JOIN w ON x.less = w.word
  UNION SELECT w.word, x.word, x.n FROM x JOIN w ON x.less = w.word),
b AS (SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
  row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS r FROM p),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form,
  CASE WHEN near_n >= 2 * n THEN near_n END AS form_n FROM w LEFT JOIN b ON b.word = w.word AND r = 1),
c AS (SELECT word, word AS root, form FROM f UNION ALL SELECT c.word, f.word, f.form FROM c JOIN f ON f.word = c.form)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM f JOIN c ON c.word = f.word AND c.form IS NULL"""

QUERIES = {"op13_spelling_variants": op13_spelling_variants}
ORACLE = {"op13_spelling_variants": ORACLE_SQL}

"""Registered query of the conversation prefix trie, with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.llm import sqltext, trie
from stayframe.llm.common import table, written

# fixed values of the contract: conversations of one block share first turns
BLOCK, MOST = 100, 6
SPAN = 4096          # turns of a conversation that meet its facts together


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, turn, chars) of the rebuilt conversations: some first
    turns of the conversation that starts their block, then their own after as
    many; one row without depth where nothing is left."""
    own = trie.turn_rows(turns)
    keep = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST).alias("h")
    heads = own.where((F.col("pos") < MOST - 1) & (F.col("conv_id") % BLOCK == 0)).groupBy(F.col("conv_id").alias("first")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "turn", "chars"))).alias("head"))
    facts = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "n", keep, (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("first")).join(heads, "first", "left")
    facts = written(facts.select("conv_id", "n", "h", F.expr("coalesce(slice(head, 1, int(h)), slice(array(), 1, 0))").alias("head")),
                    "heads")
    near = facts.select("conv_id", "h", F.size("head").alias("shift"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {SPAN}"))).alias("span"))
    rest = own.withColumn("span", F.expr(f"pos div {SPAN}")).join(near, ["conv_id", "span"]).where("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("shift") + 1).alias("depth"), "turn", "chars")
    start = facts.select("conv_id", F.explode("head").alias("x")).select(
        "conv_id", (F.col("x.pos") + 1).alias("depth"), "x.turn", "x.chars")
    bare = facts.where((F.size("head") == 0) & (F.col("n") <= F.col("h"))).selectExpr(
        "conv_id", "CAST(NULL AS BIGINT) AS depth", "CAST(NULL AS BINARY) AS turn", "CAST(NULL AS BIGINT) AS chars")
    return rest.unionByName(start).unionByName(bare)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return trie.prefixes(rebuilt(turns)).drop("turn")


ORACLE_SQL = f"""
WITH t AS (SELECT conv_id, md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
    length(coalesce(text, '')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, {sqltext.crc32('CAST(conv_id AS VARCHAR)')} % {MOST} AS h FROM t),
p AS (
  SELECT c.conv_id, 0 AS part, pos, k, chars FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % {BLOCK} AND pos < h
  UNION ALL SELECT c.conv_id, 1, pos, k, chars FROM c JOIN t USING (conv_id) WHERE pos >= h),
r AS (SELECT conv_id, k, chars, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth FROM p),
x AS (
  SELECT conv_id, depth, chars, string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM x GROUP BY path, depth),
e AS (SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, max_by(path, depth) AS path FROM x GROUP BY conv_id) GROUP BY path),
m AS (SELECT n.*, up.conv_id AS parent_conv_id FROM n LEFT JOIN n up ON n.depth > 0 AND up.path = left(n.path, 32 * (n.depth - 1))),
k AS (SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
l AS (SELECT n.path, n.depth, n.n_convs, n.chars, k.path IS NULL AS leaf FROM n LEFT JOIN k USING (path)),
s AS (SELECT a.path, count(*) FILTER (b.leaf) AS n_leaves, sum((b.n_convs - 1) * b.chars) AS saved
  FROM n a JOIN l b ON b.depth >= a.depth AND left(b.path, 32 * a.depth) = a.path GROUP BY a.path)
SELECT m.conv_id, m.depth, m.parent_conv_id, m.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM m JOIN s USING (path) LEFT JOIN k USING (path) LEFT JOIN e USING (path)"""

QUERIES = {"op12_prefix_trie": op12_prefix_trie}
ORACLE = {"op12_prefix_trie": ORACLE_SQL}

"""Registered query of exact top-k search, with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.llm import bitslice
from stayframe.llm.common import table

# fixed values of the contract
SCALE, EVERY, K = 256, 50, 5


def op9_bitsliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best rows for every EVERY-th id, against all rows."""
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding").select(
        "vec_id", bitslice.quantised(F.col("embedding"), SCALE).alias("q"))
    return bitslice.top_k(rows, rows.where(F.col("vec_id") % EVERY == 0), K)


ORACLE_SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % {EVERY} = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}"""

QUERIES = {"op9_bitsliced_topk": op9_bitsliced_topk}
ORACLE = {"op9_bitsliced_topk": ORACLE_SQL}

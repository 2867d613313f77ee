"""Registered query of sharding, with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.llm import sharding, sqltext
from stayframe.llm.common import table

SHARDS, SEED = 8, 11


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shard and slot. Rows are numbered by id, then by
    what else the result holds, so that the texts themselves stay where they are."""
    binary = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", (F.octet_length(binary) + 1).cast("long").alias("size"), F.crc32(binary).alias("text_crc32"))
    placed = sharding.place(docs, ["doc_id", "text_crc32", "size"], SHARDS, SEED)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def _mixed(v: str, key: int) -> str:
    a, b = sharding.MULTIPLIERS
    return (f"(SELECT xor(u, u >> 13) FROM (SELECT CAST(xor(t, t >> 15)::HUGEINT * {b} % 4294967296 AS BIGINT) AS u "
            f"FROM (SELECT CAST(xor({v}, {key})::HUGEINT * {a} % 4294967296 AS BIGINT) AS t)))")


def _network(source: str) -> str:
    """The whole network over columns r (row number) and x of ``source``."""
    sql = f"SELECT r, x >> low AS l, x & (1 << low) - 1 AS h, low, high FROM {source}, width"
    for i, key in enumerate(sharding.round_keys(SEED)):
        new = (f"xor(l, {_mixed('h', key)} & (1 << high) - 1) AS l, h" if i % 2 == 0 else
               f"l, xor(h, {_mixed('l', key)} & (1 << low) - 1) AS h")
        sql = f"SELECT r, {new}, low, high FROM ({sql})"
    return f"SELECT r, (l << low) | h AS x FROM ({sql})"


ORACLE_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
  {sqltext.crc32("coalesce(text, '')")} AS text_crc32 FROM documents),
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS r FROM d),
bits AS (SELECT count(*) AS n, greatest(2, length(ltrim(bin(greatest(count(*) - 1, 1)), '0'))) AS b FROM d),
width AS (SELECT n, b // 2 AS high, b - b // 2 AS low FROM bits),
walk AS (
  {_network('(SELECT r, r AS x FROM numbered)')}
  UNION ALL
  {_network('(SELECT walk.r, walk.x FROM walk, bits WHERE walk.x >= bits.n)')})
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(x % {SHARDS} AS INTEGER) AS shard, x // {SHARDS} AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM numbered JOIN walk USING (r) WHERE x < (SELECT n FROM bits)"""

QUERIES = {"op11_sharding": op11_sharding}
ORACLE = {"op11_sharding": ORACLE_SQL}

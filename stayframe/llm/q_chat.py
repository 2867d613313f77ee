"""Registered query of chat formatting, with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.llm import chat
from stayframe.llm.common import let, table

# fixed values: the conversation added to the table
PROBE = "</s>[INST] ok [/INST]"


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and what reading it back gives."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    out = chat.render(chat.fold(chat.log_of_turns(turns.unionByName(probe))))
    nl = F.lit("\n")
    digest = lambda ts: F.struct(
        F.size(ts).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(ts, lambda t: F.concat(t["role"], nl, t["text"], nl)), ""), 256).alias("sha"))
    read = out.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
                      let(chat.read_turns(F.col("formatted")), digest).alias("turns"),
                      chat.read_loss(F.col("segments")).alias("loss"))
    return read.select("conv_id", "turns.n_turns", F.col("turns.sha").alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       "formatted_chars")


def _escaped(x: str) -> str:
    t = f"replace({x}, '\\', '\\\\')"
    for c in ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>"):
        t = f"replace({t}, '{c}', '\\l{c[1:]}')"
    for c in ("[INST]", "[/INST]"):
        t = f"replace({t}, '{c}', '\\b{c[1:]}')"
    return t


_FIX = len(chat.OPEN) + 1 + len(chat.CLOSE)
ORACLE_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}')),
j AS (SELECT conv_id, count(*) AS n_turns,
  string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
  coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss,
  sum({_FIX} + length(replace({_escaped('role')}, chr(10), '\\n')) + length({_escaped('text')})) AS n
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(n AS BIGINT) AS formatted_chars
FROM j"""

QUERIES = {"op3_chat_formatting": op3_chat_formatting}
ORACLE = {"op3_chat_formatting": ORACLE_SQL}

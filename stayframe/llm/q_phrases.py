"""Registered query of substring deduplication (checked by brute force in tests)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.llm import phrases
from stayframe.llm.common import table


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its removed words counted and its kept words digested."""
    out = phrases.deduplicate(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.lower(F.hex("kept_sha")).alias("kept_sha256"))


QUERIES = {"op5_substring_dedup": op5_substring_dedup}
ORACLE: dict[str, str] = {}

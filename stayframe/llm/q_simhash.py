"""Registered query of SimHash near-duplicates (checked by brute force in tests)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.llm import simhash
from stayframe.llm.common import table


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and class."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


QUERIES = {"op6_simhash": op6_simhash}
ORACLE: dict[str, str] = {}

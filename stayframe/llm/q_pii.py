"""Registered query of personal data (checked by brute force in tests)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.llm import pii
from stayframe.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the counts and digest of its base spans and all spans."""
    found = pii.find(table(spark, sf_dir, "documents", "doc_id", "text"), pii.train()).drop("redacted")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.size(F.filter("spans", _is(k))).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(joined(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def _is(kind: str):
    return lambda s: s["kind"] == kind


QUERIES = {"op1_pii": op1_pii}
ORACLE: dict[str, str] = {}

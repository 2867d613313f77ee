"""Registered query of corpus mixing (checked by brute force in tests)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayframe.llm import mixing
from stayframe.llm.common import table

# fixed values: the mixture asked for, as shares of the tokens kept; a power evens out what the corpus holds
TARGETS = {
    "source": 0.7,
    "lang": {"en": 0.55, "de": 0.16, "fr": 0.16, "es": 0.13, "*": 0.0},
    "topic": 0.85,
}
BUDGET = 0.5      # share of all tokens to keep


def mixed(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` mixed to ``TARGETS`` within ``BUDGET``."""
    return mixing.mix(docs, TARGETS, {"source": "source", "lang": "lang"}, BUDGET, keep=keep)


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its cell, sampling probability, draw, and how far its
    labels' marginals end from their targets."""
    return mixed(table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang"))


QUERIES = {"op7_source_mixing": op7_source_mixing}
ORACLE: dict[str, str] = {}

"""Registered query of toxicity categories (held-out accuracy in tests)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.llm import toxicity
from stayframe.llm.common import table

CATEGORIES = ["low_quality", "toxic", "toxic_prose"]


def trained(docs: DataFrame, labels: DataFrame) -> toxicity.Chain:
    """The chain over what the ``labels`` table says: bad writing, toxicity, and
    toxicity in writing that is otherwise good, which a quality filter lets by."""
    q, t = F.col("quality").cast("int"), F.col("toxic").cast("int")
    labelled = labels.select("doc_id", t.alias("toxic"), (1 - q).alias("low_quality"), (q * t).alias("toxic_prose"))
    sets, forms, y, weigh = toxicity.gather(docs, labelled, "toxic", ["low_quality", "toxic_prose"])
    return toxicity.fit(sets, forms, y[:, [1, 0, 2]], CATEGORIES, weigh)


def op2_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its category probabilities and flags."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.score(docs, trained(docs, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")))


QUERIES = {"op2_toxicity_chain": op2_toxicity_chain}
ORACLE: dict[str, str] = {}

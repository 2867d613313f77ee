"""Registered query of main-text extraction (checked against labelled pages in tests)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.llm import html_text
from stayframe.llm.common import table


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its main text."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return html_text.extract(pages, html_text.train()).withColumn("n_chars", F.length("text").cast("long"))


QUERIES = {"op4_html_extraction": op4_html_extraction}
ORACLE: dict[str, str] = {}

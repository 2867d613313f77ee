"""Registered query of BPE encoding and decoding (checked against the file's
own library in tests)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.llm import bpe
from stayframe.llm.common import table

VOCABULARY = "word_bpe_49k.json"


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of every document."""
    vocabulary = bpe.read_vocabulary(public_tokenizers.path(VOCABULARY))
    out = bpe.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op10_bpe": op10_bpe}
ORACLE: dict[str, str] = {}

"""Corpus pipeline: the stages of a training-data run over ``documents``.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor
kept, and returns a DataFrame that is written as Parquet and read again as the
next stage's ``docs``. All stages but the last return the columns of
``documents``; other columns of the input are not carried on.

1. quality_rules: documents that break a rule go.
2. near_duplicates: of each class of linked SimHash fingerprints the document
   with the smallest id stays (of rows with that id, one).
3. personal_data: found spans are replaced in the text, n_chars follows.
4. source_mixing: documents are sampled to the target weights.
5. token_ids: the texts as token ids, with their decoding's digest.

Defined results: a null text counts as empty and fails the quality rules; rows
without an id are kept by every stage that keeps their text, as one class has
an id only if one of its documents has; an empty table stays empty."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.llm import bpe, pii, q_mixing, quality, simhash
from stayframe.llm.common import written
from stayframe.llm.q_bpe import VOCABULARY

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    return quality.passing(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: the one with the smallest id."""
    classes = simhash.near_duplicates(docs.select("doc_id", "text"))
    gone = written(classes.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct(), "gone")
    kept = docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)
    # rows that share an id: one of them, whichever text sorts first
    repeated = written(docs.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select("doc_id"), "repeated")
    single = kept.join(repeated, "doc_id", "left_anti")
    one = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min(F.struct("text", "lang", "source", "n_chars")).alias("row")).select("doc_id", "row.*")
    return single.select(*COLUMNS).unionByName(one.select(*COLUMNS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind."""
    found = pii.find(docs, pii.train(), keep=("doc_id", "lang", "source"))
    return found.select("doc_id", F.col("redacted").alias("text"), "lang", "source",
                        F.length("redacted").cast("long").alias("n_chars"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights."""
    mixed = q_mixing.mixed(docs, keep=("text", "lang", "source", "n_chars"))
    return mixed.where("sampled").select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (little-endian unsigned 32-bit numbers)."""
    vocabulary = bpe.read_vocabulary(public_tokenizers.path(VOCABULARY))
    out = bpe.round_trip(docs, vocabulary, keep=("lang", "source"))
    return out.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mixing", source_mixing),
    ("token_ids", token_ids),
]

# fingerprints, a trained model and raking decide rows here, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""File sources and sinks: per-parameter CSV folders and experiment records.

Writes go to a fresh sub-folder of the shared checkpoint folder
(``session.scratch_path``). Parameters live in folder names (``write_param_files``)
or, for tools that want one file each, in file names (``named_csv``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayframe.sources.named_csv import decoded


def write_param_files(df: DataFrame, path: str, param: str, mode: str = "overwrite") -> str:
    """One CSV folder per parameter value (``<path>/<param>=<value>/part-*.csv``), with header."""
    df.write.mode(mode).partitionBy(param).option("header", True).csv(path)
    return path


def read_param_files(spark: SparkSession, path: str, schema: T.StructType | str, param_out: str = "parameter",
                     from_: str = "folder", names: Sequence[str] | None = None,
                     drop: Sequence[str] = ()) -> DataFrame:
    """Read every ``*.csv`` below ``path`` (dot-files and other files are
    skipped by the glob), with an explicit schema (no inference pass), and
    derive the parameter from the folder name (``key=value``) or the file
    name (``value.csv``, or ``value~1.csv`` for a further piece of it, as
    ``named_csv`` writes them). A byte-order mark is skipped with the header.
    ``names`` renames columns by position after a width check; ``drop`` removes
    saved index columns."""
    df = (spark.read.schema(schema).option("header", True).option("pathGlobFilter", "*.csv").option("escape", '"')
          .option("recursiveFileLookup", "true").csv(path))
    if from_ == "folder":
        p = F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), r"/[^/=]+=([^/]+)/[^/]+$", 1))
    else:
        p = decoded(F.col("_metadata.file_name"))
    df = df.withColumn(param_out, p)
    if drop:
        df = df.drop(*drop)
    if names:
        cols = [c for c in df.columns if c != param_out]
        if len(cols) != len(names):
            raise ValueError(f"{len(cols)} columns, {len(names)} names")
        df = df.select(*[F.col(c).alias(n) for c, n in zip(cols, names)], param_out)
    return df


def write_experiments(df: DataFrame, path: str, mode: str = "append", partition_by: str | None = None) -> str:
    """Experiment records as JSON lines keyed by their name column. One file
    per record (the notebook layout) would be a small-files problem with
    many runs; ``partition_by`` opts into folders per value when runs are few."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.json(path)
    return path


def read_experiments(spark: SparkSession, path: str, schema: T.StructType, names: Sequence[str] | None = None,
                     name_col: str = "name") -> DataFrame:
    """Read all experiment records (every matching file, not just the first),
    optionally only the given names."""
    df = spark.read.schema(schema).json(path)
    return df.filter(F.col(name_col).isin(list(names))) if names else df

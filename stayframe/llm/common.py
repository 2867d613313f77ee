"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.session import ensure_checkpoint_dir

# fixed values: the white space that separates words, as Java and Python patterns
SPACE = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``."""
    return ensure_checkpoint_dir(spark).rstrip("/")


def written(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and go on from the
    files: later branches neither recompute it nor depend on its lineage.
    ``free`` has finished shuffles released, where disk is what runs out."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    if free:
        release(spark)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables from ``written`` that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        folder = df.inputFiles()[0].rpartition("/")[0] if df.inputFiles() else None
        if folder and folder.rpartition("/")[0].split(":")[-1].lstrip("/") == shared_dir(spark).split(":")[-1].lstrip("/"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of jobs whose results are written: it
    does so when the driver collects the frames that own them. The scheduler
    lets go of a finished job a moment later, hence the second round."""
    for pause in (0.5, 0.2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(pause)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Array of the maximal runs of characters other than space and tab to
    carriage return; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")

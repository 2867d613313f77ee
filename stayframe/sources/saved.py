"""Saved tables, bucketed and sorted by their keys.

A table that is saved once in ``buckets`` of its keys' hash needs no exchange
when it is joined or grouped by those keys later: the files already lie as the
join wants them. ``SavedTables`` names the tables of one job and drops them at
its end. Choose keys that spread a hot entity (entity and hour, or entity and
chunk): a bucket is one task's work."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.session import scratch_path


class SavedTables:
    """A ``with`` block whose saved tables are dropped when it ends."""

    def __init__(self, spark: SparkSession, prefix: str = "sf"):
        self.spark, self.prefix, self.names = spark, prefix, []

    def __enter__(self) -> SavedTables:
        return self

    def __exit__(self, *_) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def save(self, df: DataFrame, name: str, keys: Sequence[str] = (), buckets: int = 0) -> DataFrame:
        """CREATE TABLE AS in the shared folder; with ``keys``, in ``buckets``
        files sorted by them. Keys must not be null."""
        full = f"{self.prefix}_{name}_{uuid.uuid4().hex[:8]}"
        self.names.append(full)
        w = df
        if keys:
            missing = F.raise_error(F.concat(F.lit(f"{name}: null key")))
            null = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
            w = df.withColumn(keys[0], F.when(null, missing.cast(df.schema[keys[0]].dataType)).otherwise(F.col(keys[0])))
            w = w.repartition(buckets, *keys)
        w = w.write.option("path", scratch_path(self.spark, full))
        if keys:
            w = w.bucketBy(buckets, *keys).sortBy(*keys)
        w.saveAsTable(full)
        return self.spark.table(full)


def merge_saved(spine: DataFrame, tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """N-way full outer merge of tables bucketed alike: ``spine`` holds every key
    once, and left joins along it keep its buckets, so no join of the chain has
    an exchange (a full join would lose them). A key with several rows in some
    tables gives every combination, as chained full joins do."""
    out = spine
    for t in tables:
        out = out.join(t, list(keys), "left")
    return out

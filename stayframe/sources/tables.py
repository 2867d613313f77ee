"""Parquet table access with projection at the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Read one table; selecting ``cols`` here prunes the parquet ReadSchema."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def jdbc_table(spark: SparkSession, url: str, table_name: str, partition_column: str, lower: int, upper: int,
               num_partitions: int, properties: dict | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Full-table database read split into ``num_partitions`` range queries on
    an integer key (e.g. the stay id) instead of one connection pulling the
    whole table; ``columns`` become the pushed-down projection."""
    df = spark.read.jdbc(url, table_name, column=partition_column, lowerBound=lower, upperBound=upper,
                         numPartitions=num_partitions, properties=properties or {})
    return df.select(*columns) if columns else df

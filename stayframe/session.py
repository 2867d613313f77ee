"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings every job relies on: UTC wall clock, adaptive execution (runtime
# broadcast conversion under a size threshold, skew-join splitting, partition
# coalescing) and no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "stayframe", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", "8g")
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediates: the one the cluster names
    in ``spark.checkpoint.dir``, else a folder in the SQL warehouse, which
    driver and executors share as well (tests set their own)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared folder for written intermediates, remembered
    until ``drop_scratch``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_WRITTEN: dict[str, list[str]] = {}      # folders of this application that may be dropped


def drop_scratch(spark: SparkSession) -> int:
    """Delete the intermediates this application has written so far, once the
    results built on them are consumed (frames are lazy, so no operator can know
    when). Returns the number of folders."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for p in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(p)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len(paths)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and continue from the
    files: branches that consume it (an ordered scan and its carry summary,
    a fit and its application) no longer recompute the upstream, read only the
    columns they need, and a lost executor only re-reads the files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_observed(df: DataFrame, name: str, metrics: dict[str, Column]) -> tuple[DataFrame, dict]:
    """``materialize`` that also aggregates ``metrics`` over the rows while they
    pass into the files, so that a fit or a profile needs no pass of its own.
    The aggregates sit right above the write, where each task counts once even
    if it is run again."""
    seen = Observation()
    out = materialize(df.observe(seen, *[v.alias(k) for k, v in metrics.items()]), name)
    return out, seen.get


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large cluster run, sized from the input volume.

    Shuffle partitions start at input / target (at least two waves of the
    cluster's cores); adaptive execution coalesces small ones and splits
    skewed ones at runtime, and converts joins to broadcast only under the
    measured-size threshold."""
    cores = executors * cores_per_executor
    parts = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        **BASE_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }

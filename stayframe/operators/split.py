"""Ordering, limits, sampling and entity-aligned splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayframe.operators.seq import Seq, global_index, range_chunks, row_index


def entity_ranks(df: DataFrame, key: str, order: str | None = None, total: str | None = None) -> DataFrame:
    """One row per entity with its 0-based rank in the order of ``order``
    (default the key itself; any orderable type), via the global index; ``total`` names
    an optional column holding the number of entities."""
    order = order or key
    ents = df.select(key, *([order] if order != key else [])).distinct()
    return global_index(ents, order, "_rank", total)


def ordered_split(df: DataFrame, key: str, first: float = 0.8, second: float = 0.8,
                  order: str | None = None, out: str = "split") -> DataFrame:
    """Entity-aligned train / valid / test split in entity order: the first
    floor(n*first) entities are train+valid, of those t the last
    t - floor(t*second) are valid, the rest of all entities test. No entity
    straddles two parts. ``n`` comes from the rank's chunk summary, so no
    separate counting job runs."""
    ranks = entity_ranks(df, key, order, total="_n")
    t = F.floor(F.col("_n") * first)
    tr = F.floor(t * second)
    lab = ranks.select(key, F.when(F.col("_rank") < tr, "train").when(F.col("_rank") < t, "valid")
                       .otherwise("test").alias(out))
    return df.join(lab, key, "inner")


def hash_order(cols: Sequence[str], seed: int) -> F.Column:
    """Seeded, deterministic pseudo-random order key, the same in any engine:
    the md5 text of ``seed:value:...``."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def shuffled_ranks(df: DataFrame, key: str, seed: int = 7, total: str | None = None) -> DataFrame:
    """One row per entity with its 0-based place in a seeded random order."""
    ents = df.select(key).distinct().withColumn("_h", F.concat(hash_order([key], seed), F.lit(":"), F.col(key).cast("string")))
    return global_index(ents, "_h", "_rank", total).drop("_h")


def shuffled_split(df: DataFrame, key: str, seed: int = 7, first: float = 0.8, second: float = 0.8,
                   out: str = "split") -> DataFrame:
    """Entity-aligned train / valid / test split in a seeded random order."""
    ents = shuffled_ranks(df, key, seed, total="_n")
    t = F.floor(F.col("_n") * first)
    lab = ents.select(key, F.when(F.col("_rank") < F.floor(t * second), "train").when(F.col("_rank") < t, "valid")
                      .otherwise("test").alias(out))
    return df.join(lab, key, "inner")


def sample_entities(df: DataFrame, key: str, k: int, seed: int = 7) -> DataFrame:
    """k distinct entities without replacement, by seeded hash (top-k, not a
    full sort), with all their rows."""
    ents = df.select(key).distinct()
    picked = ents.orderBy(hash_order([key], seed), key).limit(k)
    return df.join(picked, key, "left_semi")


def ordered_page(df: DataFrame, order: Sequence[str], offset: int, limit: int) -> DataFrame:
    """Rows offset..offset+limit under a total order, in that order.

    Rank lookup: rows are cut into range partitions, whose row counts tell which
    of them hold the page (one row reaches the driver). Only these are read again
    and ranked, each by itself, so no task holds the rows before the page, and a
    page longer than a partition comes from several tasks."""
    x = range_chunks(df.withColumn("_o", F.struct(*order)), ["_o"], "_page")
    before = Window.orderBy("_page").rowsBetween(Window.unboundedPreceding, -1)           # a row per partition
    sizes = x.groupBy("_page").agg(F.count(F.lit(1)).alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    held = sizes.filter((F.col("start") < offset + limit) & (F.col("start") + F.col("n") > offset)).agg(
        F.min("_page").alias("lo"), F.max("_page").alias("hi"), F.min("start").alias("start")).first()
    if held["lo"] is None:
        return df.limit(0)
    page = x.filter(F.col("_page").between(held["lo"], held["hi"]))
    ranked = row_index(page, Seq((), "_o", "_page"), "_rank")
    first = offset - held["start"]
    return ranked.filter((F.col("_rank") >= first) & (F.col("_rank") < first + limit)).orderBy(*order).select(*df.columns)

"""Exact quantiles without funnelling a column into one task.

``F.median`` / ``percentile`` keep a value->count map per group and merge the
whole map in one final task; over a large continuous column that map is the
column. Here values are reduced to (group, value, count) with partial
aggregation and cut into range partitions of about equal size. Partition
totals, one row per partition and group, give the rows before each partition
and so the one partition that holds a wanted rank; only there a running count
finds the value. One plan for every size, all quantiles of all groups in one
pass. Interpolation between the two neighbouring order statistics matches
pandas / Spark ``median``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayframe.operators.seq import range_chunks

UNB = Window.unboundedPreceding


def group_quantiles(long: DataFrame, group: str, value: str, qs: Sequence[float]) -> DataFrame:
    """(group, q, quantile) for every group with a value and every q of ``qs``;
    nulls and NaN are ignored, infinities are ordinary values, a null group is
    a group."""
    v = long.select(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v"))
    v = v.filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    dist = range_chunks(v.groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_n")), ["_g", "_v"], "_part")
    parts = dist.groupBy("_g", "_part").agg(F.sum("_n").alias("_size"))
    by_group = Window.partitionBy("_g")
    parts = parts.select("_g", "_part", "_size", F.sum("_size").over(by_group).alias("_total"), F.coalesce(
        F.sum("_size").over(by_group.orderBy("_part").rowsBetween(UNB, -1)), F.lit(0)).alias("_before"))
    wanted = F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q")
    place = F.col("q") * (F.col("_total") - 1)
    ranks = F.explode(F.array_distinct(F.array(F.floor(F.col("_place")), F.ceil(F.col("_place"))))).alias("_rank")
    want = parts.select("*", wanted).withColumn("_place", place).select("*", ranks).filter(
        (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_size")))
    run = F.sum("_n").over(Window.partitionBy("_g", "_part").orderBy("_v").rowsBetween(UNB, 0))
    holding = want.select("_g", "_part").distinct()
    same = lambda a, b: a["_g"].eqNullSafe(b["_g"]) & (a["_part"] == b["_part"])
    rows = dist.join(holding, same(dist, holding), "left_semi").withColumn("_run", run)
    found = rows.alias("r").join(want.alias("w"), (F.col("r._g").eqNullSafe(F.col("w._g"))) & (F.col("r._part") == F.col("w._part")) & (
        F.col("w._rank") < F.col("w._before") + F.col("r._run")) & (
        F.col("w._rank") >= F.col("w._before") + F.col("r._run") - F.col("r._n")))
    low, high = F.min("r._v"), F.max("r._v")
    frac = F.first("w._place") - F.floor(F.first("w._place"))
    return found.groupBy(F.col("w._g").alias(group), F.col("w.q").alias("q")).agg(
        F.when((low == high) | (frac == 0), low).otherwise(low + (high - low) * frac).alias("quantile"))


def exact_quantiles_multi(df: DataFrame, cols: Sequence[str], qs: Sequence[float]) -> dict[float, dict[str, float | None]]:
    """Several exact quantiles of every column in one pass (nulls ignored); None
    for an all-null column. What is fetched is one number per column and q."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("f"), F.col(c).cast("double").alias("v")) for c in cols]))
    long = df.select(pairs.alias("s")).select("s.f", "s.v")
    got = {(r["f"], r["q"]): r["quantile"] for r in group_quantiles(long, "f", "v", qs).collect()}
    return {q: {c: got.get((c, float(q))) for c in cols} for q in qs}


def exact_quantiles(df: DataFrame, cols: Sequence[str], q: float = 0.5) -> dict[str, float | None]:
    """Exact q-quantile of every column (nulls ignored); None for an all-null column."""
    return exact_quantiles_multi(df, cols, [q])[q]

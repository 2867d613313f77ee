"""Missingness profiling, descriptive statistics and duplicate handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.operators.quantile import group_quantiles
from stayframe.session import materialize_observed


def null_profile(df: DataFrame, cols: Sequence[str], digits: int = 3) -> DataFrame:
    """Per column: null count and null ratio, plus an ``__all__`` row for all
    cells together - one aggregation pass, unpivoted with ``stack``."""
    a = df.agg(F.count(F.lit(1)).alias("_n"), *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    total = " + ".join(f"`{c}`" for c in cols)
    stack = (f"stack({len(cols) + 1}, " + ", ".join(f"'{c}', `{c}`, _n" for c in cols)
             + f", '__all__', {total}, _n * {len(cols)}) AS (feature, n_null, n_rows)")
    out = a.selectExpr(stack)
    return out.select("feature", F.col("n_null").cast("long").alias("n_null"),
                      F.round(F.try_divide(F.col("n_null"), F.col("n_rows")), digits).alias("ratio"))


def null_profile_write(df: DataFrame, cols: Sequence[str], digits: int = 3) -> tuple[DataFrame, DataFrame]:
    """``df`` written, and its ``null_profile``, counted while it was written
    (a row per column, made on the driver)."""
    metrics = {f"n_{i}": F.count(F.when(F.col(c).isNull(), 1)) for i, c in enumerate(cols)}
    rows, seen = materialize_observed(df, "profiled", {"rows": F.count(F.lit(1)), **metrics})
    n, nulls = seen.get("rows", 0), [seen.get(f"n_{i}", 0) for i in range(len(cols))]
    table = [(c, k, n) for c, k in zip(cols, nulls, strict=True)] + [("__all__", sum(nulls), n * len(cols))]
    out = df.sparkSession.createDataFrame(table, "feature string, n_null long, n_rows long")
    return rows, out.select("feature", "n_null", F.round(F.try_divide(F.col("n_null"), F.col("n_rows")), digits).alias("ratio"))


def null_by_entity(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                   min_rows: int | None = None) -> DataFrame:
    """Per entity: rows, mean number of null features per row, ratio to the
    feature count; optionally only entities with more than ``min_rows`` rows."""
    nulls = sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(nulls).alias("mean_nulls"))
    out = out.withColumn("ratio", F.col("mean_nulls") / F.lit(len(cols)))
    return out.filter(F.col("n_rows") > min_rows) if min_rows is not None else out


def never_observed(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per column: share of entities on which the column is never non-null."""
    per = df.groupBy(*keys).agg(*[F.count(c).alias(c) for c in cols])
    a = per.agg(*[F.avg((F.col(c) == 0).cast("double")).alias(c) for c in cols])
    stack = f"stack({len(cols)}, " + ", ".join(f"'{c}', `{c}`" for c in cols) + ") AS (feature, share_never)"
    return a.selectExpr(stack)


def describe(df: DataFrame, group: str, value: str, groups: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max of ``value`` for every
    group the data holds, or for the named ``groups`` only."""
    if groups is not None:
        df = df.filter(F.col(group).isin(list(groups)))
    base = df.groupBy(group).agg(F.count(value).alias("count"), F.avg(value).alias("mean"),
                                 F.stddev_samp(value).alias("std"), F.min(value).alias("min"),
                                 F.max(value).alias("max"))
    pick = lambda q: F.max(F.when(F.col("q") == q, F.col("quantile")))
    qdf = group_quantiles(df, group, value, (0.25, 0.5, 0.75)).groupBy(F.col(group).alias("_dg")).agg(
        pick(0.25).alias("q25"), pick(0.5).alias("q50"), pick(0.75).alias("q75"))
    return base.join(qdf, F.col(group).eqNullSafe(F.col("_dg")), "left").drop("_dg")


def duplicate_groups(df: DataFrame, keys: Sequence[str], tiebreak: Sequence[str], label: str,
                     keep: Sequence[str]) -> DataFrame:
    """Groups of rows sharing ``keys`` more than once: size, label max/min
    (conflict resolution: any positive wins) and the first row under the total
    order ``tiebreak`` (all columns), picked as min(struct) - a partial
    aggregate, so even a group holding a third of the table is combined
    map-side instead of being sorted in one task."""
    first = F.min(F.struct(*[F.col(c) for c in tiebreak]))
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max(label).alias("label_max"),
                              F.min(label).alias("label_min"), first.alias("_first"))
    g = g.filter(F.col("n") > 1)
    return g.select(*keys, "n", "label_max", "label_min",
                    *[F.col("_first")[c].alias(f"first_{c}") for c in keep])


def keep_first(df: DataFrame, keys: Sequence[str], tiebreak: Sequence[str]) -> DataFrame:
    """One row per key: the first under the total order ``tiebreak`` (min struct)."""
    others = [c for c in df.columns if c not in keys]
    order = [c for c in tiebreak if c not in keys] + [c for c in others if c not in tiebreak]
    g = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in order])).alias("_r"))
    return g.select(*keys, *[F.col("_r")[c].alias(c) for c in others])

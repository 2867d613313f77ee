"""Cleaning: range-to-null outlier masks, threshold scores, null handling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayframe.functions.columns import threshold_flag


@dataclass(frozen=True)
class Range:
    """Values inside the range are kept, values outside become null.

    ``lo``/``hi`` may be None (unbounded). ``lo_closed``/``hi_closed`` say
    whether a value equal to the bound is kept."""
    lo: float | None = None
    hi: float | None = None
    lo_closed: bool = True
    hi_closed: bool = True

    def keep(self, c: Column) -> Column:
        cond = F.lit(True)
        if self.lo is not None:
            cond = cond & ((c >= self.lo) if self.lo_closed else (c > self.lo))
        if self.hi is not None:
            cond = cond & ((c <= self.hi) if self.hi_closed else (c < self.hi))
        return cond


def mask_outliers(df: DataFrame, rules: Mapping[str, Range]) -> DataFrame:
    """Replace values outside each column's range by null, in one projection."""
    out = [F.when(rules[c].keep(F.col(c)), F.col(c)).alias(c) if c in rules else F.col(c)
           for c in df.columns]
    return df.select(*out)


def add_scores(df: DataFrame, parts: Mapping[str, tuple[str, float]], total: str = "score",
               flag: str | None = None, flag_at: int = 2, part_suffix: str = "_score") -> DataFrame:
    """Per-column 0/1 threshold scores (missing -> 0), their sum, and an
    optional ``total >= flag_at`` 0/1 flag."""
    scores = {f"{c}{part_suffix}": threshold_flag(c, op, th) for c, (op, th) in parts.items()}
    total_expr = sum((v for v in scores.values()), F.lit(0))
    df = df.select(F.col("*"), *[v.alias(k) for k, v in scores.items()], total_expr.alias(total))
    if flag:
        df = df.withColumn(flag, (F.col(total) >= flag_at).cast("int"))
    return df


def fill_constant(df: DataFrame, value: float, cols: Sequence[str]) -> DataFrame:
    return df.fillna(value, subset=list(cols))


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(subset))


def null_indicators(df: DataFrame, cols: Sequence[str], suffix: str = "_isnull") -> DataFrame:
    return df.select(F.col("*"), *[F.col(c).isNull().cast("int").alias(f"{c}{suffix}") for c in cols])


def nan_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Spark treats NaN as a value (NaN > 5 is true, avg turns NaN): make it null."""
    return df.select(*[F.when(~F.isnan(F.col(c)), F.col(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])

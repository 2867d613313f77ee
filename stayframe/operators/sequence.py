"""Sequence assembly for sequence models: fixed windows and sliding windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.operators.seq import Seq, row_index, trailing_frame


def window_sequences(df: DataFrame, keys: Sequence[str], step: str, features: Sequence[str], label: str,
                     length: int, target: int) -> DataFrame:
    """One row per window (``keys``; at most a window's rows per group):
    X = features of the first ``length`` steps (array of arrays, in step
    order), y = ``label`` at 1-based step ``target``; null for a shorter window."""
    st = F.struct(F.col(step).alias("s"), F.array(*[F.col(f).cast("double") for f in features]).alias("x"),
                  F.col(label).alias("y"))
    g = df.groupBy(*keys).agg(F.array_sort(F.collect_list(st)).alias("_seq"))
    return g.select(*keys, F.transform(F.slice("_seq", 1, length), lambda e: e["x"]).alias("X"),
                    F.try_element_at("_seq", F.lit(target))["y"].alias("y"), F.size("_seq").alias("n_steps"))


def sliding_sequences(df: DataFrame, s: Seq, features: Sequence[str], label: str, k: int = 4,
                      x_rows: int = 2) -> DataFrame:
    """Stride-1 windows of ``k`` consecutive rows inside each entity (never
    crossing entities): X = features of the first ``x_rows`` rows, y = label of
    the last row; one output row per window, keyed by its first row."""
    x = row_index(df, s, "_sidx")

    def build(w):
        cols = {"_start": F.lag(s.order, k - 1).over(w)}
        for j in range(x_rows):
            for f in features:
                cols[f"x{j}_{f}"] = F.lag(f, k - 1 - j).over(w)
        return cols

    y = trailing_frame(x, s.keys, "_sidx", k, build)
    y = y.filter(F.col("_sidx") >= k - 1)
    return y.select(*s.keys, F.col("_start").alias(f"start_{s.order}"),
                    *[f"x{j}_{f}" for j in range(x_rows) for f in features], F.col(label).alias("y"))

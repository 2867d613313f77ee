"""Feature scaling with the scikit-learn edge rules.

The global fits are one aggregation returning a single row (bounded), read on
the driver and applied as literals. ``minmax_write`` and ``zscore_write`` fit
while the rows are written, for rows that several later steps read anyway.
Per-entity fits aggregate per entity and join back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayframe.session import materialize_observed


def minmax_fit(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    r = df.agg(*[F.min(c).alias(f"{c}__min") for c in cols], *[F.max(c).alias(f"{c}__max") for c in cols]).first()
    return {c: (r[f"{c}__min"], r[f"{c}__max"]) for c in cols}


def _minmax_expr(c: str, lo, hi):
    lo, hi = F.lit(lo).cast("double"), F.lit(hi).cast("double")
    rng = F.when(hi - lo == 0, F.lit(1.0)).otherwise(hi - lo)   # constant column -> 0, as scikit-learn
    return (F.col(c) - lo) / rng


def minmax_apply(df: DataFrame, fit: dict) -> DataFrame:
    return df.select(*[_minmax_expr(c, *fit[c]).alias(c) if c in fit else F.col(c) for c in df.columns])


def minmax_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Min-max scale ``cols``, fitted on ``fit_on`` (default ``df``), not clipped."""
    return minmax_apply(df, minmax_fit(fit_on if fit_on is not None else df, cols))


def _where(c: str, fit_on: Column | None) -> Column:
    return F.col(c) if fit_on is None else F.when(fit_on, F.col(c))


def minmax_write(df: DataFrame, cols: Sequence[str], fit_on: Column | None = None) -> DataFrame:
    """``minmax_scale`` of rows that are written on the way: minima and maxima
    (over the rows with ``fit_on``) are taken while they pass into the files."""
    rows, seen = materialize_observed(df, "scaled", {
        f"{k}_{i}": f(_where(c, fit_on)) for i, c in enumerate(cols) for k, f in (("lo", F.min), ("hi", F.max))})
    return minmax_apply(rows, {c: (seen.get(f"lo_{i}"), seen.get(f"hi_{i}")) for i, c in enumerate(cols)})


def zscore_write(df: DataFrame, cols: Sequence[str], fit_on: Column | None = None) -> DataFrame:
    """``zscore_scale`` of rows that are written on the way."""
    rows, seen = materialize_observed(df, "scaled", {
        f"{k}_{i}": f(_where(c, fit_on)) for i, c in enumerate(cols) for k, f in (("mu", F.avg), ("sd", F.stddev_pop))})
    return zscore_apply(rows, {c: (seen.get(f"mu_{i}"), seen.get(f"sd_{i}")) for i, c in enumerate(cols)})


def minmax_by_entity(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Min-max scale within each entity (per-entity min/max joined back)."""
    st = df.groupBy(*keys).agg(*[F.min(c).alias(f"{c}__min") for c in cols],
                               *[F.max(c).alias(f"{c}__max") for c in cols])
    j = df.join(st, list(keys), "inner")
    out = []
    for c in df.columns:
        if c in cols:
            lo, hi = F.col(f"{c}__min"), F.col(f"{c}__max")
            out.append(((F.col(c) - lo) / F.when(hi - lo == 0, F.lit(1.0)).otherwise(hi - lo)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def zscore_fit(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    r = df.agg(*[F.avg(c).alias(f"{c}__mu") for c in cols], *[F.stddev_pop(c).alias(f"{c}__sd") for c in cols]).first()
    return {c: (r[f"{c}__mu"], r[f"{c}__sd"]) for c in cols}


def zscore_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std, nulls ignored; std 0 divides by 1."""
    return zscore_apply(df, zscore_fit(fit_on if fit_on is not None else df, cols))


def zscore_apply(df: DataFrame, fit: dict) -> DataFrame:
    out = []
    for c in df.columns:
        if c in fit:
            mu, sd = F.lit(fit[c][0]).cast("double"), F.lit(fit[c][1]).cast("double")
            out.append(((F.col(c) - mu) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)

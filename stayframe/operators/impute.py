"""Gap filling along each entity's ordered rows: interpolation and fills.

Semantics follow pandas defaults used by the reference pipelines:
* interpolation (``limit_direction='forward'``): with the previous non-null
  (pv at pp) and next non-null (nv at np) both present the value is
  pv + (nv - pv) * (p - pp) / (np - pp); with only a previous one it is pv
  (trailing gaps are filled); with only a next one it stays null.
* 'linear' positions are row numbers, 'time' positions are timestamps.
* forward fill = previous non-null, backward fill = next non-null.

A whole recipe (interpolate -> ffill -> bfill -> constant or median) is
evaluated from a single previous/next scan: after interpolation only leading
gaps remain, so a forward fill is a no-op and a backward fill takes the raw
next non-null value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayframe.functions.columns import time_position
from stayframe.operators.quantile import exact_quantiles
from stayframe.operators.seq import Seq, prev_next, row_index, trailing_frame

# Named recipes (the reference's W6 variants): interpolation method, forward
# fill, backward fill, final fill ('median', a number, or None).
RECIPES = {
    "ifbm": ("time", True, True, "median"),
    "ifz": ("time", True, False, 0.0),
    "qsofa": ("time", True, True, 0.0),
    "8h": ("linear", True, True, 0.0),
    "8h_min": ("linear", False, False, None),
}


def _interp(c: str, p: Column) -> Column:
    pv, pp, nv, np_ = (F.col(f"{c}__pv"), F.col(f"{c}__pp"), F.col(f"{c}__nv"), F.col(f"{c}__np"))
    # try_divide: the ratio is only used where pp < p < np, but must not fail
    # (ANSI mode) on rows that already hold a value, where np == pp
    between = pv + F.try_divide((nv - pv) * (p - pp).cast("double"), (np_ - pp).cast("double"))
    return F.coalesce(F.col(c), between, pv)


def impute(df: DataFrame, s: Seq, cols: Sequence[str], method: str | None = None,
           ffill: bool = False, bfill: bool = False, fill: float | str | None = None,
           time_col: str | None = None, medians: Mapping[str, float | None] | None = None,
           median_source: DataFrame | None = None) -> DataFrame:
    """Fill gaps of ``cols`` per entity in one scan.

    method: None | 'linear' (row position) | 'time' (``time_col``, default the
    ordering column). fill: None, a constant, or 'median' (exact per-column
    median of ``median_source`` - default ``df`` - unless ``medians`` given)."""
    need_prev = method is not None or ffill
    need_next = method is not None or bfill
    if method == "linear":       # row positions, computed inside the same scan
        x = prev_next(df, s, cols, prev=need_prev, nxt=need_next, row_position="_pos")
        pos = F.col("_pos")
    elif method == "time":
        x = df.withColumn("_pos", time_position(df, time_col or s.order))
        pos = F.col("_pos")
        x = prev_next(x, s, cols, pos, prev=need_prev, nxt=need_next)
    elif method is None:
        pos = F.col(s.order)
        x = prev_next(df, s, cols, pos, prev=need_prev, nxt=need_next)
    else:
        raise ValueError(f"unknown interpolation method {method!r}")
    if fill == "median" and medians is None:
        medians = exact_quantiles(median_source if median_source is not None else df, cols, 0.5)
    out = {}
    for c in cols:
        parts = [_interp(c, pos)] if method else [F.col(c)]
        if ffill:
            parts.append(F.col(f"{c}__pv"))
        if bfill:
            parts.append(F.col(f"{c}__nv"))
        if fill == "median":
            if medians.get(c) is not None:
                parts.append(F.lit(float(medians[c])))
        elif fill is not None:
            parts.append(F.lit(float(fill)))
        out[c] = F.coalesce(*parts) if len(parts) > 1 else parts[0]
    helpers = [f"{c}__{k}" for c in cols for k in ("pv", "pp", "nv", "np") if f"{c}__{k}" in x.columns]
    res = x.select(*[out[c].alias(c) if c in out else F.col(c) for c in x.columns])
    return res.drop(*helpers, *(["_pos"] if "_pos" in res.columns else []))


def interpolate(df: DataFrame, s: Seq, cols: Sequence[str], method: str = "linear",
                time_col: str | None = None) -> DataFrame:
    return impute(df, s, cols, method=method, time_col=time_col)


def forward_fill(df: DataFrame, s: Seq, cols: Sequence[str]) -> DataFrame:
    return impute(df, s, cols, ffill=True)


def backward_fill(df: DataFrame, s: Seq, cols: Sequence[str]) -> DataFrame:
    return impute(df, s, cols, bfill=True)


def recipe(df: DataFrame, s: Seq, cols: Sequence[str], name: str, time_col: str | None = None,
           median_source: DataFrame | None = None) -> DataFrame:
    method, ff, bf, fill = RECIPES[name]
    return impute(df, s, cols, method=method, ffill=ff, bfill=bf, fill=fill, time_col=time_col,
                  median_source=median_source)


def trailing_fill(df: DataFrame, s: Seq, cols: Sequence[str], k: int = 4,
                  how: str = "avg", idx: str | None = None) -> DataFrame:
    """coalesce(x, <avg|min> of x over the k rows ending at this row)."""
    x = df if idx else row_index(df, s, "_tidx")
    ix = idx or "_tidx"
    agg = {"avg": F.avg, "min": F.min, "max": F.max}[how]

    def build(w):
        fr = w.rowsBetween(-(k - 1), 0)
        return {f"_tf_{c}": agg(F.col(c)).over(fr) for c in cols}

    y = trailing_frame(x, s.keys, ix, k, build)
    y = y.select(*[F.coalesce(F.col(c), F.col(f"_tf_{c}")).alias(c) if c in cols else F.col(c)
                   for c in y.columns if not c.startswith("_tf_")])
    return y if idx else y.drop("_tidx")

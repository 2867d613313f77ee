"""The reference's main preparation flow as one composition of operators.

grid -> outlier mask -> fill recipe (exact medians of the masked grid) ->
onset-anchored windows -> entity-aligned split -> min-max scaling fitted on
train + valid. Column names default to the reference's SOFA grid; only the
columns present in the input are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe import presets as P
from stayframe.operators import impute as imp
from stayframe.operators.clean import mask_outliers
from stayframe.operators.cohort import onset_windows
from stayframe.operators.scale import minmax_scale
from stayframe.operators.seq import GRID_CHUNK, seq, with_chunk
from stayframe.operators.split import ordered_split
from stayframe.session import materialize


def prepare_windows(grid: DataFrame, key: str = "stay_id", order: str = "hr", time: str = "starttime",
                    features=None, rules=None, recipe: str = "ifbm", flag: str = "is_infection",
                    rows: int = P.WINDOW_ROWS, drop=None, scale_extra=None) -> DataFrame:
    """Scaled, split, fixed-length windows ready for sequence assembly."""
    features = [c for c in (features or P.SOFA_FEATURES) if c in grid.columns]
    rules = {c: r for c, r in (rules or P.SOFA_OUTLIER_RULES).items() if c in grid.columns}
    drop = [c for c in (drop if drop is not None else P.SOFA_DROPPED_BEFORE_SCALING) if c in grid.columns]
    extra = [c for c in (scale_extra if scale_extra is not None else P.SOFA_SCALED_EXTRA) if c in grid.columns]
    s = seq(key, order)
    g = with_chunk(mask_outliers(grid, rules), s, GRID_CHUNK)
    g = materialize(g)
    g = imp.recipe(g, s, features, recipe, time_col=time)
    w = materialize(onset_windows(g, s, rows, flag))
    w = ordered_split(w, key, *P.SPLIT_FRACTIONS).drop(*drop)
    cols = [c for c in features if c not in drop] + extra
    w = w.select(*[F.col(c).cast("double").alias(c) if c in extra else F.col(c) for c in w.columns])
    return minmax_scale(w, cols, fit_on=w.filter(F.col("split") != "test")).drop("_chunk")

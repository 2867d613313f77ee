"""Column expressions shared by the operators.

Times may arrive as TIMESTAMP_NTZ (the fixtures) or TIMESTAMP. Between two
TIMESTAMP_NTZ values elapsed time is the difference of the local times
themselves, whatever zone the session is in; between two TIMESTAMP values it is
the difference of the instants. (``timestamp_diff`` reads local times in the
session's zone, so a time in the gap of a clock change would be shifted.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "col", "micros_between", "hours_between", "time_position", "bin_index",
    "bin_start", "threshold_flag", "binarize", "logistic_loss", "sigmoid",
    "year_of", "hour_floor",
]

MICROS_PER_HOUR = 3_600_000_000


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros_between(start, end) -> Column:
    """Elapsed microseconds from ``start`` to ``end`` (EXTRACT(epoch ...)*1e6)."""
    a, b = col(start), col(end)
    local = (F.typeof(a) == "timestamp_ntz") & (F.typeof(b) == "timestamp_ntz")       # known when the plan is made
    return F.when(local, _local_micros(b) - _local_micros(a)).otherwise(
        F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp")))


def _local_micros(t: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a local time, from its fields."""
    seconds = F.unix_date(t.cast("date")).cast("long") * 86_400 + F.hour(t) * 3600 + F.minute(t) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("long")


def hours_between(start, end) -> Column:
    """Fractional hours from ``start`` to ``end``."""
    return micros_between(start, end) / F.lit(float(MICROS_PER_HOUR))


def time_position(df: DataFrame, name: str) -> Column:
    """A numeric, order-preserving position for column ``name``: epoch
    microseconds for timestamps and dates, the value itself otherwise."""
    dt = df.schema[name].dataType
    if isinstance(dt, T.TimestampNTZType):
        return _local_micros(F.col(name))
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(F.col(name))
    if isinstance(dt, T.DateType):
        return F.unix_date(F.col(name)).cast("long") * F.lit(86_400 * 1_000_000)
    return F.col(name)


def bin_index(time, origin, width_hours: float, closed: str = "left") -> Column:
    """Index of the fixed-width bin holding ``time`` on a grid starting at ``origin``.

    closed='left'  -> bins [start, end):  floor(dt / w)      (hour truncation)
    closed='right' -> bins (start, end]:  ceil(dt / w) - 1   (a time equal to
    the origin falls in bin -1, i.e. matches no bin at or after the origin).
    """
    dt = micros_between(origin, time)
    w = F.lit(float(width_hours * MICROS_PER_HOUR))
    if closed == "left":
        b = F.floor(dt / w)
    elif closed == "right":
        b = F.ceil(dt / w) - F.lit(1)
    else:
        raise ValueError(f"closed must be 'left' or 'right', not {closed!r}")
    return b.cast("int")


def bin_start(origin, bin_col, width_hours: int) -> Column:
    """Start time of bin ``bin_col`` (whole-hour widths)."""
    hours = col(bin_col).cast("int") * F.lit(int(width_hours))
    return col(origin) + F.make_dt_interval(F.lit(0), hours)


def threshold_flag(c, op: str, th: float) -> Column:
    """0/1 flag of ``c <op> th``; a missing value scores 0."""
    c = col(c)
    cond = {"<=": c <= th, "<": c < th, ">=": c >= th, ">": c > th}[op]
    return F.coalesce(cond.cast("int"), F.lit(0))


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(x)))


def binarize(score, threshold: float = 0.5, link: str = "identity",
             strict: bool = False) -> Column:
    """1 when the (optionally linked) score reaches the threshold, else 0."""
    s = sigmoid(score) if link == "logistic" else col(score)
    cond = s > threshold if strict else s >= threshold
    return F.when(cond, 1).otherwise(0)


def logistic_loss(logit, y, pos_weight: float = 1.0) -> Column:
    """-[w*y*log(sigmoid(x)) + (1-y)*log(1-sigmoid(x))] in the overflow-free form."""
    x, y = col(logit), col(y).cast("double")
    log_w = F.lit(1.0) + (F.lit(float(pos_weight)) - 1.0) * y
    softplus_neg = F.log1p(F.exp(-F.abs(x))) + F.greatest(-x, F.lit(0.0))
    return (F.lit(1.0) - y) * x + log_w * softplus_neg


def year_of(c) -> Column:
    """Calendar year of a timestamp, date or date text."""
    return F.year(col(c)).cast("int")


def hour_floor(c) -> Column:
    """Truncate a timestamp to the hour of its own clock; the type stays."""
    t = col(c)
    return t - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(t), F.extract(F.lit("SECOND"), t).cast("decimal(18,6)"))

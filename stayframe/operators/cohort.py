"""Event detection, onset anchors and fixed-length look-back windows.

All per-entity facts (has an event, onset position, row count) are partial
aggregates per (entity, chunk) combined per entity (``seq.index_and_aggs``,
``seq.entity_aggs``), and all row-to-row logic (lags, run lengths) runs in
chunked scans. Only after the rows
are cut down to at most N per entity is anything partitioned by the entity
alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayframe.functions.columns import hours_between
from stayframe.operators.seq import Seq, index_and_aggs, prev_row, row_index


def lag_sum(df: DataFrame, s: Seq, c: str, out: str, at_least: float | None = None,
            flag_out: str | None = None) -> DataFrame:
    """``out = c + c(previous row)`` (null on an entity's first row, as a
    shift-and-add does); optionally ``flag_out = (out >= at_least)`` as 0/1
    with null counting as 0."""
    x = prev_row(df, s, [c], suffix="__lag")
    x = x.withColumn(out, F.col(c) + F.col(f"{c}__lag")).drop(f"{c}__lag")
    if flag_out:
        x = x.withColumn(flag_out, F.coalesce((F.col(out) >= at_least).cast("int"), F.lit(0)))
    return x


def persistence(df: DataFrame, s: Seq, cond: Column, d: int, out: str = "event") -> DataFrame:
    """``out`` = 1 on rows ending a run of at least ``d`` consecutive rows
    (row-based: a missing hour does not break a run) on which ``cond`` holds,
    else 0. The first d-1 rows of an entity can never fire.

    One chunked pass: the run length is the row index minus the index of the
    last row where ``cond`` fails; both are carried across chunks through the
    per-chunk summary (row count, last failing row)."""
    brk = ~F.coalesce(cond, F.lit(False))
    w = Window.partitionBy(*s.part).orderBy(s.order)
    local = df.withColumn("_lrn", F.row_number().over(w) - 1)
    local = local.withColumn("_lbrk", F.max(F.when(brk, F.col("_lrn"))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    summ = local.groupBy(*s.part).agg(F.count(F.lit(1)).alias("_n"), F.max(F.when(brk, F.col("_lrn"))).alias("_cb"))
    prev = Window.partitionBy(*s.keys).orderBy(s.chunk).rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("_off", F.coalesce(F.sum("_n").over(prev), F.lit(0)))
    summ = summ.withColumn("_gb", F.col("_off") + F.col("_cb"))
    carry = summ.select(*s.part, "_off", F.max("_gb").over(prev).alias("_carry_brk"))
    x = local.join(carry, s.part, "inner")
    idx = F.col("_lrn") + F.col("_off")
    last = F.coalesce(F.col("_lbrk") + F.col("_off"), F.col("_carry_brk"), F.lit(-1))
    return x.withColumn(out, ((idx - last) >= d).cast("int")).drop("_lrn", "_lbrk", "_off", "_carry_brk")


def onset_windows(df: DataFrame, s: Seq, n: int, flag: str, symptomatic: Column | None = None,
                  require_any: Column | None = None, min_rows: int | None = None,
                  event_min_rows: int | None = None, event_where: Column | None = None,
                  nonevent_where: Column | None = None, label: str = "is_event",
                  step: str = "step") -> DataFrame:
    """Cut one window of ``n`` rows per entity (ordered by ``s.order``,
    an integer position such as an hour or bin index).

    * entities with fewer than ``min_rows`` rows (default n) are dropped;
    * non-event entities (``symptomatic`` never 1; default: ``flag`` never 1)
      keep their first n rows;
    * event entities (symptomatic, and ``require_any`` 1 on some row if
      given) are anchored at the first row with ``flag`` == 1 (dropped when
      there is none) and keep rows with order in (anchor - n, anchor];
      fewer than ``event_min_rows`` (default n) such rows drops the entity;
    * ``event_where`` / ``nonevent_where`` are entity-level predicates over
      ``_anchor`` (onset position), ``_nrows``, ``_maxo`` (last position) and
      ``_anchor_row`` columns prepared here.

    Adds ``label`` (1 event / 0 non-event) and ``step`` (0-based position
    within the window)."""
    o = F.col(s.order)
    fl = F.col(flag) == 1
    symp = symptomatic if symptomatic is not None else fl
    specs = [("_nrows", "count", F.lit(1)), ("_anchor", "min", F.when(fl, o)),
             ("_symp", "max", F.coalesce(symp.cast("int"), F.lit(0))), ("_maxo", "max", o)]
    if require_any is not None:
        specs.append(("_req", "max", F.coalesce(require_any.cast("int"), F.lit(0))))
    x = index_and_aggs(df, s, specs, "_ridx")
    min_rows = n if min_rows is None else min_rows
    event_min_rows = n if event_min_rows is None else event_min_rows
    enough = F.col("_nrows") >= min_rows if min_rows else F.lit(True)
    is_non = F.col("_symp") == 0
    is_evt = (F.col("_symp") == 1) & F.col("_anchor").isNotNull()
    if require_any is not None:
        is_evt = is_evt & (F.col("_req") == 1)
    if event_where is not None:
        is_evt = is_evt & event_where
    if nonevent_where is not None:
        is_non = is_non & nonevent_where
    keep_non = is_non & (F.col("_ridx") < n)
    keep_evt = is_evt & (o > F.col("_anchor") - n) & (o <= F.col("_anchor"))
    x = x.filter(enough & (keep_non | keep_evt)).withColumn(label, F.when(is_evt, 1).otherwise(0))
    # at most n rows per entity remain: entity-wide windows are bounded now
    we = Window.partitionBy(*s.keys)
    x = x.withColumn("_wrows", F.count(F.lit(1)).over(we))
    if event_min_rows:
        x = x.filter((F.col(label) == 0) | (F.col("_wrows") >= event_min_rows))
    x = x.withColumn(step, (F.row_number().over(we.orderBy(o)) - 1).cast("int"))
    return x.drop("_nrows", "_anchor", "_symp", "_maxo", "_req", "_ridx", "_wrows")


def first_rows(df: DataFrame, s: Seq, n: int, require_n: bool = True) -> DataFrame:
    """First n rows of each entity; entities with fewer rows dropped if ``require_n``."""
    x = row_index(df, s, "_fidx", total="_fn")      # both read off one per-chunk summary
    if require_n:
        x = x.filter(F.col("_fn") >= n)
    return x.filter(F.col("_fidx") < n).drop("_fidx", "_fn")


def band_flag(start: str, end: str, t: str) -> Column:
    """1 when t lies in [start, end] (closed both ends), else null."""
    return F.when(F.col(t).between(F.col(start), F.col(end)), F.lit(1))


def event_hour(bin_col: str, width_hours: int, start: str, end: str, t: str) -> Column:
    """bin * width + hours from the bin start to t, rounded half-up; null when
    t is outside [start, end]."""
    off = F.round(hours_between(F.col(start), F.col(t)), 0).cast("int")
    return F.when(F.col(t).between(F.col(start), F.col(end)),
                  F.col(bin_col) * F.lit(width_hours) + off)

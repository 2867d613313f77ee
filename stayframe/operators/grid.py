"""Binning event logs onto per-entity time grids, roll-ups and interval joins.

Fixed-width grids never use a range join: an event's bin is arithmetic on its
time, events are aggregated per (entity, bin) with map-side partial
aggregation, and the aggregate is equi-joined onto the grid skeleton; monthly
bins are arithmetic as well (``month_bin``). On overlapping or irregular
intervals an entity's events meet its intervals in one task, or, where they are
many, are added up along a summary tree (``interval_totals``); ``interval_join`` is for callers that need
the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayframe.functions.columns import bin_index, bin_start, hour_floor, time_position
from stayframe.operators.seq import GRID_CHUNK, Seq, depth_chunks, prefix_aggs, salted_join
from stayframe.session import materialize


BINS = 1 << 19    # bins of a grid that one task holds


def with_bin(df: DataFrame, time: str, origin: str, width_hours: float,
             closed: str = "left", out: str = "hr") -> DataFrame:
    """Bin index of each event on its entity's grid (see ``bin_index``)."""
    return df.withColumn(out, bin_index(time, origin, width_hours, closed))


def conditional_avgs(item_col: str, value_col: str, mapping: Mapping[str, Sequence]) -> list[Column]:
    """Long-to-wide pivot as conditional averages: one output per feature,
    averaging the values whose item is in the feature's item list."""
    return [F.avg(F.when(F.col(item_col).isin(list(ids)), F.col(value_col))).alias(name)
            for name, ids in mapping.items()]


def complete_grid(binned: DataFrame, keys: Sequence[str], bin_col: str, origin: str,
                  width_hours: int, first_bin: int = 0, start: str = "starttime",
                  end: str = "endtime", chunk: str = "_chunk",
                  chunk_width: int = GRID_CHUNK, bounds: DataFrame | None = None) -> DataFrame:
    """Expand per-(entity, bin) aggregates to every bin first_bin..last of
    each entity (empty bins included, their features null), with bin bounds.

    ``binned`` has one row per (keys, origin, bin). The skeleton is generated
    per entity from its bin range, so its size grows with the entity's span,
    not with its event count. Skeleton and aggregates are unioned and
    shuffled once by (keys, chunk) - the partitioning every ordered operator
    downstream uses - and merged in place, instead of joining on
    (keys, bin) and shuffling again for the first window. ``bounds`` (keys,
    origin, _maxb) may be given by the caller; otherwise it is read off
    ``binned``. Given bounds also tell how many bins there will be, and so over
    how many tasks the chunks are dealt (``BINS`` each): a chunk's range is one
    small row until then, so the shuffle's bytes say nothing of a task's size."""
    feats = [c for c in binned.columns if c not in (*keys, origin, bin_col)]
    tasks: tuple[int, ...] = ()
    if bounds is not None:
        bins = bounds.agg(F.sum(F.greatest(F.col("_maxb") - first_bin + 1, F.lit(0)).cast("long"))).first()[0] or 0
        tasks = (max(bounds.sparkSession.sparkContext.defaultParallelism, -(-bins // BINS)),)
    else:
        bounds = binned.groupBy(*keys, origin).agg(F.max(bin_col).alias("_maxb"))
    # one bin-range row per chunk (at most chunk_width bins each); ranges are
    # exploded into bins only after the shuffle, where each chunk has its own task
    w = F.lit(chunk_width)
    chunks = F.when(F.col("_maxb") >= first_bin,
                    F.sequence(F.floor(F.lit(first_bin) / w).cast("long"), F.floor(F.col("_maxb") / w).cast("long")))
    ranges = bounds.select(*keys, origin, "_maxb", F.explode(chunks).alias(chunk))
    ranges = ranges.select(*keys, origin, chunk,
                           F.greatest(F.col(chunk) * w, F.lit(first_bin)).cast("int").alias("_lo"),
                           F.least((F.col(chunk) + 1) * w - 1, F.col("_maxb")).cast("int").alias("_hi"))
    obs = binned.withColumn(chunk, F.floor(F.col(bin_col) / w).cast("long"))
    u = obs.unionByName(ranges, allowMissingColumns=True).repartition(*tasks, *keys, chunk)
    bins = F.when(F.col("_lo").isNotNull(), F.sequence("_lo", "_hi")).otherwise(F.array(F.col(bin_col)))
    u = u.withColumn(bin_col, F.explode(bins)).drop("_lo", "_hi")
    # at most one observed row per bin and skeleton rows carry nulls: max() is that row's value
    g = u.groupBy(*keys, chunk, bin_col).agg(F.max(origin).alias(origin), *[F.max(c).alias(c) for c in feats])
    g = g.withColumn(start, bin_start(origin, bin_col, width_hours))
    g = g.withColumn(end, bin_start(origin, F.col(bin_col) + F.lit(1), width_hours))
    return g.select(*keys, origin, bin_col, *feats, start, end, chunk)


def entity_bounds(events: DataFrame, keys: Sequence[str], time: str, origin: str = "origin") -> DataFrame:
    """(keys, first time, last time, _n rows) of every entity, written once."""
    return materialize(events.groupBy(*keys).agg(F.min(time).alias(origin), F.max(time).alias("_last"),
                                                 F.count(F.lit(1)).alias("_n")), "bounds")


def event_grid(events: DataFrame, keys: Sequence[str], time: str, width_hours: int,
               aggs: Sequence[Column], closed: str = "left", bin_col: str = "hr",
               origin: str = "origin", complete: bool = True) -> DataFrame:
    """Per-entity grid of ``width_hours`` bins anchored at the entity's first
    event, with ``aggs`` evaluated per bin. closed='right' bins are (s, e],
    so the event at the origin itself matches no bin.

    One per-entity table (first and last time), written once, gives both the
    origin joined back to the events and the last bin of the skeleton, so the
    events are read twice in all: for that table and for the bins. The join
    back deals the rows of a hot entity over tasks until they are aggregated per
    bin."""
    ent = entity_bounds(events, keys, time, origin)
    e = salted_join(events, ent.select(*keys, origin, "_n"), keys, time)
    e = with_bin(e, time, origin, width_hours, closed, bin_col).filter(F.col(bin_col) >= 0)
    b = e.groupBy(*keys, origin, bin_col).agg(*aggs)
    if not complete:
        return b
    bounds = ent.select(*keys, origin, bin_index("_last", origin, width_hours, closed).alias("_maxb"))
    return complete_grid(b, keys, bin_col, origin, width_hours, bounds=bounds)


def coarsen(grid: DataFrame, keys: Sequence[str], bin_col: str, factor: int,
            aggs: Sequence[Column], out: str | None = None, chunk: str | None = None,
            chunk_width: int = GRID_CHUNK) -> DataFrame:
    """Roll a grid up by an integer factor: bin = floor(bin / factor)
    (hr 0..199 gives the same result as the rounding cast (hr/8-0.45)::int).
    With the grid's ``chunk`` column, whose chunks hold whole coarse bins where
    the factor divides their width, the grid is rolled up in the tasks that made it."""
    out = out or bin_col
    g = grid.withColumn("_cb", F.floor(F.col(bin_col) / F.lit(factor)).cast("int"))
    within = [chunk] if chunk and chunk_width % factor == 0 else []
    res = g.groupBy(*keys, *within, "_cb").agg(*aggs).drop(*within)
    return res.withColumnRenamed("_cb", out)


def hourly_mean(df: DataFrame, keys: Sequence[str], time: str, values: Sequence[str],
                hour_col: str = "hour", drop_null_keys: bool = True) -> DataFrame:
    """Mean of each value column per (keys, hour) with hour = time truncated
    to the hour ([s, e) bins). Rows with a null key are dropped first, as a
    pandas group-by does."""
    if drop_null_keys:
        df = df.dropna(subset=list(keys))
    return df.groupBy(*keys, hour_floor(time).alias(hour_col)).agg(*[F.avg(v).alias(v) for v in values])


def interval_join(grid: DataFrame, events: DataFrame, keys: Sequence[str], start: str, end: str,
                  time: str, closed: str = "right", bucket: str = "day") -> DataFrame:
    """Join events to the grid interval holding their time, for irregular grids.

    Equality on ``keys`` plus a time bucket (date_trunc(bucket)); each
    interval is listed under every bucket it overlaps, each event under one,
    so matches are found once and an entity's intervals are only paired with
    events of the same bucket. The residual is (start, end] for
    closed='right', [start, end) for 'left', [start, end] for 'both'.
    Returns the matched (interval, event) pairs; ``interval_aggregate`` turns
    them into a left join that keeps intervals without events."""
    unit = {"day": "DAY", "month": "MONTH", "hour": "HOUR", "week": "WEEK"}[bucket]
    step = {"day": F.expr("INTERVAL 1 DAY"), "month": F.expr("INTERVAL 1 MONTH"),
            "hour": F.expr("INTERVAL 1 HOUR"), "week": F.expr("INTERVAL 7 DAYS")}[bucket]
    ttype = grid.schema[start].dataType
    g = grid.withColumn("_bk", F.explode(F.sequence(
        F.date_trunc(unit, F.col(start)).cast(ttype), F.date_trunc(unit, F.col(end)).cast(ttype), step)))
    e = events.withColumn("_bk", F.date_trunc(unit, F.col(time)).cast(events.schema[time].dataType))
    s, en, t = F.col(f"_g.{start}"), F.col(f"_g.{end}"), F.col(f"_e.{time}")
    rng = {"right": (t > s) & (t <= en), "left": (t >= s) & (t < en), "both": (t >= s) & (t <= en)}[closed]
    cond = [F.col(f"_g.{k}") == F.col(f"_e.{k}") for k in keys] + [F.col("_g._bk") == F.col("_e._bk"), rng]
    cond_all = cond[0]
    for c in cond[1:]:
        cond_all = cond_all & c
    j = g.alias("_g").join(e.alias("_e"), cond_all, "inner")
    ecols = [F.col(f"_e.{c}").alias(c) for c in events.columns if c not in keys and c not in grid.columns]
    return j.select(*[F.col(f"_g.{c}").alias(c) for c in grid.columns], *ecols)


def interval_aggregate(grid: DataFrame, events: DataFrame, grid_keys: Sequence[str],
                       join_keys: Sequence[str], start: str, end: str, time: str,
                       aggs: Sequence[Column], closed: str = "right", bucket: str = "day") -> DataFrame:
    """Aggregate events per grid interval via ``interval_join`` and left-join
    the result onto the grid (intervals without events keep null aggregates).
    ``grid_keys`` identify an interval uniquely; ``join_keys`` are the entity
    keys used to match events (a subset of the grid's columns)."""
    pairs = interval_join(grid.select(*set([*grid_keys, *join_keys, start, end])), events,
                          join_keys, start, end, time, closed, bucket)
    agg = pairs.groupBy(*grid_keys).agg(*aggs)
    return grid.join(agg, list(grid_keys), "left")


def month_bin(time: str, origin: str) -> Column:
    """Index of the monthly bin (origin + k months, origin + k+1 months] that
    holds ``time``: the month difference, less one unless the time lies after
    that border. -1 and below lie at or before the origin."""
    m = (F.year(time) - F.year(origin)) * 12 + F.month(time) - F.month(origin)
    return F.when(F.col(time) > F.col(origin) + F.make_ym_interval(F.lit(0), m), m).otherwise(m - 1)


def _dyadic(lo: Column, hi: Column) -> Column:
    """The nodes (l, b) of a binary summary tree that make up lo .. hi-1, node
    (l, b) being the 2^l positions from b * 2^l. At each level a range that
    starts at an odd node takes it, and so one that ends after an even node."""
    def level(k: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), k)
        a, b = F.floor((lo + size - 1) / size), F.floor(hi / size)
        node = lambda here, x: F.when((a < b) & here, F.struct(k.alias("l"), x.cast("long").alias("b")))
        return F.array(node(a % 2 == 1, a), node(b % 2 == 1, b - 1))
    depth = F.ceil(F.log2((hi - lo).cast("double"))).cast("int") + 1
    return F.filter(F.flatten(F.transform(F.sequence(F.lit(0), depth), level)), lambda x: x.isNotNull())


SHORT = 16        # events of a range that are listed one by one
ORDINARY = 4096   # events and borders of an entity that one task may meet pair by pair


def interval_borders(intervals: DataFrame, start: str, end: str, step: str = "_step", border: str = "_border") -> DataFrame:
    """Free-standing intervals as two borders each, for ``interval_totals``."""
    side = F.explode(F.array(F.struct(F.lit(0).alias(step), F.col(start).alias(border)),
                             F.struct(F.lit(1).alias(step), F.col(end).alias(border)))).alias("_b")
    return intervals.select(*[c for c in intervals.columns if c not in (start, end)], side).select("*", "_b.*").drop("_b")


def interval_totals(borders: DataFrame, events: DataFrame, keys: Sequence[str], grid_keys: Sequence[str], step: str,
                    border: str, time: str, value: str, n: str, avg: str, target: int = 1 << 16,
                    expand: Callable[[DataFrame], DataFrame] = lambda x: x,
                    also: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Count and mean of ``value`` of an entity's events in each interval of
    its grids, whatever grids overlap. ``borders`` has one row per (grid_keys,
    step), or ``expand`` makes these rows of it where they are needed; interval
    ``step`` is (border, border of step + 1], and a step without a successor only
    closes an interval. ``keys`` are the entity's columns in both tables. The rows
    (grid_keys, step, more columns) that ``also`` makes of the events are joined
    to the intervals.

    Entities are dealt over tasks once, before their borders are made, and an
    entity's events meet its intervals there, so that no border or interval is
    shuffled or written. Entities of more than ``ORDINARY`` events and borders
    (or ``target``, if that is less) go through ``_scanned_totals``. Nothing is
    subtracted, so a huge, infinite or NaN value changes only the intervals that
    hold it. Intervals without events or of no length have count 0 and no mean; a
    null border makes no interval."""
    grid = list(dict.fromkeys([*keys, *grid_keys]))
    count = F.count(F.lit(1)).alias("_rows")
    sizes = events.groupBy(*keys).agg(count).unionByName(expand(borders).groupBy(*keys).agg(count))
    sizes = materialize(sizes.groupBy(*keys).agg(F.sum("_rows").alias("_rows")), "sizes")
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    ordinary = known & (F.col("_rows") <= min(ORDINARY, target))
    rows, hot = sizes.agg(F.sum(F.when(ordinary, F.col("_rows"))), F.count(F.when(known & ~ordinary, 1))).first()
    if hot or sizes.filter(~known).head(1):
        many = sizes.filter(known & ~ordinary).select(*keys)
        parts = [[t.filter(known).join(many, list(keys), "left_anti"), t.join(many, list(keys), "left_semi").unionByName(t.filter(~known))]
                 for t in (borders, events)]
    else:
        parts = [[borders, None], [events, None]]
    (some, others), (some_events, other_events) = parts
    tasks = max(events.sparkSession.sparkContext.defaultParallelism, -(-2 * (rows or 0) // BINS))
    dealt = some_events.repartition(tasks, *keys)
    e = dealt.filter(F.col(value).isNotNull() & F.col(time).isNotNull()).groupBy(*keys, F.col(time).alias("_t")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col(value).cast("double")).alias("_s"))
    w = Window.partitionBy(*grid).orderBy(step)
    spans = expand(some.repartition(tasks, *keys)).filter(F.col(border).isNotNull()).groupBy(*grid, step).agg(F.max(border).alias("_lo"))
    spans = spans.withColumn("_hi", F.when(F.lead(step).over(w) == F.col(step) + 1, F.lead("_lo").over(w))).filter("_hi IS NOT NULL")
    met = [F.col(f"_g.{k}") == F.col(f"_e.{k}") for k in keys]
    inside = (F.col("_e._t") > F.col("_g._lo")) & (F.col("_e._t") <= F.col("_g._hi"))
    found = spans.alias("_g").join(e.alias("_e"), reduce(and_, [*met, inside]), "left").select(
        *[F.col(f"_g.{c}").alias(c) for c in (*grid, step)], "_n", "_s", F.lit(1).alias("_in"))
    more: list[str] = []
    if also is not None:
        beside = also(dealt)
        more = [c for c in beside.columns if c not in (*grid, step)]
        found = found.unionByName(beside, allowMissingColumns=True)
    out = found.groupBy(*grid, step).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(n), (F.sum("_s") / F.sum("_n")).alias(avg),
                                         *[F.max(c).alias(c) for c in more], F.max("_in").alias("_in"))
    out = out.filter("_in = 1").drop("_in")
    if others is None:
        return out
    rest = _scanned_totals(expand(others), other_events, keys, grid_keys, step, border, time, value, n, avg, target)
    if also is not None:
        rest = rest.join(also(other_events), [*grid, step], "left")
    return out.unionByName(rest)


def _scanned_totals(borders: DataFrame, events: DataFrame, keys: Sequence[str], grid_keys: Sequence[str], step: str,
                    border: str, time: str, value: str, n: str, avg: str, target: int) -> DataFrame:
    """``interval_totals`` of entities too large for one task.

    Events (one row per entity and time) and borders are put in one order and
    scanned in chunks of equal depth, which numbers the entity's event times and
    tells for every border how many lie up to it; so an interval is a range of
    event numbers, and most bins are seen to be empty at once. Event sums are
    added up along a binary summary tree, and an interval takes the few nodes
    that make up its range (its events, if they are few). No event meets an interval it
    does not lie in, and neither a hot entity nor a burst makes a large task."""
    grid = list(dict.fromkeys([*keys, *grid_keys]))
    ev = events.filter(F.col(value).isNotNull() & F.col(time).isNotNull()).groupBy(*keys, F.col(time).alias("_t")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col(value).cast("double")).alias("_s")).withColumn("_k", F.lit(0))
    b = borders.filter(F.col(border).isNotNull()).select(*grid, F.col(step).alias("_step"), F.col(border).alias("_t"),
                                                         F.lit(1).alias("_k"))
    u = ev.unionByName(b, allowMissingColumns=True)
    # at one time events come first, so that an interval holds its end and not its start; the order of borders does not matter
    whole = isinstance(u.schema["_t"].dataType, T.DatetimeType)
    order = time_position(u, "_t") * 2 + F.col("_k") if whole else F.struct("_t", "_k")
    s = Seq(tuple(keys), "_o")
    u = depth_chunks(materialize(u.withColumn("_o", order).drop("_t"), "merged"), s, target)
    u = prefix_aggs(u, s, [("_r", "count", F.when(F.col("_k") == 0, 1))], inclusive=False)
    u = materialize(u.drop("_o", s.chunk), "ranked")
    none = F.lit(None).cast("long")
    ends = F.explode(F.array(F.struct(F.col("_step"), F.col("_r").alias("lo"), none.alias("hi")),
                             F.struct((F.col("_step") - 1).alias("_step"), none.alias("lo"), F.col("_r").alias("hi")))).alias("_e")
    spans = u.filter(F.col("_k") == 1).select(*grid, ends).groupBy(*grid, F.col("_e._step").alias(step)).agg(
        F.max("_e.lo").alias("_lo"), F.max("_e.hi").alias("_hi"))
    spans = materialize(spans.filter("_lo IS NOT NULL AND _hi IS NOT NULL"), "spans")
    longest = spans.agg(F.max(F.col("_hi") - F.col("_lo"))).first()[0] or 0
    short = spans.filter(f"_lo < _hi AND _hi - _lo <= {SHORT}").select(*grid, step, F.lit(0).alias("_l"), F.explode(
        F.sequence(F.col("_lo"), F.col("_hi") - 1)).alias("_b"))
    nodes = spans.filter(f"_hi - _lo > {SHORT}").select(*grid, step, F.explode(_dyadic(F.col("_lo"), F.col("_hi"))).alias("_x"))
    nodes = short.unionByName(nodes.select(*grid, step, F.col("_x.l").alias("_l"), F.col("_x.b").alias("_b")))
    tree = u.filter(F.col("_k") == 0).select(*keys, F.lit(0).alias("_l"), F.col("_r").alias("_b"), "_n", "_s")
    if longest > SHORT:
        above = F.explode(F.sequence(F.lit(1), F.lit(longest.bit_length() - 1)))
        tree = tree.unionByName(tree.withColumn("_l", above).groupBy(*keys, "_l", F.expr("shiftright(_b, _l)").alias("_b")).agg(
            F.sum("_n").alias("_n"), F.sum("_s").alias("_s")))
    found = nodes.join(tree, [*keys, "_l", "_b"]).groupBy(*grid, step).agg(F.sum("_n").alias(n), (F.sum("_s") / F.sum("_n")).alias(avg))
    empty = spans.filter("_lo >= _hi").select(*grid, step, F.lit(0).cast("long").alias(n), F.lit(None).cast("double").alias(avg))
    return found.unionByName(empty)

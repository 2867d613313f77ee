"""Ordered per-entity scans that stay bounded under skew.

Operators over an entity's ordered rows (fills, interpolation, row numbers,
lags, run lengths, per-entity facts) never use a window partitioned by the
entity alone: one entity may hold a third of all rows. Rows are partitioned by
(entity keys, chunk) instead, where the chunk is a range of the ordering
position: fixed width on grids (``with_chunk``: at most ``width`` rows), equal
depth on raw event time (``depth_chunks``: at most ``target`` rows), so a hot
entity or a burst is spread over many window partitions. State that crosses a chunk border is carried by a per-chunk summary
(one row per (entity, chunk)), scanned in chunk order and joined back on
(keys, chunk), which is the partitioning the big side already has: the row data
is shuffled once, only the summaries move again.

All functions expect the chunk column to be present, non-decreasing along the
ordering within an entity, and the ordering column to be unique within an
entity.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayframe.functions.columns import col
from stayframe.session import materialize

UNB = Window.unboundedPreceding
CUR = Window.currentRow

# Default chunk width on integer grids (positions per chunk).
GRID_CHUNK = 4096


@dataclass(frozen=True)
class Seq:
    """An ordered sequence per entity: rows grouped by ``keys``, ordered by
    ``order`` (unique within an entity), chunked by column ``chunk``."""
    keys: tuple[str, ...]
    order: str
    chunk: str = "_chunk"

    @property
    def part(self) -> list[str]:
        return [*self.keys, self.chunk]


def seq(keys, order: str, chunk: str = "_chunk") -> Seq:
    keys = (keys,) if isinstance(keys, str) else tuple(keys)
    return Seq(keys, order, chunk)


def with_chunk(df: DataFrame, s: Seq, width: int, position: Column | str | None = None) -> DataFrame:
    """Add the chunk column: floor(position / width)."""
    pos = col(position) if position is not None else F.col(s.order)
    return df.withColumn(s.chunk, F.floor(pos / F.lit(width)).cast("long"))


def _ordered(s: Seq, desc: bool = False):
    o = F.col(s.order).desc() if desc else F.col(s.order)
    return Window.partitionBy(*s.part).orderBy(o)


def _chunk_window(s: Seq, desc: bool = False):
    o = F.col(s.chunk).desc() if desc else F.col(s.chunk)
    return Window.partitionBy(*s.keys).orderBy(o).rowsBetween(UNB, -1)


def row_index(df: DataFrame, s: Seq, out: str = "_idx", total: str | None = None) -> DataFrame:
    """0-based position of each row within its entity (global across chunks);
    ``total`` optionally names a column with the entity's row count, read
    off the same per-chunk summary (no extra pass over the rows)."""
    local = df.withColumn("_lrn", F.row_number().over(_ordered(s)) - 1)
    summ = local.groupBy(*s.part).agg(F.count(F.lit(1)).alias("_n"))
    extra = [F.sum("_n").over(Window.partitionBy(*s.keys)).alias(total)] if total else []
    carry = summ.select(*s.part, F.coalesce(F.sum("_n").over(_chunk_window(s)), F.lit(0)).alias("_off"), *extra)
    return (local.join(carry, s.part, "inner")
            .withColumn(out, (F.col("_lrn") + F.col("_off")).cast("long"))
            .drop("_lrn", "_off"))


def prev_next(df: DataFrame, s: Seq, cols: Sequence[str], position: Column | str | None = None,
              prev: bool = True, nxt: bool = True, row_position: str | None = None) -> DataFrame:
    """For each column c add the last non-null at or before the row
    (``c__pp`` position, ``c__pv`` value) and the first non-null at or after it
    (``c__np``, ``c__nv``), scanning the whole entity, across chunks.

    Positions are ``position`` (default the ordering column), or, when
    ``row_position`` names an output column, the 0-based row index within the
    entity, computed in the same pass (chunk row offsets travel in the same
    summary as the carried values)."""
    rows = row_position is not None
    if rows:
        df = df.withColumn("_lrn", F.row_number().over(_ordered(s)) - 1)
        pos = F.col("_lrn")
    else:
        pos = col(position) if position is not None else F.col(s.order)
    wf = _ordered(s).rowsBetween(UNB, CUR)
    wb = _ordered(s, desc=True).rowsBetween(UNB, CUR)
    sel, summ_aggs = [F.col("*")], [F.count(F.lit(1)).alias("_n")] if rows else []
    for c in cols:
        st = F.when(F.col(c).isNotNull(), F.struct(pos.alias("p"), F.col(c).alias("v")))
        if prev:
            sel.append(F.last(st, True).over(wf).alias(f"_wp_{c}"))
            summ_aggs.append(F.max(st).alias(f"_sl_{c}"))
        if nxt:
            sel.append(F.last(st, True).over(wb).alias(f"_wn_{c}"))
            summ_aggs.append(F.min(st).alias(f"_sf_{c}"))
    local = df.select(*sel)
    # summaries from the windowed rows: already partitioned by (keys, chunk)
    summ = local.groupBy(*s.part).agg(*summ_aggs)
    off = F.col("_off") if rows else F.lit(0)
    if rows:
        summ = summ.withColumn("_off", F.coalesce(F.sum("_n").over(_chunk_window(s)), F.lit(0)))

    def shift(x):           # chunk-local position -> entity position
        return F.when(x.isNotNull(), F.struct((x["p"] + off).alias("p"), x["v"].alias("v"))) if rows else x

    carry_sel = [*s.part, *(["_off"] if rows else [])]
    for c in cols:
        if prev:
            carry_sel.append(F.last(shift(F.col(f"_sl_{c}")), True).over(_chunk_window(s)).alias(f"_cp_{c}"))
        if nxt:
            carry_sel.append(F.last(shift(F.col(f"_sf_{c}")), True).over(_chunk_window(s, desc=True))
                             .alias(f"_cn_{c}"))
    carry = summ.select(*carry_sel)
    out = local.join(carry, s.part, "inner")
    res, drop = [], ["_lrn", "_off"] if rows else []
    for c in cols:
        if prev:
            p = F.coalesce(shift(F.col(f"_wp_{c}")), F.col(f"_cp_{c}"))
            res += [p["p"].alias(f"{c}__pp"), p["v"].alias(f"{c}__pv")]
            drop += [f"_wp_{c}", f"_cp_{c}"]
        if nxt:
            n = F.coalesce(shift(F.col(f"_wn_{c}")), F.col(f"_cn_{c}"))
            res += [n["p"].alias(f"{c}__np"), n["v"].alias(f"{c}__nv")]
            drop += [f"_wn_{c}", f"_cn_{c}"]
    if rows:
        res.append((F.col("_lrn") + F.col("_off")).cast("long").alias(row_position))
    return out.select(F.col("*"), *res).drop(*drop)


def prev_row(df: DataFrame, s: Seq, cols: Sequence[str], suffix: str = "__lag") -> DataFrame:
    """Value of each column on the previous row of the entity (null on the first)."""
    w = _ordered(s).rowsBetween(UNB, -1)
    sel, summ_aggs, carry_sel = [F.col("*")], [], []
    for c in cols:
        st = F.struct(F.col(s.order).alias("o"), F.col(c).alias("v"))
        sel.append(F.last(st).over(w).alias(f"_wl_{c}"))
        summ_aggs.append(F.max(st).alias(f"_sl_{c}"))
        carry_sel.append(F.last(f"_sl_{c}", True).over(_chunk_window(s)).alias(f"_cl_{c}"))
    local = df.select(*sel)
    carry = local.groupBy(*s.part).agg(*summ_aggs).select(*s.part, *carry_sel)
    out = local.join(carry, s.part, "inner")
    res = [F.when(F.col(f"_wl_{c}").isNotNull(), F.col(f"_wl_{c}")["v"])
           .otherwise(F.col(f"_cl_{c}")["v"]).alias(f"{c}{suffix}") for c in cols]
    return out.select(F.col("*"), *res).drop(*[f"_wl_{c}" for c in cols], *[f"_cl_{c}" for c in cols])


_PARTIAL = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count}
_COMBINE = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.sum}


def entity_aggs(df: DataFrame, s: Seq, specs: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Attach entity-level aggregates (name, kind, expr), kind in min/max/sum/count.

    Aggregated per (entity, chunk) first, combined over the chunk rows of the
    entity, and joined back on (keys, chunk): never a window or shuffle keyed
    by the entity alone over row data."""
    partial = df.groupBy(*s.part).agg(*[_PARTIAL[k](e).alias(n) for n, k, e in specs])
    we = Window.partitionBy(*s.keys)
    per_chunk = partial.select(*s.part, *[_COMBINE[k](n).over(we).alias(n) for n, k, _ in specs])
    return df.join(per_chunk, s.part, "inner")


def index_and_aggs(df: DataFrame, s: Seq, specs: Sequence[tuple[str, str, Column]],
                   idx: str = "_idx") -> DataFrame:
    """``row_index`` and ``entity_aggs`` in one pass: one per-chunk summary
    carries both the row offset of the chunk and the entity-level facts."""
    local = df.withColumn("_lrn", F.row_number().over(_ordered(s)) - 1)
    partial = local.groupBy(*s.part).agg(F.count(F.lit(1)).alias("_n"),
                                         *[_PARTIAL[k](e).alias(n) for n, k, e in specs])
    we = Window.partitionBy(*s.keys)
    carry = partial.select(*s.part, F.coalesce(F.sum("_n").over(_chunk_window(s)), F.lit(0)).alias("_off"),
                           *[_COMBINE[k](n).over(we).alias(n) for n, k, _ in specs])
    return (local.join(carry, s.part, "inner")
            .withColumn(idx, (F.col("_lrn") + F.col("_off")).cast("long"))
            .drop("_lrn", "_off"))


def trailing_frame(df: DataFrame, keys: Sequence[str], idx: str, k: int,
                   build: Callable[[Window], dict[str, Column]], width: int = GRID_CHUNK) -> DataFrame:
    """Evaluate expressions over the frame of the k rows ending at each row.

    ``idx`` is a gap-free 0-based row index per entity (``row_index``). Rows
    are partitioned by (keys, idx div width); the last k-1 rows of each chunk
    are copied into the next chunk as read-only halo rows so frames that cross
    a chunk border see their predecessors. ``build`` receives the ordered
    window (partition + order, no frame) and returns named columns; it must
    reach back at most k-1 rows."""
    h = k - 1
    if width <= h:
        raise ValueError("chunk width must exceed the frame length")
    shift = F.explode(F.when((F.col(idx) % width) >= width - h, F.array(F.lit(0), F.lit(1)))
                      .otherwise(F.array(F.lit(0))))
    x = df.withColumn("_halo", shift)
    x = x.withColumn("_hchunk", F.floor(F.col(idx) / width) + F.col("_halo"))
    w = Window.partitionBy(*keys, "_hchunk").orderBy(idx)
    cols = build(w)
    return (x.select(F.col("*"), *[v.alias(n) for n, v in cols.items()])
            .filter(F.col("_halo") == 0).drop("_halo", "_hchunk"))


_RUN = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count}
_RUN_COMBINE = {"min": F.least, "max": F.greatest}


def prefix_aggs(df: DataFrame, s: Seq, specs: Sequence[tuple[str, str, Column]],
                inclusive: bool = True, totals: Mapping[str, str] | None = None) -> DataFrame:
    """Running aggregates along each entity (kind min/max/sum/count), over the
    rows up to and including (``inclusive``) or strictly before the row.
    ``totals`` (spec name -> column) adds an entity's whole aggregates, which the
    per-chunk summary holds anyway.

    Within a chunk a running window; across chunks the totals of the earlier
    chunks (one row per chunk) are combined in chunk order and joined back."""
    frame = _ordered(s).rowsBetween(UNB, CUR if inclusive else -1)
    local = df.select(F.col("*"), *[_RUN[k](e).over(frame).alias(f"_rl_{n}") for n, k, e in specs])
    summ = local.groupBy(*s.part).agg(*[_RUN[k](e).alias(f"_rt_{n}") for n, k, e in specs])
    cw = _chunk_window(s)
    kind = {n: k for n, k, _ in specs}
    whole = [_COMBINE[kind[n]](f"_rt_{n}").over(Window.partitionBy(*s.keys)).alias(out) for n, out in (totals or {}).items()]
    carry = summ.select(*s.part, *[(_COMBINE[k](f"_rt_{n}")).over(cw).alias(f"_rc_{n}") for n, k, _ in specs], *whole)
    out = local.join(carry, s.part, "inner")
    res = []
    for n, k, _ in specs:
        a, b = F.col(f"_rl_{n}"), F.col(f"_rc_{n}")
        if k in ("sum", "count"):
            res.append((F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))).alias(n) if k == "count"
                       else F.when(a.isNull() & b.isNull(), None).otherwise(
                           F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))).alias(n))
        else:
            res.append(_RUN_COMBINE[k](a, b).alias(n))
    drop = [f"_rl_{n}" for n, _, _ in specs] + [f"_rc_{n}" for n, _, _ in specs]
    return out.select(F.col("*"), *res).drop(*drop)


def range_chunks(df: DataFrame, order: Sequence[str], chunk: str) -> DataFrame:
    """Add ``chunk``, the number of the range partition of each row in the
    order of the columns ``order``: partitions of about equal row counts,
    whatever the columns' types and value spread. The rows are written first,
    so that finding the range borders does not run the upstream twice, and
    written again with their chunk, which so is fixed for every reader."""
    x = materialize(df, "ranked")
    return materialize(x.repartitionByRange(*order).withColumn(chunk, F.spark_partition_id().cast("long")), "ranges")


def global_index(df: DataFrame, order: str, out: str = "_gidx", total: str | None = None) -> DataFrame:
    """0-based rank of each row in the total order of ``order`` (unique, any
    orderable type), without a single-partition window over the rows: rows are
    cut into range partitions; only the per-partition counts are ordered
    globally."""
    return row_index(range_chunks(df, [order], "_gchunk"), Seq((), order, "_gchunk"), out, total).drop("_gchunk")


def salted_join(rows: DataFrame, facts: DataFrame, keys: Sequence[str], spread: str, count: str = "_n",
                share: int = 1000) -> DataFrame:
    """Inner join of rows to one-row-per-key ``facts`` that does not put all
    rows of a hot key into one task. ``facts`` carries each key's row count in
    column ``count``: a key with more than 1/``share`` of all rows is hot, so
    there are fewer than ``share`` of them, and only these are broadcast, with
    the number of copies that brings each copy under that size. Rows of a hot
    key are dealt over its copies by a hash of the column ``spread``; all other
    keys stay single."""
    total = facts.agg(F.sum(count)).first()[0] or 0
    size = max(1.0, total / share)
    hot = facts.filter(F.col(count) > size).select(*keys, F.ceil(F.col(count) / size).cast("int").alias("_salts"))
    f = facts.withColumn("_salts", F.when(F.col(count) > size, F.ceil(F.col(count) / size)).otherwise(1).cast("int"))
    f = f.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop(count, "_salts")
    x = rows.join(F.broadcast(hot), list(keys), "left").withColumn(
        "_salt", F.pmod(F.xxhash64(spread), F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts")
    return x.join(f, [*keys, "_salt"], "inner").drop("_salt")


def depth_chunks(df: DataFrame, s: Seq, target: int = 1 << 16) -> DataFrame:
    """Add ``s.chunk`` for orderings whose density is unknown (raw event
    times): no chunk holds more than ``target`` rows, however hot an entity and
    however dense a burst inside it.

    Rows are counted per entity first. An entity of at most ``target`` rows is
    one chunk. The rows of the others are range-partitioned and sorted by (keys,
    order), written once, and cut every ``target`` rows of that order: chunks of
    equal depth, as many and in as many partitions as the rows need; the scans
    carry an entity's state on. ``df`` is read once for the counts and again by
    each scan, so let it be a table or written rows."""
    large = materialize(df.groupBy(*s.keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > target).select(
        *[F.col(k).alias(f"_large_{k}") for k in s.keys]), "large")
    if large.isEmpty():
        return df.withColumn(s.chunk, F.lit(0).cast("long"))
    on = [F.col(k).eqNullSafe(F.col(f"_large_{k}")) for k in s.keys]
    by = [*s.keys, s.order]
    x = df.join(large, on, "left_semi").repartitionByRange(*by).sortWithinPartitions(*by)
    # partition number and place in it, in one growing number
    x = materialize(x.withColumn(s.chunk, F.expr(f"monotonically_increasing_id() div {int(target)}")), "chunks")
    return df.join(large, on, "left_anti").withColumn(s.chunk, F.lit(0).cast("long")).unionByName(x)

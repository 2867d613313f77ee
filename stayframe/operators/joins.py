"""Join operators the DataFrame API lacks or gets subtly wrong."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayframe.functions.columns import bin_index
from stayframe.operators.seq import GRID_CHUNK, Seq


def not_in(left: DataFrame, right: DataFrame, lkey: str, rkey: str) -> DataFrame:
    """SQL ``lkey NOT IN (SELECT rkey FROM right)`` with its null semantics:
    any null in the list gives no rows, a null left key never qualifies, and
    an empty list keeps every row, null keys too.

    Spark plans NOT IN as a null-aware anti join that broadcasts the list;
    here one aggregate counts the list and its nulls, the list is de-duplicated,
    and the anti join itself is an ordinary (shuffled or adaptive-broadcast) join,
    so the list may be as large as the data."""
    r = right.select(F.col(rkey).alias("_nk"))
    listed = r.agg(F.count(F.lit(1)).alias("n"), F.count("_nk").alias("k")).first()
    if not listed["n"]:
        return left
    if listed["n"] > listed["k"]:
        return left.filter(F.lit(False))
    r = r.distinct()
    return left.filter(F.col(lkey).isNotNull()).join(r, F.col(lkey) == F.col("_nk"), "left_anti")


def membership_flag(df: DataFrame, ids: DataFrame, key: str, id_key: str, out: str) -> DataFrame:
    """0/1 column: does ``key`` occur among ``ids[id_key]`` (left join to the
    distinct ids; null -> 0)."""
    m = ids.select(F.col(id_key).alias(key)).distinct().withColumn(out, F.lit(1))
    return df.join(m, key, "left").fillna(0, [out])


def time_band_join(grid: DataFrame, anchors: DataFrame, keys: Sequence[str], start: str, t: str,
                   before_hours: float, after_hours: float) -> DataFrame:
    """Grid rows whose ``start`` lies in [t - before, t + after] around the
    entity's anchor time ``t`` (closed both ends); inner join on keys with a
    band residual."""
    lo = F.col(t) - F.expr(f"INTERVAL '{int(round(before_hours * 3600))}' SECOND")
    hi = F.col(t) + F.expr(f"INTERVAL '{int(round(after_hours * 3600))}' SECOND")
    j = grid.join(anchors, list(keys), "inner")
    return j.filter((F.col(start) >= lo) & (F.col(start) <= hi))


def chunk_join(rows: DataFrame, facts: DataFrame, s: Seq, lo: Column, hi: Column, how: str = "inner",
               width: int = GRID_CHUNK) -> DataFrame:
    """Join a chunked grid to one-row-per-entity ``facts`` by (entity, chunk):
    the facts are listed under the chunks of the positions ``lo`` to ``hi`` they
    can touch (none if ``hi`` is below ``lo``). Both sides meet on the
    partitioning that ordered operators use, so a hot entity is spread over its
    chunks, and chunks outside the range match nothing."""
    first, last = F.greatest(F.floor(lo / width), F.lit(0)).cast("long"), F.floor(hi / width).cast("long")
    touched = F.explode(F.when((hi >= lo) & (last >= first), F.sequence(first, last)))
    return rows.join(facts.withColumn(s.chunk, touched), s.part, how)


def band_chunk_join(grid: DataFrame, anchors: DataFrame, s: Seq, start: str, t: str, before_hours: float, after_hours: float,
                    origin: str, width_hours: float) -> DataFrame:
    """``time_band_join`` for a grid of ``width_hours`` bins in chunks: anchors
    carry the entity's ``origin``, so the band's bins, and with them the chunks it
    can touch, are known before the join."""
    lo = F.col(t) - F.expr(f"INTERVAL '{int(round(before_hours * 3600))}' SECOND")
    hi = F.col(t) + F.expr(f"INTERVAL '{int(round(after_hours * 3600))}' SECOND")
    a = anchors.withColumns({"_lo": lo, "_hi": hi})
    bins = [bin_index(c, origin, width_hours) for c in ("_lo", "_hi")]
    j = chunk_join(grid, a, s, *bins)
    return j.filter((F.col(start) >= F.col("_lo")) & (F.col(start) <= F.col("_hi"))).drop("_lo", "_hi", origin)


def outer_merge_pivot(long: DataFrame, keys: Sequence[str], param: str, value: str,
                      params: Sequence[str] | None = None) -> DataFrame:
    """N-way full outer merge of per-parameter tables that share ``keys``,
    done as one union of long rows and one pivot (no chain of N full outer
    joins; the result does not depend on the order of the inputs). Columns are
    the parameters of the data, in order, or the given ones; more of them than
    ``spark.sql.pivotMaxValues`` fail the job. (keys, param) must be unique in ``long``: a repeated cell
    fails the job instead of losing a row; ``outer_merge`` multiplies such rows."""
    cell = long.groupBy(*keys, param).agg(F.first(value).alias("_v"), F.count(F.lit(1)).alias("_n"))
    once = F.when(F.col("_n") == 1, F.col("_v")).otherwise(
        F.raise_error(F.lit("outer_merge_pivot: repeated (keys, param); use outer_merge")))
    return cell.withColumn("_v", once).groupBy(*keys).pivot(param, list(params) if params is not None else None).agg(F.first("_v"))


def outer_merge(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """N-way full outer merge by chained null-safe joins: null keys match null
    keys, and repeated keys give every combination of their rows."""
    out = tables[0]
    for t in tables[1:]:
        out = null_safe_join(out, t, keys, "full")
    return out


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "full") -> DataFrame:
    """Join on keys where null matches null (pandas merge semantics), keys coalesced."""
    l = left.select(*[F.col(c).alias(f"_l_{c}") if c in keys else F.col(c) for c in left.columns])
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = F.col(f"_l_{k}").eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    j = l.join(r, cond, how)
    keep = [F.coalesce(F.col(f"_l_{k}"), F.col(f"_r_{k}")).alias(k) for k in keys]
    rest = [c for c in j.columns if not (c.startswith("_l_") or c.startswith("_r_"))]
    return j.select(*keep, *rest)

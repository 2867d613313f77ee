"""Training-history analysis: early-stopping replay, history explode, comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayframe.operators.seq import Seq


def early_stop(df: DataFrame, s: Seq, loss: str, patience: int = 20) -> DataFrame:
    """Replay an early-stopping rule over each experiment's epochs, the rows
    of the experiment in ``s.order`` (epoch = 0-based row position): the
    first epoch sets the reference; an epoch whose loss is <= every earlier
    loss resets the counter; training stops at the first epoch with
    epoch - last_reset >= patience. The kept model is the first epoch that
    reaches the minimum up to the stop.

    The last reset at or before epoch e is the latest epoch attaining the
    running minimum, so one chunked prefix pass carries (minimum, latest
    epoch) and (minimum, first epoch); a final partial aggregate per
    experiment picks the stop. An epoch without a loss (null) neither resets
    the counter nor becomes the best one; before the first loss nothing stops. Returns n_epochs, stop_epoch (null: never
    stopped), best_epoch, best_loss."""
    w = Window.partitionBy(*s.part).orderBy(s.order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    lv = F.col(loss)

    def at(epoch, value=lv, name="e"):          # (loss, epoch); null without a loss
        return F.when(value.isNotNull(), F.struct(value.alias("l"), epoch.alias(name)))

    x = df.withColumn("_lrn", F.row_number().over(w) - 1)
    x = x.withColumn("_rl", F.min(at(-F.col("_lrn"))).over(upto))
    x = x.withColumn("_rf", F.min(at(F.col("_lrn"))).over(upto))
    summ = x.groupBy(*s.part).agg(F.count(F.lit(1)).alias("_n"),
                                  F.min(at(-F.col("_lrn"))).alias("_cl"),
                                  F.min(at(F.col("_lrn"))).alias("_cf"))
    prev = Window.partitionBy(*s.keys).orderBy(s.chunk).rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("_off", F.coalesce(F.sum("_n").over(prev), F.lit(0)))
    summ = summ.select(*s.part, "_off",
                       at(F.col("_cl.e") - F.col("_off"), F.col("_cl.l")).alias("_gl"),
                       at(F.col("_cf.e") + F.col("_off"), F.col("_cf.l")).alias("_gf"))
    carry = summ.select(*s.part, "_off", F.min("_gl").over(prev).alias("_kl"), F.min("_gf").over(prev).alias("_kf"))
    y = x.join(carry, s.part, "inner")
    ep = F.col("_lrn") + F.col("_off")
    run_last = F.least(at(F.col("_rl.e") - F.col("_off"), F.col("_rl.l")), F.col("_kl"))
    run_first = F.least(at(F.col("_rf.e") + F.col("_off"), F.col("_rf.l")), F.col("_kf"))
    y = y.select(*s.keys, ep.alias("_ep"), lv.alias("_loss"), run_first.alias("_best"),
                 (ep + run_last["e"]).alias("_gap"))
    g = y.groupBy(*s.keys).agg(
        F.count(F.lit(1)).alias("n_epochs"),
        F.min(F.when(F.col("_gap") >= patience, F.struct(F.col("_ep").alias("e"), F.col("_best").alias("b")))).alias("_stop"),
        F.min(at(F.col("_ep"), F.col("_loss"))).alias("_all"))
    best = F.coalesce(F.col("_stop.b"), F.col("_all"))
    return g.select(*s.keys, "n_epochs", F.col("_stop.e").alias("stop_epoch"), best["e"].alias("best_epoch"),
                    best["l"].alias("best_loss"))


def history_long(df: DataFrame, keys: Sequence[str], array_cols: dict[str, str], offset: str | None = None,
                 settings: Sequence[str] = ()) -> DataFrame:
    """Explode list-valued history columns into (keys, settings, type, epoch,
    value) rows; ``array_cols`` maps a type name to its array column. The
    epoch is the array position plus ``offset`` (for histories stored in
    bounded pieces). All arrays are zipped and exploded in one pass, so the
    input is read once whatever the number of types; per-epoch histories
    have equal lengths (a shorter array would yield null values)."""
    zipped = F.arrays_zip(*[F.col(c) for c in array_cols.values()])
    x = df.select(*keys, *settings, *([offset] if offset else []), F.posexplode(zipped).alias("pos", "z"))
    per_type = F.explode(F.array(*[F.struct(F.lit(t).alias("type"), F.col("z")[c].alias("value"))
                                   for t, c in array_cols.items()]))
    x = x.select(*keys, *settings, (F.col("pos") + (F.col(offset) if offset else F.lit(0))).cast("long").alias("epoch"),
                 per_type.alias("t"))
    return x.select(*keys, *settings, F.col("t.type").alias("type"), "epoch", F.col("t.value").alias("value"))


def compare_settings(df: DataFrame, var1: str, var2: str, metrics: Sequence[str]) -> DataFrame:
    """Mean of each metric per (var1, var2) setting pair."""
    return df.groupBy(var1, var2).agg(*[F.avg(m).alias(m) for m in metrics], F.count(F.lit(1)).alias("n_runs"))


def experiment_key(settings: Sequence[str], n: int = 6) -> F.Column:
    """Short hex key of a settings record: first n hex digits of sha1(JSON)."""
    return F.substring(F.sha1(F.to_json(F.struct(*[F.col(c) for c in settings]))), 1, n)

"""Exact classification metrics as aggregations.

Scores are first reduced to one row per distinct score (positives,
negatives) with partial aggregation; cumulative counts over the score order
use the chunked prefix scan (``seq.prefix_aggs``) over range partitions of the
scores, so no step puts all rows, or all distinct scores, in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayframe.operators.seq import Seq, prefix_aggs, range_chunks


def score_table(df: DataFrame, score: str, label: str, groups: Sequence[str] = (),
                bounded_groups: bool = False) -> DataFrame:
    """(groups, score) -> pos, neg, plus the counts of strictly lower scores
    (pos_below, neg_below) and of all (P, N) within the group. ``bounded_groups`` declares that
    every group is small (e.g. fixed-size batches): a plain window per group
    then replaces the chunked prefix scan."""
    t = df.groupBy(*groups, score).agg(F.sum(F.col(label).cast("long")).alias("pos"),
                                       F.sum((1 - F.col(label)).cast("long")).alias("neg"))
    if bounded_groups and groups:
        w = Window.partitionBy(*groups).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
        every = Window.partitionBy(*groups)
        return t.select("*", F.coalesce(F.sum("pos").over(w), F.lit(0)).alias("pos_below"),
                        F.coalesce(F.sum("neg").over(w), F.lit(0)).alias("neg_below"),
                        F.sum("pos").over(every).alias("P"), F.sum("neg").over(every).alias("N"))
    s = Seq(tuple(groups), score, "_schunk")
    t = range_chunks(t, [*groups, score], s.chunk)
    t = prefix_aggs(t, s, [("pos_below", "sum", F.col("pos")), ("neg_below", "sum", F.col("neg"))],
                    inclusive=False, totals={"pos_below": "P", "neg_below": "N"})
    return t.fillna(0, ["pos_below", "neg_below"]).drop("_schunk")


def _auc_expr() -> Column:
    p, n = F.sum("pos"), F.sum("neg")
    num = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
    return F.when((p > 0) & (n > 0), num / (p * n))


def roc_auc(df: DataFrame, score: str, label: str, groups: Sequence[str] = (),
            bounded_groups: bool = False) -> DataFrame:
    """Exact ROC-AUC with ties counted half (Mann-Whitney); null for one class."""
    t = score_table(df, score, label, groups, bounded_groups)
    return t.groupBy(*groups).agg(_auc_expr().alias("auc"), F.sum("pos").alias("n_pos"),
                                  F.sum("neg").alias("n_neg"))


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    """Step-wise AP = sum over distinct thresholds of (R_n - R_{n-1}) * P_n."""
    t = score_table(df, score, label)
    tp = F.col("P") - F.col("pos_below")
    fp = F.col("N") - F.col("neg_below")
    return t.agg(F.when(F.first("P") > 0, F.sum(F.col("pos") * tp / (tp + fp)) / F.first("P"))
                 .alias("average_precision"))


def pr_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """Precision and recall at every distinct threshold, plus the (recall 0,
    precision 1) end point with a null threshold."""
    t = score_table(df, score, label)
    tp = F.col("P") - F.col("pos_below")
    fp = F.col("N") - F.col("neg_below")
    pts = t.select(F.col(score).cast("double").alias("threshold"),
                   F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0).alias("precision"),
                   F.when(F.col("P") > 0, tp / F.col("P")).otherwise(1.0).alias("recall"))
    end = df.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return pts.unionByName(end)


def confusion(y: str, pred: str) -> list[Column]:
    """Aggregates tn, fp, fn, tp (0/1 labels and predictions)."""
    yy, pp = F.col(y), F.col(pred)
    c = lambda cond: F.sum(cond.cast("long"))
    return [c((yy == 0) & (pp == 0)).alias("tn"), c((yy == 0) & (pp == 1)).alias("fp"),
            c((yy == 1) & (pp == 0)).alias("fn"), c((yy == 1) & (pp == 1)).alias("tp")]


def _div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def scores_from_confusion(cm: DataFrame) -> DataFrame:
    """Accuracy, support-weighted precision/recall/F1, specificity,
    sensitivity, PPV and NPV from a tn/fp/fn/tp table (zero denominators -> 0)."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    f1 = _div(2 * p1 * r1, p1 + r1)
    f0 = _div(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp
    return cm.select("*", _div(tp + tn, n).alias("accuracy"),
                     _div(p0 * s0 + p1 * s1, n).alias("precision_weighted"),
                     _div(r0 * s0 + r1 * s1, n).alias("recall_weighted"),
                     _div(f0 * s0 + f1 * s1, n).alias("f1_weighted"),
                     r0.alias("specificity"), r1.alias("sensitivity"), p1.alias("ppv"), p0.alias("npv"))


def class_report(cm: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Per-class precision, recall, F1, support, plus macro and weighted
    averages: one projection of the tn/fp/fn/tp row, unpivoted with ``stack``."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    f1 = _div(2 * p1 * r1, p1 + r1)
    f0 = _div(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp
    vals = {"p0": p0, "r0": r0, "f0": f0, "s0": s0, "p1": p1, "r1": r1, "f1": f1, "s1": s1,
            "pm": (p0 + p1) / 2, "rm": (r0 + r1) / 2, "fm": (f0 + f1) / 2, "n": n,
            "pw": _div(p0 * s0 + p1 * s1, n), "rw": _div(r0 * s0 + r1 * s1, n), "fw": _div(f0 * s0 + f1 * s1, n)}
    wide = cm.select(*group_cols, *[v.alias(k) for k, v in vals.items()])
    stack = ("stack(4, '0', p0, r0, f0, s0, '1', p1, r1, f1, s1, 'macro avg', pm, rm, fm, n, "
             "'weighted avg', pw, rw, fw, n) AS (class, precision, recall, f1, support)")
    return wide.selectExpr(*[f"`{c}`" for c in group_cols], stack)

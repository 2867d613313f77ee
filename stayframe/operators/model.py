"""Weighted classifiers on flattened windows: logistic regression and boosted
trees (``pyspark.ml``), and an epoch-wise sweep with a training history (the
sequence network of the reference is re-aimed here).

Rows carry their features as one array column. ``train_epochs`` trains all
settings of a sweep in the same pass over the rows: per epoch one job in which
every task turns its Arrow batches into matrices, multiplies them by the current
coefficients of all settings and adds up gradients and losses; these are summed
by position before they reach the driver, so what it gets has the size of the
coefficients, whatever the number of rows or tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODELS = ("logistic", "boosted_trees")


def with_class_weight(df: DataFrame, label: str, pos_weight: float, out: str = "w") -> DataFrame:
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(pos_weight))).otherwise(F.lit(1.0)))


def _vectors(df: DataFrame, features: str) -> DataFrame:
    """Features as a vector; a missing one counts as 0."""
    return df.withColumn("_x", array_to_vector(F.transform(features, lambda v: F.coalesce(v, F.lit(0.0)))))


def fit(train: DataFrame, features: str, label: str, model: str = "logistic", pos_weight: float = 50.0, reg: float = 0.01,
        iters: int = 200, trees: int = 20, depth: int = 3, bins: int = 32, seed: int = 7):
    """A fitted ``pyspark.ml`` model; positives weigh ``pos_weight``. Logistic
    regression has a ridge of ``reg`` on the features as given, so its optimum is
    one point; boosted trees take ``trees`` rounds of trees of ``depth`` over
    ``bins`` thresholds a feature. Train rows that are read many times should be
    a written table."""
    common = {"featuresCol": "_x", "labelCol": label, "weightCol": "_w"}
    if model == "logistic":
        est = LogisticRegression(**common, regParam=reg, maxIter=iters, tol=1e-10, standardization=False)
    elif model == "boosted_trees":
        est = GBTClassifier(**common, maxIter=trees, maxDepth=depth, maxBins=bins, stepSize=0.1, seed=seed)
    else:
        raise ValueError(f"model must be one of {MODELS}, not {model!r}")
    return est.fit(_vectors(with_class_weight(train, label, pos_weight, "_w"), features))


def _sigmoid(coef: Column, intercept: Column, x: str) -> Column:
    """Probability of label 1 of the array column ``x``; a missing feature counts as 0."""
    z = F.aggregate(F.zip_with(x, coef, lambda a, b: F.coalesce(a, F.lit(0.0)) * b), intercept, lambda s, v: s + v)
    return 1 / (1 + F.exp(-z))


def predict(model, df: DataFrame, features: str, out: str = "score") -> DataFrame:
    """``df`` with the probability of label 1."""
    if isinstance(model, LogisticRegressionModel):      # a column expression; the model object carries its training table
        coef = F.array(*[F.lit(float(c)) for c in model.coefficients])
        return df.withColumn(out, _sigmoid(coef, F.lit(float(model.intercept)), features))
    pred = model.transform(_vectors(df, features))
    return pred.withColumn(out, vector_to_array("probability")[1]).drop("_x", "rawPrediction", "probability", "prediction")


def save(model, path: str) -> None:
    """The fitted model as a one-stage pipeline (the best-model checkpoint)."""
    PipelineModel([model]).write().overwrite().save(path)


def weighted_gradient(model, train: DataFrame, features: str, label: str, pos_weight: float = 50.0) -> DataFrame:
    """(feature, gradient) of the ridge logistic objective at the fitted
    coefficients, feature -1 being the intercept: the mean of weight * (p - y) * x
    plus the ridge's part. All are zero at the optimum and nowhere else."""
    scored = predict(model, with_class_weight(train, label, pos_weight, "_w"), features, "_p")
    r = (F.col("_w") * (F.col("_p") - F.col(label))).alias("_r")
    x = F.concat(F.array(F.lit(1.0)), F.col(features))
    parts = scored.select("_w", r, F.posexplode(x).alias("pos", "x"))
    ridge = F.array(*[F.lit(0.0), *[F.lit(float(c * model.getRegParam())) for c in model.coefficients]])
    return parts.groupBy("pos").agg((F.sum(F.col("_r") * F.col("x")) / F.sum("_w")).alias("g")).select(
        (F.col("pos") - 1).alias("feature"), (F.col("g") + F.get(ridge, F.col("pos"))).alias("gradient"))


def root_split(model, train: DataFrame, features: str, label: str, pos_weight: float = 50.0) -> DataFrame:
    """(gain, leaf_gap) of the first boosted tree on its training rows: the drop
    in weighted variance of the labels -1 and 1 at its root, and the largest
    distance between a leaf's value and the weighted mean label of its rows."""
    tree = model.trees[0]
    root = tree._call_java("rootNode")
    rows = _vectors(with_class_weight(train, label, pos_weight, "_w"), features).withColumn("_y", 2.0 * F.col(label) - 1.0)
    side = F.lit(0)
    if tree.numNodes > 1:
        split = root.split()
        side = (F.get(F.col(features), F.lit(split.featureIndex())) <= F.lit(split.threshold())).cast("int")
    moments = [F.sum("_w").alias("w"), F.sum(F.col("_w") * F.col("_y")).alias("s")]
    sides = rows.groupBy(side.alias("side")).agg(*moments)
    # labels are -1 or 1, so a weighted variance is 1 - mean^2
    inner = sides.agg(F.sum("w").alias("w"), F.sum("s").alias("s"), F.sum(F.col("w") - F.col("s") * F.col("s") / F.col("w")).alias("rest"))
    gain = inner.select((1 - F.pow(F.col("s") / F.col("w"), 2) - F.col("rest") / F.col("w")).alias("gain"))
    leaves = tree.setLeafCol("_leaf").setFeaturesCol("_x").setPredictionCol("_value").transform(rows).groupBy("_leaf", "_value").agg(*moments)
    gap = leaves.agg(F.max(F.abs(F.col("s") / F.col("w") - F.col("_value"))).alias("leaf_gap"))
    return gain.withColumn("_k", F.lit(1)).join(gap.withColumn("_k", F.lit(1)), "_k").drop("_k")


# ---- epoch-wise training -------------------------------------------------------------------------

@dataclass
class Run:
    """One setting of a sweep while it trains."""
    setting: int
    rate: float
    reg: float
    coef: np.ndarray                       # the intercept last
    best: np.ndarray = field(default_factory=lambda: np.zeros(0))
    best_epoch: int | None = None
    best_loss: float | None = None
    low: float | None = None               # loss that the next one is held against
    since: int = 0
    stop_epoch: int | None = None

    def see(self, epoch: int, loss: float, patience: int) -> None:
        """A loss at most the last reset's resets the counter; a lower one than
        any so far keeps the coefficients it was measured with."""
        if self.low is None or loss <= self.low:
            self.low, self.since = loss, 0
        else:
            self.since += 1
        if self.best_loss is None or loss < self.best_loss:
            self.best, self.best_epoch, self.best_loss = self.coef.copy(), epoch, loss
        if self.since >= patience:
            self.stop_epoch = epoch


def _pass(rows: DataFrame, coef: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One pass over (train, y, w, x): gradients [settings, features + 1] of the
    train rows, and weighted losses and weights [settings, (valid, train)]."""
    k, width = coef.shape

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * width + 2 * k + 2)
        for b in batches:
            if not b.num_rows:
                continue
            train = b.column(0).to_numpy(zero_copy_only=False).astype(float)
            y, w = b.column(1).to_numpy(), b.column(2).to_numpy()
            x = np.hstack([b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, width - 1), np.ones((b.num_rows, 1))])
            z = x @ coef.T
            loss = (np.logaddexp(0, z) - y[:, None] * z) * w[:, None]
            p = 1 / (1 + np.exp(-z))
            total[:k * width] += (((p - y[:, None]) * (w * train)[:, None]).T @ x).ravel()
            total[k * width:k * width + k] += ((1 - train)[:, None] * loss).sum(axis=0)
            total[k * width + k:-2] += (train[:, None] * loss).sum(axis=0)
            total[-2:] += ((1 - train) * w).sum(), (train * w).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["pos", "v"])

    got = rows.select("train", "y", "w", "x").mapInArrow(each, "pos long, v double").groupBy("pos").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(k * width + 2 * k + 2)
    for r in got:                           # as many as there are coefficients and losses
        total[r["pos"]] = r["v"]
    losses = total[k * width:-2].reshape(2, k) / np.maximum(total[-2:], 1e-300)[:, None]
    return total[:k * width].reshape(k, width) / max(total[-1], 1e-300), losses, total[-2:]


def train_epochs(rows: DataFrame, n_features: int, rates: Sequence[float], regs: Sequence[float], max_epochs: int,
                 patience: int) -> tuple[list[Run], list[tuple]]:
    """A logistic model for every learning rate and ridge, trained together by
    full-gradient steps. ``rows`` (a written table) has train (true: fit, false:
    validation), y, w and x (array of numbers without nulls). Epoch 0 measures
    the zero model; each later epoch is one step from the last coefficients, and
    every setting stops by itself: ``patience`` epochs above the last reset.
    Returns the runs, each with the coefficients of its best epoch, and the
    history (setting, rate, reg, epoch, train_loss, val_loss): at most
    settings * epochs rows, fixed by the parameters."""
    runs = [Run(i, rate, reg, np.zeros(n_features + 1)) for i, (rate, reg) in enumerate((a, b) for a in rates for b in regs)]
    history: list[tuple] = []
    for epoch in range(max_epochs):
        active = [r for r in runs if r.stop_epoch is None]
        if not active:
            break
        gradients, (val, train), _ = _pass(rows, np.stack([r.coef for r in active]))
        for r, g, tl, vl in zip(active, gradients, train, val, strict=True):
            vl = round(float(vl), 9)        # sums differ in the last digits with the order of tasks
            history.append((r.setting, float(r.rate), float(r.reg), epoch, float(tl), vl))
            r.see(epoch, vl, patience)
            ridge = np.append(r.coef[:-1], 0.0) * r.reg
            r.coef = r.coef - r.rate * (g + ridge)
    return runs, history


def score_runs(rows: DataFrame, runs: Sequence[Run]) -> DataFrame:
    """``rows`` once for every run, with ``setting`` and the ``score`` of its best
    coefficients, as native column expressions."""
    per = [F.struct(F.lit(r.setting).alias("setting"), F.lit(float(r.best[-1])).alias("b"),
                    F.array(*[F.lit(float(v)) for v in r.best[:-1]]).alias("c")) for r in runs]
    x = rows.withColumn("_run", F.explode(F.array(*per)))
    return x.withColumn("setting", F.col("_run.setting")).withColumn(
        "score", _sigmoid(F.col("_run.c"), F.col("_run.b"), "x")).drop("_run")

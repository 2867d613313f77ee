"""Weighted classifiers and the epoch-wise sweep against plain computations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayframe.operators import model as M
from stayframe.operators.history import early_stop
from stayframe.operators.seq import seq, with_chunk
from stayframe.plans import q_models

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    y = (x @ [1.5, -1, 0.5, 0, 0] + rng.normal(size=400) > 1).astype(float)
    train = rng.random(400) < 0.7
    w = np.where(y == 1, 5.0, 1.0)
    df = spark.createDataFrame([(i, bool(t), float(a), float(b), [float(v) for v in r])
                                for i, (t, a, b, r) in enumerate(zip(train, y, w, x))],
                               "id long, train boolean, y double, w double, x array<double>").repartition(3).cache()
    return df, x, y, w, train


def _loss(c, x, y, w):
    z = x @ c[:-1] + c[-1]
    return float((w * (np.logaddexp(0, z) - y * z)).sum() / w.sum())


def test_epochs_equal_plain_gradient_descent(spark, rows):
    df, x, y, w, train = rows
    runs, history = M.train_epochs(df, 5, (1.0, 0.1), (0.0, 0.05), 12, 3)
    assert [(r.rate, r.reg) for r in runs] == [(1.0, 0.0), (1.0, 0.05), (0.1, 0.0), (0.1, 0.05)]
    for run in runs:
        c = np.zeros(6)
        for s, _, _, epoch, tl, vl in [h for h in history if h[0] == run.setting]:
            assert tl == pytest.approx(_loss(c, x[train], y[train], w[train]), abs=1e-8)
            assert vl == pytest.approx(_loss(c, x[~train], y[~train], w[~train]), abs=1e-8)
            if epoch == run.best_epoch:
                assert np.allclose(run.best, c) and run.best_loss == vl
            a = np.hstack([x[train], np.ones((train.sum(), 1))])
            p = 1 / (1 + np.exp(-a @ c))
            c = c - run.rate * (a.T @ (w[train] * (p - y[train])) / w[train].sum() + np.append(c[:-1], 0) * run.reg)
    # longer training goes on from the same steps, and helps
    _, longer = M.train_epochs(df, 5, (1.0,), (0.0,), 30, 30)
    assert np.allclose([h[3:] for h in longer[:12]], [h[3:] for h in history if h[0] == 0]) and longer[-1][5] < longer[0][5]


def test_online_stop_equals_the_replay(spark, rows):
    df = rows[0]
    runs, history = M.train_epochs(df, 5, (60.0, 8.0, 0.5), (0.0, 0.3), 25, 3)
    h = spark.createDataFrame(history, q_models.HISTORY_SCHEMA)
    s = seq("setting", "epoch")
    got = {r.setting: (r.stop_epoch, r.best_epoch, r.best_loss) for r in early_stop(with_chunk(h, s, 4), s, "val_loss", 3).collect()}
    assert got == {r.setting: (r.stop_epoch, r.best_epoch, r.best_loss) for r in runs}
    assert any(r.stop_epoch is not None for r in runs) and any(r.stop_epoch is None for r in runs)


def test_scores_of_the_kept_coefficients(spark, rows):
    df, x, *_ = rows
    runs, _ = M.train_epochs(df, 5, (0.5, 0.1), (0.0,), 4, 9)
    got = M.score_runs(df, runs).select("id", "setting", "score").collect()
    assert len(got) == 800
    for r in got:
        c = runs[r.setting].best
        assert r.score == pytest.approx(1 / (1 + np.exp(-(x[r.id] @ c[:-1] + c[-1]))))


def test_gradient_is_zero_at_the_optimum_only(spark, rows):
    df = rows[0]
    best = M.fit(df, "x", "y", pos_weight=5.0)
    early = M.fit(df, "x", "y", pos_weight=5.0, iters=1)
    g = {r.feature: r.gradient for r in M.weighted_gradient(best, df, "x", "y", 5.0).collect()}
    assert sorted(g) == list(range(-1, 5)) and max(map(abs, g.values())) < 1e-5
    assert max(abs(r.gradient) for r in M.weighted_gradient(early, df, "x", "y", 5.0).collect()) > 1e-3
    # other weights have another optimum
    assert max(abs(r.gradient) for r in M.weighted_gradient(best, df, "x", "y", 50.0).collect()) > 1e-2


def test_boosted_trees(spark, rows):
    df, x, y, w, _ = rows
    m = M.fit(df, "x", "y", "boosted_trees", 5.0, trees=10, bins=512)
    s = 2 * y - 1
    gains = []
    for j in range(5):
        for t in np.unique(x[:, j])[:-1]:
            left = x[:, j] <= t
            rest = sum(w[k].sum() * (1 - (np.average(s[k], weights=w[k])) ** 2) for k in (left, ~left))
            gains.append(1 - np.average(s, weights=w) ** 2 - rest / w.sum())
    r = M.root_split(m, df, "x", "y", 5.0).first()
    assert r.gain == pytest.approx(max(gains)) and r.leaf_gap < 1e-9
    scored = M.predict(m, df, "x").collect()
    hit = np.average([(q.score > 0.5) == q.y for q in scored], weights=[q.w for q in scored])
    constant = max(w[y == 1].sum(), w[y == 0].sum()) / w.sum()
    assert hit > constant + 0.15 and all(0 <= q.score <= 1 for q in scored)
    with pytest.raises(ValueError):
        M.fit(df, "x", "y", "nothing")


def test_one_label_and_no_rows(spark, rows):
    df = rows[0]
    runs, history = M.train_epochs(df.where("y = 0"), 5, (0.5,), (0.0,), 5, 2)
    assert [h[5] for h in history] == sorted((h[5] for h in history), reverse=True) and runs[0].best_epoch == 4
    _, none = M.train_epochs(df.limit(0), 5, (0.5,), (0.0,), 3, 2)
    assert [h[4:] for h in none] == [(0.0, 0.0)] * 3


def test_sweep_trains_and_agrees(spark):
    out = q_models.m_sweep(spark, SF).collect()
    assert len(out) == 9 and all(r.agrees for r in out)
    best = min(out, key=lambda r: r.best_loss)
    assert best.best_loss < 0.9 * np.log(2) and best.auc > 0.5
    long = q_models.m_sweep_history(spark, SF)
    assert long.groupBy("name").count().where(F.col("count") > 2 * q_models.SWEEP_EPOCHS).isEmpty()
    assert {r.type for r in long.select("type").distinct().collect()} == {"train", "val"}

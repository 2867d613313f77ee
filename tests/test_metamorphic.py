"""Metamorphic properties on the smallest fixture."""

import pytest
from pyspark.sql import functions as F

from stayframe.operators import impute as imp
from stayframe.operators.metrics import roc_auc
from stayframe.operators.seq import seq, with_chunk
from stayframe.operators.split import ordered_split
from stayframe.plans import q_models, q_windows
from stayframe.plans.common import FEATURES, G8_SEQ, grid8

SF = "/root/testdata/sf0.001"
F4 = list(FEATURES)


def test_interpolating_complete_grid_is_identity(spark):
    g = imp.impute(grid8(spark, SF), G8_SEQ, F4, ffill=True, fill=0.0)       # no gaps left
    again = imp.impute(g, G8_SEQ, F4, method="time", ffill=True, bfill=True, time_col="starttime")
    a = sorted(tuple(r) for r in g.select("user_id", "hr", *F4).collect())
    b = sorted(tuple(r) for r in again.select("user_id", "hr", *F4).collect())
    assert a == b


def test_windows_have_exactly_n_rows(spark):
    w = q_windows.w_window_sofa(spark, SF)
    per = w.groupBy("user_id").agg(F.count("*").alias("n"), F.min("step").alias("lo"), F.max("step").alias("hi"))
    assert per.filter((F.col("n") != 24) | (F.col("lo") != 0) | (F.col("hi") != 23)).count() == 0
    assert per.count() > 0


def test_split_disjoint_and_covering(spark):
    w = q_models.sofa_windows(spark, SF)
    sp = ordered_split(w, "user_id")
    per = sp.groupBy("user_id").agg(F.countDistinct("split").alias("k"))
    assert per.filter("k != 1").count() == 0
    assert per.count() == w.select("user_id").distinct().count()
    assert sp.count() == w.count()


def test_minmax_train_range(spark):
    m = q_models.m_minmax(spark, SF).filter("split != 'test'")
    agg = m.agg(*[F.min(c).alias(f"{c}_lo") for c in F4], *[F.max(c).alias(f"{c}_hi") for c in F4]).first()
    for c in F4:
        if agg[f"{c}_lo"] is not None:
            assert agg[f"{c}_lo"] == 0.0 and agg[f"{c}_hi"] in (0.0, 1.0)


def test_auc_complement(spark):
    p = q_models.predictions(spark, SF)
    a = roc_auc(p, "score", "y").first().auc
    b = roc_auc(p.withColumn("score", -F.col("score")), "score", "y").first().auc
    assert a is not None and abs(a + b - 1.0) < 1e-12


@pytest.mark.parametrize("parts", [1, 7])
def test_independent_of_row_order_and_partitions(spark, parts):
    g = grid8(spark, SF, materialized=False)
    base = imp.recipe(g, G8_SEQ, F4, "8h").select("user_id", "hr", *F4)
    shuffled = g.repartition(parts, F.rand(3)).orderBy(F.rand(5))
    other = imp.recipe(shuffled, G8_SEQ, F4, "8h").select("user_id", "hr", *F4)
    assert sorted(map(tuple, base.collect())) == sorted(map(tuple, other.collect()))

"""Facts measured on the sf0.01 fixture (FIXTURES.md §2), reproduced by the
operators: they pin the fixture roles independently of the SQL oracles."""

from pyspark.sql import functions as F

from __spark_entry__ import queries
from stayframe.plans.common import grid8
from stayframe.plans.q_windows import scored_grid

SF = "/root/testdata/sf0.01"


def test_fixture_facts(spark):
    q = queries()
    masked = {r.feature: r.masked for r in q["p_outlier_mask"](spark, SF).collect()}
    assert (masked["click"], masked["view"], masked["purchase"]) == (28, 116, 34)
    sg = scored_grid(spark, SF)
    assert sorted((r.score, r["count"]) for r in sg.groupBy("score").count().collect()) == \
        [(0, 5131), (1, 5756), (2, 2115), (3, 200)]
    assert sg.filter("score >= 2").select("user_id").distinct().count() == 143
    assert q["w_persistence"](spark, SF).filter("event = 1").select("user_id").distinct().count() == 123
    g = grid8(spark, SF, materialized=False)
    assert g.count() == 13202
    ev = g.groupBy("user_id").agg(F.max("is_infection").alias("e"),
                                  F.min(F.when(F.col("is_infection") == 1, F.col("hr"))).alias("a"))
    assert (ev.filter("e = 1").count(), ev.filter("a + 1 >= 24").count(), ev.filter("a + 1 >= 4").count(),
            ev.filter("e = 0").count()) == (134, 82, 123, 16)
    assert q["w_interp_linear"](spark, SF).filter("click is null").count() == 618
    assert q["j_not_in"](spark, SF).count() == 22

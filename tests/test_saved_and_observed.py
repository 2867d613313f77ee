"""Bucketed tables, fits taken while writing, and times without a zone."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stayframe.functions.columns import bin_index, hour_floor, hours_between, time_position
from stayframe.operators import profile, scale
from stayframe.operators.joins import outer_merge
from stayframe.plans import q_flows
from stayframe.session import materialize_observed
from stayframe.sources.saved import SavedTables, merge_saved

SF = "/root/testdata/sf0.001"


def _tables(spark):
    return {r.tableName for r in spark.sql("SHOW TABLES").collect()}


def test_chained_merge_of_bucketed_tables_has_no_exchange(spark):
    before = _tables(spark)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        with SavedTables(spark) as saved:
            spine, parts = q_flows.hourly_tables(spark, SF, saved)
            out = merge_saved(spine, parts, ["user_id", "hour"])
            n = out.count()
            counted = out.groupBy("user_id", "hour").agg(F.count("click").alias("n"))
            for df in (out, counted):
                plan = df._jdf.queryExecution().executedPlan().toString()
                assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3
            assert len(_tables(spark) - before) == 4
            assert n == spine.count()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert _tables(spark) == before


def test_merge_of_repeated_keys_equals_chained_full_joins(spark):
    a = spark.createDataFrame([(1, 1, 1.0), (1, 1, 2.0), (2, 0, 3.0)], "u long, h long, a double")
    b = spark.createDataFrame([(1, 1, 5.0), (3, 0, 6.0), (3, 0, 6.0)], "u long, h long, b double")
    c = spark.createDataFrame([(1, 1, 7.0), (1, 1, 8.0), (4, 2, 9.0)], "u long, h long, c double")
    keys = ["u", "h"]
    spine = a.select(*keys).unionByName(b.select(*keys)).unionByName(c.select(*keys)).distinct()
    rows = lambda df: sorted(map(str, df.select(*keys, "a", "b", "c").collect()))
    before = _tables(spark)
    with SavedTables(spark) as saved:
        x = [saved.save(t, n, keys, 3) for t, n in ((spine, "s"), (a, "a"), (b, "b"), (c, "c"))]
        assert rows(merge_saved(x[0], x[1:], keys)) == rows(outer_merge([a, b, c], keys))
        with pytest.raises(Exception, match="null key"):
            saved.save(a.withColumn("h", F.lit(None).cast("long")), "bad", keys, 3)
    assert _tables(spark) == before


def test_saved_table_query_leaves_no_table(spark):
    before = _tables(spark)
    assert q_flows.s_saved_table(spark, SF).count() > 0 and q_flows.s_bucketed_merge(spark, SF).count() > 0
    assert _tables(spark) == before


def test_fits_while_writing_equal_fits_of_their_own(spark):
    df = spark.createDataFrame([(i, float(i % 7), None if i % 5 == 0 else i / 3, 4.0) for i in range(60)],
                               "k long, a double, b double, c double")
    cols, on = ["a", "b", "c"], F.col("k") < 30
    rows = lambda x: sorted((tuple(None if v is None else round(v, 12) for v in r) for r in x.collect()), key=str)
    assert rows(scale.minmax_write(df, cols, on)) == rows(scale.minmax_scale(df, cols, df.where(on)))
    assert rows(scale.zscore_write(df, cols, on)) == rows(scale.zscore_scale(df, cols, df.where(on)))
    assert rows(scale.minmax_write(df, cols)) == rows(scale.minmax_scale(df, cols))
    for x in (df, df.limit(0)):
        written, prof = profile.null_profile_write(x, cols)
        assert sorted(map(tuple, prof.collect())) == sorted(map(tuple, profile.null_profile(x.fillna(0, ["k"]), cols).fillna(0, ["n_null"]).collect()))
        assert written.count() == x.count()


def test_a_fit_while_writing_runs_no_job_of_its_own(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("observed", "")
    try:
        df = spark.range(100).withColumn("v", F.col("id") * 1.5)
        _, seen = materialize_observed(df, "t", {"lo": F.min("v"), "hi": F.max("v")})
        assert seen == {"lo": 0.0, "hi": 148.5} and len(tracker.getJobIdsForGroup("observed")) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Berlin", "Australia/Lord_Howe"])
def test_elapsed_time_of_local_times_in_any_zone(spark, zone):
    # 2024-03-10 02:30 and 2024-03-31 02:30 lie in the gap of a clock change in New York and Berlin
    pairs = [(dt.datetime(2024, 3, d, a, 30), dt.datetime(2024, 3, d, b, 30, 0, 250_000)) for d in (10, 31) for a, b in ((2, 3), (1, 3), (0, 2))]
    pairs += [(dt.datetime(2024, 10, 27, 1, 30), dt.datetime(2024, 10, 27, 3, 30)), (dt.datetime(1969, 12, 31, 23), dt.datetime(1970, 1, 1)),
              (dt.datetime(2024, 4, 7, 1, 45), dt.datetime(2024, 4, 7, 2, 15)), (dt.datetime(2024, 3, 1), dt.datetime(2024, 2, 28, 12))]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a timestamp_ntz, b timestamp_ntz")
        out = df.select("i", hours_between("a", "b").alias("h"), bin_index("b", "a", 1).alias("k"), hour_floor("a").alias("f"),
                        (time_position(df, "b") - time_position(df, "a")).alias("us")).collect()
        for r in out:
            a, b = pairs[r.i]
            hours = (b - a).total_seconds() / 3600
            assert r.h == pytest.approx(hours, abs=1e-12) and r.us == round((b - a).total_seconds() * 1e6)
            assert r.k == hours // 1 and r.f == a.replace(minute=0)
        # instants: one hour passes over the change whatever the clock shows
        ts = spark.sql("SELECT timestamp_seconds(1710054000) AS a, timestamp_seconds(1710057600) AS b")
        assert ts.select(hours_between("a", "b").alias("h")).first().h == 1.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_intermediates_are_dropped_on_request(spark, tmp_path):
    import os
    from stayframe.session import drop_scratch, materialize
    drop_scratch(spark)
    out = materialize(spark.range(5), "gone")
    path = out.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    assert os.path.isdir(path) and drop_scratch(spark) == 1 and not os.path.exists(path) and drop_scratch(spark) == 0


def test_totals_travel_with_the_running_counts(spark):
    from stayframe.operators import metrics
    from stayframe.operators.seq import prefix_aggs, seq, with_chunk
    df = spark.createDataFrame([(k, i, i % 3) for k in range(3) for i in range(10 * k + 1)], "k long, i long, v long")
    s = seq("k", "i")
    out = prefix_aggs(with_chunk(df, s, 4), s, [("before", "sum", F.col("v")), ("n", "count", F.lit(1))], inclusive=False,
                      totals={"before": "total", "n": "rows"})
    for k in range(3):
        vs = [i % 3 for i in range(10 * k + 1)]
        got = sorted((r.i, r.before or 0, r.total, r.rows) for r in out.where(f"k = {k}").collect())
        assert got == [(i, sum(vs[:i]), sum(vs), len(vs)) for i in range(len(vs))]
    p = spark.createDataFrame([(0.1, 0), (0.4, 1), (0.4, 0), (0.8, 1)], "s double, y int")
    assert metrics.average_precision(p, "s", "y").first()[0] == pytest.approx(0.5 + 0.5 * 2 / 3)
    assert metrics.pr_curve(p.limit(0), "s", "y").count() == 1

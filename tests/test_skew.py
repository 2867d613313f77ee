"""A hot key holding a third of all rows (derived from the fixture events)."""

from pyspark.sql import functions as F

from stayframe.functions.columns import time_position
from stayframe.operators import impute as imp
from stayframe.operators.history import early_stop
from stayframe.operators.seq import depth_chunks, seq, with_chunk
from stayframe.sources.tables import table

SF = "/root/testdata/sf0.01"
TARGET = 256


def _hot_events(spark):
    ev = table(spark, SF, "events", ["event_id", "user_id", "ts", "event_type", "value"])
    hot = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0          # a third of all rows -> user 0
    ev = ev.withColumn("user_id", F.when(hot, F.lit(0).cast("long")).otherwise(F.col("user_id")))
    # (user_id, ts) stays unique: shift the hot rows by their event id in microseconds
    return ev.withColumn("ts", F.when(hot, F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                                             (F.col("event_id") % 997) / 1e6))
                         .otherwise(F.col("ts")))


def test_hot_entity_is_split_and_results_unchanged(spark):
    ev = _hot_events(spark)
    x = ev.select("user_id", "ts", *[F.when(F.col("event_type") == t, F.col("value")).alias(t)
                                     for t in ("click", "view")])
    s = seq("user_id", "ts")
    chunked = depth_chunks(x, s, target=TARGET)
    sizes = chunked.groupBy("user_id", "_chunk").count()
    hot_rows = x.filter("user_id = 0").count()
    total = x.count()
    assert hot_rows > total / 4                                   # the hot key really is hot
    largest = sizes.agg(F.max("count")).first()[0]
    hot_chunks = sizes.filter("user_id = 0").count()
    assert largest <= TARGET < hot_rows and hot_chunks >= hot_rows // TARGET
    a = imp.impute(chunked, s, ["click", "view"], method="time", ffill=True, bfill=True)
    one = with_chunk(x, s, 1 << 62, time_position(x, "ts"))      # every entity in one partition
    b = imp.impute(one, s, ["click", "view"], method="time", ffill=True, bfill=True)
    ra = sorted(map(tuple, a.select("user_id", "ts", "click", "view").collect()))
    rb = sorted(map(tuple, b.select("user_id", "ts", "click", "view").collect()))
    assert len(ra) == total and all(p[:2] == q[:2] and all(
        (u is None and v is None) or abs(u - v) < 1e-9 for u, v in zip(p[2:], q[2:])) for p, q in zip(ra, rb))
    e1 = {r.user_id: tuple(r)[1:] for r in early_stop(chunked.withColumn("loss", F.col("click")).fillna(0.0, ["loss"]),
                                                     s, "loss", 20).collect()}
    e2 = {r.user_id: tuple(r)[1:] for r in early_stop(one.withColumn("loss", F.col("click")).fillna(0.0, ["loss"]),
                                                     s, "loss", 20).collect()}
    assert e1 == e2


def _rows_per_task(df):
    counts = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    return max(counts), sum(counts) / 8


def test_no_task_holds_a_hot_entity(spark):
    """With broadcasts off, rows of a hot entity are spread over the tasks of
    salted joins and of chunked windows."""
    from stayframe.operators.seq import salted_join
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ev = _hot_events(spark)
        facts = ev.groupBy("user_id").agg(F.min("ts").alias("origin"), F.count(F.lit(1)).alias("_n"))
        most, mean = _rows_per_task(salted_join(ev, facts, ["user_id"], "ts"))
        assert most <= 2 * mean
        s = seq("user_id", "ts")
        most, mean = _rows_per_task(depth_chunks(ev, s, target=64).repartition(*s.part))
        assert most <= 2 * mean
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_burst_is_spread_over_tasks(spark):
    """A third of all rows are one user's within one minute: rows per task of
    the chunked scans, and results as without chunks."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ev = table(spark, SF, "events", ["event_id", "user_id", "ts", "value"])
        burst = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
        start = F.lit("2024-01-05 10:00:00").cast("timestamp_ntz")
        ev = ev.select(F.when(burst, F.lit(0).cast("long")).otherwise(F.col("user_id")).alias("user_id"), F.when(
            burst, start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("event_id") * 3 / 1e3 % 60).cast("decimal(8,6)")))
            .otherwise(F.col("ts")).alias("ts"), F.when(F.col("event_id") % 4 > 0, F.col("value")).alias("value"))
        ev = ev.groupBy("user_id", "ts").agg(F.max("value").alias("value"))      # unique times
        s = seq("user_id", "ts")
        x = depth_chunks(ev, s, target=64)
        most, mean = _rows_per_task(x.repartition(*s.part))
        assert x.filter("user_id = 0").count() > x.count() / 4 and most <= 2 * mean
        a = imp.interpolate(x, s, ["value"], method="time").select("user_id", "ts", "value")
        b = imp.interpolate(with_chunk(ev, s, 1 << 62, time_position(ev, "ts")), s, ["value"], method="time").select(
            "user_id", "ts", "value")
        ra, rb = (sorted(map(tuple, y.collect())) for y in (a, b))
        assert len(ra) == len(rb) and all(p[:2] == q[:2] and (p[2] == q[2] or abs(p[2] - q[2]) < 1e-9) for p, q in zip(ra, rb))
        stops = [{r.user_id: tuple(r) for r in early_stop(y.fillna(0.0, ["value"]), s, "value", 20).collect()}
                 for y in (x, with_chunk(ev, s, 1 << 62, time_position(ev, "ts")))]
        assert stops[0] == stops[1]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_cold_keys_have_no_copies(spark):
    """Salts follow row counts: facts of cold keys are not repeated."""
    from stayframe.operators.seq import salted_join
    rows = spark.range(4000).select(F.when(F.col("id") < 1500, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    facts = rows.groupBy("k").agg(F.min("v").alias("lo"), F.count(F.lit(1)).alias("_n"))
    out = salted_join(rows, facts, ["k"], "v", share=10)
    assert out.columns == ["k", "v", "lo"] and out.count() == 4000 and out.where("lo <> IF(k = -1, 0, k)").isEmpty()
    plan = salted_join(rows, facts, ["k"], "v", share=10)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salts" in plan
    assert salted_join(rows.limit(0), facts.limit(0), ["k"], "v").count() == 0


def test_cohort_joins_meet_on_chunks(spark):
    """A hot user's grid rows are spread over tasks when they meet a cohort, and
    chunks that the cohort cannot touch match nothing."""
    from stayframe.operators.joins import chunk_join
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        s = seq("u", "hr")
        g = spark.range(12000).select(F.when(F.col("id") < 4000, F.lit(0)).otherwise(F.col("id") % 800 + 1).alias("u"),
                                      F.when(F.col("id") < 4000, F.col("id")).otherwise(F.floor(F.col("id") / 800)).alias("hr"))
        g = with_chunk(g, s, 32)
        facts = g.groupBy("u").agg(F.max("hr").alias("last"))
        j = chunk_join(g, facts, s, F.lit(0), F.col("last"), width=32)
        most, mean = _rows_per_task(j)
        assert j.count() == 12000 and most <= 2 * mean
        plan = chunk_join(g, facts.withColumn("one", F.lit(1)), s, F.lit(0), F.col("last"), width=32)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(u#" in plan and "_chunk#" in plan.split("hashpartitioning(")[1]
        near = chunk_join(g, facts.filter("u = 0"), s, F.lit(100), F.lit(130), width=32)
        assert sorted(r.hr for r in near.collect()) == list(range(96, 160))
        assert chunk_join(g, facts, s, F.lit(5), F.lit(3), width=32).count() == 0
        assert chunk_join(g, facts.filter("u = 0"), s, F.lit(-50), F.lit(-3), width=32).count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_cohort_queries_have_no_exchange_on_the_user_alone(spark):
    import re
    from __spark_entry__ import queries
    for name in ("j_time_band", "l_union", "j_cohort_members", "p_band_flag"):
        plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"hashpartitioning\(user_id#\d+L, \d", plan), name

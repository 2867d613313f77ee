"""Hand-made cases for the operators (FIXTURES.md part 3) and metamorphic checks."""

import datetime as dt
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayframe.functions.columns import bin_index
from stayframe.operators import impute as imp
from stayframe.operators.cohort import onset_windows, persistence
from stayframe.operators.history import early_stop
from stayframe.operators.joins import not_in
from stayframe.operators.metrics import average_precision, roc_auc
from stayframe.operators.profile import duplicate_groups
from stayframe.operators.quantile import exact_quantiles
from stayframe.operators.scale import minmax_scale
from stayframe.operators.seq import row_index, seq, trailing_frame, with_chunk

T0 = dt.datetime(2024, 1, 1)


def _rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def _grid(spark, rows, width=4096):
    df = spark.createDataFrame(rows, "sid long, hr int, ts timestamp_ntz, x double")
    s = seq("sid", "hr")
    return with_chunk(df, s, width), s


EXAMPLE = [(1, 0, None), (1, 1, 1.0), (1, 2, None), (1, 5, None), (1, 7, 4.0), (1, 9, None)]


def _example(spark, width=4096):
    return _grid(spark, [(s, h, T0 + dt.timedelta(hours=h), v) for s, h, v in EXAMPLE], width)


@pytest.mark.parametrize("width", [1, 2, 3, 4096])
def test_interpolation_example(spark, width):
    df, s = _example(spark, width)
    t = imp.interpolate(df, s, ["x"], method="time", time_col="ts")
    assert [r.x for r in t.orderBy("hr").collect()] == [None, 1.0, 1.5, 3.0, 4.0, 4.0]
    lin = imp.interpolate(df, s, ["x"], method="linear")
    assert [r.x for r in lin.orderBy("hr").collect()] == [None, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_fill_recipes_edge_entities(spark):
    rows = [(1, h, T0 + dt.timedelta(hours=h), v) for h, v in [(0, None), (1, None), (2, 3.0), (3, None)]]
    rows += [(2, 0, T0, None), (2, 1, T0 + dt.timedelta(hours=1), None)]            # all null
    rows += [(3, 0, T0, 7.0)]                                                     # one row
    df, s = _grid(spark, rows, 2)
    r = imp.impute(df, s, ["x"], method="time", ffill=True, bfill=True, fill="median", time_col="ts")
    got = {(a.sid, a.hr): a.x for a in r.collect()}
    med = 5.0   # median of 3 and 7
    assert got == {(1, 0): 3.0, (1, 1): 3.0, (1, 2): 3.0, (1, 3): 3.0, (2, 0): med, (2, 1): med, (3, 0): 7.0}
    z = imp.impute(df, s, ["x"], method="linear", ffill=True, fill=0.0)
    got = {(a.sid, a.hr): a.x for a in z.collect()}
    assert got[(1, 0)] == 0.0 and got[(1, 3)] == 3.0 and got[(2, 1)] == 0.0


def _random_grid(spark, n_ent=6, seed=3):
    rnd = random.Random(seed)
    rows = []
    for sid in range(n_ent):
        hrs = sorted(rnd.sample(range(60), rnd.randint(1, 40)))
        for h in hrs:
            v = None if rnd.random() < 0.5 else round(rnd.uniform(0, 10), 2)
            rows.append((sid, h, T0 + dt.timedelta(hours=h), v))
    return rows


@pytest.mark.parametrize("width", [1, 3, 7])
def test_chunked_scans_match_unchunked(spark, width):
    rows = _random_grid(spark)
    big, s = _grid(spark, rows, 4096)
    small, _ = _grid(spark, rows, width)
    for method in ("linear", "time", None):
        a = imp.impute(big, s, ["x"], method=method, ffill=True, bfill=True, time_col="ts")
        b = imp.impute(small, s, ["x"], method=method, ffill=True, bfill=True, time_col="ts")
        ra = _rows(a.select("sid", "hr", "x"), "sid", "hr")
        rb = _rows(b.select("sid", "hr", "x"), "sid", "hr")
        assert [(x[0], x[1]) for x in ra] == [(x[0], x[1]) for x in rb]
        for x, y in zip(ra, rb):
            assert (x[2] is None and y[2] is None) or abs(x[2] - y[2]) < 1e-9
    ia = _rows(row_index(big, s).select("sid", "hr", "_idx"), "sid", "hr")
    ib = _rows(row_index(small, s).select("sid", "hr", "_idx"), "sid", "hr")
    assert ia == ib
    pa = persistence(big, s, F.col("x").isNotNull(), 2)
    pb = persistence(small, s, F.col("x").isNotNull(), 2)
    assert _rows(pa.select("sid", "hr", "event"), "sid", "hr") == _rows(pb.select("sid", "hr", "event"), "sid", "hr")


def test_trailing_frame_halo(spark):
    rows = _random_grid(spark, 4, 9)
    df, s = _grid(spark, rows, 4096)
    x = row_index(df, s)

    def build(w):
        return {"m": F.avg("x").over(w.rowsBetween(-3, 0)), "l": F.lag("x", 2).over(w)}

    a = trailing_frame(x, ["sid"], "_idx", 4, build, width=4)
    b = trailing_frame(x, ["sid"], "_idx", 4, build, width=4096)
    ra, rb = _rows(a.select("sid", "hr", "m", "l"), "sid", "hr"), _rows(b.select("sid", "hr", "m", "l"), "sid", "hr")
    assert ra == rb


def test_persistence_and_onset_windows(spark):
    # entity 1: flag rows at hr 1 and 5 (two onsets), 6 rows; entity 2: onset in first row;
    # entity 3: never flagged, 5 rows; entity 4: too short
    rows = [(1, h, int(h in (1, 5))) for h in range(6)] + [(2, h, int(h == 0)) for h in range(4)]
    rows += [(3, h, 0) for h in range(5)] + [(4, 0, 0)]
    df = spark.createDataFrame(rows, "sid long, hr int, f int")
    s = seq("sid", "hr")
    df = with_chunk(df, s, 2)
    w = onset_windows(df, s, 2, "f")
    got = sorted((r.sid, r.hr, r.is_event, r.step) for r in w.collect())
    assert got == [(1, 0, 1, 0), (1, 1, 1, 1), (3, 0, 0, 0), (3, 1, 0, 1)]
    w1 = onset_windows(df, s, 1, "f")
    assert sorted((r.sid, r.hr) for r in w1.filter("is_event = 1").collect()) == [(1, 1), (2, 0)]
    p = persistence(df, s, F.col("f") == 0, 3)
    assert [r.event for r in p.filter("sid = 3").orderBy("hr").collect()] == [0, 0, 1, 1, 1]


def test_bin_closure(spark):
    df = spark.createDataFrame([(T0, T0), (T0, T0 + dt.timedelta(hours=8)), (T0, T0 + dt.timedelta(hours=8, seconds=1))],
                               "o timestamp_ntz, t timestamp_ntz")
    r = df.select(bin_index("t", "o", 8, "left").alias("l"), bin_index("t", "o", 8, "right").alias("r")).collect()
    assert [(x.l, x.r) for x in r] == [(0, -1), (1, 0), (1, 1)]


def test_not_in_null_semantics(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    right = spark.createDataFrame([(2,)], "k long")
    assert sorted(r.k for r in not_in(left, right, "k", "k").collect()) == [1]
    right_null = spark.createDataFrame([(2,), (None,)], "k long")
    assert not_in(left, right_null, "k", "k").count() == 0


def test_exact_quantiles(spark):
    rnd = np.random.default_rng(5)
    vals = np.concatenate([rnd.normal(size=501), rnd.integers(0, 5, size=300).astype(float)])
    df = spark.createDataFrame([(float(v), float(v) * 2 if i % 3 else None) for i, v in enumerate(vals)], "a double, b double")
    got = exact_quantiles(df, ["a", "b"], 0.5)
    pdf = df.toPandas()
    assert math.isclose(got["a"], float(pdf.a.median()), rel_tol=0, abs_tol=1e-12)
    assert math.isclose(got["b"], float(pdf.b.median()), rel_tol=0, abs_tol=1e-12)
    q = exact_quantiles(df, ["a"], 0.25)
    assert math.isclose(q["a"], float(np.quantile(pdf.a, 0.25)), abs_tol=1e-12)
    empty = spark.createDataFrame([(None,)], "a double")
    assert exact_quantiles(empty, ["a"])["a"] is None


def test_exact_quantiles_of_infinite_extreme_and_many_values(spark):
    inf = float("inf")
    odd = spark.createDataFrame([(v,) for v in (inf, inf, 1.0, -1.7e308, 1.7e308, float("nan"), None)], "a double")
    assert exact_quantiles(odd, ["a"], 0.5)["a"] == 1.7e308 and exact_quantiles(odd, ["a"], 1.0)["a"] == inf
    many = spark.range(300_001).select((F.col("id") * 7 % 300_001).cast("double").alias("a"))
    assert exact_quantiles(many, ["a"], 0.5)["a"] == 150_000.0


def test_not_in_empty_list_keeps_every_row(spark):
    left = spark.createDataFrame([(1,), (None,)], "k long")
    assert not_in(left, left.limit(0), "k", "k").count() == 2


def test_early_stop_ignores_null_losses(spark):
    from stayframe.operators.history import early_stop
    rows = [(e, None if e in (0, 2) else v) for e, v in enumerate([0.0, 3.0, 0.0, 2.0, 2.5, 2.6, 2.7])]
    for width in (1, 3, 100):
        s = seq(("k",), "e")
        df = with_chunk(spark.createDataFrame([(1, *r) for r in rows], "k int, e int, loss double"), s, width)
        r = early_stop(df, s, "loss", 3).first()
        assert (r.stop_epoch, r.best_epoch, r.best_loss) == (6, 3, 2.0)


def test_short_windows_have_no_label(spark):
    from stayframe.operators.sequence import window_sequences
    df = spark.createDataFrame([(1, 0, 1.0, 1), (1, 1, 2.0, 0), (2, 0, 1.0, 1)], "k int, hr int, x double, y int")
    assert {r.k: r.y for r in window_sequences(df, ["k"], "hr", ["x"], "y", 1, 2).collect()} == {1: 0, 2: None}


def test_outer_merges_of_repeated_and_null_keys(spark):
    from stayframe.operators.joins import outer_merge, outer_merge_pivot
    long = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0), (1, "b", 3.0)], "k int, p string, v double")
    with pytest.raises(Exception, match="repeated"):
        outer_merge_pivot(long, ["k"], "p", "v", ["a", "b"]).collect()
    a = spark.createDataFrame([(1, 1.0), (1, 2.0), (None, 5.0)], "k int, a double")
    b = spark.createDataFrame([(1, 3.0), (None, 6.0), (2, 7.0)], "k int, b double")
    got = sorted(outer_merge([a, b], ["k"]).collect(), key=str)
    assert sorted(map(tuple, got), key=str) == sorted([(1, 1.0, 3.0), (1, 2.0, 3.0), (None, 5.0, 6.0), (2, None, 7.0)], key=str)


def test_ranks_of_string_and_sparse_ids(spark):
    from stayframe.operators.split import entity_ranks
    names = spark.createDataFrame([(x,) for x in ("b", "a", "ä", "c")], "k string")
    assert {r.k: r._rank for r in entity_ranks(names, "k").collect()} == {"a": 0, "b": 1, "c": 2, "ä": 3}
    wide = spark.range(5000).select(F.xxhash64("id").alias("k"))
    ks = sorted(r.k for r in wide.collect())
    assert {r.k: r._rank for r in entity_ranks(wide, "k").collect()} == {k: i for i, k in enumerate(ks)}


def _brute_auc(s, y):
    pos = [a for a, b in zip(s, y) if b == 1]
    neg = [a for a, b in zip(s, y) if b == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_ties_and_symmetry(spark):
    rnd = random.Random(2)
    rows = [(round(rnd.random(), 1), int(rnd.random() < 0.4)) for _ in range(300)]
    df = spark.createDataFrame(rows, "s double, y int")
    auc = roc_auc(df, "s", "y").first().auc
    assert abs(auc - _brute_auc(*zip(*rows))) < 1e-12
    flip = roc_auc(df.withColumn("s", 1 - F.col("s")), "s", "y").first().auc
    assert abs(flip - (1 - auc)) < 1e-12
    one = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert roc_auc(one, "s", "y").first().auc is None


def test_average_precision_small(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)], "s double, y int")
    ap = average_precision(df, "s", "y").first().average_precision
    assert abs(ap - 0.8333333333333333) < 1e-12


def test_early_stop_equal_minima(spark):
    losses = [5.0, 3.0, 4.0, 3.0, 6.0, 6.0, 6.0, 2.0]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(losses)], "e long, ep long, loss double")
    s = seq("e", "ep")
    r = early_stop(with_chunk(df, s, 3), s, "loss", patience=3).first()
    # resets at 0,1,3 (3 == min resets); 4,5,6 count up; stop at 6
    assert (r.stop_epoch, r.best_epoch, r.best_loss, r.n_epochs) == (6, 1, 3.0, 8)


def test_minmax_constant_column(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "c double, v double")
    r = minmax_scale(df, ["c", "v"]).collect()
    assert [(x.c, x.v) for x in r] == [(0.0, 0.0), (0.0, 1.0)]


def test_duplicates_keep_first(spark):
    df = spark.createDataFrame([(1, 1, "b", 1), (1, 1, "a", 0), (2, 1, "z", 0)], "k1 long, k2 long, t string, y int")
    r = duplicate_groups(df, ["k1", "k2"], ["t", "y"], "y", ["t"]).collect()
    assert [(x.k1, x.n, x.label_max, x.label_min, x.first_t) for x in r] == [(1, 2, 1, 0, "a")]


def test_null_safe_full_merge(spark):
    from stayframe.operators.joins import null_safe_join
    a = spark.createDataFrame([(1, None, 1.0), (2, 5, 2.0)], "s long, h long, a double")
    b = spark.createDataFrame([(1, None, 9.0), (3, 5, 3.0)], "s long, h long, b double")
    r = sorted((x.s, x.h, x.a, x.b) for x in null_safe_join(a, b, ["s", "h"], "full").collect())
    assert r == [(1, None, 1.0, 9.0), (2, 5, 2.0, None), (3, 5, None, 3.0)]


def test_right_closed_interval_join_buckets(spark):
    from stayframe.operators.grid import interval_aggregate
    g = spark.createDataFrame([(1, 0, dt.datetime(2024, 1, 31), dt.datetime(2024, 2, 29)),
                               (1, 1, dt.datetime(2024, 2, 29), dt.datetime(2024, 3, 31))],
                              "k long, b int, s timestamp_ntz, e timestamp_ntz")
    ev = spark.createDataFrame([(1, dt.datetime(2024, 1, 31), 1.0), (1, dt.datetime(2024, 2, 29), 2.0),
                                (1, dt.datetime(2024, 3, 1), 4.0), (2, dt.datetime(2024, 3, 1), 8.0)],
                               "k long, t timestamp_ntz, v double")
    r = interval_aggregate(g, ev, ["k", "b"], ["k"], "s", "e", "t", [F.sum("v").alias("sv")], bucket="month")
    assert sorted((x.b, x.sv) for x in r.collect()) == [(0, 2.0), (1, 4.0)]


def _seq_early_stop(losses, patience):
    best, best_e, last, counter = None, None, None, 0
    for e, v in enumerate(losses):
        if last is None:
            best, best_e, last = v, e, v
            continue
        if last < v:
            counter += 1
            if counter >= patience:
                return e, best_e, best
        else:
            last = v
            if best > v:
                best, best_e = v, e
            counter = 0
    return None, best_e, best


@pytest.mark.parametrize("width", [1, 4, 1000])
def test_early_stop_random_vs_sequential(spark, width):
    rnd = random.Random(11)
    rows, expect = [], {}
    for e in range(12):
        n = rnd.randint(1, 40)
        losses = [float(rnd.randint(0, 6)) for _ in range(n)]
        rows += [(e, i, v) for i, v in enumerate(losses)]
        expect[e] = (n, *_seq_early_stop(losses, 3))
    df = spark.createDataFrame(rows, "e long, ep long, loss double")
    s = seq("e", "ep")
    got = {r.e: (r.n_epochs, r.stop_epoch, r.best_epoch, r.best_loss)
           for r in early_stop(with_chunk(df, s, width), s, "loss", patience=3).collect()}
    assert got == expect


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_persistence_random_vs_sequential(spark, width):
    rnd = random.Random(4)
    rows, expect = [], {}
    for e in range(8):
        flags = [rnd.random() < 0.7 for _ in range(rnd.randint(1, 30))]
        run = 0
        for i, f in enumerate(flags):
            run = run + 1 if f else 0
            rows.append((e, i * 2, int(f)))      # gaps in the order column: row-based runs
            expect[(e, i * 2)] = int(run >= 3)
    df = spark.createDataFrame(rows, "e long, o long, f int")
    s = seq("e", "o")
    got = {(r.e, r.o): r.event for r in persistence(with_chunk(df, s, width), s, F.col("f") == 1, 3).collect()}
    assert got == expect


@pytest.mark.parametrize("step", [dt.timedelta(microseconds=1000), dt.timedelta(microseconds=1)])
def test_depth_chunks_cut_a_burst_by_row_count(spark, step):
    from stayframe.operators.seq import depth_chunks
    from stayframe.functions.columns import time_position
    # entity 1 is hot: 3000 events within seconds or milliseconds; entity 2 has 10 spread over hours
    rows = [(1, T0 + i * step, float(i) if i % 7 else None) for i in range(3000)]
    rows += [(2, T0 + dt.timedelta(hours=i), float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "u long, ts timestamp_ntz, v double")
    s = seq("u", "ts")
    x = depth_chunks(df, s, target=500)
    sizes = {(r.u, r._chunk): r.n for r in x.groupBy("u", "_chunk").agg(F.count("*").alias("n")).collect()}
    assert max(sizes.values()) <= 500 and len([k for k in sizes if k[0] == 1]) >= 6
    # the chunk grows along the order, and ordered results equal the unchunked ones
    back = x.selectExpr("u", "_chunk", "lag(_chunk) OVER (PARTITION BY u ORDER BY ts) AS p").where("p > _chunk")
    assert back.isEmpty()
    y = imp.interpolate(x, s, ["v"], method="time")
    z = imp.interpolate(with_chunk(df, s, 1 << 62, time_position(df, "ts")), s, ["v"], method="time")
    assert _rows(y.select("u", "ts", "v"), "u", "ts") == _rows(z.select("u", "ts", "v"), "u", "ts")


def _interval_rows(spark, events, intervals, target):
    from stayframe.operators.grid import interval_borders, interval_totals
    ev = spark.createDataFrame(events, "u long, t timestamp_ntz, v double")
    iv = spark.createDataFrame(intervals, "u long, id long, s timestamp_ntz, e timestamp_ntz")
    out = interval_totals(interval_borders(iv, "s", "e"), ev, ["u"], ["id"], "_step", "_border", "t", "v", "n", "m", target)
    return {r.id: (r.n, r.m) for r in out.collect()}


def test_interval_totals_of_extreme_values(spark):
    import math
    at = lambda h: T0 + dt.timedelta(hours=h)
    events = [(1, at(1), 1e17), (1, at(2), 3.0), (1, at(3), 5.0), (1, at(4), math.nan), (1, at(5), 7.0), (1, at(6), math.inf),
              (1, at(7), -2.0), (1, at(7), 4.0), (1, None, 9.0), (1, at(8), None), (2, at(2), 11.0)]
    ivs = [(1, 0, at(0), at(1)), (1, 1, at(1), at(2)), (1, 2, at(2), at(3)), (1, 3, at(3), at(4)), (1, 4, at(4), at(5)),
           (1, 5, at(5), at(6)), (1, 6, at(6), at(8)), (1, 7, at(1), at(3)), (2, 8, at(0), at(9)), (1, 9, at(20), at(30)),
           (1, 10, at(3), at(3)), (1, 11, at(5), at(2)), (1, 12, None, at(9)), (3, 13, at(0), at(9)), (1, 14, at(6), None)]
    got = _interval_rows(spark, events, ivs, 4)
    none = (0, None)
    assert len(got) == 13 and math.isnan(got.pop(3)[1]) and got == {
        0: (1, 1e17), 1: (1, 3.0), 2: (1, 5.0), 4: (1, 7.0), 5: (1, math.inf), 6: (2, 1.0), 7: (2, 4.0), 8: (1, 11.0),
        9: none, 10: none, 11: none, 13: none}


@pytest.mark.parametrize("target, short", [(1, 16), (7, 0), (1 << 16, 3)])
def test_interval_totals_against_all_pairs(spark, monkeypatch, target, short):
    monkeypatch.setattr("stayframe.operators.grid.SHORT", short)
    rnd = random.Random(target)
    at = lambda: T0 + dt.timedelta(minutes=rnd.randint(0, 300))
    events = [(rnd.randint(0, 3), at(), float(rnd.randint(0, 99))) for _ in range(200)]
    ivs = [(rnd.randint(0, 4), i, *sorted((at(), at()))) for i in range(150)]
    want = {}
    for u, i, s, e in ivs:
        v = [x for w, t, x in events if w == u and s < t <= e]
        want[i] = (len(v), sum(v) / len(v) if v else None)
    got = _interval_rows(spark, events, ivs, target)
    assert got.keys() == want.keys()
    assert all(got[i][0] == want[i][0] and (got[i][1] == want[i][1] or abs(got[i][1] - want[i][1]) < 1e-9) for i in want)


def test_interval_totals_of_chained_grids_and_other_times(spark):
    from stayframe.operators.grid import interval_totals
    ev = spark.createDataFrame([(1, "b", 1.0), (1, "d", 2.0), (1, "dd", 4.0)], "u long, t string, v double")
    b = spark.createDataFrame([(1, 7, 0, "a"), (1, 7, 1, "c"), (1, 7, 2, "d"), (1, 7, 3, "e"), (1, 8, 5, "a"), (1, 8, 6, "z"),
                               (1, 8, 8, "zz"), (1, 9, 0, None), (1, 9, 1, "z")], "u long, g long, k int, x string")
    out = interval_totals(b, ev, ["u"], ["g"], "k", "x", "t", "v", "n", "m")
    assert sorted(map(tuple, out.collect())) == [(1, 7, 0, 1, 1.0), (1, 7, 1, 1, 2.0), (1, 7, 2, 1, 4.0), (1, 8, 5, 3, 7 / 3)]


def test_month_bin(spark):
    from stayframe.operators.grid import month_bin
    day = lambda *d: dt.datetime(*d)
    rows = [(day(2024, 1, 31), day(2024, 1, 31), -1), (day(2024, 1, 31), day(2024, 2, 1), 0), (day(2024, 1, 31), day(2024, 2, 29), 0),
            (day(2024, 1, 31), day(2024, 3, 1), 1), (day(2024, 1, 31), day(2024, 3, 31), 1), (day(2024, 1, 31), day(2024, 4, 30), 2),
            (day(2024, 1, 15), day(2024, 1, 10), -1), (day(2024, 1, 15), day(2023, 12, 15), -2), (day(2024, 5, 1), day(2025, 5, 1), 11)]
    df = spark.createDataFrame(rows, "o timestamp_ntz, t timestamp_ntz, k int")
    assert df.where(month_bin("t", "o") != F.col("k")).isEmpty() and df.where(month_bin("t", "o").isNull()).isEmpty()


def test_lag_sum_first_rows_trailing_fill(spark):
    from stayframe.operators.cohort import first_rows, lag_sum
    rows = [(1, h, v) for h, v in [(0, 1.0), (1, None), (2, 3.0), (3, 5.0), (4, None)]] + [(2, 0, 2.0)]
    df, s = _grid(spark, [(a, b, T0 + dt.timedelta(hours=b), c) for a, b, c in rows], 2)
    ls = lag_sum(df, s, "x", "xs", at_least=6, flag_out="f")
    assert [(r.xs, r.f) for r in ls.filter("sid = 1").orderBy("hr").collect()] == \
        [(None, 0), (None, 0), (None, 0), (8.0, 1), (None, 0)]
    fr = first_rows(df, s, 3)
    assert sorted((r.sid, r.hr) for r in fr.collect()) == [(1, 0), (1, 1), (1, 2)]
    tf = imp.trailing_fill(df, s, ["x"], k=2, how="avg")
    assert [r.x for r in tf.filter("sid = 1").orderBy("hr").collect()] == [1.0, 1.0, 3.0, 5.0, 5.0]
    tm = imp.trailing_fill(df, s, ["x"], k=3, how="min")
    assert [r.x for r in tm.filter("sid = 1").orderBy("hr").collect()] == [1.0, 1.0, 3.0, 5.0, 3.0]


def test_describe_quartiles(spark):
    from stayframe.operators.profile import describe
    rows = [("a", float(v)) for v in [1, 2, 3, 4, 10]] + [("b", 5.0)]
    r = {x.g: x for x in describe(spark.createDataFrame(rows, "g string, v double"), "g", "v", ["a", "b", "c"]).collect()}
    assert (r["a"].q25, r["a"].q50, r["a"].q75, r["a"]["count"]) == (2.0, 3.0, 4.0, 5)
    assert r["b"].q50 == 5.0 and "c" not in r


def test_keep_first_nan_and_fill_aliases(spark):
    from stayframe.operators.clean import nan_to_null
    from stayframe.operators.profile import keep_first
    from stayframe.session import cluster_conf
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 5.0), (2, "c", float("nan"))], "k long, t string, v double")
    kf = sorted((r.k, r.t, r.v) for r in keep_first(df.filter("k = 1"), ["k"], ["t"]).collect())
    assert kf == [(1, "a", 5.0)]
    nn = nan_to_null(df, ["v"]).filter("k = 2").first()
    assert nn.v is None
    g, s = _example(spark, 2)
    assert [r.x for r in imp.forward_fill(g, s, ["x"]).orderBy("hr").collect()] == [None, 1.0, 1.0, 1.0, 4.0, 4.0]
    assert [r.x for r in imp.backward_fill(g, s, ["x"]).orderBy("hr").collect()] == [1.0, 1.0, 4.0, 4.0, 4.0, None]
    conf = cluster_conf(100 * 2 ** 40, 1000, 8)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600 and conf["spark.sql.adaptive.enabled"] == "true"


def test_reference_flow_on_reference_columns(spark):
    from stayframe.plans.reference_flow import prepare_windows
    rnd = random.Random(8)
    rows = []
    for stay in range(10):
        onset = rnd.choice([None, 30, 40])
        for hr in range(50):
            rows.append((stay, hr, T0 + dt.timedelta(hours=hr),
                         None if rnd.random() < 0.3 else rnd.uniform(30, 250),   # sbp, some outside 50..200
                         None if rnd.random() < 0.5 else rnd.uniform(20, 220),   # heart_rate
                         rnd.uniform(0, 5), int(stay % 2), 40 + stay, int(onset is not None and hr >= onset)))
    grid = spark.createDataFrame(rows, "stay_id long, hr int, starttime timestamp_ntz, sbp double, heart_rate double, "
                                       "urine double, icd_event int, age int, is_infection int")
    w = prepare_windows(grid)
    per = w.groupBy("stay_id").agg(F.count("*").alias("n"), F.countDistinct("split").alias("k"))
    assert per.filter("n != 24 or k != 1").count() == 0 and per.count() == 10
    assert "urine" not in w.columns
    fit = w.filter("split != 'test'").agg(F.min("sbp"), F.max("sbp"), F.min("age"), F.max("age")).first()
    assert tuple(fit) == (0.0, 1.0, 0.0, 1.0)
    assert w.filter("sbp is null or heart_rate is null").count() == 0


def test_grouped_auc_bounded_equals_chunked(spark):
    rnd = random.Random(6)
    rows = [(g, round(rnd.random(), 1), int(rnd.random() < 0.5)) for g in range(10) for _ in range(20)]
    df = spark.createDataFrame(rows, "g long, s double, y int")
    a = {r.g: r.auc for r in roc_auc(df, "s", "y", ["g"]).collect()}
    b = {r.g: r.auc for r in roc_auc(df, "s", "y", ["g"], bounded_groups=True).collect()}
    assert a.keys() == b.keys() and all((a[k] is None and b[k] is None) or abs(a[k] - b[k]) < 1e-12 for k in a)
    for g in range(10):
        sub = [(s, y) for gg, s, y in rows if gg == g]
        if 0 < sum(y for _, y in sub) < len(sub):
            assert abs(a[g] - _brute_auc(*zip(*sub))) < 1e-12


def test_complete_grid_chunked_ranges(spark):
    from stayframe.operators.grid import complete_grid
    binned = spark.createDataFrame([(1, T0, 0, 1.0), (1, T0, 7, 7.0), (2, T0, 2, 2.0), (2, T0, 3, None)],
                                   "u long, origin timestamp_ntz, hr int, x double")
    g = complete_grid(binned, ["u"], "hr", "origin", 8, chunk_width=3)
    got = sorted((r.u, r.hr, r.x, r._chunk) for r in g.collect())
    exp = [(1, h, {0: 1.0, 7: 7.0}.get(h), h // 3) for h in range(8)] + \
          [(2, h, {2: 2.0}.get(h), h // 3) for h in range(4)]
    assert got == sorted(exp)
    r = {(x.u, x.hr): (x.starttime, x.endtime) for x in g.collect()}
    assert r[(1, 7)] == (T0 + dt.timedelta(hours=56), T0 + dt.timedelta(hours=64))


def test_interval_closures_band_and_event_hour(spark):
    from stayframe.operators.cohort import band_flag, event_hour
    from stayframe.operators.grid import hourly_mean, interval_join
    from stayframe.operators.joins import membership_flag, time_band_join
    g = spark.createDataFrame([(1, 0, T0, T0 + dt.timedelta(hours=8)),
                               (1, 1, T0 + dt.timedelta(hours=8), T0 + dt.timedelta(hours=16))],
                              "k long, b int, s timestamp_ntz, e timestamp_ntz")
    ev = spark.createDataFrame([(1, T0), (1, T0 + dt.timedelta(hours=8))], "k long, t timestamp_ntz")

    def pairs(closed):
        return sorted((r.b, r.t) for r in interval_join(g, ev, ["k"], "s", "e", "t", closed).collect())
    assert pairs("right") == [(0, T0 + dt.timedelta(hours=8))]
    assert pairs("left") == [(0, T0), (1, T0 + dt.timedelta(hours=8))]
    assert pairs("both") == [(0, T0), (0, T0 + dt.timedelta(hours=8)), (1, T0 + dt.timedelta(hours=8))]
    # a time on a shared border flags both bins; event hour rounds half up
    t = T0 + dt.timedelta(hours=8)
    x = g.withColumn("t", F.lit(t).cast("timestamp_ntz")).select("b", band_flag("s", "e", "t").alias("f"),
                                                                 event_hour("b", 8, "s", "e", "t").alias("h"))
    assert sorted((r.b, r.f, r.h) for r in x.collect()) == [(0, 1, 8), (1, 1, 8)]
    half = g.withColumn("t", F.lit(T0 + dt.timedelta(hours=2, minutes=30)).cast("timestamp_ntz"))
    assert [r.h for r in half.select(event_hour("b", 8, "s", "e", "t").alias("h")).orderBy("b").collect()] == [3, None]
    # band join is closed on both ends
    anchors = spark.createDataFrame([(1, T0 + dt.timedelta(hours=24))], "k long, a timestamp_ntz")
    grid = spark.createDataFrame([(1, h, T0 + dt.timedelta(hours=h)) for h in (0, 24, 48, 49)], "k long, h int, s timestamp_ntz")
    assert sorted(r.h for r in time_band_join(grid, anchors, ["k"], "s", "a", 24, 24).collect()) == [0, 24, 48]
    # hourly means drop null keys; membership flag is 0/1
    raw = spark.createDataFrame([(1, T0 + dt.timedelta(minutes=5), 2.0), (1, T0 + dt.timedelta(minutes=50), 4.0),
                                 (None, T0, 9.0)], "k long, t timestamp_ntz, v double")
    assert [(r.k, r.v) for r in hourly_mean(raw, ["k"], "t", ["v"]).collect()] == [(1, 3.0)]
    users = spark.createDataFrame([(1,), (2,)], "k long")
    ids = spark.createDataFrame([(2,), (2,), (None,)], "k long")
    assert sorted((r.k, r.f) for r in membership_flag(users, ids, "k", "k", "f").collect()) == [(1, 0), (2, 1)]


def test_ordered_page_reads_only_its_partitions(spark):
    from stayframe.operators.split import ordered_page
    df = spark.range(20000).select((F.col("id") * 7919 % 20011).alias("a"), F.col("id").alias("b"), F.lit("x").alias("_c"))
    want = sorted((r.a, r.b) for r in df.collect())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for offset, limit in [(0, 5), (10000, 50), (4990, 6000), (19990, 50), (20000, 5), (7, 0)]:
            page = ordered_page(df, ["a", "b"], offset, limit)
            assert [(r.a, r.b) for r in page.collect()] == want[offset:offset + limit]
            assert page.columns == df.columns
        page = ordered_page(df, ["a", "b"], 10000, 50)
        plan = page._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrdered" not in plan and "Limit" not in plan
        # of the four range partitions, one or two are read
        lo, hi = (int(v) for v in re.search(r"GreaterThanOrEqual\(_page,(\d+)\), LessThanOrEqual\(_page,(\d+)\)", plan.replace("`", "")).groups())
        assert hi - lo <= 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_outer_merge_pivot_takes_parameters_from_the_data(spark):
    from stayframe.operators.joins import outer_merge_pivot
    long = spark.createDataFrame([(1, "b", 1.0), (1, "a", 2.0), (2, "new", 3.0)], "k long, p string, v double")
    out = outer_merge_pivot(long, ["k"], "p", "v")
    assert out.columns == ["k", "a", "b", "new"]
    assert sorted(map(tuple, out.collect())) == [(1, 2.0, 1.0, None), (2, None, None, 3.0)]
    assert outer_merge_pivot(long, ["k"], "p", "v", ["a"]).columns == ["k", "a"]


def test_band_chunk_join_equals_the_plain_one(spark):
    from stayframe.operators.joins import band_chunk_join, time_band_join
    rnd = random.Random(5)
    s = seq("k", "hr")
    grid = spark.createDataFrame([(k, h, T0 + dt.timedelta(hours=8 * h + k)) for k in range(6) for h in range(40)],
                                 "k long, hr int, st timestamp_ntz")
    anchors = spark.createDataFrame([(k, T0 + dt.timedelta(minutes=rnd.randint(-6000, 25000)), T0 + dt.timedelta(hours=k))
                                     for k in range(7)], "k long, t timestamp_ntz, o timestamp_ntz")
    rows = lambda df: sorted((r.k, r.hr) for r in df.collect())
    want = rows(time_band_join(grid, anchors, ["k"], "st", "t", 48, 24))
    import stayframe.operators.joins as J
    for width in (1, 7, 4096):
        joined = J.chunk_join
        J.chunk_join = lambda r, f, q, lo, hi, how="inner", w=width: joined(r, f, q, lo, hi, how, w)
        try:
            assert rows(band_chunk_join(with_chunk(grid, s, width), anchors, s, "st", "t", 48, 24, "o", 8)) == want and want
        finally:
            J.chunk_join = joined


def test_grid_is_dealt_by_its_bins(spark, monkeypatch):
    """Few events over a long time make many bins: their tasks are as many as
    the bins need, and a roll-up takes place where the bins are made."""
    from stayframe.operators import grid as G
    monkeypatch.setattr(G, "BINS", 500)
    rows = [(u, dt.datetime(2020, 1, 1) + dt.timedelta(hours=h), float(h)) for u in (1, 2, None) for h in (0, 5, 9001)]
    ev = spark.createDataFrame(rows, "u long, ts timestamp, v double")
    g = G.event_grid(ev, ["u"], "ts", 1, [F.sum("v").alias("v")])
    tasks = g.groupBy(F.spark_partition_id()).count()
    assert g.rdd.getNumPartitions() >= 2 * 9002 // 500 and tasks.agg(F.sum("count")).first()[0] >= 2 * 9002
    aggs = [F.sum("v").alias("v"), F.count(F.lit(1)).alias("n")]
    for factor in (4, 3):
        near = G.coarsen(g, ["u"], "hr", factor, aggs, out="bin", chunk="_chunk")
        far = G.coarsen(g, ["u"], "hr", factor, aggs, out="bin")
        assert near.columns == far.columns and near.exceptAll(far).count() == far.exceptAll(near).count() == 0
        assert near.filter("u = 1").count() == -(-9002 // factor)
    plans = [G.coarsen(g, ["u"], "hr", 4, aggs, chunk=c)._jdf.queryExecution().executedPlan().toString() for c in ("_chunk", None)]
    assert plans[0].count("hashpartitioning(u") + 1 == plans[1].count("hashpartitioning(u")


def test_interval_totals_shuffle_no_intervals(spark):
    """Borders are made where an entity's events are: only rows before them are
    dealt, once; large and null entities take the other way to the same totals."""
    from stayframe.operators import grid as G
    rows = [(u, T0 + dt.timedelta(hours=5 * i), float(i % 7)) for u in (1, 2, None) for i in range(60 if u == 1 else 6)]
    ev = spark.createDataFrame(rows, "u long, t timestamp_ntz, v double")
    made = spark.createDataFrame([(u, 10 * (u or 5) + i, T0 + dt.timedelta(hours=7 * i)) for u in (1, 2, 3) for i in range(3)],
                                 "u long, g long, t0 timestamp_ntz")

    def expand(x):
        x = x.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(40))))
        return x.select("u", "g", "k", (F.col("t0") + F.make_dt_interval(hours=F.col("k"))).alias("x"))

    def beside(x):
        return x.groupBy("u", (10 * F.col("u")).alias("g"), F.lit(3).alias("k")).agg(F.max("v").alias("most"))

    def totals(target):
        return G.interval_totals(made, ev, ["u"], ["g"], "k", "x", "t", "v", "n", "m", target, expand=expand, also=beside)
    whole = [t for t in rows if t[0] is not None]
    want = {}
    for u in (1, 2, 3):
        for i in range(3):
            for k in range(40):
                lo = T0 + dt.timedelta(hours=7 * i + k)
                got = [v for w, t, v in whole if w == u and lo < t <= lo + dt.timedelta(hours=1)]
                most = max((v for w, _, v in whole if w == u), default=None) if i == 0 and k == 3 else None
                want[u, 10 * u + i, k] = (len(got), sum(got) / len(got) if got else None, most)
    for target in (1 << 16, 150):
        assert {(r.u, r.g, r.k): (r.n, r.m, r.most) for r in totals(target).collect()} == want
    known = ev.filter("u IS NOT NULL")
    plan = G.interval_totals(made, known, ["u"], ["g"], "k", "x", "t", "v", "n", "m", expand=expand)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.index("Generate explode") < plan.rindex("Exchange hashpartitioning")

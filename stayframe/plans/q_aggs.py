"""Aggregations and profiling (A1-A22, L1-L3)."""

from __future__ import annotations


from pyspark.sql import functions as F

from stayframe.operators.grid import coarsen, conditional_avgs, event_grid, hourly_mean
from stayframe.operators.profile import (describe, duplicate_groups, never_observed, null_by_entity,
                                         null_profile_write)
from stayframe.operators.quantile import exact_quantiles
from stayframe.operators.split import entity_ranks, ordered_page, ordered_split
from stayframe.plans.common import FEATURES, events, grid8, masked_grid8, r6, sql_g8, sql_masked
from stayframe.plans.q_relational import _sql_scores
from stayframe.plans.q_windows import MED_FILL, _sql_medians, _sql_window_sofa, scored_grid
from stayframe.sources.tables import table

F4 = list(FEATURES)
BATCH = 32


# ---- A1/A2/F1/F2 -------------------------------------------------------------------

def _hour_grid(spark, d):
    aggs = conditional_avgs("event_type", "value", {f: [f] for f in F4})
    return event_grid(events(spark, d), ["user_id"], "ts", 1, aggs, bin_col="hr")


def _rollup(factor: int):
    def q(spark, d):
        g = _hour_grid(spark, d)
        aggs = [F.min("starttime").alias("starttime"), F.max("endtime").alias("endtime"),
                *[F.avg(f).alias(f) for f in F4], F.min("view").alias("view_min"),
                F.max("purchase").alias("purchase_max"), F.count(F.lit(1)).alias("n_hours")]
        r = coarsen(g, ["user_id"], "hr", factor, aggs, out="bin", chunk="_chunk")
        return r.select("user_id", "bin", "starttime", "endtime", *[r6(f) for f in F4],
                        r6("view_min"), r6("purchase_max"), "n_hours")
    return q


def _sql_rollup(factor: int) -> str:
    return (f"WITH {sql_g8(width=1)}\nSELECT user_id, CAST(floor(hr / {factor}) AS INTEGER) AS bin, "
            "min(starttime) AS starttime, max(endtime) AS endtime, "
            + ", ".join(f"round(avg({f}), 6) AS {f}" for f in F4)
            + ", round(min(view), 6) AS view_min, round(max(purchase), 6) AS purchase_max, "
            "CAST(count(*) AS BIGINT) AS n_hours FROM g8 GROUP BY 1, 2")


# ---- A3/F6 ------------------------------------------------------------------------------

def a_hourly_mean(spark, d):
    h = hourly_mean(events(spark, d), ["user_id", "event_type"], "ts", ["value"])
    return h.select("user_id", "event_type", "hour", r6("value"))


# ---- A6 ------------------------------------------------------------------------------------

def a_first_above(spark, d):
    g = scored_grid(spark, d).filter(F.col("score") >= 2)
    a = g.groupBy("user_id").agg(F.min("hr").alias("first_hr"), F.min("starttime").alias("first_start"))
    return a.filter(F.col("first_hr") >= 3)


def _sql_first_above():
    head, tail = _sql_scores().rsplit("SELECT user_id, hr,", 1)
    inner = head + "SELECT user_id, hr, starttime," + tail
    return ("WITH sc AS (" + inner + ")\nSELECT user_id, min(hr) AS first_hr, min(starttime) AS first_start "
            "FROM sc WHERE score >= 2 GROUP BY user_id HAVING min(hr) >= 3")


# ---- A7 ---------------------------------------------------------------------------------------

PIVOT_MAP = {"engagement": ["click", "view"], "purchase": ["purchase"], "signup": ["signup"]}  # fixed


def a_pivot_avg(spark, d):
    aggs = conditional_avgs("event_type", "value", PIVOT_MAP)
    b = event_grid(events(spark, d), ["user_id"], "ts", 8, aggs, bin_col="hr", complete=False)
    return b.select("user_id", "hr", *[r6(c) for c in PIVOT_MAP])


SQL_PIVOT = (f"WITH {sql_g8()}\nSELECT user_id, hr, "
             + ", ".join(f"round(avg(CASE WHEN event_type IN ({', '.join(repr(t) for t in ids)}) THEN value END), 6) AS {c}"
                         for c, ids in PIVOT_MAP.items())
             + " FROM eb WHERE hr >= 0 GROUP BY user_id, hr")


# ---- A9/A11/A21 ---------------------------------------------------------------------------------

def _split_windows(spark, d):
    from stayframe.plans.q_models import sofa_windows
    return ordered_split(sofa_windows(spark, d), "user_id")


def a_cohort_counts(spark, d):
    w = _split_windows(spark, d)
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.countDistinct("user_id").alias("n_users"),
            F.countDistinct(F.when(F.col("is_event") == 1, F.col("user_id"))).alias("n_pos")]
    per = w.groupBy("split").agg(*aggs)
    # splits are disjoint by user: the totals are sums of the (three) split rows
    tot = per.agg(*[F.sum(c).cast("long").alias(c) for c in ("n_rows", "n_users", "n_pos")]) \
        .withColumn("split", F.lit("all"))
    out = per.unionByName(tot)
    return out.withColumn("n_windows", F.floor(F.col("n_rows") / 24).cast("long"))


def a_cohort_sizes(spark, d):
    g = grid8(spark, d, materialized=False)
    per = g.groupBy("user_id").agg(F.max("is_infection").alias("ev"))
    return per.agg(F.count(F.lit(1)).alias("n_all"), F.sum("ev").cast("long").alias("n_event"),
                   F.sum(1 - F.col("ev")).cast("long").alias("n_never"))


def _sql_split(src: str) -> str:
    """CTE ``sp``: src rows with the entity-aligned split by user_id order."""
    return f"""ur AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS rk, count(*) OVER () AS n
  FROM (SELECT DISTINCT user_id FROM {src})),
ul AS (SELECT user_id, CASE WHEN rk < floor(floor(n * 0.8) * 0.8) THEN 'train'
  WHEN rk < floor(n * 0.8) THEN 'valid' ELSE 'test' END AS split FROM ur),
sp AS (SELECT s.*, ul.split FROM {src} s JOIN ul ON s.user_id = ul.user_id)"""


def _sql_cohort_counts():
    base = _sql_window_sofa()
    head, tail = base.rsplit("\n", 1)
    return (head + ",\nwo AS (" + tail + "),\n" + _sql_split("wo") + """,
cc AS (SELECT split, count(*) AS n_rows, count(DISTINCT user_id) AS n_users,
  count(DISTINCT CASE WHEN is_event = 1 THEN user_id END) AS n_pos FROM sp GROUP BY split
  UNION ALL SELECT 'all', count(*), count(DISTINCT user_id), count(DISTINCT CASE WHEN is_event = 1 THEN user_id END) FROM sp)
SELECT split, CAST(n_rows AS BIGINT) AS n_rows, CAST(n_users AS BIGINT) AS n_users, CAST(n_pos AS BIGINT) AS n_pos,
  CAST(floor(n_rows / 24) AS BIGINT) AS n_windows FROM cc""")


# ---- A12-A15 ------------------------------------------------------------------------------------

def a_null_profile(spark, d):
    """Nulls of the grid, counted while it is written for the scans that follow."""
    return null_profile_write(grid8(spark, d, materialized=False), F4)[1]


def _sql_null_profile():
    per = " UNION ALL ".join(f"SELECT '{f}' AS feature, count(*) - count({f}) AS n_null, count(*) AS n_rows FROM g8"
                             for f in F4)
    return (f"WITH {sql_g8()},\np AS ({per}),\nt AS (SELECT * FROM p UNION ALL SELECT '__all__', sum(n_null), "
            "sum(n_rows) FROM p)\nSELECT feature, CAST(n_null AS BIGINT) AS n_null, round(n_null / n_rows, 3) AS ratio FROM t")


def a_null_by_subject(spark, d):
    r = null_by_entity(grid8(spark, d, materialized=False), ["user_id"], F4, min_rows=85)
    return r.select("user_id", "n_rows", r6("mean_nulls"), r6("ratio"))


def _sql_null_by_subject():
    nulls = " + ".join(f"CAST({f} IS NULL AS INTEGER)" for f in F4)
    return (f"WITH {sql_g8()}\nSELECT user_id, CAST(count(*) AS BIGINT) AS n_rows, round(avg({nulls}), 6) AS mean_nulls, "
            f"round(avg({nulls}) / {len(F4)}, 6) AS ratio FROM g8 GROUP BY user_id HAVING count(*) > 85")


def a_coverage(spark, d):
    r = never_observed(grid8(spark, d, materialized=False), ["user_id"], F4)
    return r.select("feature", r6("share_never"))


def _sql_coverage():
    per = ", ".join(f"count({f}) AS {f}" for f in F4)
    un = " UNION ALL ".join(f"SELECT '{f}' AS feature, round(avg(CAST({f} = 0 AS DOUBLE)), 6) AS share_never FROM pu"
                            for f in F4)
    return f"WITH {sql_g8()},\npu AS (SELECT user_id, {per} FROM g8 GROUP BY user_id)\n{un}"


# ---- A16 ------------------------------------------------------------------------------------------

def a_median(spark, d):
    m = masked_grid8(spark, d)
    med = exact_quantiles(m, F4, 0.5)
    rows = [(f, None if med[f] is None else round(med[f], 6)) for f in F4]
    return spark.createDataFrame(rows, "feature string, median double")


def _sql_median():
    un = " UNION ALL ".join(f"SELECT '{f}' AS feature, round({MED_FILL[f]}, 6) AS median" for f in F4)
    return f"WITH {sql_g8()},\n{sql_masked()},\n{_sql_medians()}\n{un}"


# ---- A17 --------------------------------------------------------------------------------------------

def a_describe(spark, d):
    r = describe(events(spark, d), "event_type", "value")
    return r.select("event_type", "count", *[r6(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


SQL_DESCRIBE = ("SELECT event_type, CAST(count(value) AS BIGINT) AS count, round(avg(value), 6) AS mean, "
                "round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min, "
                "round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50, "
                "round(quantile_cont(value, 0.75), 6) AS q75, round(max(value), 6) AS max FROM events GROUP BY event_type")


# ---- A18/L1 ------------------------------------------------------------------------------------------

def a_group_counts(spark, d):
    g = grid8(spark, d, materialized=False)
    r = g.groupBy("user_id").agg(*[F.count(f).alias(f"n_{f}") for f in F4])
    return r.orderBy(F.col("n_click").desc(), "user_id")


SQL_GROUP_COUNTS = (f"WITH {sql_g8()}\nSELECT user_id, " + ", ".join(f"CAST(count({f}) AS BIGINT) AS n_{f}" for f in F4)
                    + " FROM g8 GROUP BY user_id ORDER BY n_click DESC, user_id")


# ---- A19/A20 ------------------------------------------------------------------------------------------

LI_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def a_duplicates(spark, d):
    li = table(spark, d, "lineitem", LI_COLS).withColumn("label", (F.col("l_returnflag") == "R").cast("int"))
    tb = LI_COLS[2:]
    r = duplicate_groups(li, ["l_orderkey", "l_linenumber"], tb, "label",
                         ["l_partkey", "l_suppkey", "l_quantity", "l_shipdate"])
    return r.withColumn("first_l_quantity", F.round("first_l_quantity", 6))


def _sql_duplicates():
    order = ", ".join(LI_COLS[2:])
    return f"""WITH li AS (SELECT *, CAST(l_returnflag = 'R' AS INTEGER) AS label FROM lineitem),
g AS (SELECT l_orderkey, l_linenumber, count(*) AS n, max(label) AS label_max, min(label) AS label_min
  FROM li GROUP BY 1, 2 HAVING count(*) > 1),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn
  FROM li) WHERE rn = 1)
SELECT g.l_orderkey, g.l_linenumber, CAST(g.n AS BIGINT) AS n, g.label_max, g.label_min,
  f.l_partkey AS first_l_partkey, f.l_suppkey AS first_l_suppkey, round(f.l_quantity, 6) AS first_l_quantity,
  f.l_shipdate AS first_l_shipdate
FROM g JOIN f ON g.l_orderkey = f.l_orderkey AND g.l_linenumber = f.l_linenumber"""


# ---- A22 ------------------------------------------------------------------------------------------------

def a_batch_positives(spark, d):
    from stayframe.plans.q_models import sofa_windows
    w = sofa_windows(spark, d).groupBy("user_id").agg(F.max("is_event").alias("y"))
    r = entity_ranks(w, "user_id")
    x = w.join(r, "user_id").withColumn("batch", F.floor(F.col("_rank") / BATCH).cast("long"))
    return x.groupBy("batch").agg(F.count(F.lit(1)).alias("n_windows"), F.sum("y").cast("long").alias("n_pos"))


def _sql_batch_positives():
    base = _sql_window_sofa()
    head, tail = base.rsplit("\n", 1)
    return (head + ",\nwo AS (" + tail + "),\npw AS (SELECT user_id, max(is_event) AS y FROM wo GROUP BY user_id),\n"
            f"rk AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY user_id) - 1) / {BATCH}) AS BIGINT) AS batch FROM pw)\n"
            "SELECT batch, CAST(count(*) AS BIGINT) AS n_windows, CAST(sum(y) AS BIGINT) AS n_pos FROM rk GROUP BY batch")


# ---- L2/L3 ----------------------------------------------------------------------------------------------

def l_limit_offset(spark, d):
    g = grid8(spark, d, materialized=False).select("user_id", "hr", r6("click"))
    return ordered_page(g, ["user_id", "hr"], 100, 50)


SQL_LIMIT = (f"WITH {sql_g8()}\nSELECT user_id, hr, round(click, 6) AS click FROM g8 "
             "ORDER BY user_id, hr LIMIT 50 OFFSET 100")


QUERIES = {
    "a_rollup_8h": _rollup(8),
    "a_rollup_4h": _rollup(4),
    "a_hourly_mean": a_hourly_mean,
    "a_first_above": a_first_above,
    "a_pivot_avg": a_pivot_avg,
    "a_cohort_counts": a_cohort_counts,
    "a_cohort_sizes": a_cohort_sizes,
    "a_null_profile": a_null_profile,
    "a_null_by_subject": a_null_by_subject,
    "a_coverage": a_coverage,
    "a_median": a_median,
    "a_describe": a_describe,
    "a_group_counts": a_group_counts,
    "a_duplicates": a_duplicates,
    "a_batch_positives": a_batch_positives,
    "l_limit_offset": l_limit_offset,
}

ORACLE = {
    "a_rollup_8h": _sql_rollup(8),
    "a_rollup_4h": _sql_rollup(4),
    "a_hourly_mean": ("SELECT user_id, event_type, date_trunc('hour', ts) AS hour, round(avg(value), 6) AS value "
                      "FROM events GROUP BY 1, 2, 3"),
    "a_first_above": _sql_first_above(),
    "a_pivot_avg": SQL_PIVOT,
    "a_cohort_counts": _sql_cohort_counts(),
    "a_cohort_sizes": (f"WITH {sql_g8()},\npu AS (SELECT user_id, max(is_infection) AS ev FROM g8 GROUP BY user_id)\n"
                       "SELECT CAST(count(*) AS BIGINT) AS n_all, CAST(sum(ev) AS BIGINT) AS n_event, "
                       "CAST(sum(1 - ev) AS BIGINT) AS n_never FROM pu"),
    "a_null_profile": _sql_null_profile(),
    "a_null_by_subject": _sql_null_by_subject(),
    "a_coverage": _sql_coverage(),
    "a_median": _sql_median(),
    "a_describe": SQL_DESCRIBE,
    "a_group_counts": SQL_GROUP_COUNTS,
    "a_duplicates": _sql_duplicates(),
    "a_batch_positives": _sql_batch_positives(),
    "l_limit_offset": SQL_LIMIT,
}

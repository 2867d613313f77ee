"""Scans, predicates and joins (S1-S2, P1-P15, J1-J20) on the fixture tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.functions.columns import binarize, bin_index, year_of
from stayframe.operators.clean import add_scores, drop_null_rows, fill_constant, null_indicators
from stayframe.operators.grid import entity_bounds, hourly_mean, interval_totals, month_bin
from stayframe.operators.joins import (band_chunk_join, chunk_join, membership_flag, not_in, null_safe_join,
                                       outer_merge_pivot)
from stayframe.operators.seq import salted_join
from stayframe.plans.common import (EVENT_MIN_VALUE, EVENT_TYPE, FEATURES, G8_SEQ, OUTLIER_RULES,
                                    SCORE_PARTS, URGENT, events, grid8, r6, sql_g8, sql_rule)
from stayframe.plans.q_windows import _sql_event_table, event_table, stays
from stayframe.session import materialize
from stayframe.sources.tables import table

F4 = list(FEATURES)
TYPES = ("click", "view", "purchase", "signup", "error")   # fixed: every event type
MEMBER_PRIORITIES = ("1-URGENT", "2-HIGH")                   # fixed: P4 literal list


def patients(spark: SparkSession, d: str) -> DataFrame:
    """customer as patients: anchor_age = 15 + key % 70, anchor_year = 2000 + key % 20."""
    c = table(spark, d, "customer", ["c_custkey"])
    return c.select(F.col("c_custkey").alias("subject_id"),
                    (F.lit(15) + F.col("c_custkey") % 70).cast("int").alias("anchor_age"),
                    (F.lit(2000) + F.col("c_custkey") % 20).cast("int").alias("anchor_year"))


SQL_PATIENTS = ("pat AS (SELECT c_custkey AS subject_id, CAST(15 + c_custkey % 70 AS INTEGER) AS anchor_age, "
                "CAST(2000 + c_custkey % 20 AS INTEGER) AS anchor_year FROM customer)")


# ---- S1/S2/P1/P3 ---------------------------------------------------------------

def s_projected_scan(spark, d):
    ev = table(spark, d, "events")
    return ev.filter(F.col("value") >= EVENT_MIN_VALUE).select("user_id", "ts", "value")


# ---- P2/P6 ---------------------------------------------------------------------

def p_outlier_mask(spark, d):
    """Null counts per feature before and after the range mask, one pass."""
    g = grid8(spark, d, materialized=False)
    aggs = []
    for f in F4:
        kept = OUTLIER_RULES[f].keep(F.col(f)) if f in OUTLIER_RULES else F.lit(True)
        aggs += [F.sum(F.col(f).isNull().cast("long")).alias(f"r_{f}"),
                 F.sum((F.col(f).isNull() | ~kept).cast("long")).alias(f"m_{f}")]
    a = g.agg(*aggs)
    stack = "stack(4, " + ", ".join(f"'{f}', r_{f}, m_{f}" for f in F4) + ") AS (feature, nulls_raw, nulls_masked)"
    return a.selectExpr(stack).withColumn("masked", F.col("nulls_masked") - F.col("nulls_raw"))


def _sql_outlier_mask():
    sel = ", ".join((f"{sql_rule(f, OUTLIER_RULES[f])} AS {f}" if f in OUTLIER_RULES else f) for f in F4)
    un = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST(sum(CASE WHEN g.{f} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls_raw, "
        f"CAST(sum(CASE WHEN m.{f} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls_masked "
        f"FROM g8 g JOIN m ON g.user_id = m.user_id AND g.hr = m.hr" for f in F4)
    return (f"WITH {sql_g8()},\nm AS (SELECT user_id, hr, {sel} FROM g8),\nu AS ({un})\n"
            "SELECT feature, nulls_raw, nulls_masked, nulls_masked - nulls_raw AS masked FROM u")


# ---- P7/W15/F4/J9 ------------------------------------------------------------------

def p_band_flag(spark, d):
    return event_table(spark, d, grid8(spark, d, materialized=False)).select("user_id", "hr", "is_infection", "infection_hour")


# ---- P8/J11/P4 -----------------------------------------------------------------------

def p_membership_flag(spark, d):
    users = table(spark, d, "events", ["user_id"]).distinct()
    o = table(spark, d, "orders", ["o_custkey", "o_orderpriority"])
    ids = o.filter(F.col("o_orderpriority").isin(list(MEMBER_PRIORITIES)))
    return membership_flag(users, ids, "user_id", "o_custkey", "icd_event")


# ---- P9/P10/P11/F13 --------------------------------------------------------------------

def p_three_way_score(spark, d):
    from stayframe.operators.impute import impute
    from stayframe.plans.common import G8_SEQ
    g = impute(grid8(spark, d), G8_SEQ, F4, ffill=True)
    g = add_scores(g, SCORE_PARTS, total="score", flag="is_qsofa", flag_at=2)
    g = g.withColumn("const0", F.lit(0)).withColumn("half", binarize(F.col("score") / 3.0, 0.5))
    return g.select("user_id", "hr", "click_score", "view_score", "purchase_score", "score",
                    "is_qsofa", "const0", "half")


# ---- P12/P13/J15/F7 ------------------------------------------------------------------------

def _start_years(spark, d):
    ev = table(spark, d, "events", ["user_id", "ts"])
    return ev.select("user_id", year_of("ts").alias("year")).distinct()


def p_age(spark, d):
    sy = _start_years(spark, d)
    j = sy.join(patients(spark, d), sy.user_id == F.col("subject_id"), "left")
    age = (F.col("year") - F.col("anchor_year") + F.col("anchor_age")).cast("double")
    return j.select("user_id", "year", age.alias("age")).filter(F.col("age") > 18)


# ---- P5/P14/P15/F10 --------------------------------------------------------------------------

def p_null_handling(spark, d):
    g = drop_null_rows(grid8(spark, d, materialized=False), ["click"])
    g = null_indicators(g, ["view", "purchase"])
    g = fill_constant(g, 0.0, ["view", "purchase", "signup"])
    return g.select("user_id", "hr", r6("click"), "view_isnull", "purchase_isnull",
                    r6("view"), r6("purchase"), r6("signup"))


# ---- J1/A8, J2: fixed-width right-closed interval join -----------------------------------------

def _right_closed_aggs(spark, d, types=None):
    """Per-user 8h bins as (start, end]: bin = ceil(dt/8h) - 1, aggregated, then
    left-joined onto the G8 skeleton - an equi join, not a range join."""
    g = grid8(spark, d, materialized=False).select("user_id", "hr")
    ev = events(spark, d)
    if types:
        ev = ev.filter(F.col("event_type").isin(list(types)))   # the ON-clause item filter
    o = entity_bounds(events(spark, d), ["user_id"], "ts").drop("_last")
    e = salted_join(ev, o, ["user_id"], "ts").withColumn("hr", bin_index("ts", "origin", 8, "right"))
    a = e.groupBy("user_id", "hr").agg(F.count(F.lit(1)).alias("n_events"), F.avg("value").alias("avg_value"))
    j = g.join(a, ["user_id", "hr"], "left").fillna(0, ["n_events"])
    return j.select("user_id", "hr", "n_events", r6("avg_value"))


def j_interval_right_closed(spark, d):
    return _right_closed_aggs(spark, d)


def j_interval_item_on(spark, d):
    return _right_closed_aggs(spark, d, types=("click", "view"))


def _sql_interval(types=None):
    on = f" AND e.event_type IN ({', '.join(repr(t) for t in types)})" if types else ""
    return (f"WITH {sql_g8()}\nSELECT g8.user_id, g8.hr, CAST(count(e.value) AS BIGINT) AS n_events, "
            "round(avg(e.value), 6) AS avg_value FROM g8 LEFT JOIN events e ON g8.user_id = e.user_id "
            f"AND e.ts > g8.starttime AND e.ts <= g8.endtime{on} GROUP BY g8.user_id, g8.hr")


# ---- J3/J4/J5: irregular (monthly) grid, two-key and one-key range joins ------------------------

def _orders(spark, d):
    """Orders with the index of their last monthly bin (s, e], which holds the
    last shipment (one bin at least)."""
    o = table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    last = table(spark, d, "lineitem", ["l_orderkey", "l_shipdate"]).groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("last"))
    o = o.join(last, o.o_orderkey == last.l_orderkey, "left")
    last_bin = F.greatest(F.coalesce(month_bin("last", "o_orderdate"), F.lit(0)), F.lit(0))
    return materialize(o.select("o_custkey", "o_orderkey", "o_orderdate", last_bin.alias("last_bin")), "orders")


def _order_borders(orders):
    """Borders of each order's monthly bins."""
    g = orders.select("o_custkey", "o_orderkey", "o_orderdate", F.explode(F.sequence(F.lit(0), F.col("last_bin") + 1)).alias("k"))
    return g.select("o_custkey", "o_orderkey", "k", (F.col("o_orderdate") + F.make_ym_interval(F.lit(0), F.col("k"))).alias("border"))


def j_interval_composite(spark, d):
    """Line items (mapped to their order's customer through the distinct id
    map) aggregated per monthly bin (s, e] of each order: those of the order
    itself, whose bin is arithmetic on its months, and those of the whole
    customer, which lie in bins of several orders (``interval_totals``)."""
    li = table(spark, d, "lineitem", ["l_orderkey", "l_shipdate", "l_quantity"])
    idmap = table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"]).distinct()
    ev = materialize(li.join(idmap, li.l_orderkey == idmap.o_orderkey, "left").select(
        "o_custkey", F.col("l_orderkey").alias("o_orderkey"), "o_orderdate", "l_shipdate", "l_quantity"), "items")
    keys = ["o_custkey", "o_orderkey", "k"]

    def two(items):
        return items.withColumn("k", month_bin("l_shipdate", "o_orderdate")).groupBy(*keys).agg(
            F.count("l_quantity").alias("n_two"), F.avg("l_quantity").alias("qty_two"))
    both = interval_totals(_orders(spark, d), ev, ["o_custkey"], keys[:2], "k", "border", "l_shipdate", "l_quantity",
                           "n_one", "qty_one", expand=_order_borders, also=two)
    return both.select(*keys, F.coalesce("n_two", F.lit(0)).alias("n_two"), r6("qty_two"), "n_one", r6("qty_one"))


SQL_J_COMPOSITE = """WITH b AS (SELECT o.o_custkey, o.o_orderkey, o.o_orderdate, l.last,
  unnest(range(0, greatest(coalesce(datediff('month', o.o_orderdate, l.last), 0), 0) + 1)) AS k
  FROM orders o LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last FROM lineitem GROUP BY 1) l
  ON o.o_orderkey = l.l_orderkey),
g AS (SELECT o_custkey, o_orderkey, CAST(k AS INTEGER) AS k,
  o_orderdate + to_months(CAST(k AS INTEGER)) AS bin_start, o_orderdate + to_months(CAST(k AS INTEGER) + 1) AS bin_end
  FROM b WHERE k = 0 OR o_orderdate + to_months(CAST(k AS INTEGER)) < last),
ev AS (SELECT m.o_custkey, l.l_orderkey AS o_orderkey, l.l_shipdate, l.l_quantity
  FROM lineitem l LEFT JOIN (SELECT DISTINCT o_orderkey, o_custkey FROM orders) m ON l.l_orderkey = m.o_orderkey),
two AS (SELECT g.o_custkey, g.o_orderkey, g.k, count(ev.l_quantity) AS n_two, avg(ev.l_quantity) AS qty_two
  FROM g LEFT JOIN ev ON g.o_custkey = ev.o_custkey AND g.o_orderkey = ev.o_orderkey
  AND ev.l_shipdate > g.bin_start AND ev.l_shipdate <= g.bin_end GROUP BY 1, 2, 3),
one AS (SELECT g.o_custkey, g.o_orderkey, g.k, count(ev.l_quantity) AS n_one, avg(ev.l_quantity) AS qty_one
  FROM g LEFT JOIN ev ON g.o_custkey = ev.o_custkey
  AND ev.l_shipdate > g.bin_start AND ev.l_shipdate <= g.bin_end GROUP BY 1, 2, 3)
SELECT two.o_custkey, two.o_orderkey, two.k, CAST(n_two AS BIGINT) AS n_two, round(qty_two, 6) AS qty_two,
  CAST(n_one AS BIGINT) AS n_one, round(qty_one, 6) AS qty_one
FROM two JOIN one ON two.o_custkey = one.o_custkey AND two.o_orderkey = one.o_orderkey AND two.k = one.k"""


# ---- J6/J7/A10/F3 ----------------------------------------------------------------------------

def j_first_year(spark, d):
    sy = _start_years(spark, d)
    p = patients(spark, d)
    j = sy.join(p, sy.user_id == p.subject_id, "right")
    age = (F.col("year") - F.col("anchor_year") + F.col("anchor_age")).cast("int")
    return j.select("subject_id", "user_id", "year", age.alias("age"))


# ---- J8/A4/A10 ---------------------------------------------------------------------------------

def j_first_infection(spark, d):
    ev = events(spark, d).filter(F.col("event_type") == EVENT_TYPE)
    sus = ev.select("user_id", "ts", (F.col("value") >= EVENT_MIN_VALUE).cast("int").alias("suspected"))
    sy = _start_years(spark, d)
    dx = table(spark, d, "orders", ["o_custkey", "o_orderpriority"]).filter(F.col("o_orderpriority") == URGENT)
    j = sus.join(sy.select("user_id").distinct(), "user_id").join(
        dx.select(F.col("o_custkey").alias("user_id")), "user_id", "left_semi")
    return j.filter(F.col("suspected") == 1).groupBy("user_id").agg(F.min("ts").alias("infection_time"))


# ---- J10/J12/J19 --------------------------------------------------------------------------------

def j_cohort_members(spark, d):
    """Grid rows of the users with an onset, met chunk by chunk."""
    cohort = stays(spark, d).filter(F.col("infection_time").isNotNull()).select("user_id", "last_bin")
    g = chunk_join(grid8(spark, d), cohort, G8_SEQ, F.lit(0), F.col("last_bin"), "left_semi")
    return g.select("user_id", "hr", *[r6(f) for f in F4])


# ---- J13/J20 -------------------------------------------------------------------------------------

def j_not_in(spark, d):
    users = table(spark, d, "events", ["user_id"]).distinct()
    o = table(spark, d, "orders", ["o_custkey", "o_orderpriority"]).filter(F.col("o_orderpriority") == URGENT)
    return not_in(users, o, "user_id", "o_custkey")


def j_not_in_null(spark, d):
    """The list comes from a left join and so holds nulls: NOT IN gives no rows."""
    users = table(spark, d, "events", ["user_id"]).distinct()
    c = table(spark, d, "customer", ["c_custkey"])
    o = table(spark, d, "orders", ["o_custkey", "o_orderpriority"]).filter(F.col("o_orderpriority") == URGENT)
    lst = c.join(o, c.c_custkey == o.o_custkey, "left").select("o_custkey")
    return not_in(users, lst, "user_id", "o_custkey")


# ---- J14/A5/F5 -----------------------------------------------------------------------------------

def j_time_band(spark, d):
    """Grid rows within 48 hours before and 24 hours after the user's first
    flagged event, by the chunks that band can touch."""
    flagged = (F.col("event_type") == EVENT_TYPE) & (F.col("value") >= EVENT_MIN_VALUE)
    inf = events(spark, d).groupBy("user_id").agg(
        F.max(F.when(F.col("event_type") == EVENT_TYPE, flagged.cast("int"))).alias("flag"),
        F.min(F.when(flagged, F.col("ts"))).alias("t"), F.min("ts").alias("origin")).filter(F.col("flag") == 1)
    inf = materialize(inf.drop("flag"), "anchors")
    g = grid8(spark, d).select("user_id", "hr", "starttime", G8_SEQ.chunk)
    return band_chunk_join(g, inf, G8_SEQ, "starttime", "t", 48, 24, "origin", 8).select("user_id", "hr", "starttime", "t")


# ---- J16/J17/J18: N-way outer merge as union + pivot -----------------------------------------------

def j_outer_merge(spark, d):
    """Hourly means of the event types merged on (user, hour): four types as
    one union + pivot (no chain of full joins), the fifth (kept apart, like a
    lab file) merged by a null-safe full outer join."""
    ev = events(spark, d)
    hm = hourly_mean(ev, ["user_id", "event_type"], "ts", ["value"])
    wide = outer_merge_pivot(hm.filter(F.col("event_type") != EVENT_TYPE), ["user_id", "hour"], "event_type",
                             "value")
    lab = hm.filter(F.col("event_type") == EVENT_TYPE).select("user_id", "hour", F.col("value").alias(EVENT_TYPE))
    merged = null_safe_join(wide, lab, ["user_id", "hour"], "full").withColumn("year", year_of("hour"))
    found = [c for c in wide.columns if c not in ("user_id", "hour")]
    return merged.select("user_id", "hour", "year", *[r6(t) for t in [*found, EVENT_TYPE]])


def _sql_outer_merge():
    parts = [f"t_{t} AS (SELECT user_id, date_trunc('hour', ts) AS hour, avg(value) AS {t} FROM events "
             f"WHERE event_type = '{t}' GROUP BY 1, 2)" for t in TYPES]
    join = f"t_{TYPES[0]}"
    for t in TYPES[1:]:
        join += f" FULL OUTER JOIN t_{t} USING (user_id, hour)"
    return ("WITH " + ",\n".join(parts) + "\nSELECT user_id, hour, CAST(year(hour) AS INTEGER) AS year, "
            + ", ".join(f"round({t}, 6) AS {t}" for t in TYPES) + f" FROM {join}")


QUERIES = {
    "s_projected_scan": s_projected_scan,
    "p_outlier_mask": p_outlier_mask,
    "p_band_flag": p_band_flag,
    "p_membership_flag": p_membership_flag,
    "p_three_way_score": p_three_way_score,
    "p_age": p_age,
    "p_null_handling": p_null_handling,
    "j_interval_right_closed": j_interval_right_closed,
    "j_interval_item_on": j_interval_item_on,
    "j_interval_composite": j_interval_composite,
    "j_first_year": j_first_year,
    "j_first_infection": j_first_infection,
    "j_cohort_members": j_cohort_members,
    "j_not_in": j_not_in,
    "j_not_in_null": j_not_in_null,
    "j_time_band": j_time_band,
    "j_outer_merge": j_outer_merge,
}


def _sql_scores():
    from stayframe.plans.common import sql_impute
    parts = {c: f"coalesce(CAST({c} {op} {th} AS INTEGER), 0)" for c, (op, th) in SCORE_PARTS.items()}
    total = " + ".join(parts.values())
    return (f"WITH {sql_g8()},\n{sql_impute('g8', 'ff', F4, ffill=True)}\n"
            f"SELECT user_id, hr, {parts['click']} AS click_score, {parts['view']} AS view_score, "
            f"{parts['purchase']} AS purchase_score, {total} AS score, CAST({total} >= 2 AS INTEGER) AS is_qsofa, "
            f"0 AS const0, CASE WHEN ({total}) / 3.0 >= 0.5 THEN 1 ELSE 0 END AS half FROM ff")


ORACLE = {
    "s_projected_scan": f"SELECT user_id, ts, value FROM events WHERE value >= {EVENT_MIN_VALUE}",
    "p_outlier_mask": _sql_outlier_mask(),
    "p_band_flag": f"WITH {_sql_event_table()}\nSELECT user_id, hr, is_infection, infection_hour FROM et",
    "p_membership_flag": (
        "SELECT u.user_id, CASE WHEN m.k IS NULL THEN 0 ELSE 1 END AS icd_event FROM (SELECT DISTINCT user_id FROM events) u "
        "LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority IN "
        f"({', '.join(repr(p) for p in MEMBER_PRIORITIES)})) m ON u.user_id = m.k"),
    "p_three_way_score": _sql_scores(),
    "p_age": (f"WITH {SQL_PATIENTS},\nsy AS (SELECT DISTINCT user_id, CAST(year(ts) AS INTEGER) AS year FROM events)\n"
              "SELECT * FROM (SELECT sy.user_id, sy.year, CAST(sy.year - p.anchor_year + p.anchor_age AS DOUBLE) AS age "
              "FROM sy LEFT JOIN pat p ON sy.user_id = p.subject_id) WHERE age > 18"),
    "p_null_handling": (f"WITH {sql_g8()}\nSELECT user_id, hr, round(click, 6) AS click, "
                        "CAST(view IS NULL AS INTEGER) AS view_isnull, CAST(purchase IS NULL AS INTEGER) AS purchase_isnull, "
                        "round(coalesce(view, 0), 6) AS view, round(coalesce(purchase, 0), 6) AS purchase, "
                        "round(coalesce(signup, 0), 6) AS signup FROM g8 WHERE click IS NOT NULL"),
    "j_interval_right_closed": _sql_interval(),
    "j_interval_item_on": _sql_interval(("click", "view")),
    "j_interval_composite": SQL_J_COMPOSITE,
    "j_first_year": (f"WITH {SQL_PATIENTS},\nsy AS (SELECT DISTINCT user_id, CAST(year(ts) AS INTEGER) AS year FROM events)\n"
                     "SELECT p.subject_id, sy.user_id, sy.year, CAST(sy.year - p.anchor_year + p.anchor_age AS INTEGER) AS age "
                     "FROM sy RIGHT JOIN pat p ON sy.user_id = p.subject_id"),
    "j_first_infection": (
        "SELECT s.user_id, min(s.ts) AS infection_time FROM "
        f"(SELECT user_id, ts, CAST(value >= {EVENT_MIN_VALUE} AS INTEGER) AS suspected FROM events WHERE event_type = '{EVENT_TYPE}') s "
        "JOIN (SELECT DISTINCT user_id FROM events) r ON s.user_id = r.user_id "
        f"WHERE s.suspected = 1 AND s.user_id IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '{URGENT}') "
        "GROUP BY s.user_id"),
    "j_cohort_members": (f"WITH {sql_g8()}\nSELECT user_id, hr, " + ", ".join(f"round({f}, 6) AS {f}" for f in F4)
                         + f" FROM g8 WHERE user_id IN (SELECT user_id FROM events WHERE event_type = '{EVENT_TYPE}' "
                         f"AND value >= {EVENT_MIN_VALUE})"),
    "j_not_in": ("SELECT DISTINCT user_id FROM events WHERE user_id NOT IN "
                 f"(SELECT o_custkey FROM orders WHERE o_orderpriority = '{URGENT}')"),
    "j_not_in_null": ("SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT o.o_custkey FROM customer c "
                      f"LEFT JOIN orders o ON c.c_custkey = o.o_custkey AND o.o_orderpriority = '{URGENT}')"),
    "j_time_band": (
        f"WITH {sql_g8()},\ninf AS (SELECT user_id, max(CAST(value >= {EVENT_MIN_VALUE} AS INTEGER)) AS flag, "
        f"min(CASE WHEN value >= {EVENT_MIN_VALUE} THEN ts END) AS t FROM events WHERE event_type = '{EVENT_TYPE}' GROUP BY user_id)\n"
        "SELECT g8.user_id, g8.hr, g8.starttime, inf.t FROM g8 LEFT JOIN inf ON g8.user_id = inf.user_id "
        "WHERE inf.flag = 1 AND g8.starttime BETWEEN inf.t - INTERVAL 48 HOUR AND inf.t + INTERVAL 24 HOUR"),
    "j_outer_merge": _sql_outer_merge(),
}

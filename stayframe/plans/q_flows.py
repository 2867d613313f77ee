"""Flows that chain several operators the way the reference's notebooks do
(A20, J10, J14 with A6, J16, J18, L5, S8 and the 4-hour score windows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.functions.columns import year_of
from stayframe.operators import impute as imp
from stayframe.operators.clean import add_scores
from stayframe.operators.cohort import lag_sum, onset_windows
from stayframe.operators.grid import hourly_mean
from stayframe.operators.joins import band_chunk_join, not_in, outer_merge
from stayframe.operators.profile import keep_first
from stayframe.operators.split import shuffled_ranks, shuffled_split
from stayframe.plans.common import (EVENT_MIN_VALUE, EVENT_TYPE, FEATURES, G8_SEQ, SCORE_PARTS, URGENT, events, grid8, r6, sql_g8)
from stayframe.plans.q_aggs import LI_COLS
from stayframe.plans.q_windows import _sql_scored, _sql_windows, scored_grid, stays
from stayframe.session import materialize
from stayframe.sources.saved import SavedTables, merge_saved
from stayframe.sources.tables import table

F4 = list(FEATURES)
USERS = "(SELECT DISTINCT user_id FROM events)"


# ---- A20: drop duplicates, keep the first ---------------------------------------

def a_keep_first(spark: SparkSession, d: str) -> DataFrame:
    li = keep_first(table(spark, d, "lineitem", LI_COLS), ["l_orderkey", "l_linenumber"], LI_COLS[2:])
    return li.select(*LI_COLS)


SQL_KEEP_FIRST = (f"SELECT {', '.join(LI_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
                  f"ORDER BY {', '.join(LI_COLS[2:])}) AS rn FROM lineitem) WHERE rn = 1")


# ---- J14 then A6: first time above the threshold inside the onset band -------------

def j_band_first(spark: SparkSession, d: str) -> DataFrame:
    inf = stays(spark, d).filter(F.col("infection_time").isNotNull()).select("user_id", "infection_time", "origin")
    g = band_chunk_join(scored_grid(spark, d), inf, G8_SEQ, "starttime", "infection_time", 48, 24, "origin", 8)
    a = g.filter(F.col("score") >= 2).groupBy("user_id").agg(F.min("hr").alias("first_hr"),
                                                             F.min("starttime").alias("first_start"))
    return a.filter(F.col("first_hr") >= 3)


SQL_BAND_FIRST = (f"WITH {_sql_scored()},\n"
                  f"inf AS (SELECT user_id, min(ts) AS t FROM events WHERE event_type = '{EVENT_TYPE}' "
                  f"AND value >= {EVENT_MIN_VALUE} GROUP BY user_id)\n"
                  "SELECT sc.user_id, min(sc.hr) AS first_hr, min(sc.starttime) AS first_start FROM sc JOIN inf "
                  "ON sc.user_id = inf.user_id WHERE sc.starttime BETWEEN inf.t - INTERVAL 48 HOUR AND inf.t + INTERVAL 24 HOUR "
                  "AND sc.score >= 2 GROUP BY sc.user_id HAVING min(sc.hr) >= 3")


# ---- J16: left merge on key and derived year ------------------------------------------

def j_year_merge(spark: SparkSession, d: str) -> DataFrame:
    """Hourly means joined to the customer's orders of the same year."""
    h = hourly_mean(events(spark, d), ["user_id"], "ts", ["value"]).withColumn("year", year_of("hour"))
    o = table(spark, d, "orders", ["o_custkey", "o_orderdate"]).groupBy(
        F.col("o_custkey").alias("user_id"), year_of("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n_orders"))
    return h.join(o, ["user_id", "year"], "left").select("user_id", "hour", "year", r6("value"), "n_orders")


SQL_YEAR_MERGE = ("WITH h AS (SELECT user_id, date_trunc('hour', ts) AS hour, avg(value) AS value FROM events "
                  "WHERE user_id IS NOT NULL GROUP BY 1, 2), "
                  "o AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n FROM orders GROUP BY 1, 2) "
                  "SELECT h.user_id, h.hour, CAST(year(h.hour) AS INTEGER) AS year, round(h.value, 6) AS value, "
                  "CAST(o.n AS BIGINT) AS n_orders FROM h LEFT JOIN o ON h.user_id = o.o_custkey AND year(h.hour) = o.y")


# ---- J18: three keys, null keys, several rows per key ------------------------------------

def j_three_key_merge(spark: SparkSession, d: str) -> DataFrame:
    """Events of one half of the types merged with the other half on (user,
    day, kind): kind is null for errors, and a key may hold several rows."""
    ev = events(spark, d).select("user_id", F.to_date("ts").alias("day"), "event_type", "value")
    kind = F.when(F.col("event_type") != EVENT_TYPE, F.lit("act")).alias("kind")
    left = ev.filter(F.col("event_type").isin("click", EVENT_TYPE)).select("user_id", "day", kind, F.col("value").alias("a"))
    right = ev.filter(F.col("event_type").isin("view", EVENT_TYPE)).select("user_id", "day", kind, F.col("value").alias("b"))
    out = outer_merge([left, right], ["user_id", "day", "kind"])
    return out.select("user_id", "day", "kind", r6("a"), r6("b"))


SQL_THREE_KEY = (f"WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type, value, "
                 f"CASE WHEN event_type <> '{EVENT_TYPE}' THEN 'act' END AS kind FROM events), "
                 f"l AS (SELECT * FROM e WHERE event_type IN ('click', '{EVENT_TYPE}')), "
                 f"r AS (SELECT * FROM e WHERE event_type IN ('view', '{EVENT_TYPE}')) "
                 "SELECT coalesce(l.user_id, r.user_id) AS user_id, coalesce(l.day, r.day) AS day, coalesce(l.kind, r.kind) AS kind, "
                 "round(l.value, 6) AS a, round(r.value, 6) AS b FROM l FULL OUTER JOIN r ON l.user_id IS NOT DISTINCT FROM r.user_id "
                 "AND l.day IS NOT DISTINCT FROM r.day AND l.kind IS NOT DISTINCT FROM r.kind")


# ---- J10: cohort join that multiplies rows ---------------------------------------------------

def j_cohort_multiply(spark: SparkSession, d: str) -> DataFrame:
    """Grid rows once for every urgent order of the user."""
    o = table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"]).filter(F.col("o_orderpriority") == URGENT)
    g = grid8(spark, d, materialized=False).select("user_id", "hr")
    return g.join(o.select(F.col("o_custkey").alias("user_id"), "o_orderkey"), "user_id").select("user_id", "hr", "o_orderkey")


SQL_MULTIPLY = (f"WITH {sql_g8()}\nSELECT g8.user_id, g8.hr, o.o_orderkey FROM g8 JOIN orders o ON g8.user_id = o.o_custkey "
                f"AND o.o_orderpriority = '{URGENT}'")


# ---- J13: NOT IN an empty list -----------------------------------------------------------------

def j_not_in_empty(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders", ["o_custkey", "o_orderpriority"]).filter(F.col("o_orderpriority") == "no such priority")
    return not_in(table(spark, d, "events", ["user_id"]).distinct(), o, "user_id", "o_custkey")


# ---- L5: shuffled order of the stays, and the split in that order --------------------------------

def l_shuffle(spark: SparkSession, d: str) -> DataFrame:
    return shuffled_ranks(table(spark, d, "events", ["user_id"]), "user_id").select("user_id", F.col("_rank").alias("place"))


SQL_PLACES = f"SELECT user_id, row_number() OVER (ORDER BY md5('7:' || user_id), user_id) - 1 AS place FROM {USERS}"


def l_shuffled_split(spark: SparkSession, d: str) -> DataFrame:
    users = table(spark, d, "events", ["user_id"]).distinct()
    return shuffled_split(users, "user_id").select("user_id", "split")


SQL_SHUFFLED_SPLIT = (f"WITH p AS ({SQL_PLACES}), n AS (SELECT floor(count(*) * 0.8) AS t FROM p) "
                      "SELECT user_id, CASE WHEN place < floor(n.t * 0.8) THEN 'train' WHEN place < n.t THEN 'valid' "
                      "ELSE 'test' END AS split FROM p, n")


# ---- S8: CREATE TABLE AS saved tables, read back --------------------------------------------------

def s_saved_table(spark: SparkSession, d: str) -> DataFrame:
    """Daily means saved as a table in the shared folder and read by name; the
    table is dropped when the result is written."""
    ev = events(spark, d)
    daily = ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.avg("value").alias("value"), F.count(F.lit(1)).alias("n"))
    with SavedTables(spark) as saved:
        saved.save(daily, "daily")
        return materialize(spark.table(saved.names[0]).select("user_id", "day", r6("value"), "n"), "saved")


BUCKETS = 8
MERGED = ("click", "view", "purchase")      # fixed: the parameters merged


def hourly_tables(spark: SparkSession, d: str, saved: SavedTables) -> tuple[DataFrame, list[DataFrame]]:
    """Hourly means of three parameters and all their keys, each a table bucketed
    by (user, hour)."""
    keys = ["user_id", "hour"]
    ev = events(spark, d).filter(F.col("event_type").isin(*MERGED))
    hm = materialize(hourly_mean(ev, ["user_id", "event_type"], "ts", ["value"]), "hourly")
    parts = [saved.save(hm.filter(F.col("event_type") == t).select(*keys, F.col("value").alias(t)), t, keys, BUCKETS) for t in MERGED]
    return saved.save(hm.select(*keys).distinct(), "spine", keys, BUCKETS), parts


def s_bucketed_merge(spark: SparkSession, d: str) -> DataFrame:
    """The three parameters merged from their bucketed tables; no join has an
    exchange."""
    with SavedTables(spark) as saved:
        spine, parts = hourly_tables(spark, d, saved)
        return materialize(merge_saved(spine, parts, ["user_id", "hour"]).select("user_id", "hour", *[r6(t) for t in MERGED]), "merged")


SQL_BUCKETED = ("WITH " + ", ".join(f"t_{t} AS (SELECT user_id, date_trunc('hour', ts) AS hour, avg(value) AS {t} FROM events "
                                    f"WHERE event_type = '{t}' GROUP BY 1, 2)" for t in MERGED)
                + "\nSELECT user_id, hour, " + ", ".join(f"round({t}, 6) AS {t}" for t in MERGED) + f" FROM t_{MERGED[0]}"
                + "".join(f" FULL OUTER JOIN t_{t} USING (user_id, hour)" for t in MERGED[1:]))

SQL_SAVED = "SELECT user_id, CAST(ts AS DATE) AS day, round(avg(value), 6) AS value, count(*) AS n FROM events GROUP BY 1, 2"


# ---- A2 -> P9/P10 -> W8/W10 -> W14: 4-hour score windows ---------------------------------------------

def w_window_4h(spark: SparkSession, d: str) -> DataFrame:
    """4-hour grid, forward fill, scores, onset where two rows' scores sum to 4
    or more; one window of 4 rows per user."""
    g = add_scores(imp.impute(grid8(spark, d, width=4), G8_SEQ, F4, ffill=True), SCORE_PARTS, total="score",
                   flag="is_flag", flag_at=2)
    g = materialize(lag_sum(g, G8_SEQ, "score", "lag_score", 4, "event"))
    w = onset_windows(g, G8_SEQ, 4, "event", symptomatic=F.col("is_flag"))
    return w.select("user_id", "hr", "step", "is_event", "score", "lag_score", *[r6(f) for f in F4])


def _sql_window_4h() -> str:
    scored = _sql_scored().replace(sql_g8(), sql_g8(width=4), 1)
    return (f"WITH {scored},\n"
            "lg AS (SELECT sc.*, score + lag(score) OVER (PARTITION BY user_id ORDER BY hr) AS lag_score FROM sc),\n"
            "ev AS (SELECT lg.*, coalesce(CAST(lag_score >= 4 AS INTEGER), 0) AS event FROM lg),\n"
            f"{_sql_windows('ev', 4, 'event', symp='is_flag')}\n"
            "SELECT user_id, hr, step, is_event, score, lag_score, " + ", ".join(f"round({f}, 6) AS {f}" for f in F4) + " FROM win")


QUERIES = {
    "a_keep_first": a_keep_first,
    "j_band_first": j_band_first,
    "j_year_merge": j_year_merge,
    "j_three_key_merge": j_three_key_merge,
    "j_cohort_multiply": j_cohort_multiply,
    "j_not_in_empty": j_not_in_empty,
    "l_shuffle": l_shuffle,
    "l_shuffled_split": l_shuffled_split,
    "s_saved_table": s_saved_table,
    "s_bucketed_merge": s_bucketed_merge,
    "w_window_4h": w_window_4h,
}

ORACLE = {
    "a_keep_first": SQL_KEEP_FIRST,
    "j_band_first": SQL_BAND_FIRST,
    "j_year_merge": SQL_YEAR_MERGE,
    "j_three_key_merge": SQL_THREE_KEY,
    "j_cohort_multiply": SQL_MULTIPLY,
    "j_not_in_empty": f"SELECT user_id FROM {USERS} WHERE user_id NOT IN (SELECT o_custkey FROM orders "
                      "WHERE o_orderpriority = 'no such priority')",
    "l_shuffle": SQL_PLACES,
    "l_shuffled_split": SQL_SHUFFLED_SPLIT,
    "s_saved_table": SQL_SAVED,
    "s_bucketed_merge": SQL_BUCKETED,
    "w_window_4h": _sql_window_4h(),
}

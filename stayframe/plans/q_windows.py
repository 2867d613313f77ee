"""Window and time-series queries (W1-W19) on the fixture grid and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.operators import impute as imp
from stayframe.operators.clean import add_scores
from stayframe.operators.cohort import band_flag, event_hour, lag_sum, onset_windows, persistence
from stayframe.functions.columns import bin_index, bin_start
from stayframe.operators.joins import chunk_join, not_in
from stayframe.operators.seq import depth_chunks, prev_next, row_index, seq
from stayframe.plans.common import (EVENT_MIN_VALUE, EVENT_TYPE, FEATURES, G8_SEQ, SCORE_PARTS,
                                    URGENT, events, grid8, masked_grid8, r6, sql_g8, sql_impute,
                                    sql_masked)
from stayframe.session import materialize
from stayframe.sources.tables import table

F4 = list(FEATURES)


def _out(df: DataFrame, extra=()) -> DataFrame:
    return df.select("user_id", "hr", *extra, *[r6(f) for f in F4])


def _sql_out(src: str, extra=()) -> str:
    ex = "".join(f"{e}, " for e in extra)
    return f"SELECT user_id, hr, {ex}" + ", ".join(f"round({f}, 6) AS {f}" for f in F4) + f" FROM {src}"


def _sql_medians(src: str = "m8") -> str:
    return "med AS (SELECT " + ", ".join(f"median({f}) AS {f}_med" for f in F4) + f" FROM {src})"


MED_FILL = {f: f"(SELECT {f}_med FROM med)" for f in F4}


# ---- W1 / W2 ---------------------------------------------------------------

def w_interp_linear(spark: SparkSession, d: str) -> DataFrame:
    return _out(imp.interpolate(grid8(spark, d), G8_SEQ, F4, method="linear"))


def _event_rows(spark: SparkSession, d: str) -> DataFrame:
    """One row per event (user_id, ts), the value under its type's column."""
    ev = events(spark, d)
    x = ev.select("user_id", "ts", *[F.when(F.col("event_type") == f, F.col("value")).alias(f) for f in F4])
    s = seq("user_id", "ts")
    return depth_chunks(x, s), s


def w_interp_time(spark: SparkSession, d: str) -> DataFrame:
    x, s = _event_rows(spark, d)
    y = imp.interpolate(x, s, F4, method="time")
    return y.select("user_id", "ts", *[r6(f) for f in F4])


# ---- W3 / W4 ---------------------------------------------------------------

def w_ffill_bfill(spark: SparkSession, d: str) -> DataFrame:
    """Forward fill, and forward then backward fill, from one scan."""
    g = prev_next(grid8(spark, d), G8_SEQ, F4)
    return g.select("user_id", "hr", *[F.round(F.col(f"{f}__pv"), 6).alias(f"{f}_ff") for f in F4],
                    *[F.round(F.coalesce(f"{f}__pv", f"{f}__nv"), 6).alias(f"{f}_bf") for f in F4])


# ---- W5 / W6 recipes -----------------------------------------------------------

def _recipe(name: str):
    def q(spark: SparkSession, d: str) -> DataFrame:
        m = masked_grid8(spark, d)
        return _out(imp.recipe(m, G8_SEQ, F4, name, time_col="starttime"))
    q.__name__ = f"w_recipe_{name}"
    return q


def _sql_recipe(name: str) -> str:
    method, ff, bf, fill = imp.RECIPES[name]
    if fill == "median":
        fill_sql = MED_FILL
    elif fill is None:
        fill_sql = None
    else:
        fill_sql = {f: f"{float(fill)}" for f in F4}
    return (f"WITH {sql_g8()},\n{sql_masked()},\n{_sql_medians()},\n"
            f"{sql_impute('m8', 'imp', F4, method=method, ffill=ff, bfill=bf, fill_sql=fill_sql)}\n"
            + _sql_out("imp"))


# ---- W7 ----------------------------------------------------------------------

def w_trailing_fill(spark: SparkSession, d: str) -> DataFrame:
    g = row_index(grid8(spark, d), G8_SEQ, "_idx")
    for how in ("avg", "min"):
        g = g.withColumns({f"{f}_{how}4": F.col(f) for f in F4})
        g = imp.trailing_fill(g, G8_SEQ, [f"{f}_{how}4" for f in F4], 4, how, idx="_idx")
    return g.select("user_id", "hr", *[r6(f"{f}_{k}") for f in F4 for k in ("avg4", "min4")])


def _sql_trailing() -> str:
    fr = "OVER (PARTITION BY user_id ORDER BY hr ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"
    cols = ", ".join(f"round(coalesce({f}, avg({f}) {fr}), 6) AS {f}_avg4, "
                     f"round(coalesce({f}, min({f}) {fr}), 6) AS {f}_min4" for f in F4)
    return f"WITH {sql_g8()}\nSELECT user_id, hr, {cols} FROM g8"


# ---- scores on the forward-filled grid (P9/P10, W8-W10) ----------------------------

def scored_grid(spark: SparkSession, d: str) -> DataFrame:
    g = imp.impute(grid8(spark, d), G8_SEQ, F4, ffill=True)
    return add_scores(g, SCORE_PARTS, total="score", flag="is_flag", flag_at=2)


def _sql_scored() -> str:
    parts = []
    for c, (op, th) in SCORE_PARTS.items():
        parts.append(f"coalesce(CAST({c} {op} {th} AS INTEGER), 0)")
    total = " + ".join(parts)
    return (f"{sql_g8()},\n{sql_impute('g8', 'ff', F4, ffill=True)},\n"
            f"sc AS (SELECT *, {total} AS score, CAST({total} >= 2 AS INTEGER) AS is_flag FROM ff)")


def w_two_row(spark: SparkSession, d: str) -> DataFrame:
    g = lag_sum(scored_grid(spark, d), G8_SEQ, "is_flag", "cum_flag", 2, "two_row")
    g = lag_sum(g, G8_SEQ, "score", "lag_score", 4, "lag_event")
    return g.select("user_id", "hr", "score", "cum_flag", "two_row", "lag_score", "lag_event")


def _sql_two_row() -> str:
    w = "OVER (PARTITION BY user_id ORDER BY hr)"
    return (f"WITH {_sql_scored()},\n"
            f"l AS (SELECT user_id, hr, score, is_flag + lag(is_flag) {w} AS cum_flag, "
            f"score + lag(score) {w} AS lag_score FROM sc)\n"
            "SELECT user_id, hr, score, cum_flag, coalesce(CAST(cum_flag >= 2 AS INTEGER), 0) AS two_row, "
            "lag_score, coalesce(CAST(lag_score >= 4 AS INTEGER), 0) AS lag_event FROM l")


def w_persistence(spark: SparkSession, d: str) -> DataFrame:
    g = scored_grid(spark, d)
    g = persistence(g, G8_SEQ, F.col("score") >= 2, 4, out="event")
    return g.select("user_id", "hr", "score", "event")


def _sql_persistence() -> str:
    fr = "OVER (PARTITION BY user_id ORDER BY hr ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"
    return (f"WITH {_sql_scored()}\n"
            f"SELECT user_id, hr, score, CASE WHEN count(*) {fr} = 4 AND "
            f"sum(CAST(score >= 2 AS INTEGER)) {fr} = 4 THEN 1 ELSE 0 END AS event FROM sc")


# ---- W11-W14 cohort windows ------------------------------------------------------

def w_window_sofa(spark: SparkSession, d: str) -> DataFrame:
    """ifbm-imputed G8, one 24-bin window per user: the 24 bins up to the first
    onset bin for users with an onset, the first 24 bins otherwise."""
    g = imp.recipe(masked_grid8(spark, d), G8_SEQ, F4, "ifbm", time_col="starttime")
    w = onset_windows(g, G8_SEQ, 24, "is_infection")
    return _out(w, extra=("step", "is_event"))


def _sql_windows(src: str, n: int, flag: str, symp: str | None = None, req: str | None = None,
                 min_rows: int | None = None, event_min_rows: int | None = None,
                 event_where: str = "TRUE", nonevent_where: str = "TRUE") -> str:
    """CTE ``win`` = onset_windows over ``src`` (columns user_id, hr, ...)."""
    symp = symp or f"CAST({flag} = 1 AS INTEGER)"
    min_rows = n if min_rows is None else min_rows
    event_min_rows = n if event_min_rows is None else event_min_rows
    req_agg = f", max(coalesce(CAST({req} AS INTEGER), 0)) AS req" if req else ", 1 AS req"
    evt = f"e.symp = 1 AND e.anchor IS NOT NULL AND e.req = 1 AND ({event_where})"
    non = f"e.symp = 0 AND ({nonevent_where})"
    return f"""ent AS (SELECT user_id, count(*) AS nrows, min(CASE WHEN {flag} = 1 THEN hr END) AS anchor,
  max(coalesce({symp}, 0)) AS symp, max(hr) AS maxo{req_agg} FROM {src} GROUP BY user_id),
rr AS (SELECT s.*, CASE WHEN {evt} THEN 1 ELSE 0 END AS is_event, e.nrows,
  CASE WHEN {non} AND (row_number() OVER (PARTITION BY s.user_id ORDER BY s.hr) - 1) < {n} THEN 1
       WHEN {evt} AND s.hr > e.anchor - {n} AND s.hr <= e.anchor THEN 1 ELSE 0 END AS keep
  FROM {src} s JOIN ent e ON s.user_id = e.user_id),
kk AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS wrows FROM rr
  WHERE keep = 1 AND nrows >= {min_rows}),
win AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY hr) - 1 AS INTEGER) AS step
  FROM kk WHERE is_event = 0 OR wrows >= {event_min_rows})"""


def _sql_window_sofa() -> str:
    return (f"WITH {sql_g8()},\n{sql_masked()},\n{_sql_medians()},\n"
            f"{sql_impute('m8', 'imp', F4, method='time', ffill=True, bfill=True, fill_sql=MED_FILL)},\n"
            f"{_sql_windows('imp', 24, 'is_infection')}\n" + _sql_out("win", ("step", "is_event")))


def _urgent_users(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders", ["o_custkey", "o_orderpriority"])
    return (o.filter(F.col("o_orderpriority") == URGENT).select(F.col("o_custkey").alias("user_id"))
            .distinct().withColumn("icd_event", F.lit(1)))


def w_window_qsofa(spark: SparkSession, d: str) -> DataFrame:
    """qSOFA flavour: symptomatic = any score >= 2; onset = first row ending
    4 consecutive rows with score >= 2; symptomatic users also need an
    urgent order (icd_event); never-symptomatic users give their first 24 rows."""
    g = scored_grid(spark, d)
    g = persistence(g, G8_SEQ, F.col("score") >= 2, 4, out="event")
    g = g.join(_urgent_users(spark, d), "user_id", "left").fillna(0, ["icd_event"])
    g = materialize(g)   # flagged grid: read by the window cut's rows and summary branches
    w = onset_windows(g, G8_SEQ, 24, "event", symptomatic=F.col("is_flag"),
                      require_any=F.col("icd_event") == 1)
    return _out(w, extra=("step", "is_event", "score"))


def _sql_window_qsofa() -> str:
    fr = "OVER (PARTITION BY user_id ORDER BY hr ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"
    return (f"WITH {_sql_scored()},\n"
            f"pe AS (SELECT sc.*, CASE WHEN count(*) {fr} = 4 AND sum(CAST(score >= 2 AS INTEGER)) {fr} = 4 "
            f"THEN 1 ELSE 0 END AS event FROM sc),\n"
            f"urg AS (SELECT DISTINCT o_custkey AS user_id, 1 AS icd_event FROM orders "
            f"WHERE o_orderpriority = '{URGENT}'),\n"
            f"pq AS (SELECT pe.*, coalesce(u.icd_event, 0) AS icd_event FROM pe LEFT JOIN urg u "
            f"ON pe.user_id = u.user_id),\n"
            f"{_sql_windows('pq', 24, 'event', symp='is_flag', req='icd_event = 1')}\n"
            + _sql_out("win", ("step", "is_event", "score")))


# ---- W15, W18, W19: 8h event table and 4-bin windows ----------------------------

def stays(spark: SparkSession, d: str) -> DataFrame:
    """One row per user, from one aggregate over the events, written once: the
    grid's origin and last bin, the onset time (null without), its bin and hour."""
    onset = (F.col("event_type") == EVENT_TYPE) & (F.col("value") >= EVENT_MIN_VALUE)
    f = events(spark, d).groupBy("user_id").agg(F.min("ts").alias("origin"), F.max("ts").alias("_last"),
                                                F.min(F.when(onset, F.col("ts"))).alias("infection_time"))
    f = f.withColumns({"last_bin": bin_index("_last", "origin", 8), "onset_bin": bin_index("infection_time", "origin", 8)})
    f = f.withColumns({"_s": bin_start("origin", "onset_bin", 8), "_e": bin_start("origin", F.col("onset_bin") + 1, 8)})
    f = f.withColumn("onset_hour", event_hour("onset_bin", 8, "_s", "_e", "infection_time"))
    return materialize(f.drop("_last", "_s", "_e"), "stays")


def event_table(spark: SparkSession, d: str, grid: DataFrame | None = None, facts: DataFrame | None = None,
                back: int | None = None) -> DataFrame:
    """G8 rows of users with an onset, with is_infection (1 when the onset
    time lies in [start, end], else null) and infection_hour. With ``back``,
    only chunks that hold the ``back`` bins up to the onset bin are read."""
    g = (grid if grid is not None else grid8(spark, d)).drop("is_infection")
    f = (facts if facts is not None else stays(spark, d)).filter(F.col("infection_time").isNotNull())
    lo, hi = (F.lit(0), F.col("last_bin")) if back is None else (F.greatest(F.col("onset_bin") - back, F.lit(0)), F.col("onset_bin"))
    f = f.select("user_id", "infection_time", lo.alias("_lo"), hi.alias("_hi"))
    j = chunk_join(g, f, G8_SEQ, F.col("_lo"), F.col("_hi")).drop("_lo", "_hi")
    return j.select(F.col("*"), band_flag("starttime", "endtime", "infection_time").alias("is_infection"),
                    event_hour("hr", 8, "starttime", "endtime", "infection_time").alias("infection_hour"))


def _sql_event_table() -> str:
    return (f"{sql_g8()},\n"
            f"inf AS (SELECT user_id, min(ts) AS infection_time FROM events WHERE event_type = '{EVENT_TYPE}' "
            f"AND value >= {EVENT_MIN_VALUE} GROUP BY user_id),\n"
            "et AS (SELECT g8.user_id, g8.hr, g8.starttime, g8.endtime, "
            + ", ".join(f"g8.{f}" for f in F4) + ", inf.infection_time, "
            "CASE WHEN inf.infection_time BETWEEN g8.starttime AND g8.endtime THEN 1 END AS is_infection, "
            "CASE WHEN inf.infection_time BETWEEN g8.starttime AND g8.endtime THEN g8.hr * 8 + "
            "CAST(floor(date_diff('microsecond', g8.starttime, inf.infection_time) / 3600000000.0 + 0.5) "
            "AS INTEGER) END AS infection_hour FROM g8 JOIN inf ON g8.user_id = inf.user_id)")


def nonevent_users(spark: SparkSession, d: str, materialized: bool = False) -> DataFrame:
    """Users with a non-onset error event (value < 100), none of whose orders
    is urgent (NOT IN semantics, null-aware, without broadcasting the list)."""
    ev = events(spark, d)
    sus0 = (ev.filter((F.col("event_type") == EVENT_TYPE) & (F.col("value") < EVENT_MIN_VALUE))
            .select("user_id").distinct())
    urgent = table(spark, d, "orders", ["o_custkey", "o_orderpriority"]).filter(F.col("o_orderpriority") == URGENT)
    r = not_in(sus0, urgent, "user_id", "o_custkey")
    return materialize(r) if materialized else r


def w_window_short(spark: SparkSession, d: str) -> DataFrame:
    """8h cohorts: onset users whose onset hour is >= 32 keep the 4 bins up
    to the onset bin (no length check); non-event users having bin 4 keep
    their first 4 bins. Both cohorts are known from the stays, and meet only
    the chunks of the grid that hold those bins."""
    g, s, f = grid8(spark, d), G8_SEQ, stays(spark, d)
    et = event_table(spark, d, g, f.filter(F.col("onset_hour") >= 32), back=4)
    ev = onset_windows(et, s, 4, "is_infection", symptomatic=F.lit(1), min_rows=0, event_min_rows=0)
    ev = ev.select("user_id", "hr", "step", "is_event", *F4)
    # bin 4 exists where the last bin is no earlier
    cohort = nonevent_users(spark, d).join(f.filter(F.col("last_bin") >= 4).select("user_id"), "user_id")
    cohort = materialize(cohort, "cohort")
    non = chunk_join(g, cohort, s, F.lit(0), F.lit(4)).withColumn("is_infection", F.lit(0))
    nw = onset_windows(non, s, 4, "is_infection").select("user_id", "hr", "step", "is_event", *F4)
    return _out(ev.unionByName(nw), extra=("step", "is_event"))


def _sql_window_short() -> str:
    return (f"WITH {_sql_event_table()},\n"
            "ev32 AS (SELECT * FROM et WHERE user_id IN (SELECT user_id FROM et WHERE infection_hour >= 32)),\n"
            "anc AS (SELECT user_id, min(hr) AS anchor FROM ev32 WHERE is_infection = 1 GROUP BY user_id),\n"
            "evw AS (SELECT ev32.user_id, ev32.hr, 1 AS is_event, "
            "CAST(row_number() OVER (PARTITION BY ev32.user_id ORDER BY ev32.hr) - 1 AS INTEGER) AS step, "
            + ", ".join(f"ev32.{f}" for f in F4) +
            " FROM ev32 JOIN anc ON ev32.user_id = anc.user_id WHERE ev32.hr > anc.anchor - 4 AND ev32.hr <= anc.anchor),\n"
            f"nu AS (SELECT DISTINCT user_id FROM events WHERE event_type = '{EVENT_TYPE}' AND value < {EVENT_MIN_VALUE} "
            f"AND user_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '{URGENT}')),\n"
            "nt AS (SELECT * FROM g8 WHERE user_id IN (SELECT user_id FROM nu) "
            "AND user_id IN (SELECT user_id FROM g8 WHERE hr = 4)),\n"
            "nn AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY hr) - 1 AS ri, "
            "count(*) OVER (PARTITION BY user_id) AS nr FROM nt),\n"
            "nw AS (SELECT user_id, hr, 0 AS is_event, CAST(ri AS INTEGER) AS step, " + ", ".join(F4)
            + " FROM nn WHERE ri < 4 AND nr >= 4),\n"
            "win AS (SELECT * FROM evw UNION ALL SELECT * FROM nw)\n"
            + _sql_out("win", ("step", "is_event")))


def w_first_rows(spark: SparkSession, d: str) -> DataFrame:
    """First 4 bins of every user with at least 4 bins (W13)."""
    from stayframe.operators.cohort import first_rows
    return _out(first_rows(grid8(spark, d), G8_SEQ, 4))


SQL_FIRST_ROWS = (f"WITH {sql_g8()},\nr AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY hr) AS rn, "
                  "count(*) OVER (PARTITION BY user_id) AS n FROM g8)\n"
                  + _sql_out("r").replace(" FROM r", " FROM r WHERE rn <= 4 AND n >= 4"))


QUERIES = {
    "w_first_rows": w_first_rows,
    "w_recipe_8h_min": _recipe("8h_min"),
    "w_interp_linear": w_interp_linear,
    "w_interp_time": w_interp_time,
    "w_ffill_bfill": w_ffill_bfill,
    "w_recipe_ifbm": _recipe("ifbm"),
    "w_recipe_ifz": _recipe("ifz"),
    "w_recipe_qsofa": _recipe("qsofa"),
    "w_recipe_8h": _recipe("8h"),
    "w_trailing_fill": w_trailing_fill,
    "w_two_row": w_two_row,
    "w_persistence": w_persistence,
    "w_window_sofa": w_window_sofa,
    "w_window_qsofa": w_window_qsofa,
    "w_window_short": w_window_short,
}

_TIME_POS = "epoch_us(ts)"

ORACLE = {
    "w_first_rows": SQL_FIRST_ROWS,
    "w_recipe_8h_min": _sql_recipe("8h_min"),
    "w_interp_linear": f"WITH {sql_g8()},\n{sql_impute('g8', 'imp', F4, method='linear')}\n" + _sql_out("imp"),
    "w_interp_time": (
        "WITH x AS (SELECT user_id, ts, " + ", ".join(f"CASE WHEN event_type = '{f}' THEN value END AS {f}" for f in F4)
        + " FROM events),\n"
        + sql_impute("x", "imp", F4, order="ts", method="time", pos_sql=_TIME_POS, other=("user_id", "ts"))
        + "\nSELECT user_id, ts, " + ", ".join(f"round({f}, 6) AS {f}" for f in F4) + " FROM imp"),
    "w_ffill_bfill": (
        f"WITH {sql_g8()},\n{sql_impute('g8', 'imp', F4, ffill=True, bfill=False)},\n"
        f"{sql_impute('g8', 'imb', F4, ffill=True, bfill=True)}\n"
        "SELECT a.user_id, a.hr, " + ", ".join(f"round(a.{f}, 6) AS {f}_ff, round(b.{f}, 6) AS {f}_bf" for f in F4)
        + " FROM imp a JOIN imb b ON a.user_id = b.user_id AND a.hr = b.hr"),
    "w_recipe_ifbm": _sql_recipe("ifbm"),
    "w_recipe_ifz": _sql_recipe("ifz"),
    "w_recipe_qsofa": _sql_recipe("qsofa"),
    "w_recipe_8h": _sql_recipe("8h"),
    "w_trailing_fill": _sql_trailing(),
    "w_two_row": _sql_two_row(),
    "w_persistence": _sql_persistence(),
    "w_window_sofa": _sql_window_sofa(),
    "w_window_qsofa": _sql_window_qsofa(),
    "w_window_short": _sql_window_short(),
}

"""Roles of the fixture tables (see FIXTURES.md §2) and shared plan pieces.

The entity ("stay") is ``events.user_id``; measurements are events
(type, value, ts); the 8-hour grid ``G8`` has one row per user and 8h bin
from the user's first event to the last, empty bins included, features are
the per-bin mean value of four event types and ``is_infection`` marks a bin
holding an ``error`` event with value >= 100.

Each Spark builder here has an SQL twin used by the DuckDB oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.operators.clean import Range, mask_outliers
from stayframe.operators.grid import conditional_avgs, event_grid
from stayframe.operators.seq import seq
from stayframe.session import materialize
from stayframe.sources.tables import table

# ---- fixed values (fixture roles; must equal the oracle SQL) -------------
FEATURES = ("click", "view", "purchase", "signup")
EVENT_TYPE = "error"          # suspicion / onset events
EVENT_MIN_VALUE = 100.0       # error value >= 100 flags an onset
OUTLIER_RULES = {             # kept when inside; null otherwise
    "click": Range(hi=200.0),
    "view": Range(lo=1.0, hi=150.0),
    "purchase": Range(hi=180.0, hi_closed=False),
}
SCORE_PARTS = {"click": ("<=", 20.0), "view": ("<=", 15.0), "purchase": (">=", 60.0)}
URGENT = "1-URGENT"
# ---------------------------------------------------------------------------

G8_SEQ = seq("user_id", "hr")


def events(spark: SparkSession, d: str, cols=("user_id", "ts", "event_type", "value")) -> DataFrame:
    return table(spark, d, "events", list(cols))


def grid8(spark: SparkSession, d: str, closed: str = "left", width: int = 8,
          materialized: bool = True) -> DataFrame:
    """G8: user_id, hr, starttime, endtime, click, view, purchase, signup,
    is_infection (0/1), plus the chunk column used by ordered operators.

    Materialized (checkpointed) by default: every ordered operator reads it
    from two branches (rows and carry summary), and the events table - the big
    input - should be scanned and aggregated once."""
    ev = events(spark, d)
    aggs = conditional_avgs("event_type", "value", {f: [f] for f in FEATURES})
    aggs.append(F.max(((F.col("event_type") == EVENT_TYPE) & (F.col("value") >= EVENT_MIN_VALUE))
                      .cast("int")).alias("is_infection"))
    g = event_grid(ev, ["user_id"], "ts", width, aggs, closed=closed, bin_col="hr")
    g = g.withColumn("is_infection", F.coalesce("is_infection", F.lit(0))).drop("origin")
    return materialize(g) if materialized else g


def masked_grid8(spark: SparkSession, d: str, materialized: bool = True) -> DataFrame:
    return mask_outliers(grid8(spark, d, materialized=materialized), OUTLIER_RULES)


def r6(c: str, name: str | None = None):
    """Round a double to 6 places for engine-independent comparison."""
    return F.round(F.col(c), 6).alias(name or c)


# ---------------------------------------------------------------------------
# SQL twins (DuckDB dialect)

def sql_g8(width: int = 8, closed: str = "left") -> str:
    """CTE chain ending in ``g8`` (same columns as ``grid8`` minus the chunk)."""
    w_us = width * 3_600_000_000
    if closed == "left":
        b = f"CAST(floor(date_diff('microsecond', o.origin, e.ts) / {w_us}.0) AS INTEGER)"
    else:
        b = f"CAST(ceil(date_diff('microsecond', o.origin, e.ts) / {w_us}.0) - 1 AS INTEGER)"
    feats = ",\n  ".join(f"avg(CASE WHEN event_type = '{f}' THEN value END) AS {f}" for f in FEATURES)
    fsel = ", ".join(f"a.{f}" for f in FEATURES)
    return f"""
o AS (SELECT user_id, min(ts) AS origin FROM events GROUP BY user_id),
eb AS (SELECT e.user_id, o.origin, e.event_type, e.value, {b} AS hr
       FROM events e JOIN o ON e.user_id = o.user_id),
agg AS (SELECT user_id, hr,
  {feats},
  max(CASE WHEN event_type = '{EVENT_TYPE}' AND value >= {EVENT_MIN_VALUE} THEN 1 ELSE 0 END) AS is_infection
  FROM eb WHERE hr >= 0 GROUP BY user_id, hr),
mb AS (SELECT user_id, max(hr) AS maxb FROM agg GROUP BY user_id),
sk AS (SELECT o.user_id, o.origin, CAST(unnest(range(0, mb.maxb + 1)) AS INTEGER) AS hr
       FROM o JOIN mb ON o.user_id = mb.user_id),
g8 AS (SELECT sk.user_id, sk.hr,
  sk.origin + to_hours(sk.hr * {width}) AS starttime,
  sk.origin + to_hours((sk.hr + 1) * {width}) AS endtime,
  {fsel}, coalesce(a.is_infection, 0) AS is_infection
  FROM sk LEFT JOIN agg a ON sk.user_id = a.user_id AND sk.hr = a.hr)"""


def sql_rule(c: str, r: Range) -> str:
    conds = []
    if r.lo is not None:
        conds.append(f"{c} {'>=' if r.lo_closed else '>'} {r.lo}")
    if r.hi is not None:
        conds.append(f"{c} {'<=' if r.hi_closed else '<'} {r.hi}")
    return f"CASE WHEN {' AND '.join(conds)} THEN {c} END"


def sql_masked(src: str = "g8", name: str = "m8") -> str:
    """CTE ``name``: ``src`` with the outlier rules applied."""
    cols = ", ".join(sql_rule(f, OUTLIER_RULES[f]) + f" AS {f}" if f in OUTLIER_RULES else f
                     for f in FEATURES)
    return f"{name} AS (SELECT user_id, hr, starttime, endtime, {cols}, is_infection FROM {src})"


def sql_impute(src: str, name: str, cols, keys="user_id", order="hr", method=None,
               ffill=False, bfill=False, fill_sql: dict | None = None, pos_sql: str | None = None,
               other=("user_id", "hr", "starttime", "endtime", "is_infection")) -> str:
    """CTE ``name`` filling ``cols`` of ``src`` the way ``impute`` does.

    pos_sql: position expression (row_number for 'linear', epoch for 'time')."""
    if method == "linear":
        pos = f"(row_number() OVER (PARTITION BY {keys} ORDER BY {order}) - 1)"
    elif method == "time":
        pos = pos_sql or "epoch_us(starttime)"
    else:
        pos = order
    fw = f"OVER (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    bw = f"OVER (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    inner = [f"{c}, last_value(CASE WHEN {c} IS NOT NULL THEN _p END IGNORE NULLS) {fw} AS {c}_pp, "
             f"last_value({c} IGNORE NULLS) {fw} AS {c}_pv, "
             f"first_value(CASE WHEN {c} IS NOT NULL THEN _p END IGNORE NULLS) {bw} AS {c}_np, "
             f"first_value({c} IGNORE NULLS) {bw} AS {c}_nv" for c in cols]
    outs = []
    for c in cols:
        parts = []
        if method:
            parts.append(f"coalesce({c}, {c}_pv + ({c}_nv - {c}_pv) * CAST(_p - {c}_pp AS DOUBLE) "
                         f"/ CAST({c}_np - {c}_pp AS DOUBLE), {c}_pv)")
        else:
            parts.append(c)
        if ffill:
            parts.append(f"{c}_pv")
        if bfill:
            parts.append(f"{c}_nv")
        if fill_sql and fill_sql.get(c) is not None:
            parts.append(fill_sql[c])
        outs.append((f"coalesce({', '.join(parts)})" if len(parts) > 1 else parts[0]) + f" AS {c}")
    o = ", ".join(other)
    return (f"{name}_p AS (SELECT {o}, _p, {', '.join(inner)} FROM (SELECT *, {pos} AS _p FROM {src})),\n"
            f"{name} AS (SELECT {o}, {', '.join(outs)} FROM {name}_p)")

"""Splits, scaling, sequences, models, metrics and training history (L4-L7, W16-W17, M1-M18)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayframe.functions.columns import binarize, logistic_loss
from stayframe.operators import impute as imp
from stayframe.operators.cohort import onset_windows
from stayframe.operators.history import compare_settings, early_stop, experiment_key, history_long
from stayframe.operators.joins import chunk_join
from stayframe.operators.metrics import (average_precision, class_report, confusion, pr_curve, roc_auc,
                                         scores_from_confusion)
from stayframe.operators.model import (MODELS, fit, predict, root_split, save, score_runs, train_epochs,
                                       weighted_gradient, with_class_weight)
from stayframe.operators.scale import minmax_by_entity, minmax_write, zscore_write
from stayframe.operators.seq import depth_chunks, global_index, row_index, seq, with_chunk
from stayframe.operators.sequence import sliding_sequences, window_sequences
from stayframe.operators.split import ordered_split, sample_entities
from stayframe.plans.common import FEATURES, G8_SEQ, events, grid8, masked_grid8, r6, sql_g8
from stayframe.plans.q_aggs import _sql_split
from stayframe.plans.q_windows import (_sql_event_table, _sql_window_sofa, event_table, nonevent_users)
from stayframe.session import materialize, scratch_path
from stayframe.sources.files import read_experiments, write_experiments
from stayframe.sources.tables import table

F4 = list(FEATURES)
SEQ_LEN, SEQ_TARGET = 19, 24          # fixed: 19 input rows, label of row 24
BATCH = 32
POS_WEIGHT = 50.0
PATIENCE = 20
PIECE = 1024                          # history arrays are stored in pieces of this many epochs


def sofa_windows(spark: SparkSession, d: str, materialized: bool = True) -> DataFrame:
    """The 24-bin cohort windows, materialized: splits, fits and sequence
    builders read them from several branches."""
    g = imp.recipe(masked_grid8(spark, d), G8_SEQ, F4, "ifbm", time_col="starttime")
    w = onset_windows(g, G8_SEQ, 24, "is_infection")
    return materialize(w) if materialized else w


def _sql_windows_cte():
    base = _sql_window_sofa()
    head, _ = base.rsplit("\n", 1)
    return head + ",\nwo AS (SELECT user_id, hr, step, is_event, is_infection, " + ", ".join(F4) + " FROM win)"


# ---- L4/L5 --------------------------------------------------------------------------

def l_sample_shuffle(spark, d):
    return sample_entities(grid8(spark, d, materialized=False).select("user_id", "hr"), "user_id", 50, seed=7)


SQL_SAMPLE = (f"WITH {sql_g8()}\nSELECT user_id, hr FROM g8 WHERE user_id IN (SELECT user_id FROM "
              "(SELECT DISTINCT user_id FROM events) ORDER BY md5('7:' || user_id), user_id LIMIT 50)")


# ---- L6 -------------------------------------------------------------------------------

def l_split(spark, d):
    # the cut needs neither features nor their fills
    g = grid8(spark, d).select("user_id", "hr", "is_infection", G8_SEQ.chunk)
    w = materialize(onset_windows(g, G8_SEQ, 24, "is_infection").select("user_id", "hr"))
    return ordered_split(w, "user_id").select("user_id", "hr", "split")


# ---- L7 ---------------------------------------------------------------------------------

def l_union(spark, d):
    g = grid8(spark, d)   # read by the event and the non-event side
    et = event_table(spark, d, g, back=1)      # an onset on a border lies in two bins
    ev = et.filter(F.col("is_infection") == 1).select("user_id", "hr", "infection_time", "infection_hour")
    non = chunk_join(g, nonevent_users(spark, d, materialized=True), G8_SEQ, F.lit(0), F.lit(0)).filter(F.col("hr") == 0)
    non = non.select("user_id", "hr", F.col("is_infection").alias("flag"))
    return ev.unionByName(non, allowMissingColumns=True)


def _sql_union():
    return (f"WITH {_sql_event_table()},\n"
            "nu AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND value < 100.0 "
            "AND user_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'))\n"
            "SELECT user_id, hr, infection_time, infection_hour, CAST(NULL AS INTEGER) AS flag FROM et "
            "WHERE is_infection = 1 UNION ALL SELECT user_id, hr, NULL, NULL, is_infection FROM g8 "
            "WHERE user_id IN (SELECT user_id FROM nu) AND hr = 0")


# ---- M1-M3 --------------------------------------------------------------------------------

SCALE_COLS = F4 + ["const"]


def _split_windows(spark, d):
    w = ordered_split(sofa_windows(spark, d), "user_id")
    return w.withColumn("const", F.lit(1.0))


def m_minmax(spark, d):
    w = _split_windows(spark, d)
    s = minmax_write(w, SCALE_COLS, F.col("split") != "test")
    return s.select("user_id", "hr", "split", *[r6(c) for c in SCALE_COLS])


def m_minmax_by_stay(spark, d):
    w = _split_windows(spark, d)
    s = minmax_by_entity(w, ["user_id"], SCALE_COLS)
    return s.select("user_id", "hr", *[r6(c) for c in SCALE_COLS])


def m_zscore(spark, d):
    w = _split_windows(spark, d)
    s = zscore_write(w, SCALE_COLS, F.col("split") != "test")
    return s.select("user_id", "hr", "split", *[r6(c) for c in SCALE_COLS])


def _sql_scale(kind: str):
    base = _sql_windows_cte() + ",\n" + _sql_split("wo") + ",\nsw AS (SELECT *, 1.0 AS const FROM sp)"
    if kind == "minmax":
        fit = ", ".join(f"min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c in SCALE_COLS)
        cols = ", ".join(f"round(({c} - f.{c}_lo) / CASE WHEN f.{c}_hi - f.{c}_lo = 0 THEN 1.0 "
                         f"ELSE f.{c}_hi - f.{c}_lo END, 6) AS {c}" for c in SCALE_COLS)
        return (base + f",\nf AS (SELECT {fit} FROM sw WHERE split <> 'test')\n"
                f"SELECT user_id, hr, split, {cols} FROM sw, f")
    if kind == "zscore":
        fit = ", ".join(f"avg({c}) AS {c}_mu, stddev_pop({c}) AS {c}_sd" for c in SCALE_COLS)
        cols = ", ".join(f"round(({c} - f.{c}_mu) / CASE WHEN f.{c}_sd = 0 THEN 1.0 ELSE f.{c}_sd END, 6) AS {c}"
                         for c in SCALE_COLS)
        return (base + f",\nf AS (SELECT {fit} FROM sw WHERE split <> 'test')\n"
                f"SELECT user_id, hr, split, {cols} FROM sw, f")
    fit = ", ".join(f"min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c in SCALE_COLS)
    cols = ", ".join(f"round((sw.{c} - f.{c}_lo) / CASE WHEN f.{c}_hi - f.{c}_lo = 0 THEN 1.0 "
                     f"ELSE f.{c}_hi - f.{c}_lo END, 6) AS {c}" for c in SCALE_COLS)
    return (base + f",\nf AS (SELECT user_id, {fit} FROM sw GROUP BY user_id)\n"
            f"SELECT sw.user_id, sw.hr, {cols} FROM sw JOIN f ON sw.user_id = f.user_id")


# ---- W16 / W17 ------------------------------------------------------------------------------

def w_sequences(spark, d):
    w = sofa_windows(spark, d)
    sq = window_sequences(w, ["user_id"], "step", F4, "is_infection", SEQ_LEN, SEQ_TARGET)
    x = sq.select("user_id", "y", F.posexplode("X").alias("step", "x"))
    return x.select("user_id", F.col("step").cast("int").alias("step"),
                    *[F.round(F.col("x")[i], 6).alias(f) for i, f in enumerate(F4)], "y")


def _sql_sequences():
    return (_sql_windows_cte() + ",\n"
            f"yy AS (SELECT user_id, is_infection AS y FROM wo WHERE step = {SEQ_TARGET - 1})\n"
            "SELECT wo.user_id, wo.step, " + ", ".join(f"round(wo.{f}, 6) AS {f}" for f in F4)
            + f", yy.y FROM wo JOIN yy ON wo.user_id = yy.user_id WHERE wo.step < {SEQ_LEN}")


def w_sliding(spark, d):
    s = sliding_sequences(grid8(spark, d), G8_SEQ, F4, "is_infection", k=4, x_rows=2)
    return s.select("user_id", "start_hr", *[r6(f"x{j}_{f}") for j in range(2) for f in F4], "y")


def _sql_sliding():
    w = "OVER (PARTITION BY user_id ORDER BY hr)"
    cols = ", ".join(f"round(lag({f}, {3 - j}) {w}, 6) AS x{j}_{f}" for j in range(2) for f in F4)
    return (f"WITH {sql_g8()},\nz AS (SELECT user_id, lag(hr, 3) {w} AS start_hr, {cols}, is_infection AS y, "
            f"row_number() {w} AS rn FROM g8)\nSELECT user_id, start_hr, "
            + ", ".join(f"x{j}_{f}" for j in range(2) for f in F4) + ", y FROM z WHERE rn >= 4")


# ---- M4: classifiers ------------------------------------------------------------------------------

N_FLAT = SEQ_LEN * len(FEATURES)
TREE_BINS = 1024          # thresholds a feature where the best split is checked: every distinct value of the fixtures


def _flat_windows(spark, d):
    """Min-max scaled windows, fitted on the train and valid part, as one array
    per user, written once: fits read it many times."""
    w = _split_windows(spark, d)
    w = minmax_write(w, F4, F.col("split") != "test")
    sq = window_sequences(w, ["user_id", "split"], "step", F4, "is_infection", SEQ_LEN, SEQ_TARGET)
    return materialize(sq.select("user_id", "split", F.col("y").cast("double").alias("y"), F.flatten("X").alias("x")), "flat")


def _parts(fw):
    return fw.filter(F.col("split") != "test"), fw.filter(F.col("split") == "test")


def m_classifier(spark, d):
    """Scores of the test users by both weighted models, each saved as a checkpoint."""
    train, test = _parts(_flat_windows(spark, d))
    out = None
    for name in MODELS:
        m = fit(train, "x", "y", name, POS_WEIGHT)
        save(m, scratch_path(spark, name))
        p = predict(m, test, "x").select("user_id", F.lit(name).alias("model"), "y", "score")
        out = p if out is None else out.unionByName(p)
    return out


def m_classifier_facts(spark, d):
    """The weighted gradient at the fitted coefficients, feature by feature (-1:
    the intercept): zero at the optimum only."""
    train, _ = _parts(_flat_windows(spark, d))
    m = fit(train, "x", "y", "logistic", POS_WEIGHT)
    g = weighted_gradient(m, train, "x", "y", POS_WEIGHT)
    return g.select("feature", (F.abs(F.round("gradient", 4)) + 0.0).alias("gradient"))


SQL_CLASSIFIER_FACTS = f"SELECT CAST(unnest(range(-1, {N_FLAT})) AS INTEGER) AS feature, CAST(0.0 AS DOUBLE) AS gradient"


def m_tree_facts(spark, d):
    """The root of the first boosted tree: its gain, which must be the best of
    all splits, and how far its leaves are from their rows' weighted means."""
    train, _ = _parts(_flat_windows(spark, d))
    m = fit(train, "x", "y", "boosted_trees", POS_WEIGHT, bins=TREE_BINS)
    return root_split(m, train, "x", "y", POS_WEIGHT).select(r6("gain"), r6("leaf_gap"))


def _sql_flat() -> str:
    """Scaled windows in long form: fl (user_id, split, y, i, x)."""
    fit_cols = ", ".join(f"min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c in F4)
    long = " UNION ALL ".join(
        f"SELECT user_id, split, step * {len(F4)} + {j} AS i, ({c} - f.{c}_lo) / CASE WHEN f.{c}_hi - f.{c}_lo = 0 THEN 1.0 "
        f"ELSE f.{c}_hi - f.{c}_lo END AS x FROM sp, f WHERE step < {SEQ_LEN}" for j, c in enumerate(F4))
    return (f"{_sql_windows_cte()},\n{_sql_split('wo')},\nf AS (SELECT {fit_cols} FROM sp WHERE split <> 'test'),\n"
            f"ly AS (SELECT user_id, CAST(is_infection AS DOUBLE) AS y FROM sp WHERE step = {SEQ_TARGET - 1}),\n"
            f"fl AS (SELECT l.*, ly.y, CASE WHEN ly.y = 1 THEN {POS_WEIGHT} ELSE 1.0 END AS w FROM ({long}) l JOIN ly USING (user_id))")


def _sql_tree_facts() -> str:
    run = "OVER (PARTITION BY i ORDER BY x)"
    return (f"{_sql_flat()},\nt AS (SELECT i, x, w, w * (2 * y - 1) AS s FROM fl WHERE split <> 'test'),\n"
            "a AS (SELECT i, sum(w) AS w, sum(s) AS s FROM t GROUP BY i),\n"
            f"r AS (SELECT DISTINCT i, x, sum(w) {run} AS lw, sum(s) {run} AS ls FROM t)\n"
            "SELECT round(max(CASE WHEN a.w > lw THEN (ls * ls / lw + (a.s - ls) * (a.s - ls) / (a.w - lw)) / a.w "
            "- (a.s / a.w) * (a.s / a.w) ELSE 0 END), 6) AS gain, CAST(0.0 AS DOUBLE) AS leaf_gap FROM r JOIN a USING (i)")


# ---- M5/M6: a sweep trained by epochs, and its history ----------------------------------------------

RATES, REGS = (2.0, 0.5, 0.1), (0.0, 0.001, 0.01)     # fixed: the sweep's settings
SWEEP_EPOCHS, SWEEP_PATIENCE = 40, 5
HISTORY_SCHEMA = "setting int, learning_rate double, reg_param double, epoch int, train_loss double, val_loss double"
RECORD_SCHEMA = ("name string, setting int, learning_rate double, reg_param double, train_losses array<double>, "
                 "val_losses array<double>")


def _trained(spark, d, epochs=SWEEP_EPOCHS):
    """The runs of the sweep, its history table, and the rows it was trained on
    (features without nulls: a missing one is 0, the scaled minimum)."""
    fw = _flat_windows(spark, d).filter(F.col("split") != "test")
    rows = materialize(with_class_weight(fw, "y", POS_WEIGHT).select(
        "user_id", (F.col("split") == "train").alias("train"), "y", "w",
        F.transform("x", lambda v: F.coalesce(v, F.lit(0.0))).alias("x")), "epochs")
    runs, history = train_epochs(rows, N_FLAT, RATES, REGS, epochs, SWEEP_PATIENCE)
    return runs, materialize(spark.createDataFrame(history, HISTORY_SCHEMA), "history"), rows


def m_first_epochs(spark, d):
    """The first epochs of every setting, step by step as SQL computes them."""
    _, history, _ = _trained(spark, d, epochs=4)
    return history.select("setting", "epoch", r6("train_loss"), r6("val_loss"))


def _sql_first_epochs() -> str:
    sets = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate((a, b) for a in RATES for b in REGS))
    sql = (f"{_sql_flat()},\nst(setting, rate, reg) AS (VALUES {sets}),\n"
           "x AS (SELECT user_id, split, y, w, i, coalesce(x, 0.0) AS x FROM fl WHERE split <> 'test' "
           "UNION ALL SELECT DISTINCT user_id, split, y, w, -1, 1.0 FROM fl WHERE split <> 'test'),\n"
           "tw AS (SELECT split, sum(w) AS w FROM x WHERE i = -1 GROUP BY split),\n"
           "c0 AS (SELECT setting, i, 0.0::DOUBLE AS c FROM st, (SELECT DISTINCT i FROM x))")
    out = []
    for e in range(4):
        sql += (f",\nz{e} AS (SELECT setting, user_id, split, y, w, sum(c * x) AS z FROM x JOIN c{e} USING (i) GROUP BY ALL),\n"
                f"c{e + 1} AS (SELECT setting, i, any_value(c) - any_value(rate) * (sum(z.w * (1 / (1 + exp(-z)) - z.y) * x) "
                "/ (SELECT w FROM tw WHERE split = 'train') + CASE WHEN i >= 0 THEN any_value(reg) * any_value(c) ELSE 0 END) AS c "
                f"FROM z{e} z JOIN x USING (user_id) JOIN c{e} USING (setting, i) JOIN st USING (setting) "
                "WHERE z.split = 'train' GROUP BY setting, i)")
        loss = "sum(CASE WHEN split = '{}' THEN w * (greatest(z, 0) + ln(1 + exp(-abs(z))) - y * z) ELSE 0 END) / (SELECT w FROM tw WHERE split = '{}')"
        out.append(f"SELECT setting, {e} AS epoch, round({loss.format('train', 'train')}, 6) AS train_loss, "
                   f"round({loss.format('valid', 'valid')}, 6) AS val_loss FROM z{e} GROUP BY setting")
    return f"{sql}\n" + " UNION ALL ".join(out)


def _records(spark, history):
    """One record per run with its losses as lists, written and read as
    experiment files."""
    h = history.groupBy("setting", "learning_rate", "reg_param").agg(
        F.array_sort(F.collect_list(F.struct("epoch", "train_loss", "val_loss"))).alias("h"))      # at most SWEEP_EPOCHS each
    rec = h.select(F.concat(F.lit("exp-"), experiment_key(["learning_rate", "reg_param"])).alias("name"), "setting",
                   "learning_rate", "reg_param", F.col("h.train_loss").alias("train_losses"), F.col("h.val_loss").alias("val_losses"))
    return read_experiments(spark, write_experiments(rec, scratch_path(spark, "runs")), T.StructType.fromDDL(RECORD_SCHEMA))


def m_sweep(spark, d):
    """Every setting of the sweep: where the stopping rule replayed over its
    history ends, whether training ended there, and the area under ROC of the
    kept coefficients on the valid users."""
    runs, history, rows = _trained(spark, d)
    s = seq("setting", "epoch")
    replay = early_stop(with_chunk(history, s, 1 << 16), s, "val_loss", SWEEP_PATIENCE)
    online = spark.createDataFrame([(r.setting, r.rate, r.reg, r.stop_epoch, r.best_epoch) for r in runs],
                                   "setting int, learning_rate double, reg_param double, _stop int, _best int")
    auc = roc_auc(score_runs(rows.filter(~F.col("train")), runs).select("setting", "score", F.col("y").cast("int").alias("y")),
                  "score", "y", ["setting"])
    same = F.col("stop_epoch").eqNullSafe(F.col("_stop")) & (F.col("best_epoch") == F.col("_best"))
    return online.join(replay, "setting").join(auc, "setting", "left").select(
        "setting", "learning_rate", "reg_param", "n_epochs", "stop_epoch", "best_epoch", "best_loss", "auc", same.alias("agrees"))


def m_sweep_facts(spark, d):
    """What holds for every setting of a right sweep, beside the number of users
    it was measured on: training stopped where the replayed rule does, the area
    lies in [0, 1], and the kept epoch is no worse than the zero model."""
    _, history, rows = _trained(spark, d)
    n = rows.filter(~F.col("train")).agg(F.count(F.lit(1)).alias("n_valid"))
    s = seq("setting", "epoch")
    stop = early_stop(with_chunk(history, s, 1 << 16), s, "val_loss", SWEEP_PATIENCE)
    last = history.groupBy("setting", "learning_rate", "reg_param").agg(
        F.max("epoch").alias("last"), F.max(F.when(F.col("epoch") == 0, F.col("val_loss"))).alias("zero"))
    j = stop.join(last, "setting").select(
        "setting", "learning_rate", "reg_param", (F.coalesce("stop_epoch", F.lit(SWEEP_EPOCHS - 1)) == F.col("last")).alias("stopped_there"),
        (F.col("best_loss") <= F.col("zero")).alias("no_worse"), F.lit(1).alias("_k"))
    return j.join(n.withColumn("_k", F.lit(1)), "_k").drop("_k")


def _sql_sweep_facts():
    sets = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate((a, b) for a in RATES for b in REGS))
    return (f"{_sql_windows_cte()},\n{_sql_split('wo')},\nn AS (SELECT count(DISTINCT user_id) AS n_valid FROM sp "
            "WHERE split = 'valid')\nSELECT CAST(setting AS INTEGER) AS setting, CAST(a AS DOUBLE) AS learning_rate, "
            f"CAST(b AS DOUBLE) AS reg_param, TRUE AS stopped_there, TRUE AS no_worse, n_valid FROM (VALUES {sets}) s(setting, a, b), n")


def m_sweep_history(spark, d):
    """The history of the sweep, from experiment records, one row per epoch and
    kind of loss."""
    rec = _records(spark, _trained(spark, d)[1])
    long = history_long(rec, ["name"], {"train": "train_losses", "val": "val_losses"}, settings=["learning_rate", "reg_param"])
    return long.withColumn("value", F.round("value", 6))


def m_sweep_summary(spark, d):
    """Mean last and best losses per learning rate and ridge."""
    rec = _records(spark, _trained(spark, d)[1]).select(
        "learning_rate", "reg_param", F.element_at("train_losses", -1).alias("train_last"),
        F.element_at("val_losses", -1).alias("val_last"), F.array_min("val_losses").alias("val_best"))
    out = compare_settings(rec, "learning_rate", "reg_param", ["train_last", "val_last", "val_best"])
    return out.select("learning_rate", "reg_param", r6("train_last"), r6("val_last"), r6("val_best"), "n_runs")


# ---- M6, M17, M18: training histories ---------------------------------------------------------------

def _epochs(spark, d):
    """experiment = user, epoch = rank by ts, loss = value."""
    ev = events(spark, d, ("user_id", "ts", "value"))
    s = seq("user_id", "ts")
    x = depth_chunks(ev, s)
    return row_index(x, s, "epoch").drop("_chunk")


def m_early_stop(spark, d):
    """experiment = user, epochs = the user's events in time order, loss = value."""
    ev = events(spark, d, ("user_id", "ts", "value"))
    s = seq("user_id", "ts")
    x = depth_chunks(ev, s)
    return early_stop(x, s, "value", patience=PATIENCE).withColumn("best_loss", F.round("best_loss", 6))


SQL_EPOCHS = "ep AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS epoch, value FROM events)"

SQL_EARLY_STOP = f"""WITH {SQL_EPOCHS},
p AS (SELECT *, min(value) OVER (PARTITION BY user_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM ep),
r AS (SELECT *, max(CASE WHEN pm IS NULL OR value <= pm THEN epoch END) OVER (PARTITION BY user_id ORDER BY epoch
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lr FROM p),
st AS (SELECT user_id, count(*) AS n_epochs, min(CASE WHEN epoch - lr >= {PATIENCE} THEN epoch END) AS stop_epoch FROM r GROUP BY user_id),
k AS (SELECT r.user_id, r.epoch, r.value FROM r JOIN st ON r.user_id = st.user_id WHERE st.stop_epoch IS NULL OR r.epoch <= st.stop_epoch),
bl AS (SELECT user_id, min(value) AS best_loss FROM k GROUP BY user_id),
be AS (SELECT k.user_id, min(k.epoch) AS best_epoch FROM k JOIN bl ON k.user_id = bl.user_id AND k.value = bl.best_loss GROUP BY k.user_id)
SELECT st.user_id, CAST(st.n_epochs AS BIGINT) AS n_epochs, st.stop_epoch, be.best_epoch, round(bl.best_loss, 6) AS best_loss
FROM st JOIN bl ON st.user_id = bl.user_id JOIN be ON st.user_id = be.user_id"""


def _settings(spark, d):
    c = table(spark, d, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"])
    n = table(spark, d, "nation", ["n_nationkey", "n_regionkey"])
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("var1"), F.col("n_regionkey").alias("var2"))


SQL_SETTINGS = ("st AS (SELECT c.c_custkey AS user_id, c.c_mktsegment AS var1, n.n_regionkey AS var2 "
                "FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)")


def history_records(spark, d):
    """Per (experiment, piece): arrays of train / val losses of PIECE epochs
    starting at ``offset`` - the record shape of a training history."""
    e = _epochs(spark, d).withColumn("piece", F.floor(F.col("epoch") / PIECE).cast("long"))
    st = F.struct("epoch", F.col("value").alias("tr"), F.log1p("value").alias("va"))
    g = e.groupBy("user_id", "piece").agg(F.array_sort(F.collect_list(st)).alias("_h"))
    return g.select("user_id", (F.col("piece") * PIECE).alias("offset"),
                    F.transform("_h", lambda x: x["tr"]).alias("train_losses"),
                    F.transform("_h", lambda x: x["va"]).alias("val_losses"))


def m_history_long(spark, d):
    h = history_records(spark, d).join(_settings(spark, d), "user_id")
    long = history_long(h, ["user_id"], {"train": "train_losses", "val": "val_losses"}, offset="offset",
                        settings=["var1", "var2"])
    return long.withColumn("value", F.round("value", 6))


SQL_HISTORY_LONG = (f"WITH {SQL_EPOCHS},\n{SQL_SETTINGS}\n"
                    "SELECT ep.user_id, st.var1, st.var2, 'train' AS type, epoch, round(value, 6) AS value FROM ep "
                    "JOIN st ON ep.user_id = st.user_id UNION ALL SELECT ep.user_id, st.var1, st.var2, 'val', epoch, "
                    "round(ln(1 + value), 6) FROM ep JOIN st ON ep.user_id = st.user_id")

ACC_CUTS = {"train_acc": 100.0, "val_acc": 50.0, "test_acc": 25.0}   # fixed: share of values below


def m_history_summary(spark, d):
    ev = events(spark, d, ("user_id", "value"))
    runs = ev.groupBy("user_id").agg(*[F.avg((F.col("value") < c).cast("double")).alias(k) for k, c in ACC_CUTS.items()])
    r = compare_settings(runs.join(_settings(spark, d), "user_id"), "var1", "var2", list(ACC_CUTS))
    return r.select("var1", "var2", *[r6(k) for k in ACC_CUTS], "n_runs")


SQL_HISTORY_SUMMARY = (f"WITH {SQL_SETTINGS},\nru AS (SELECT user_id, "
                       + ", ".join(f"avg(CAST(value < {c} AS DOUBLE)) AS {k}" for k, c in ACC_CUTS.items())
                       + " FROM events GROUP BY user_id)\nSELECT var1, var2, "
                       + ", ".join(f"round(avg({k}), 6) AS {k}" for k in ACC_CUTS)
                       + ", CAST(count(*) AS BIGINT) AS n_runs FROM ru JOIN st ON ru.user_id = st.user_id GROUP BY var1, var2")


# ---- M7-M16: metrics on predictions ---------------------------------------------------------------

def predictions(spark, d):
    """labels x documents: score = n_chars / 50000, y = quality."""
    lab = table(spark, d, "labels", ["doc_id", "quality"])
    doc = table(spark, d, "documents", ["doc_id", "n_chars"])
    return lab.join(doc, "doc_id").select("doc_id", (F.col("n_chars") / 50000.0).alias("score"),
                                          F.col("quality").cast("int").alias("y"))


SQL_PRED = ("p AS (SELECT l.doc_id, d.n_chars / 50000.0 AS score, CAST(l.quality AS INTEGER) AS y "
            "FROM labels l JOIN documents d ON l.doc_id = d.doc_id)")


def m_auc(spark, d):
    return roc_auc(predictions(spark, d), "score", "y").select(r6("auc"), "n_pos", "n_neg")


SQL_AUC = (f"WITH {SQL_PRED},\npr AS (SELECT sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 "
           "ELSE 0 END) AS s FROM p a JOIN p b ON a.y = 1 AND b.y = 0)\n"
           "SELECT round((SELECT s FROM pr) / (sum(y) * sum(1 - y)), 6) AS auc, CAST(sum(y) AS BIGINT) AS n_pos, "
           "CAST(sum(1 - y) AS BIGINT) AS n_neg FROM p")


def m_average_precision(spark, d):
    return average_precision(predictions(spark, d), "score", "y").select(r6("average_precision"))


SQL_AP = (f"WITH {SQL_PRED},\nt AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM p GROUP BY score),\n"
          "c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, "
          "sum(pos) OVER () AS P FROM t)\nSELECT round(sum(pos * tp / (tp + fp)) / max(P), 6) AS average_precision FROM c")


def m_pr_curve(spark, d):
    return pr_curve(predictions(spark, d), "score", "y").select(r6("threshold"), r6("precision"), r6("recall"))


SQL_PR = (f"WITH {SQL_PRED},\nt AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM p GROUP BY score),\n"
          "c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, "
          "sum(pos) OVER () AS P FROM t)\nSELECT round(score, 6) AS threshold, round(tp / (tp + fp), 6) AS precision, "
          "round(tp / P, 6) AS recall FROM c UNION ALL SELECT NULL, 1.0, 0.0")

LINKS = ("identity", "logistic")


def _linked(spark, d):
    p = predictions(spark, d).withColumn("link", F.explode(F.array(*[F.lit(x) for x in LINKS])))
    pred = F.when(F.col("link") == "logistic", binarize("score", 0.5, "logistic")).otherwise(binarize("score", 0.5))
    return p.withColumn("pred", pred)


def _cm(spark, d):
    return _linked(spark, d).groupBy("link").agg(*confusion("y", "pred"))


def m_confusion(spark, d):
    return _cm(spark, d)


def m_scores(spark, d):
    s = scores_from_confusion(_cm(spark, d))
    return s.select("link", *[r6(c) for c in ("accuracy", "precision_weighted", "recall_weighted", "f1_weighted",
                                               "specificity", "sensitivity", "ppv", "npv")])


def m_class_report(spark, d):
    r = class_report(_cm(spark, d), ["link"])
    return r.select("link", "class", r6("precision"), r6("recall"), r6("f1"), F.col("support").cast("long"))


SQL_CM = (f"{SQL_PRED},\nl AS (SELECT p.*, k.link, CASE WHEN k.link = 'logistic' THEN "
          "CASE WHEN 1.0 / (1.0 + exp(-score)) >= 0.5 THEN 1 ELSE 0 END ELSE CASE WHEN score >= 0.5 THEN 1 ELSE 0 END END AS pred "
          "FROM p, (SELECT unnest(['identity', 'logistic']) AS link) k),\n"
          "cm AS (SELECT link, CAST(sum(CASE WHEN y = 0 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn, "
          "CAST(sum(CASE WHEN y = 0 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp, "
          "CAST(sum(CASE WHEN y = 1 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn, "
          "CAST(sum(CASE WHEN y = 1 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp FROM l GROUP BY link)")


def _d(a, b):
    return f"(CASE WHEN ({b}) <> 0 THEN ({a}) / ({b}) ELSE 0.0 END)"


_P1, _R1 = _d("tp", "tp + fp"), _d("tp", "tp + fn")
_P0, _R0 = _d("tn", "tn + fn"), _d("tn", "tn + fp")
_F1, _F0 = _d(f"2 * {_P1} * {_R1}", f"{_P1} + {_R1}"), _d(f"2 * {_P0} * {_R0}", f"{_P0} + {_R0}")
_N = "CAST(tn + fp + fn + tp AS DOUBLE)"

SQL_SCORES = (f"WITH {SQL_CM}\nSELECT link, round({_d('tp + tn', _N)}, 6) AS accuracy, "
              f"round({_d(f'{_P0} * (tn + fp) + {_P1} * (tp + fn)', _N)}, 6) AS precision_weighted, "
              f"round({_d(f'{_R0} * (tn + fp) + {_R1} * (tp + fn)', _N)}, 6) AS recall_weighted, "
              f"round({_d(f'{_F0} * (tn + fp) + {_F1} * (tp + fn)', _N)}, 6) AS f1_weighted, "
              f"round({_R0}, 6) AS specificity, round({_R1}, 6) AS sensitivity, round({_P1}, 6) AS ppv, "
              f"round({_P0}, 6) AS npv FROM cm")

SQL_CLASS_REPORT = (f"WITH {SQL_CM}\n"
                    f"SELECT link, '0' AS class, round({_P0}, 6) AS precision, round({_R0}, 6) AS recall, round({_F0}, 6) AS f1, "
                    "CAST(tn + fp AS BIGINT) AS support FROM cm UNION ALL "
                    f"SELECT link, '1', round({_P1}, 6), round({_R1}, 6), round({_F1}, 6), CAST(tp + fn AS BIGINT) FROM cm UNION ALL "
                    f"SELECT link, 'macro avg', round(({_P0} + {_P1}) / 2, 6), round(({_R0} + {_R1}) / 2, 6), "
                    f"round(({_F0} + {_F1}) / 2, 6), CAST(tn + fp + fn + tp AS BIGINT) FROM cm UNION ALL "
                    f"SELECT link, 'weighted avg', round({_d(f'{_P0} * (tn + fp) + {_P1} * (tp + fn)', _N)}, 6), "
                    f"round({_d(f'{_R0} * (tn + fp) + {_R1} * (tp + fn)', _N)}, 6), "
                    f"round({_d(f'{_F0} * (tn + fp) + {_F1} * (tp + fn)', _N)}, 6), CAST(tn + fp + fn + tp AS BIGINT) FROM cm")


def m_batch_auc(spark, d):
    p = predictions(spark, d)
    p = global_index(p, "doc_id", "_rk").withColumn("batch", F.floor(F.col("_rk") / BATCH).cast("long"))
    per = roc_auc(p, "score", "y", ["batch"], bounded_groups=True)   # batches hold BATCH rows
    return per.agg(F.count(F.lit(1)).alias("n_batches"), F.count("auc").alias("n_scored"),
                   F.round(F.avg("auc"), 6).alias("auc_mean_skip"),
                   F.round(F.avg(F.coalesce("auc", F.lit(0.0))), 6).alias("auc_mean_zero"))


SQL_BATCH_AUC = (f"WITH {SQL_PRED},\nb AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / {BATCH}) AS BIGINT) "
                 "AS batch FROM p),\npa AS (SELECT a.batch, sum(CASE WHEN a.score > c.score THEN 1.0 WHEN a.score = c.score "
                 "THEN 0.5 ELSE 0 END) AS s FROM b a JOIN b c ON a.batch = c.batch AND a.y = 1 AND c.y = 0 GROUP BY a.batch),\n"
                 "bt AS (SELECT batch, sum(y) AS P, sum(1 - y) AS N FROM b GROUP BY batch),\n"
                 "ba AS (SELECT bt.batch, CASE WHEN P > 0 AND N > 0 THEN pa.s / (P * N) END AS auc FROM bt "
                 "LEFT JOIN pa ON bt.batch = pa.batch)\n"
                 "SELECT CAST(count(*) AS BIGINT) AS n_batches, CAST(count(auc) AS BIGINT) AS n_scored, "
                 "round(avg(auc), 6) AS auc_mean_skip, round(avg(coalesce(auc, 0.0)), 6) AS auc_mean_zero FROM ba")


def m_weighted_log_loss(spark, d):
    p = predictions(spark, d)
    return p.agg(F.round(F.avg(logistic_loss("score", "y", POS_WEIGHT)), 6).alias("loss_weighted"),
                 F.round(F.avg(logistic_loss("score", "y", 1.0)), 6).alias("bce"))


SQL_LOG_LOSS = (f"WITH {SQL_PRED},\ns AS (SELECT y, 1.0 / (1.0 + exp(-score)) AS q FROM p)\n"
                f"SELECT round(avg(-({POS_WEIGHT} * y * ln(q) + (1 - y) * ln(1 - q))), 6) AS loss_weighted, "
                "round(avg(-(y * ln(q) + (1 - y) * ln(1 - q))), 6) AS bce FROM s")


QUERIES = {
    "m_classifier_facts": m_classifier_facts,
    "m_sweep_facts": m_sweep_facts,
    "l_sample_shuffle": l_sample_shuffle,
    "l_split": l_split,
    "l_union": l_union,
    "m_minmax": m_minmax,
    "m_minmax_by_stay": m_minmax_by_stay,
    "m_zscore": m_zscore,
    "w_sequences": w_sequences,
    "w_sliding": w_sliding,
    "m_classifier": m_classifier,
    "m_tree_facts": m_tree_facts,
    "m_first_epochs": m_first_epochs,
    "m_sweep": m_sweep,
    "m_sweep_history": m_sweep_history,
    "m_sweep_summary": m_sweep_summary,
    "m_early_stop": m_early_stop,
    "m_history_long": m_history_long,
    "m_history_summary": m_history_summary,
    "m_auc": m_auc,
    "m_average_precision": m_average_precision,
    "m_pr_curve": m_pr_curve,
    "m_confusion": m_confusion,
    "m_scores": m_scores,
    "m_class_report": m_class_report,
    "m_batch_auc": m_batch_auc,
    "m_weighted_log_loss": m_weighted_log_loss,
}

ORACLE = {
    "m_classifier_facts": SQL_CLASSIFIER_FACTS,
    "m_tree_facts": _sql_tree_facts(),
    "m_first_epochs": _sql_first_epochs(),
    "m_sweep_facts": _sql_sweep_facts(),
    "l_sample_shuffle": SQL_SAMPLE,
    "l_split": _sql_windows_cte() + ",\n" + _sql_split("wo") + "\nSELECT user_id, hr, split FROM sp",
    "l_union": _sql_union(),
    "m_minmax": _sql_scale("minmax"),
    "m_minmax_by_stay": _sql_scale("by_stay"),
    "m_zscore": _sql_scale("zscore"),
    "w_sequences": _sql_sequences(),
    "w_sliding": _sql_sliding(),
    "m_early_stop": SQL_EARLY_STOP,
    "m_history_long": SQL_HISTORY_LONG,
    "m_history_summary": SQL_HISTORY_SUMMARY,
    "m_auc": SQL_AUC,
    "m_average_precision": SQL_AP,
    "m_pr_curve": SQL_PR,
    "m_confusion": f"WITH {SQL_CM}\nSELECT * FROM cm",
    "m_scores": SQL_SCORES,
    "m_class_report": SQL_CLASS_REPORT,
    "m_batch_auc": SQL_BATCH_AUC,
    "m_weighted_log_loss": SQL_LOG_LOSS,
}

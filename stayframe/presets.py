"""Settings of the reference pipelines, for grids that use its column names.

Everything below the marker is a fixed value that must equal the reference's
for the same results (column lists in the reference's order; ranges with
their closedness; thresholds; sizes).
"""

from __future__ import annotations

from stayframe.operators.clean import Range

# ---- fixed values ------------------------------------------------------------------------------

# hourly SOFA grid: key columns, the 27 features, then the label-side columns
SOFA_KEYS = ["subject_id", "hadm_id", "stay_id", "hr", "starttime", "endtime"]
SOFA_FEATURES = ["sbp", "dbp", "gcs_min", "respiratory_rate", "abp_mean", "heart_rate", "temperature",
                 "hemoglobin", "hematocrit", "sao2", "fio2", "urine", "wbc", "bun", "bilirubin_max",
                 "creatinine_max", "pao2fio2ratio_vent", "platelet_min", "dobutamine", "dopamine", "epinephrine",
                 "norepinephrine", "vasopressin", "pH", "potassium", "bicarbonate", "lactate"]
SOFA_LABELS = ["icd_event", "age", "is_infection"]
SOFA_DROPPED_BEFORE_SCALING = ["urine"]
SOFA_SCALED_EXTRA = ["icd_event", "age"]

# outside the range -> null (both bounds kept)
SOFA_OUTLIER_RULES = {
    "sbp": Range(50, 200),
    "dbp": Range(50, 100),
    "respiratory_rate": Range(5, 50),
    "heart_rate": Range(30, 200),
    "hemoglobin": Range(0, 21),
    "hematocrit": Range(15, 60),
    "sao2": Range(lo=50),
    "bilirubin_max": Range(hi=40),
    "creatinine_max": Range(hi=10),
    "platelet_min": Range(hi=500),
    "pH": Range(6, 8),
    "bicarbonate": Range(10, 40),
    "lactate": Range(hi=6),
    "potassium": Range(1, 10),
}

# hourly qSOFA grid
QSOFA_FEATURES = ["sbp", "gcs_min", "respiratory_rate", "abp_mean", "heart_rate", "SaO2", "fio2"]
QSOFA_OUTLIER_RULES = {
    "respiratory_rate": Range(hi=200, hi_closed=False),
    "heart_rate": Range(lo=0, hi=220, hi_closed=False),
    "SaO2": Range(0, 100),
}
QSOFA_SCORE_PARTS = {"sbp": ("<=", 100), "gcs_min": ("<=", 14), "respiratory_rate": (">=", 22)}
QSOFA_FLAG_AT = 2          # is_qsofa = score >= 2
PERSISTENCE_ROWS = 4       # event = 4 consecutive rows with score >= 2
LAG_SUM_AT = 4             # score + previous score >= 4

# windows, splits, sequences, training
WINDOW_ROWS = 24
SHORT_WINDOW_ROWS = 4
SHORT_ONSET_HOUR = 32      # 8h cohorts: onset hour >= 32
ROLLUP_HOURS = (4, 8)
SPLIT_FRACTIONS = (0.8, 0.8)
SEQUENCE_INPUT_ROWS, SEQUENCE_GAP_ROWS, SEQUENCE_TARGET_ROWS = 19, 4, 1
POSITIVE_WEIGHT = 50
PATIENCE = 20
MAX_EPOCHS = 1000
BATCH_SIZE = 128
SCORE_THRESHOLD = 0.5

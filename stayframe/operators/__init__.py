"""DataFrame -> DataFrame operators.

seq       chunked per-entity scans (row index, previous/next non-null, lags,
          prefix aggregates, entity facts, trailing frames with halos)
grid      binning, grid completion, roll-ups, hourly means, interval joins
clean     outlier masks, threshold scores, null handling
impute    interpolation and fill recipes
cohort    persistence events, onset anchors, look-back windows
joins     null-aware NOT IN, membership flags, time bands, outer merge by pivot
profile   missingness, describe, duplicate groups, keep-first
quantile  exact quantiles by histogram refinement
split     entity ranks, splits, sampling, paging
scale     min-max / z-score with scikit-learn edge rules
sequence  fixed and sliding sequence assembly
metrics   exact ROC-AUC, AP, PR curve, confusion-based scores
history   early-stop replay, history explode, setting comparison
model     weighted logistic regression and a parameter sweep (pyspark.ml)
"""

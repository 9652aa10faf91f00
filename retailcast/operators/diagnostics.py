"""Data and model diagnostics: outliers, split shift, correlations, prediction checks, rules."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailcast.config import (IQR_MULTIPLIER, LEAKAGE_CORRELATION, MAX_FEATURES, MIN_TRAIN_ROWS,
                               OUTLIER_PCT_DIGITS, SHIFT_THRESHOLD, ZERO_TARGET_SHARE)
from retailcast.operators.ordering import null_safe
from retailcast.operators.quantiles import exact_quantiles


def outlier_summary(df: DataFrame, col: str, group_cols: list[str] | None = None,
                    k: float = IQR_MULTIPLIER) -> DataFrame:
    """IQR fences (Q1 - k IQR, Q3 + k IQR) and the values outside them, per group.

    Columns: q1, q3, lower_bound, upper_bound, count, percentage (2 places),
    min_outlier, max_outlier (null when there is none).  Quantiles are exact
    and linear, computed without gathering a group into one task.
    """
    g = list(group_cols or [])
    q = exact_quantiles(df, col, [0.25, 0.75], g)
    q = q.select(*g, F.col("q_0").alias("q1"), F.col("q_1").alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    q = q.withColumns({"lower_bound": F.col("q1") - k * iqr, "upper_bound": F.col("q3") + k * iqr})
    x = F.col(col)
    if g:
        j = null_safe(df.select(*g, x), q, g, "left")  # a group of nulls has no quantiles, but a row
    else:
        vals = q.select(F.array("q1", "q3", "lower_bound", "upper_bound")).scalar()
        j = df.select(x).withColumns({"q1": vals[0], "q3": vals[1], "lower_bound": vals[2],
                                      "upper_bound": vals[3]})
    out = F.when((x < F.col("lower_bound")) | (x > F.col("upper_bound")), x)
    agg = j.groupBy(*g, "q1", "q3", "lower_bound", "upper_bound").agg(
        F.count(out).alias("count"), F.count(x).alias("__n"),
        F.min(out).alias("min_outlier"), F.max(out).alias("max_outlier"))
    return agg.select(*g, "q1", "q3", "lower_bound", "upper_bound", "count",
                      F.round(F.try_divide("count", "__n") * 100, OUTLIER_PCT_DIGITS).alias("percentage"),
                      "min_outlier", "max_outlier")


def split_profile(df: DataFrame, target: str, split_col: str = "split",
                  threshold: float = SHIFT_THRESHOLD) -> DataFrame:
    """Mean and sample std of the target per split; relative mean shift against train."""
    agg = df.groupBy(split_col).agg(F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"),
                                    F.count(target).alias("n"))
    w = Window.partitionBy()  # one row per split
    m_train = F.max(F.when(F.col(split_col) == "train", F.col("mean"))).over(w)
    shift = F.abs(F.try_divide(F.col("mean") - m_train, m_train))
    return agg.withColumns({"mean_shift": shift, "shifted": shift > threshold})


def safe_corr(x, y):
    """Pearson r with pairwise null skipping; null (not an ANSI error) for a constant column."""
    xs = F.when(y.isNotNull(), x.cast("double"))
    ys = F.when(x.isNotNull(), y.cast("double"))
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


MOMENTS = "feature string, n long, mx double, my double, xx double, yy double, xy double"


def _partial_moments(cols: list[str], target: str):
    """One row per column and task: count, means and central co-moments of (column, target) pairs without nulls."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(cols), 6))
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in cols]) if cols else np.empty((0, 0))
            y = np.broadcast_to(batch.column(target).to_numpy(zero_copy_only=False).astype(float), x.shape)
            null = np.stack([batch.column(c).is_null().to_numpy(zero_copy_only=False) for c in cols]) | batch.column(target).is_null().to_numpy(zero_copy_only=False)
            n = (~null).sum(axis=1)
            some = np.maximum(n, 1)
            mx, my = np.where(null, 0, x).sum(axis=1) / some, np.where(null, 0, y).sum(axis=1) / some
            dx, dy = np.where(null, 0, x - mx[:, None]), np.where(null, 0, y - my[:, None])
            total = merge_moments(total, np.stack([n, mx, my, (dx * dx).sum(axis=1), (dy * dy).sum(axis=1), (dx * dy).sum(axis=1)], axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(cols), pa.array(total[:, 0].astype(np.int64)), *(pa.array(total[:, i]) for i in range(1, 6))],
                                         names=[f.split()[0] for f in MOMENTS.split(", ")])
    return run


def merge_moments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Co-moments of two disjoint sets of rows taken together (columns n, mx, my, xx, yy, xy)."""
    n = a[:, 0] + b[:, 0]
    some = np.maximum(n, 1)
    dx, dy, w = b[:, 1] - a[:, 1], b[:, 2] - a[:, 2], a[:, 0] * b[:, 0] / some
    return np.stack([n, a[:, 1] + dx * b[:, 0] / some, a[:, 2] + dy * b[:, 0] / some, a[:, 3] + b[:, 3] + dx * dx * w,
                     a[:, 4] + b[:, 4] + dy * dy * w, a[:, 5] + b[:, 5] + dx * dy * w], axis=1)


def co_moments(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """The MOMENTS of each column with the target over all rows.

    Tasks reduce their rows, all columns at a time, to one row per column; those are merged per column by sums: with the
    grand means, each part's moments shift by its means' distance from them.
    """
    typed = df.select(F.col(target).cast("double").alias("__y"), *[F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(cols)])
    names = [f"__x{i}" for i in range(len(cols))]
    parts = typed.mapInArrow(_partial_moments(names, "__y"), MOMENTS).where("n > 0")
    label = F.element_at(F.array(*[F.lit(c) for c in cols]), F.substring("feature", 4, 9).cast("int") + 1)
    per = parts.groupBy("feature").agg(F.collect_list(F.struct("n", "mx", "my", "xx", "yy", "xy")).alias("p"))  # one entry per task
    total = lambda f: F.aggregate("p", F.lit(0.0), lambda s, x: s + f(x))
    per = per.select(label.alias("feature"), "p", total(lambda x: x["n"]).cast("long").alias("n"))
    per = per.select("*", (total(lambda x: x["n"] * x["mx"]) / F.col("n")).alias("mx"), (total(lambda x: x["n"] * x["my"]) / F.col("n")).alias("my"))
    off = lambda x, c: x[c] - F.col(c)
    return per.select("feature", "n", "mx", "my", *[
        total(lambda x, a=a, b=b, m=m: x[m] + x["n"] * off(x, a) * off(x, b)).alias(m) for m, a, b in (("xx", "mx", "mx"), ("yy", "my", "my"), ("xy", "mx", "my"))])


def target_correlations(df: DataFrame, target: str, cols: list[str],
                        threshold: float = LEAKAGE_CORRELATION) -> DataFrame:
    """Pearson r of each column with the target (pairwise null skipping), from mergeable co-moments: one pass over
    the rows, which are not repeated per column.

    Constant columns and columns without a pair give null.  Output: (feature, correlation, high).
    """
    m = co_moments(df, cols, target)
    corr = m.select("feature", F.try_divide("xy", F.sqrt("xx") * F.sqrt("yy")).alias("correlation"))
    spark = df.sparkSession
    names = spark.createDataFrame([(c,) for c in cols], "feature string")
    return names.join(corr, "feature", "left").withColumn("high", F.abs("correlation") > threshold)


def long_features(df: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    """(keep..., feature, value) with every feature cast to double."""
    x = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
    return x.unpivot(keep, cols, "feature", "value")


def prediction_analysis(preds: DataFrame) -> DataFrame:
    """Per model: prediction mean / population std, extreme predictions, residual stats, mape.

    Extreme = below half the smallest actual or above 1.5x the largest actual.
    The per-model min/max frame has one row per model, so it is broadcast.
    """
    r = F.col("actual") - F.col("prediction")
    bounds = preds.groupBy("model").agg(F.min("actual").alias("__lo"), F.max("actual").alias("__hi"))
    j = preds.join(F.broadcast(bounds), "model")
    return j.groupBy("model").agg(
        F.avg("prediction").alias("pred_mean"), F.stddev_pop("prediction").alias("pred_std"),
        F.count_if(F.col("prediction") < F.col("__lo") * 0.5).alias("extreme_low_count"),
        F.count_if(F.col("prediction") > F.col("__hi") * 1.5).alias("extreme_high_count"),
        F.avg(r).alias("residual_mean"), F.stddev_samp(r).alias("residual_std"),
        (F.avg(F.abs(F.try_divide(r, F.col("actual")))) * 100).alias("mape"))


def zero_target_share(df: DataFrame, target: str) -> DataFrame:
    return df.agg(F.count_if(F.col(target) == 0).alias("zeros"), F.count(F.lit(1)).alias("n"))


def diagnosis_rules(profile: DataFrame, correlations: DataFrame, train: DataFrame, target: str,
                    n_features: int) -> DataFrame:
    """Rule rows (check, value, threshold, fired) from the split profile, correlations and train rows."""
    shifts = profile.where(F.col("split") != "train").select(
        F.concat(F.lit("mean_shift_"), F.col("split")).alias("check"),
        F.col("mean_shift").alias("value"), F.lit(SHIFT_THRESHOLD).alias("threshold"))
    spark = train.sparkSession
    feats = spark.range(1).select(F.lit("n_features").alias("check"), F.lit(float(n_features)).alias("value"),
                                  F.lit(float(MAX_FEATURES)).alias("threshold"))
    high = correlations.agg(F.lit("high_correlation_features").alias("check"),
                            F.count_if(F.col("high")).cast("double").alias("value"),
                            F.lit(0.0).alias("threshold"))
    t = train.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(target) == 0).alias("z"))
    small = t.select(F.lit("train_rows").alias("check"), F.col("n").cast("double").alias("value"),
                     F.lit(float(MIN_TRAIN_ROWS)).alias("threshold"))
    zeros = t.select(F.lit("zero_target_share").alias("check"),
                     F.try_divide(F.col("z"), F.col("n")).cast("double").alias("value"),
                     F.lit(ZERO_TARGET_SHARE).alias("threshold"))
    rules = shifts.unionByName(feats).unionByName(high).unionByName(small).unionByName(zeros)
    fired = F.when(F.col("check") == "train_rows", F.col("value") < F.col("threshold")) \
             .otherwise(F.col("value") > F.col("threshold"))
    return rules.withColumn("fired", F.coalesce(fired, F.lit(False)))

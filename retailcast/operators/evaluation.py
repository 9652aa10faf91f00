"""Predictions in long form, stand-in forecasters and the weighted ensemble.

A prediction table is long: (model, keys..., split, actual, prediction).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailcast.config import MIN_ENSEMBLE_WEIGHT
from retailcast.operators.features import apply_windows

# --- fixed values: deterministic stand-in forecasters -------------------------
BASELINES = ("naive_lag_1", "naive_lag_7", "trailing_mean_7")
# -----------------------------------------------------------------------------


def baseline_predictions(df: DataFrame, target: str = "sales", group_cols=("store_id",),
                         order_col: str = "date", keep=("split",)) -> DataFrame:
    """Three deterministic forecasts: previous row, row 7 back, mean of the 7 previous rows.

    One window pass over chunks of each series, so that a hot one is split; the three forecasts
    are unpivoted with ``explode`` (no union).
    """
    keys = [order_col, *group_cols, *[k for k in keep if k in df.columns]]
    columns = {"__p0": lambda w: F.lag("actual", 1).over(w), "__p1": lambda w: F.lag("actual", 7).over(w),
               "__p2": lambda w: F.avg("actual").over(w.rowsBetween(-7, -1))}
    wide = apply_windows(df.select(*keys, F.col(target).alias("actual")), columns, list(group_cols), order_col, history=7)
    preds = F.array(*[F.struct(F.lit(name).alias("model"), F.col(f"__p{i}").alias("prediction"))
                      for i, name in enumerate(BASELINES)])
    x = wide.select(*keys, "actual", F.explode(preds).alias("__p"))
    return (x.select("__p.model", *keys, "actual", "__p.prediction")
             .where(F.col("prediction").isNotNull()))


def join_actuals(actuals: DataFrame, preds: DataFrame, keys=("date", "store_id"), target: str = "sales") -> DataFrame:
    """Predictions with the ``actual`` of their keys; predictions of unknown keys are left out.

    ``keys`` must name one row of ``actuals`` each, or rows multiply.
    """
    own = actuals.select(*keys, F.col(target).alias("actual"))
    return preds.drop("actual").join(own, list(keys))


def ensemble_weights(val_metrics: DataFrame, min_weight: float = MIN_ENSEMBLE_WEIGHT) -> DataFrame:
    """Weights from validation R^2: max(min_weight, r2_i / sum r2), renormalised.

    R^2 is floored at 0; if every R^2 is <= 0 the models get equal weights.
    Input: (model, r2), one row per model; output adds ``weight``.
    """
    w = Window.partitionBy()  # frame of one row per model
    r2 = F.greatest(F.coalesce(F.col("r2"), F.lit(0.0)), F.lit(0.0))
    total = F.sum(r2).over(w)
    share = F.when(total > 0, r2 / total).otherwise(1.0 / F.count(F.lit(1)).over(w))
    raw = F.greatest(F.lit(min_weight), share)
    x = val_metrics.select("model", "r2", raw.alias("__raw"))
    return x.select("model", "r2", (F.col("__raw") / F.sum("__raw").over(w)).alias("weight"))


def ensemble_predictions(preds: DataFrame, weights: DataFrame, keys: list[str],
                         name: str = "ensemble") -> DataFrame:
    """sum(w * p) / sum(w) per key over models with positive weight and a prediction.

    Weights hold one row per model, so the join broadcasts a frame bounded by
    the number of models.
    """
    j = preds.join(F.broadcast(weights.where(F.col("weight") > 0).select("model", "weight")), "model")
    return (j.groupBy(*keys)
             .agg(F.first("actual").alias("actual"),
                  (F.sum(F.col("weight") * F.col("prediction")) / F.sum("weight")).alias("prediction"))
             .select(F.lit(name).alias("model"), *keys, "actual", "prediction"))

"""Forecast error metrics, model comparison, rolling metrics and stability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailcast.config import CV_EPSILON, METRICS, STABILITY_WINDOW
from retailcast.operators.features import CHUNK_ROWS, apply_windows


def _r2(sse: Column, sst: Column) -> Column:
    # sklearn convention for a constant target: 1 if perfect, else 0
    return F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(1 - sse / sst)


def metric_columns(y: str = "actual", p: str = "prediction") -> list[Column]:
    e = F.col(y) - F.col(p)
    sse = F.sum(e * e)
    sst = F.var_pop(y) * F.count(y)
    return [F.sqrt(F.avg(e * e)).alias("rmse"),
            F.avg(F.abs(e)).alias("mae"),
            (F.avg(F.abs(F.try_divide(e, F.col(y)))) * 100).alias("mape"),
            _r2(sse, sst).alias("r2"),
            F.count(F.lit(1)).alias("n")]


def model_metrics(preds: DataFrame, by=("model", "split")) -> DataFrame:
    """rmse, mae, mape (x100, zero targets skipped), r2 per group: one aggregation."""
    return preds.groupBy(*by).agg(*metric_columns())


def to_long(metrics: DataFrame, keys=("model",), names=METRICS) -> DataFrame:
    """(keys..., metric, value) from a wide metric frame."""
    return metrics.unpivot(list(keys), list(names), "metric", "value")


def _higher_is_better(metric: Column) -> Column:
    return metric == "r2"


def best_per_metric(long: DataFrame) -> DataFrame:
    """Best model per metric: lowest rmse/mae/mape, highest r2 (ties -> first model name)."""
    signed = F.when(_higher_is_better(F.col("metric")), -F.col("value")).otherwise(F.col("value"))
    w = Window.partitionBy("metric").orderBy(signed.asc_nulls_last(), F.col("model"))
    return (long.withColumn("__r", F.row_number().over(w)).where(F.col("__r") == 1)
                .select("metric", F.col("model").alias("best_model"), F.col("value").alias("best_value")))


def _full_grid(long: DataFrame, names=METRICS) -> DataFrame:
    """Every (model, metric) pair; a missing metric has a null value (no cross join)."""
    models = long.select("model").distinct()
    grid = models.select("model", F.explode(F.array(*[F.lit(m) for m in names])).alias("metric"))
    return grid.join(long.select("model", "metric", "value"), ["model", "metric"], "left")


def average_rank(long: DataFrame, names=METRICS) -> DataFrame:
    """Competition rank per metric (1 = best, ties share the first rank), averaged.

    A missing metric ranks as the worst value (+inf for errors, -inf for r2).
    """
    g = _full_grid(long, names)
    hib = _higher_is_better(F.col("metric"))
    filled = F.coalesce(F.col("value"), F.when(hib, F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
    signed = F.when(hib, -filled).otherwise(filled)
    ranked = g.withColumn("rank", F.rank().over(Window.partitionBy("metric").orderBy(signed)))
    return ranked.groupBy("model").agg((F.sum("rank") / F.lit(len(names))).alias("average_rank"))


def normalized_scores(long: DataFrame, names=METRICS) -> DataFrame:
    """Scale each metric to 0.1..1 across models (1 = best); all equal -> 0.55; missing -> 0."""
    g = _full_grid(long, names).withColumn("value", F.coalesce(F.col("value"), F.lit(0.0)))
    w = Window.partitionBy("metric")
    lo, hi = F.min("value").over(w), F.max("value").over(w)
    frac = (F.col("value") - lo) / (hi - lo)
    score = (F.when(hi == lo, F.lit(0.55))
              .when(_higher_is_better(F.col("metric")), 0.1 + 0.9 * frac)
              .otherwise(0.1 + 0.9 * (1 - frac)))
    return g.select("model", "metric", score.alias("score"))


def rolling_metrics(preds: DataFrame, keys=("store_id",), order_col: str = "date",
                    window: int = STABILITY_WINDOW, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """MAE, RMSE, R^2 over the ``window`` rows *before* each row, per (model, keys).

    Row i (0-based) is labelled with its own date and exists only for i >= window.  A series is cut
    into chunks that carry ``window`` rows of the chunk before.
    """
    e = F.col("actual") - F.col("prediction")

    def over(column):
        return lambda w: column(w.rowsBetween(-window, -1))

    def r2(fr):
        return _r2(F.sum(e * e).over(fr), F.var_pop("actual").over(fr) * F.count("actual").over(fr))

    columns = {"__n": over(lambda fr: F.count(F.lit(1)).over(fr)), "rolling_mae": over(lambda fr: F.avg(F.abs(e)).over(fr)),
               "rolling_rmse": over(lambda fr: F.sqrt(F.avg(e * e).over(fr))), "rolling_r2": over(r2)}
    rows = preds.select("model", *keys, order_col, "actual", "prediction")
    out = apply_windows(rows, columns, ["model", *keys], order_col, window, chunk_rows)
    return out.where(F.col("__n") == window).select("model", *keys, order_col, "rolling_mae", "rolling_rmse", "rolling_r2")


def stability_scores(rolling: DataFrame, eps: float = CV_EPSILON) -> DataFrame:
    """Coefficient of variation of rolling mae, rmse (std/mean) and r2 (std/mean|r2|); average."""
    agg = rolling.groupBy("model").agg(
        (F.stddev_pop("rolling_mae") / (F.avg("rolling_mae") + eps)).alias("mae_cv"),
        (F.stddev_pop("rolling_rmse") / (F.avg("rolling_rmse") + eps)).alias("rmse_cv"),
        (F.stddev_pop("rolling_r2") / (F.avg(F.abs("rolling_r2")) + eps)).alias("r2_cv"))
    return agg.withColumn("stability_score", (F.col("mae_cv") + F.col("rmse_cv") + F.col("r2_cv")) / 3)


def performance_alerts(long: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Metrics above their alert threshold: (model, metric, value, threshold, alert).

    ``mape`` is a percentage in the metric tables and a share in the thresholds.
    """
    th = F.create_map(*[x for k, v in thresholds.items() for x in (F.lit(k), F.lit(float(v)))])
    x = long.withColumn("threshold", th[F.col("metric")]).where(F.col("threshold").isNotNull())
    share = F.when(F.col("metric") == "mape", F.col("value") / 100).otherwise(F.col("value"))
    return x.withColumn("alert", share > F.col("threshold"))

"""Registered queries: split, encoders, stand-in forecasts, ensemble and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from retailcast.config import ALERT_THRESHOLDS, TEST_SIZE, VALIDATION_SIZE
from retailcast.operators import crossval, encode, evaluation, metrics, rollups, split
from retailcast.plans.oracle_sql import with_fixtures
from retailcast.plans.registry import present, register, rnd, rounded
from retailcast.sources import retail

TRAIN_FRAC = 1 - TEST_SIZE - VALIDATION_SIZE

# ------------------------------------------------------------ shared plans --


def store_split(spark, sf_dir):
    sd = rollups.store_days(spark, sf_dir, checkpoint=True)
    return split.chronological_split(sd, ["date", "store_id"], "sales")


def all_predictions(spark, sf_dir):
    """Stand-in forecasts plus their validation-weighted ensemble (long form).

    The stand-in forecasts are read three times (validation metrics, weights,
    ensemble), so they are checkpointed once.
    """
    from retailcast.operators.features import materialize

    preds = materialize(evaluation.baseline_predictions(store_split(spark, sf_dir)))
    val = metrics.model_metrics(preds.where(F.col("split") == "validation"), by=("model",))
    w = evaluation.ensemble_weights(val.select("model", "r2"))
    ens = evaluation.ensemble_predictions(preds, w, ["date", "store_id", "split"])
    return preds.unionByName(ens)


def test_metrics_long(spark, sf_dir):
    m = metrics.model_metrics(all_predictions(spark, sf_dir).where(F.col("split") == "test"), by=("model",))
    return metrics.to_long(m)


SPLIT_CTES = f"""rc_split AS (
  SELECT *, CASE WHEN row_index < CAST(floor(__n * CAST({TRAIN_FRAC} AS DOUBLE)) AS BIGINT) THEN 'train'
                 WHEN row_index < CAST(floor(__n * CAST({TRAIN_FRAC} AS DOUBLE)) AS BIGINT)
                                + CAST(floor(__n * CAST({VALIDATION_SIZE} AS DOUBLE)) AS BIGINT) THEN 'validation'
                 ELSE 'test' END AS split
  FROM (SELECT s.*, row_number() OVER (ORDER BY date, store_id) - 1 AS row_index, count(*) OVER () AS __n
        FROM rc_store_days s) WHERE sales IS NOT NULL)"""

_METRIC_SQL = """sqrt(avg((actual - prediction) * (actual - prediction))) AS rmse,
  avg(abs(actual - prediction)) AS mae,
  avg(abs((actual - prediction) / nullif(actual, 0))) * 100 AS mape,
  CASE WHEN var_pop(actual) * count(actual) = 0
       THEN CASE WHEN sum((actual - prediction) * (actual - prediction)) = 0 THEN 1.0 ELSE 0.0 END
       ELSE 1 - sum((actual - prediction) * (actual - prediction)) / (var_pop(actual) * count(actual)) END AS r2,
  count(*) AS n"""

EVAL_CTES = SPLIT_CTES + f""",
rc_pred_wide AS (
  SELECT date, store_id, split, sales AS actual,
         lag(sales, 1) OVER (PARTITION BY store_id ORDER BY date) AS p1,
         lag(sales, 7) OVER (PARTITION BY store_id ORDER BY date) AS p7,
         avg(sales) OVER (PARTITION BY store_id ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS pm
  FROM rc_split),
rc_preds AS (
  SELECT 'naive_lag_1' AS model, date, store_id, split, actual, p1 AS prediction FROM rc_pred_wide WHERE p1 IS NOT NULL
  UNION ALL SELECT 'naive_lag_7', date, store_id, split, actual, p7 FROM rc_pred_wide WHERE p7 IS NOT NULL
  UNION ALL SELECT 'trailing_mean_7', date, store_id, split, actual, pm FROM rc_pred_wide WHERE pm IS NOT NULL),
rc_val_r2 AS (SELECT model, {_METRIC_SQL} FROM rc_preds WHERE split = 'validation' GROUP BY model),
rc_w1 AS (SELECT model, r2, greatest(coalesce(r2, 0.0), 0.0) AS r2p FROM rc_val_r2),
rc_w2 AS (SELECT model, r2, greatest(0.2, CASE WHEN sum(r2p) OVER () > 0 THEN r2p / sum(r2p) OVER ()
                                              ELSE 1.0 / count(*) OVER () END) AS raw FROM rc_w1),
rc_weights AS (SELECT model, r2, raw / sum(raw) OVER () AS weight FROM rc_w2),
rc_ens AS (
  SELECT 'ensemble' AS model, date, store_id, split, first(actual) AS actual,
         sum(weight * prediction) / sum(weight) AS prediction
  FROM rc_preds JOIN rc_weights USING (model) WHERE weight > 0 GROUP BY date, store_id, split),
rc_all_preds AS (SELECT * FROM rc_preds UNION ALL SELECT * FROM rc_ens),
rc_test_metrics AS (SELECT model, {_METRIC_SQL} FROM rc_all_preds WHERE split = 'test' GROUP BY model),
rc_test_long AS (
  SELECT model, 'rmse' AS metric, rmse AS value FROM rc_test_metrics
  UNION ALL SELECT model, 'mae', mae FROM rc_test_metrics
  UNION ALL SELECT model, 'mape', mape FROM rc_test_metrics
  UNION ALL SELECT model, 'r2', r2 FROM rc_test_metrics)"""


def _metric_select(prefix=""):
    return (f"{rnd(prefix + 'rmse', 3)} AS rmse, {rnd(prefix + 'mae', 3)} AS mae, "
            f"{rnd(prefix + 'mape', 6)} AS mape, {rnd(prefix + 'r2', 6)} AS r2, {prefix}n AS n")


def _present_metrics(df):
    return df.select(*[c for c in df.columns if c not in ("rmse", "mae", "mape", "r2", "n")],
                     rounded("rmse", 3).alias("rmse"), rounded("mae", 3).alias("mae"),
                     rounded("mape", 6).alias("mape"), rounded("r2", 6).alias("r2"), "n")


# -------------------------------------------------------------------- split --
@register("chronological_split", with_fixtures(
    f"SELECT date, store_id, {rnd('sales', 6)} AS sales, row_index, split FROM rc_split", SPLIT_CTES))
def q_chronological_split(spark, sf_dir):
    s = store_split(spark, sf_dir)
    return s.select("date", "store_id", rounded("sales", 6).alias("sales"), "row_index", "split")


@register("expanding_folds", with_fixtures("""
SELECT date, store_id, fold, role FROM (
  SELECT s.date, s.store_id, f.fold,
         CASE WHEN s.row_index < s.__n - (5 - f.fold) * (s.__n // 6) THEN 'train'
              WHEN s.row_index < s.__n - (5 - f.fold) * (s.__n // 6) + (s.__n // 6) THEN 'test' END AS role
  FROM rc_split s, (SELECT CAST(range AS INTEGER) AS fold FROM range(0, 5)) f)
WHERE role IS NOT NULL""", SPLIT_CTES))
def q_expanding_folds(spark, sf_dir):
    sd = rollups.store_days(spark, sf_dir, checkpoint=True)
    return split.expanding_folds(sd, ["date", "store_id"], 5).select("date", "store_id", "fold", "role")


_FOLDS = 5
FOLD_CTES = SPLIT_CTES + f""",
rc_blocks AS (SELECT *, greatest(0, {_FOLDS} - (__n - 1 - row_index) // (__n // {_FOLDS + 1})) AS block FROM rc_split),
rc_fold_wide AS (
  SELECT date, store_id, block, sales AS actual, lag(sales, 1) OVER s AS p1, lag(sales, 7) OVER s AS p7,
         avg(sales) OVER (PARTITION BY store_id ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS pm
  FROM rc_blocks WINDOW s AS (PARTITION BY store_id ORDER BY date)),
rc_fold_preds AS (
  SELECT 'naive_lag_1' AS model, date, store_id, block, actual, p1 AS prediction FROM rc_fold_wide WHERE p1 IS NOT NULL
  UNION ALL SELECT 'naive_lag_7', date, store_id, block, actual, p7 FROM rc_fold_wide WHERE p7 IS NOT NULL
  UNION ALL SELECT 'trailing_mean_7', date, store_id, block, actual, pm FROM rc_fold_wide WHERE pm IS NOT NULL),
rc_fold_r2 AS (SELECT fold, model, greatest(1 - sum((actual - prediction) ** 2) / nullif(var_pop(actual) * count(*), 0), 0.0) AS r2
               FROM rc_fold_preds, (SELECT CAST(range AS INTEGER) AS fold FROM range({_FOLDS})) WHERE block <= fold GROUP BY fold, model),
rc_fold_weights AS (SELECT fold, model, greatest(0.2, CASE WHEN sum(r2) OVER f > 0 THEN r2 / sum(r2) OVER f ELSE 1.0 / count(*) OVER f END) AS weight
                    FROM rc_fold_r2 WINDOW f AS (PARTITION BY fold)),
rc_fold_all AS (
  SELECT block - 1 AS fold, model, date, store_id, actual, prediction FROM rc_fold_preds WHERE block > 0
  UNION ALL SELECT fold, 'ensemble', date, store_id, first(actual), sum(weight * prediction) / sum(weight)
            FROM rc_fold_preds p JOIN rc_fold_weights w USING (model) WHERE fold = block - 1 GROUP BY fold, date, store_id),
rc_fold_metrics AS (SELECT fold, model, {_METRIC_SQL} FROM rc_fold_all GROUP BY fold, model),
rc_fold_scores AS (SELECT fold, model, n, unnest(['rmse', 'mae', 'mape', 'r2']) AS metric, unnest([rmse, mae, mape, r2]) AS value
                   FROM rc_fold_metrics)"""


def fold_frame(spark, sf_dir):
    """The store-days with their fold blocks, written once."""
    return crossval.fold_frame(rollups.store_days(spark, sf_dir).where("sales is not null"), ["date", "store_id"], _FOLDS)


@register("fold_scores", with_fixtures(f"""
SELECT CAST(fold AS INTEGER) AS fold, model, metric, {rnd('value', 3)} AS value, n FROM rc_fold_scores""", FOLD_CTES))
def q_fold_scores(spark, sf_dir):
    """Metrics of the stand-in forecasts and their ensemble on each of five expanding folds."""
    s = crossval.fold_scores(crossval.baseline_folds(fold_frame(spark, sf_dir)))
    return s.select("fold", "model", "metric", rounded("value", 3).alias("value"), "n")


@register("fold_score_summary", with_fixtures(f"""
SELECT model, metric, {rnd('avg(value)', 3)} AS mean, {rnd('stddev_samp(value)', 3)} AS std, count(value) AS folds
FROM rc_fold_scores GROUP BY model, metric""", FOLD_CTES))
def q_fold_score_summary(spark, sf_dir):
    return present(crossval.score_summary(crossval.fold_scores(crossval.baseline_folds(fold_frame(spark, sf_dir)))), 3)


# ----------------------------------------------------------------- encoders --
@register("label_encoding", with_fixtures("""
SELECT s.date, s.store_id, s.split, CAST(coalesce(c.code, -1) AS INTEGER) AS store_id_code
FROM rc_split s LEFT JOIN (
  SELECT store_id, row_number() OVER (ORDER BY store_id) - 1 AS code
  FROM (SELECT DISTINCT store_id FROM rc_split WHERE split = 'train')) c USING (store_id)""", SPLIT_CTES))
def q_label_encoding(spark, sf_dir):
    s = store_split(spark, sf_dir)
    codes = encode.fit_label_codes(s.where(F.col("split") == "train"), "store_id")
    return encode.apply_label_codes(s.select("date", "store_id", "split"), codes, "store_id", replace=False)


_SCALED = ["sales", "quantity_sold", "profit", "has_promotion", "customer_traffic"]


def _scaling_sql():
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALED)
    cols = ", ".join(
        rnd(f"(CAST({c} AS DOUBLE) - m_{c}) / CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 1.0 ELSE s_{c} END", 6)
        + f" AS {c}" for c in _SCALED)
    return with_fixtures(f"SELECT date, store_id, split, {cols} FROM rc_split, "
                         f"(SELECT {stats} FROM rc_split WHERE split = 'train') st", SPLIT_CTES)


@register("standard_scaling", _scaling_sql())
def q_standard_scaling(spark, sf_dir):
    s = store_split(spark, sf_dir)
    scale = encode.fit_scaler(s.where(F.col("split") == "train"), _SCALED)
    return present(scale(s.select("date", "store_id", "split", *_SCALED)), 6)


@register("target_encoding", with_fixtures(f"""
SELECT d.date, d.store_id, d.product_id, d.category,
       {rnd('coalesce(e.enc, g.m)', 4)} AS category_target_encoded
FROM rc_daily_base d
CROSS JOIN (SELECT avg(sales) AS m FROM rc_daily_base) g
LEFT JOIN (SELECT category, (count(*) * avg(sales) + 1.0 * (SELECT avg(sales) FROM rc_daily_base))
                            / (count(*) + 1.0) AS enc
           FROM rc_daily_base GROUP BY category) e USING (category)"""))
def q_target_encoding(spark, sf_dir):
    d = rollups.daily_sales(retail.sales(spark, sf_dir))
    out = encode.target_encode(d.select("date", "store_id", "product_id", "category", "sales"),
                               ["category"], "sales")
    return out.select("date", "store_id", "product_id", "category",
                      rounded("category_target_encoded", 4).alias("category_target_encoded"))


# ---------------------------------------------------------------- forecasts --
@register("forecast_predictions", with_fixtures(
    f"SELECT model, date, store_id, split, {rnd('actual', 3)} AS actual, {rnd('prediction', 3)} AS prediction "
    "FROM rc_all_preds", EVAL_CTES))
def q_forecast_predictions(spark, sf_dir):
    return present(all_predictions(spark, sf_dir), 3)


@register("ensemble_weights", with_fixtures(
    f"SELECT model, {rnd('r2', 6)} AS r2, {rnd('weight', 6)} AS weight FROM rc_weights", EVAL_CTES))
def q_ensemble_weights(spark, sf_dir):
    preds = evaluation.baseline_predictions(store_split(spark, sf_dir))
    val = metrics.model_metrics(preds.where(F.col("split") == "validation"), by=("model",))
    return present(evaluation.ensemble_weights(val.select("model", "r2")), 6)


@register("model_metrics", with_fixtures(
    f"SELECT model, split, {_metric_select()} FROM "
    f"(SELECT model, split, {_METRIC_SQL} FROM rc_all_preds GROUP BY model, split)", EVAL_CTES))
def q_model_metrics(spark, sf_dir):
    return _present_metrics(metrics.model_metrics(all_predictions(spark, sf_dir)))


@register("best_model_per_metric", with_fixtures(f"""
SELECT metric, model AS best_model, {rnd('value', 6)} AS best_value FROM (
  SELECT *, row_number() OVER (PARTITION BY metric ORDER BY CASE WHEN metric = 'r2' THEN -value ELSE value END
                               ASC NULLS LAST, model) AS r
  FROM rc_test_long) WHERE r = 1""", EVAL_CTES))
def q_best_model_per_metric(spark, sf_dir):
    return present(metrics.best_per_metric(test_metrics_long(spark, sf_dir)), 6)


@register("model_ranking", with_fixtures("""
SELECT model, sum(rk) / 4.0 AS average_rank FROM (
  SELECT model, rank() OVER (PARTITION BY metric ORDER BY CASE WHEN metric = 'r2' THEN -value ELSE value END) AS rk
  FROM rc_test_long) GROUP BY model""", EVAL_CTES))
def q_model_ranking(spark, sf_dir):
    return metrics.average_rank(test_metrics_long(spark, sf_dir))


@register("normalized_scores", with_fixtures(f"""
SELECT model, metric, {rnd('''CASE WHEN hi = lo THEN 0.55
  WHEN metric = 'r2' THEN 0.1 + 0.9 * ((value - lo) / (hi - lo))
  ELSE 0.1 + 0.9 * (1 - (value - lo) / (hi - lo)) END''', 6)} AS score
FROM (SELECT model, metric, value, min(value) OVER (PARTITION BY metric) AS lo,
             max(value) OVER (PARTITION BY metric) AS hi FROM rc_test_long)""", EVAL_CTES))
def q_normalized_scores(spark, sf_dir):
    return present(metrics.normalized_scores(test_metrics_long(spark, sf_dir)), 6)


ROLLING_SQL = """rc_rolling AS (
  SELECT model, store_id, date, rolling_mae, rolling_rmse, rolling_r2 FROM (
    SELECT model, store_id, date,
      row_number() OVER (PARTITION BY model, store_id ORDER BY date) AS rn,
      avg(abs(actual - prediction)) OVER w AS rolling_mae,
      sqrt(avg((actual - prediction) * (actual - prediction)) OVER w) AS rolling_rmse,
      CASE WHEN var_pop(actual) OVER w * count(actual) OVER w = 0
           THEN CASE WHEN sum((actual - prediction) * (actual - prediction)) OVER w = 0 THEN 1.0 ELSE 0.0 END
           ELSE 1 - sum((actual - prediction) * (actual - prediction)) OVER w
                    / (var_pop(actual) OVER w * count(actual) OVER w) END AS rolling_r2
    FROM rc_all_preds WHERE split = 'test'
    WINDOW w AS (PARTITION BY model, store_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
  WHERE rn > 30)"""


def _rolling(spark, sf_dir):
    test = all_predictions(spark, sf_dir).where(F.col("split") == "test")
    return metrics.rolling_metrics(test, ("store_id",), "date", 30)


@register("rolling_metrics", with_fixtures(
    f"SELECT model, store_id, date, {rnd('rolling_mae', 3)} AS rolling_mae, "
    f"{rnd('rolling_rmse', 3)} AS rolling_rmse, {rnd('rolling_r2', 6)} AS rolling_r2 FROM rc_rolling",
    EVAL_CTES + ",\n" + ROLLING_SQL))
def q_rolling_metrics(spark, sf_dir):
    r = _rolling(spark, sf_dir)
    return r.select("model", "store_id", "date", rounded("rolling_mae", 3).alias("rolling_mae"),
                    rounded("rolling_rmse", 3).alias("rolling_rmse"), rounded("rolling_r2", 6).alias("rolling_r2"))


@register("stability_scores", with_fixtures(f"""
SELECT model, {rnd('mae_cv', 6)} AS mae_cv, {rnd('rmse_cv', 6)} AS rmse_cv, {rnd('r2_cv', 6)} AS r2_cv,
       {rnd('(mae_cv + rmse_cv + r2_cv) / 3', 6)} AS stability_score FROM (
  SELECT model, stddev_pop(rolling_mae) / (avg(rolling_mae) + 1e-8) AS mae_cv,
         stddev_pop(rolling_rmse) / (avg(rolling_rmse) + 1e-8) AS rmse_cv,
         stddev_pop(rolling_r2) / (avg(abs(rolling_r2)) + 1e-8) AS r2_cv
  FROM rc_rolling GROUP BY model)""", EVAL_CTES + ",\n" + ROLLING_SQL))
def q_stability_scores(spark, sf_dir):
    return present(metrics.stability_scores(_rolling(spark, sf_dir)), 6)


@register("performance_alerts", with_fixtures(f"""
SELECT model, metric, {rnd('value', 6)} AS value, threshold,
       value > threshold * CASE metric WHEN 'mape' THEN 100 ELSE 1 END AS alert FROM (
  SELECT l.*, CASE metric WHEN 'rmse' THEN {ALERT_THRESHOLDS['rmse']} WHEN 'mape' THEN {ALERT_THRESHOLDS['mape']} END
              AS threshold FROM rc_test_long l) WHERE threshold IS NOT NULL""", EVAL_CTES))
def q_performance_alerts(spark, sf_dir):
    a = metrics.performance_alerts(test_metrics_long(spark, sf_dir), ALERT_THRESHOLDS)
    return a.select("model", "metric", rounded("value", 6).alias("value"), "threshold", "alert")

"""Registered queries: diagnostics, report data and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from retailcast.operators import diagnostics as diag
from retailcast.operators import drift, features as feat, report, rollups, split
from retailcast.plans import sql_features as sqlf
from retailcast.plans.oracle_sql import with_fixtures
from retailcast.plans.queries_eval import EVAL_CTES, SPLIT_CTES, all_predictions, store_split
from retailcast.plans.registry import present, register, rnd, rounded

_BASE_MODELS = ("naive_lag_1", "naive_lag_7", "trailing_mean_7")


def feature_frame(spark, sf_dir):
    sd = rollups.store_days(spark, sf_dir).drop("is_holiday")
    return feat.materialize(feat.create_all_features(sd, "sales", "date", ["store_id"], ["store_id"], checkpoint=True))


def feature_split(spark, sf_dir):
    return split.chronological_split(feature_frame(spark, sf_dir), ["date", "store_id"], "sales")


def test_preds(spark, sf_dir):
    return all_predictions(spark, sf_dir).where(F.col("split") == "test")


FEAT_CTES = SPLIT_CTES + ",\n" + sqlf.feature_ctes() + """,
rc_fsplit AS (SELECT f.*, s.split FROM rc_features f JOIN rc_split s USING (date, store_id))"""


# ---------------------------------------------------------------- outliers --
@register("outlier_summary", with_fixtures(f"""
SELECT split, {rnd('q1', 3)} AS q1, {rnd('q3', 3)} AS q3, {rnd('lo', 3)} AS lower_bound, {rnd('hi', 3)} AS upper_bound,
       count(CASE WHEN sales < lo OR sales > hi THEN 1 END) AS count,
       round(count(CASE WHEN sales < lo OR sales > hi THEN 1 END) / count(sales) * 100, 2) AS percentage,
       {rnd('min(CASE WHEN sales < lo OR sales > hi THEN sales END)', 3)} AS min_outlier,
       {rnd('max(CASE WHEN sales < lo OR sales > hi THEN sales END)', 3)} AS max_outlier
FROM rc_split JOIN (
  SELECT split, q1, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
    SELECT split, quantile_cont(sales, 0.25) AS q1, quantile_cont(sales, 0.75) AS q3 FROM rc_split GROUP BY split))
  USING (split)
GROUP BY split, q1, q3, lo, hi""", SPLIT_CTES))
def q_outlier_summary(spark, sf_dir):
    o = diag.outlier_summary(store_split(spark, sf_dir), "sales", ["split"])
    return present(o.select("split", "q1", "q3", "lower_bound", "upper_bound", "count", "percentage",
                            "min_outlier", "max_outlier"), 3)


@register("split_profile", with_fixtures(f"""
SELECT split, {rnd('m', 3)} AS mean, {rnd('s', 3)} AS std, n, {rnd('shift', 6)} AS mean_shift, shift > 0.2 AS shifted
FROM (SELECT split, m, s, n, abs((m - max(CASE WHEN split = 'train' THEN m END) OVER ())
                                 / nullif(max(CASE WHEN split = 'train' THEN m END) OVER (), 0)) AS shift
      FROM (SELECT split, avg(sales) AS m, stddev_samp(sales) AS s, count(sales) AS n FROM rc_split GROUP BY split))""",
    SPLIT_CTES))
def q_split_profile(spark, sf_dir):
    p = diag.split_profile(store_split(spark, sf_dir), "sales")
    return p.select("split", F.round(F.col("mean") + 1e-8, 3).alias("mean"),
                    F.round(F.col("std") + 1e-8, 3).alias("std"), "n",
                    F.round(F.col("mean_shift") + 1e-8, 6).alias("mean_shift"), "shifted")


def _corr_sql(source: str, cols, target: str, where: str = "") -> str:
    parts = [f"SELECT '{c}' AS feature, CASE WHEN stddev_pop(CASE WHEN {target} IS NOT NULL THEN {c} END) = 0 "
             f"THEN NULL ELSE corr(CAST({c} AS DOUBLE), {target}) END AS correlation FROM {source} {where}"
             for c in cols]
    return " UNION ALL ".join(parts)


@register("target_correlations", with_fixtures(f"""
SELECT feature, {rnd('correlation', 6)} AS correlation, abs(correlation) > 0.95 AS high FROM (
{_corr_sql('rc_fsplit', sqlf.FEATURE_COLUMNS, 'sales', "WHERE split = 'train'")})""", FEAT_CTES))
def q_target_correlations(spark, sf_dir):
    train = feature_split(spark, sf_dir).where(F.col("split") == "train")
    c = diag.target_correlations(train, "sales", list(sqlf.FEATURE_COLUMNS))
    return c.select("feature", F.round(F.col("correlation") + 1e-8, 6).alias("correlation"), "high")


@register("prediction_analysis", with_fixtures(f"""
SELECT model, {rnd('avg(prediction)', 3)} AS pred_mean, {rnd('stddev_pop(prediction)', 3)} AS pred_std,
       count(CASE WHEN prediction < lo * 0.5 THEN 1 END) AS extreme_low_count,
       count(CASE WHEN prediction > hi * 1.5 THEN 1 END) AS extreme_high_count,
       {rnd('avg(actual - prediction)', 3)} AS residual_mean,
       {rnd('stddev_samp(actual - prediction)', 3)} AS residual_std,
       {rnd('avg(abs((actual - prediction) / nullif(actual, 0))) * 100', 6)} AS mape
FROM rc_all_preds JOIN (SELECT model, min(actual) AS lo, max(actual) AS hi FROM rc_all_preds WHERE split = 'test'
                        GROUP BY model) USING (model)
WHERE split = 'test' GROUP BY model""", EVAL_CTES))
def q_prediction_analysis(spark, sf_dir):
    a = diag.prediction_analysis(test_preds(spark, sf_dir))
    out = a.select("model", "pred_mean", "pred_std", "extreme_low_count", "extreme_high_count",
                   "residual_mean", "residual_std", "mape")
    return out.select("model", *[F.round(F.col(c) + 1e-8, 6 if c == "mape" else 3).alias(c)
                                 if c not in ("model", "extreme_low_count", "extreme_high_count") else F.col(c)
                                 for c in out.columns[1:]])


# ------------------------------------------------------------- report data --
RESID_CTE = """rc_resid AS (SELECT model, date, store_id, actual, prediction, actual - prediction AS residual
                            FROM rc_all_preds WHERE split = 'test')"""


@register("residual_histogram", with_fixtures(f"""
SELECT r.model, b.bin, {rnd('lo + (b.bin - 1) * ((hi - lo) / 30)', 3)} AS bin_start,
       {rnd('lo + b.bin * ((hi - lo) / 30)', 3)} AS bin_end, coalesce(c.cnt, 0) AS count,
       {rnd('coalesce(c.cnt, 0) / (n * ((hi - lo) / 30))', 9)} AS density
FROM (SELECT model, count(residual) AS n,
             CASE WHEN max(residual) > min(residual) THEN min(residual) ELSE min(residual) - 0.5 END AS lo,
             CASE WHEN max(residual) > min(residual) THEN max(residual) ELSE max(residual) + 0.5 END AS hi
      FROM rc_resid GROUP BY model) r
CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 31)) b
LEFT JOIN (SELECT x.model, least(CAST(floor((x.residual - y.lo) * 30 / (y.hi - y.lo)) AS INTEGER) + 1, 30) AS bin,
                  count(*) AS cnt
           FROM rc_resid x JOIN (SELECT model,
             CASE WHEN max(residual) > min(residual) THEN min(residual) ELSE min(residual) - 0.5 END AS lo,
             CASE WHEN max(residual) > min(residual) THEN max(residual) ELSE max(residual) + 0.5 END AS hi
             FROM rc_resid GROUP BY model) y USING (model) GROUP BY 1, 2) c
  ON c.model = r.model AND c.bin = b.bin""", EVAL_CTES + ",\n" + RESID_CTE))
def q_residual_histogram(spark, sf_dir):
    h = report.density_histogram(report.residuals(test_preds(spark, sf_dir)), "residual", 30)
    return h.select("model", "bin", F.round(F.col("bin_start") + 1e-8, 3).alias("bin_start"),
                    F.round(F.col("bin_end") + 1e-8, 3).alias("bin_end"), "count",
                    F.round(F.col("density") + 1e-8, 9).alias("density"))


@register("box_statistics", with_fixtures(f"""
SELECT model, {rnd('q1', 3)} AS q1, {rnd('med', 3)} AS median, {rnd('q3', 3)} AS q3,
       {rnd('min(CASE WHEN residual >= q1 - 1.5 * (q3 - q1) AND residual <= q3 + 1.5 * (q3 - q1) THEN residual END)', 3)} AS whisker_low,
       {rnd('max(CASE WHEN residual >= q1 - 1.5 * (q3 - q1) AND residual <= q3 + 1.5 * (q3 - q1) THEN residual END)', 3)} AS whisker_high,
       count(CASE WHEN NOT (residual >= q1 - 1.5 * (q3 - q1) AND residual <= q3 + 1.5 * (q3 - q1)) THEN 1 END) AS n_fliers
FROM rc_resid JOIN (SELECT model, quantile_cont(residual, 0.25) AS q1, quantile_cont(residual, 0.5) AS med,
                           quantile_cont(residual, 0.75) AS q3 FROM rc_resid GROUP BY model) USING (model)
GROUP BY model, q1, med, q3""", EVAL_CTES + ",\n" + RESID_CTE))
def q_box_statistics(spark, sf_dir):
    b = report.box_statistics(report.residuals(test_preds(spark, sf_dir)), "residual")
    return present(b.select("model", "q1", "median", "q3", "whisker_low", "whisker_high", "n_fliers"), 3)


@register("scale_location", with_fixtures(f"""
SELECT model, date, store_id, {rnd('prediction', 3)} AS prediction,
       {rnd('sqrt(abs(residual / nullif(stddev_samp(residual) OVER (PARTITION BY model), 0)))', 6)} AS scale_location
FROM rc_resid""", EVAL_CTES + ",\n" + RESID_CTE))
def q_scale_location(spark, sf_dir):
    s = report.scale_location(test_preds(spark, sf_dir))
    return s.select("model", "date", "store_id", F.round(F.col("prediction") + 1e-8, 3).alias("prediction"),
                    F.round(F.col("scale_location") + 1e-8, 6).alias("scale_location"))


def _ratio_sql(x: str, coefficients) -> str:
    def poly(c):
        out = repr(c[-1])
        for k in reversed(c[:-1]):
            out = f"({out} * {x} + {k!r}::DOUBLE)"
        return out.replace(repr(c[-1]), f"{c[-1]!r}::DOUBLE", 1)
    return f"({poly(coefficients[0])} / {poly(coefficients[1])})"


_QQ_SQL = f"""
WITH_T AS (
  SELECT model, residual, row_number() OVER (PARTITION BY model ORDER BY residual) - 1 AS rank,
         row_number() OVER (PARTITION BY model ORDER BY residual) / (count(*) OVER (PARTITION BY model) + 1)::DOUBLE AS p
  FROM (SELECT model, actual - prediction AS residual FROM rc_all_preds WHERE split = 'test') WHERE residual IS NOT NULL),
rc_qr AS (SELECT *, p - 0.5 AS q, sqrt(-ln(least(p, 1 - p))) AS r FROM WITH_T),
rc_qt AS (
  SELECT model, rank, residual, CASE WHEN abs(q) <= 0.425 THEN q * {_ratio_sql('(0.180625 - q * q)', report.PPF_CENTRE)}
         ELSE sign(q) * CASE WHEN r <= 5 THEN {_ratio_sql('(r - 1.6)', report.PPF_MIDDLE)}
                        ELSE {_ratio_sql('(r - 5)', report.PPF_TAIL)} END END AS theoretical FROM rc_qr),
rc_ql AS (SELECT model, regr_slope(residual, theoretical) AS slope, regr_intercept(residual, theoretical) AS intercept
          FROM rc_qt GROUP BY model)""".replace("WITH_T", "rc_qp")


@register("qq_points", with_fixtures(f"""
SELECT model, rank, {rnd('theoretical', 6)} AS theoretical, {rnd('residual', 3)} AS residual, {rnd('slope', 3)} AS slope,
       {rnd('intercept', 3)} AS intercept FROM rc_qt JOIN rc_ql USING (model)""", EVAL_CTES + "," + _QQ_SQL))
def q_qq_points(spark, sf_dir):
    q = report.qq_points(test_preds(spark, sf_dir))
    return q.select("model", "rank", rounded("theoretical", 6).alias("theoretical"), rounded("residual", 3).alias("residual"),
                    rounded("slope", 3).alias("slope"), rounded("intercept", 3).alias("intercept"))


@register("thinned_series", with_fixtures(f"""
SELECT model, date, store_id, {rnd('actual', 3)} AS actual, {rnd('prediction', 3)} AS prediction FROM (
  SELECT p.*, row_number() OVER (PARTITION BY model ORDER BY date, store_id) - 1 AS pos,
         count(*) OVER (PARTITION BY model) AS n FROM rc_all_preds p WHERE split = 'test') t
WHERE n <= 500 OR pos = n - 1 OR pos IN (
  SELECT CAST(floor(i * (CAST(t.n - 1 AS DOUBLE) / 499.0)) AS BIGINT) FROM (SELECT range AS i FROM range(0, 499)))""",
    EVAL_CTES))
def q_thinned_series(spark, sf_dir):
    t = report.thinned_series(test_preds(spark, sf_dir))
    return present(t.select("model", "date", "store_id", "actual", "prediction"), 3)


@register("ks_drift", with_fixtures(f"""
SELECT {rnd('max(abs(ca / na - cb / nb))', 9)} AS statistic, max(na) AS n1, max(nb) AS n2,
       max(abs(ca / na - cb / nb)) > 0.1 AS drift FROM (
  SELECT sum(a) OVER (ORDER BY x) AS ca, sum(b) OVER (ORDER BY x) AS cb,
         sum(a) OVER () AS na, sum(b) OVER () AS nb FROM (
    SELECT x, sum(a) AS a, sum(b) AS b FROM (
      SELECT sales AS x, 1 AS a, 0 AS b FROM rc_split WHERE split = 'train'
      UNION ALL SELECT sales, 0, 1 FROM rc_split WHERE split = 'test') GROUP BY x))""", SPLIT_CTES))
def q_ks_drift(spark, sf_dir):
    s = store_split(spark, sf_dir)
    k = drift.ks_statistic(s.where(F.col("split") == "train"), s.where(F.col("split") == "test"), "sales")
    return k.select(F.round(F.col("statistic") + 1e-8, 9).alias("statistic"), "n1", "n2", "drift")


# ---------------------------------------------------- feature importances --
def stand_in_importances(spark, sf_dir):
    """Importance of a feature for a stand-in model = |corr(feature, model prediction)| on test rows."""
    f = feature_split(spark, sf_dir).where(F.col("split") == "test")
    preds = test_preds(spark, sf_dir).where(F.col("model").isin(*_BASE_MODELS))
    j = preds.select("model", "date", "store_id", "prediction").join(f, ["date", "store_id"])
    long = diag.long_features(j, list(sqlf.FEATURE_COLUMNS), ["model", "prediction"])
    imp = long.groupBy("model", "feature").agg(F.abs(diag.safe_corr(F.col("value"), F.col("prediction")))
                                               .alias("importance"))
    return imp.where(F.col("importance").isNotNull())


def _importance_sql() -> str:
    parts = [f"SELECT model, '{c}' AS feature, abs(CASE WHEN stddev_pop({c}) = 0 THEN NULL "
             f"ELSE corr(CAST({c} AS DOUBLE), prediction) END) AS importance "
             f"FROM rc_imp_src GROUP BY model" for c in sqlf.FEATURE_COLUMNS]
    return (FEAT_CTES + ",\n" + EVAL_CTES.split(",\n", 1)[1] +
            ",\nrc_imp_src AS (SELECT p.model, p.prediction, f.* FROM rc_preds p JOIN rc_fsplit f "
            "USING (date, store_id) WHERE p.split = 'test')" +
            ",\nrc_importance AS (SELECT * FROM (" + " UNION ALL ".join(parts) +
            ") WHERE importance IS NOT NULL AND NOT isnan(importance))" +
            ",\nrc_top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model "
            "ORDER BY importance DESC, feature) AS rank FROM rc_importance) WHERE rank <= 15)")


@register("top_features", with_fixtures(
    f"SELECT model, feature, {rnd('importance', 6)} AS importance, rank FROM rc_top", _importance_sql()))
def q_top_features(spark, sf_dir):
    t = report.top_features(stand_in_importances(spark, sf_dir))
    return t.select("model", "feature", F.round(F.col("importance") + 1e-8, 6).alias("importance"),
                    F.col("rank").cast("long").alias("rank"))


@register("feature_consistency", with_fixtures(
    "SELECT feature, count(*) AS n_models FROM rc_top GROUP BY feature HAVING count(*) > 1", _importance_sql()))
def q_feature_consistency(spark, sf_dir):
    return report.feature_consistency(stand_in_importances(spark, sf_dir))


@register("importance_matrix", with_fixtures(f"""
SELECT f.feature, m.model, {rnd('coalesce(i.importance, 0.0) / (max(coalesce(i.importance, 0.0)) OVER (PARTITION BY f.feature) + 1e-8)', 6)} AS normalized
FROM (SELECT DISTINCT feature FROM rc_top) f CROSS JOIN (SELECT DISTINCT model FROM rc_importance) m
LEFT JOIN rc_importance i ON i.feature = f.feature AND i.model = m.model""", _importance_sql()))
def q_importance_matrix(spark, sf_dir):
    m = report.importance_matrix(stand_in_importances(spark, sf_dir))
    return m.select("feature", "model", F.round(F.col("normalized") + 1e-8, 6).alias("normalized"))

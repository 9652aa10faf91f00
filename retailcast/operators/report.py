"""Comparison-report data: residual distributions, box statistics, Q-Q points,
thinned series and feature-importance summaries.  Rendering is out of scope;
every function returns a small aggregated DataFrame (or per-row values).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailcast.config import IQR_MULTIPLIER, STABILITY_WINDOW, THIN_POINTS, TOP_FEATURES_PER_MODEL
from retailcast.operators import metrics
from retailcast.operators.ordering import POS, cut_bucket, null_safe, range_cuts, row_index, thin_evenly
from retailcast.operators.quantiles import exact_quantiles


def residuals(preds: DataFrame) -> DataFrame:
    return preds.withColumn("residual", F.col("actual") - F.col("prediction"))


def density_histogram(df: DataFrame, col: str, bins: int = 30, group_cols=("model",)) -> DataFrame:
    """k equal-width bins over [min, max] per group (last bin closed), density = count / (n * width).

    Every bin is returned, empty ones with count 0 (bins generated with
    ``sequence`` from the per-group range, then left-joined to counts).
    A constant group uses the range [v - 0.5, v + 0.5].
    """
    g = list(group_cols)
    x = F.col(col)
    rng = df.where(x.isNotNull()).groupBy(*g).agg(F.min(x).alias("__mn"), F.max(x).alias("__mx"),
                                                 F.count(x).alias("__n"))
    rng = rng.select(*g, "__n",
                     F.when(F.col("__mx") > F.col("__mn"), F.col("__mn")).otherwise(F.col("__mn") - 0.5).alias("__lo"),
                     F.when(F.col("__mx") > F.col("__mn"), F.col("__mx")).otherwise(F.col("__mx") + 0.5).alias("__hi"))
    b = F.floor((x - F.col("__lo")) * bins / (F.col("__hi") - F.col("__lo"))).cast("int") + 1
    # one row per group, and groups are the caller's: no broadcast hint - AQE
    # broadcasts it from the measured size, or keeps a shuffle join past the limit
    counted = (null_safe(df.where(x.isNotNull()).select(*g, x), rng, g)
                 .groupBy(*g, F.least(b, F.lit(bins)).alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    all_bins = rng.select(*g, "__n", "__lo", "__hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    out = null_safe(all_bins, counted, g + ["bin"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
    return out.select(*g, "bin", (F.col("__lo") + (F.col("bin") - 1) * width).alias("bin_start"),
                      (F.col("__lo") + F.col("bin") * width).alias("bin_end"), "count",
                      (F.col("count") / (F.col("__n") * width)).alias("density"))


def box_statistics(df: DataFrame, col: str, group_cols=("model",), k: float = IQR_MULTIPLIER) -> DataFrame:
    """Quartiles, whiskers at the last points within k*IQR, and the number of fliers."""
    g = list(group_cols)
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], g)
    q = q.select(*g, F.col("q_0").alias("q1"), F.col("q_1").alias("median"), F.col("q_2").alias("q3"))
    x = F.col(col)
    lo = F.col("q1") - k * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + k * (F.col("q3") - F.col("q1"))
    j = null_safe(df.where(x.isNotNull()).select(*g, x), q, g)  # AQE sizes the per-group side
    inside = (x >= lo) & (x <= hi)
    return j.groupBy(*g, "q1", "median", "q3").agg(
        F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("n_fliers"))


def scale_location(preds: DataFrame) -> DataFrame:
    """sqrt(|residual / sample std of the model's residuals|) per row."""
    r = residuals(preds)
    sd = r.groupBy("model").agg(F.stddev_samp("residual").alias("__sd"))
    return (r.join(F.broadcast(sd), "model")
             .withColumn("scale_location", F.sqrt(F.abs(F.try_divide(F.col("residual"), F.col("__sd")))))
             .drop("__sd"))


# --- fixed values: Wichura's algorithm AS 241 (PPND16), rational approximations of the
# inverse normal CDF, numerator and denominator from the constant term upwards
PPF_CENTRE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3))
PPF_MIDDLE = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
     1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9))
PPF_TAIL = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15))
# -----------------------------------------------------------------------------


def _ratio(x: Column, coefficients) -> Column:
    parts = []
    for c in coefficients:
        value = F.lit(c[-1])
        for k in reversed(c[:-1]):
            value = value * x + F.lit(k)
        parts.append(value)
    return parts[0] / parts[1]


def normal_ppf(p: Column) -> Column:
    """Inverse standard-normal CDF as built-in expressions (null outside (0, 1))."""
    q = p - 0.5
    r = F.sqrt(-F.ln(F.least(p, 1 - p)))
    tail = F.when(r <= 5, _ratio(r - 1.6, PPF_MIDDLE)).otherwise(_ratio(r - 5, PPF_TAIL))
    value = F.when(F.abs(q) <= 0.425, q * _ratio(0.180625 - q * q, PPF_CENTRE)).otherwise(F.signum(q) * tail)
    return F.when((p > 0) & (p < 1), value)


def qq_points(preds: DataFrame, parts: int = 64) -> DataFrame:
    """Sorted residuals against normal quantiles ppf(i / (n + 1)), plus the least-squares line.

    Ranks come from ``row_index`` over ranges cut at sampled residuals, so each
    model's residuals are never sorted in one task.  Null residuals have no rank.
    """
    r = residuals(preds).select("model", "residual").where(F.col("residual").isNotNull())
    r = r.withColumn("__bk", cut_bucket("residual", range_cuts(r, "residual", parts)))
    n = r.groupBy("model").agg(F.count(F.lit(1)).alias("__n"))
    idx = null_safe(row_index(r, ["residual"], ["model"], bucket_expr=F.col("__bk")), n, ["model"])
    pts = idx.withColumn("theoretical", normal_ppf((F.col(POS) + 1) / (F.col("__n") + 1)))
    line = pts.groupBy("model").agg(F.regr_slope("residual", "theoretical").alias("slope"),
                                    F.regr_intercept("residual", "theoretical").alias("intercept"))
    return (null_safe(pts, line, ["model"])
            .select("model", F.col(POS).alias("rank"), "theoretical", "residual", "slope", "intercept"))


def thinned_series(preds: DataFrame, order_cols=("date", "store_id"), points: int = THIN_POINTS) -> DataFrame:
    """At most ``points`` evenly spaced rows per model, for time-series panels."""
    return thin_evenly(preds, list(order_cols), points, ["model"])


def top_features(importances: DataFrame, n: int = TOP_FEATURES_PER_MODEL) -> DataFrame:
    """n most important features per model (ties by feature name)."""
    w = Window.partitionBy("model").orderBy(F.desc("importance"), F.asc("feature"))
    return importances.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def feature_consistency(importances: DataFrame, n: int = TOP_FEATURES_PER_MODEL) -> DataFrame:
    """Features in the top n of more than one model, with the number of models."""
    return (top_features(importances, n).groupBy("feature").agg(F.count(F.lit(1)).alias("n_models"))
            .where(F.col("n_models") > 1))


def importance_matrix(importances: DataFrame, n: int = TOP_FEATURES_PER_MODEL, eps: float = 1e-8) -> DataFrame:
    """Union of top-n features x models, importance divided by the feature's max over models (+eps).

    Long form (feature, model, normalized); a model without the feature gets 0.
    """
    feats = top_features(importances, n).select("feature").distinct()
    # every (feature, model) pair: the model list is a scalar array, one entry per model
    models = importances.select(F.sort_array(F.collect_set("model"))).scalar()
    full = feats.select("feature", F.explode(models).alias("model"))
    vals = full.join(importances.select("feature", "model", "importance"), ["feature", "model"], "left") \
               .withColumn("importance", F.coalesce("importance", F.lit(0.0)))
    mx = F.max("importance").over(Window.partitionBy("feature"))
    return vals.select("feature", "model", (F.col("importance") / (mx + eps)).alias("normalized"))


def performance_report(preds: DataFrame) -> DataFrame:
    """One row per model: test rows, first and last date, error metrics, average rank."""
    test = preds.where(F.col("split") == "test")
    m = metrics.model_metrics(test, by=("model",))
    rank = metrics.average_rank(metrics.to_long(m))
    span = test.groupBy("model").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    return m.join(rank, "model").join(span, "model")


def comparison_bundle(preds: DataFrame, importance: DataFrame | None = None, window: int = STABILITY_WINDOW,
                      keys=("store_id",)) -> dict[str, DataFrame]:
    """The data of a model comparison, frame by frame, on test predictions.

    Stability comes only if the test set has more than 2 * ``window`` rows (one count).
    """
    test = preds.where(F.col("split") == "test")
    res = residuals(test)
    long = metrics.to_long(metrics.model_metrics(test, by=("model",)))
    out = {"metrics": long, "best": metrics.best_per_metric(long), "ranks": metrics.average_rank(long),
           "scores": metrics.normalized_scores(long), "histogram": density_histogram(res, "residual"),
           "box": box_statistics(res, "residual"), "scale_location": scale_location(test), "qq": qq_points(test),
           "series": thinned_series(test)}
    if test.count() > 2 * window:
        rolling = metrics.rolling_metrics(test, keys, "date", window)
        out |= {"rolling": rolling, "stability": metrics.stability_scores(rolling)}
    if importance is not None:
        out |= {"top_features": top_features(importance), "consistency": feature_consistency(importance),
                "importance_matrix": importance_matrix(importance)}
    return out

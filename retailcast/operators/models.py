"""Model fitting on Spark ML: boosted trees, a random forest, the weighted ensemble,
importances, importance-based selection, prediction intervals and recursive forecasts.

Training data are the store-day feature rows; fitting runs on executors
(Spark ML tree learners aggregate split statistics per partition).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retailcast.config import (CONFIDENCE_LEVELS, FEATURE_IMPORTANCE_THRESHOLD, FOREST_PARAMS, GBT_PARAMS,
                               PREDICTION_HORIZON)
from retailcast.operators import encode, evaluation, metrics
from retailcast.operators.features import apply_windows, materialize, numeric_columns
from retailcast.operators.ordering import null_safe
from retailcast.operators.quantiles import exact_quantiles
from retailcast.operators.tree_expression import TreeEnsemble

FEATURES = "features"
# Memory for split statistics per task.  It only decides how many tree nodes are
# grouped into one pass over the data, never which splits are chosen; 64 MB keeps
# eight concurrent tasks inside a small driver heap in local mode.
TREE_MEMORY_MB = 64


@dataclass
class Preprocessor:
    """Label codes and scaling statistics fitted on training rows, as tables that can be written and read.

    ``codes``: (column, value, code), ``stats``: (column, mean, std), one row per class or column.
    """

    codes: DataFrame
    stats: DataFrame
    names: list[str]
    categorical: tuple[str, ...]

    @classmethod
    def fit(cls, train: DataFrame, target: str, exclude=("date", "split", "row_index"), categorical=("store_id",)) -> Preprocessor:
        tables = [encode.fit_label_codes(train, c).select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"),
                                                          F.col(f"{c}_code").alias("code")) for c in categorical]
        codes = materialize(reduce(DataFrame.unionByName, tables)) if tables else \
            train.sparkSession.createDataFrame([], "column string, value string, code int")
        coded = cls(codes, None, [], tuple(categorical))._coded(train)
        names = [c for c in numeric_columns(coded) if c != target and c not in exclude]
        wide = coded.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in names])
        stats = wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), f"{c}.mean", f"{c}.std") for c in names])).alias("s"))
        return cls(codes, materialize(stats.select("s.*")), names, tuple(categorical))

    def _coded(self, df: DataFrame) -> DataFrame:
        for c in self.categorical:
            own = self.codes.where(F.col("column") == c).select(F.col("value").alias("__v"), F.col("code").alias(f"{c}_enc"))
            df = df.join(own, F.col(c).cast("string") == F.col("__v"), "left").drop("__v")
            df = df.withColumn(f"{c}_enc", F.coalesce(f"{c}_enc", F.lit(-1)))  # unseen when fitted
        return df

    def apply(self, df: DataFrame) -> DataFrame:
        """Add the vector column of coded and scaled features; null features stay NaN in it."""
        stats = {r["column"]: (r["mean"], r["std"] or 1.0) for r in self.stats.collect()}  # one row per feature
        scaled = {c: (F.col(c).cast("double") - stats[c][0]) / stats[c][1] for c in self.names if stats[c][0] is not None}
        return VectorAssembler(inputCols=self.names, outputCol=FEATURES, handleInvalid="keep").transform(self._coded(df).withColumns(scaled))

    def save(self, root: str) -> None:
        self.codes.write.mode("overwrite").parquet(f"{root}/codes")
        self.stats.write.mode("overwrite").parquet(f"{root}/stats")
        spark = self.codes.sparkSession
        rows = [("feature", i, n) for i, n in enumerate(self.names)] + [("categorical", i, n) for i, n in enumerate(self.categorical)]
        spark.createDataFrame(rows, "kind string, place int, name string").write.mode("overwrite").parquet(f"{root}/columns")

    @classmethod
    def load(cls, spark: SparkSession, root: str) -> Preprocessor:
        columns = spark.read.parquet(f"{root}/columns").orderBy("place").collect()
        kind = lambda k: [r["name"] for r in columns if r["kind"] == k]
        return cls(spark.read.parquet(f"{root}/codes"), spark.read.parquet(f"{root}/stats"), kind("feature"), tuple(kind("categorical")))


def prepare_matrix(df: DataFrame, target: str, exclude=("date", "split", "row_index"),
                   categorical=("store_id",)) -> tuple[DataFrame, list[str]]:
    """Label-encode categoricals (fitted on train), scale numerics (train mean / population std),
    assemble a vector column.  Returns (frame with ``features``, feature names)."""
    p = Preprocessor.fit(df.where(F.col("split") == "train"), target, exclude, categorical)
    return p.apply(df), p.names


def fit_boosted(train_val: DataFrame, target: str, params: dict | None = None):
    """Gradient-boosted trees; the validation rows (``is_val``) drive early stopping."""
    p = {**GBT_PARAMS, **(params or {})}
    gbt = GBTRegressor(featuresCol=FEATURES, labelCol=target, validationIndicatorCol="is_val",
                       maxMemoryInMB=TREE_MEMORY_MB, **p)
    return gbt.fit(train_val)


def fit_forest(train: DataFrame, target: str, params: dict | None = None):
    p = {"numTrees": 100, "maxDepth": 5, "seed": 42, **(params or {})}
    return RandomForestRegressor(featuresCol=FEATURES, labelCol=target, maxMemoryInMB=TREE_MEMORY_MB,
                                 **p).fit(train)


def predict_long(model, df: DataFrame, name: str, target: str, keys=("date", "store_id", "split")) -> DataFrame:
    return model.transform(df).select(F.lit(name).alias("model"), *keys, F.col(target).alias("actual"),
                                      F.col("prediction"))


def importances(spark: SparkSession, model, feature_names: list[str], name: str) -> DataFrame:
    """(model, feature, importance), importance descending; one value per feature."""
    vals = model.featureImportances.toArray().tolist()
    schema = "model string, feature string, importance double"
    return spark.createDataFrame([(name, f, float(v)) for f, v in zip(feature_names, vals)], schema)


def train_all(feature_split: DataFrame, target: str = "sales", gbt_params: dict | None = None,
              forest_params: dict | None = None) -> dict:
    """Fit both learners, weight them by validation R^2, evaluate everything.

    Returns DataFrames: predictions (long), metrics (model x split), weights,
    importances.  The prepared matrix is checkpointed once because fitting and
    every prediction read it.
    """
    spark = feature_split.sparkSession
    # checkpoint first: the encoders' statistics are scalar subqueries over this frame,
    # and they must reference a short plan, not the whole feature build
    rows = materialize(feature_split)
    prepared = Preprocessor.fit(rows.where(F.col("split") == "train"), target)
    mat, names = prepared.apply(rows), prepared.names
    # keep only what fitting and prediction read: keys, label, split and the vector
    mat = materialize(mat.select("date", "store_id", "split", target, FEATURES,
                                 (F.col("split") == "validation").alias("is_val")))
    train = mat.where(F.col("split") == "train")
    gbt = fit_boosted(mat.where(F.col("split") != "test"), target, gbt_params)
    forest = fit_forest(train, target, forest_params)
    preds = predict_long(gbt, mat, "boosted_trees", target).unionByName(
        predict_long(forest, mat, "random_forest", target))
    val = metrics.model_metrics(preds.where(F.col("split") == "validation"), by=("model",))
    weights = evaluation.ensemble_weights(val.select("model", "r2"))
    ens = evaluation.ensemble_predictions(preds, weights, ["date", "store_id", "split"])
    all_preds = preds.unionByName(ens)
    imps = importances(spark, gbt, names, "boosted_trees").unionByName(
        importances(spark, forest, names, "random_forest"))
    return {"predictions": all_preds, "metrics": metrics.model_metrics(all_preds), "weights": weights,
            "importances": imps, "models": {"boosted_trees": gbt, "random_forest": forest},
            "feature_names": names, "preprocessor": prepared}


_LEARNERS = {"boosted_trees": GBTRegressionModel, "random_forest": RandomForestRegressionModel}


def save_bundle(result: dict, root: str) -> None:
    """Write what ``train_all`` returned: models, preprocessor, ensemble weights and importances."""
    for name, model in result["models"].items():
        model.write().overwrite().save(f"{root}/models/{name}")
    result["preprocessor"].save(f"{root}/preprocessor")
    result["weights"].write.mode("overwrite").parquet(f"{root}/weights")
    result["importances"].write.mode("overwrite").parquet(f"{root}/importances")


def load_bundle(spark: SparkSession, root: str) -> dict:
    """Read back what ``save_bundle`` wrote."""
    return {"models": {name: kind.load(f"{root}/models/{name}") for name, kind in _LEARNERS.items()},
            "preprocessor": Preprocessor.load(spark, f"{root}/preprocessor"),
            "weights": spark.read.parquet(f"{root}/weights"), "importances": spark.read.parquet(f"{root}/importances")}


def predict_bundle(bundle: dict, df: DataFrame, target: str, keys=("date", "store_id", "split")) -> DataFrame:
    """Predictions of every model of a bundle and of the weighted ensemble, long form."""
    mat = bundle["preprocessor"].apply(df)
    parts = [predict_long(m, mat, name, target, keys) for name, m in bundle["models"].items()]
    preds = reduce(DataFrame.unionByName, parts)
    return preds.unionByName(evaluation.ensemble_predictions(preds, bundle["weights"], list(keys)))


def select_features(feature_split: DataFrame, target: str = "sales",
                    threshold: float = FEATURE_IMPORTANCE_THRESHOLD) -> DataFrame:
    """Features whose random-forest importance (50 trees, seed 42) exceeds ``threshold``."""
    mat, names = prepare_matrix(materialize(feature_split), target)
    rf = fit_forest(mat.where(F.col("split") == "train"), target, {**FOREST_PARAMS, "maxDepth": 5})
    imp = importances(feature_split.sparkSession, rf, names, "random_forest")
    return imp.where(F.col("importance") > threshold).orderBy(F.desc("importance"))


def prediction_intervals(preds: DataFrame, levels=CONFIDENCE_LEVELS, keys=("store_id",)) -> DataFrame:
    """Residual quantiles per (model, keys) on validation rows, added to test predictions.

    For level c the bounds are prediction + q((1-c)/2) and prediction + q((1+c)/2).
    """
    probs = []
    for c in levels:
        probs += [(1 - c) / 2, (1 + c) / 2]
    val = preds.where(F.col("split") == "validation").withColumn("__r", F.col("actual") - F.col("prediction"))
    q = exact_quantiles(val, "__r", probs, ["model", *keys])
    test = null_safe(preds.where(F.col("split") == "test"), q, ["model", *keys], "left")
    cols = {}
    for i, c in enumerate(levels):
        tag = str(int(round(c * 100)))
        cols[f"lower_{tag}"] = F.col("prediction") + F.col(f"q_{2 * i}")
        cols[f"upper_{tag}"] = F.col("prediction") + F.col(f"q_{2 * i + 1}")
    return test.withColumns(cols).drop(*[f"q_{i}" for i in range(len(probs))])


def with_bounds(preds: DataFrame, bounds: DataFrame, keys=("date",), lower: str = "lower", upper: str = "upper") -> DataFrame:
    """Predictions with ``prediction_lower`` and ``prediction_upper`` from a table of given bounds.

    Keys without bounds keep their rows, with nulls; nulls in keys match each other.  Keys with several bounds take the
    widest, so no prediction is doubled.
    """
    widest = bounds.groupBy(*keys).agg(F.min(lower).alias("prediction_lower"), F.max(upper).alias("prediction_upper"))
    return null_safe(preds, widest, list(keys), "left")


def _tail(history: DataFrame, target: str, group_col: str, date_col: str, rows: int) -> DataFrame:
    """(group, last date, its last ``rows`` known values, oldest first): one row per group.

    Spark limits each group before the shuffle, so a hot group sends ``rows`` values from each task.  A group
    without a known value has an empty tail.
    """
    w = Window.partitionBy(group_col).orderBy(F.col(date_col).desc_nulls_last(), F.desc("__v"))
    value = history.select(group_col, date_col, F.col(target).cast("double").alias("__v"))
    last = value.where("__v is not null").withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= rows)
    tails = last.groupBy(group_col).agg(F.transform(F.array_sort(F.collect_list(F.struct(-F.col("__rn"), "__v"))),
                                                    lambda x: x["__v"]).alias("__tail"))
    ends = value.groupBy(group_col).agg(F.max(date_col).alias(date_col))
    return null_safe(ends, tails, [group_col], "left").withColumn("__tail", F.coalesce("__tail", F.array().cast("array<double>")))


def trailing_mean_forecast(history: DataFrame, target: str = "sales", group_col: str = "store_id",
                           date_col: str = "date", horizon: int = PREDICTION_HORIZON, window: int = 7) -> DataFrame:
    """Forecast ``horizon`` days ahead per group: the mean of the last ``window`` values, each forecast
    fed back as history.  (group, date, step, prediction).

    A group's tail is an array of ``window`` values at most, and the steps fold over it in one expression.
    """
    mean = lambda a: F.try_divide(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), F.size(a))
    start = F.struct(F.col("__tail").alias("tail"), F.array().cast("array<double>").alias("out"))

    def step(s, _):
        m = mean(s["tail"])
        grown = F.concat(s["tail"], F.array(m))
        return F.struct(F.when(F.size(grown) > window, F.slice(grown, 2, window)).otherwise(grown).alias("tail"),
                        F.concat(s["out"], F.array(m)).alias("out"))

    fold = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step, lambda s: s["out"])
    rows = _tail(history, target, group_col, date_col, window).select(group_col, date_col, F.posexplode(fold).alias("__i", "prediction"))
    return rows.select(group_col, F.date_add(date_col, F.col("__i") + 1).alias(date_col), (F.col("__i") + 1).alias("step"), "prediction")


LAG_FEATURES = ("lag_1", "lag_2", "lag_3", "lag_7", "mean_3", "mean_7", "day_of_week", "month")
DEEPEST_LAG = 7


def lag_vector(tail: F.Column, date: F.Column) -> F.Column:
    """LAG_FEATURES as an array, from the values before ``date`` (oldest first).  A lag beyond the tail is NaN, a
    mean is that of the values there are (none: NaN)."""
    nan = F.lit(float("nan"))
    at = lambda k: F.coalesce(F.get(tail, F.size(tail) - k), nan)

    def mean(k):
        last = F.slice(tail, F.greatest(F.size(tail) - (k - 1), F.lit(1)), F.lit(k))
        return F.coalesce(F.try_divide(F.aggregate(last, F.lit(0.0), lambda s, x: s + x), F.size(last)), nan)

    return F.array(at(1), at(2), at(3), at(7), mean(3), mean(7), F.weekday(date).cast("double"), F.month(date).cast("double"))


def lag_training_rows(history: DataFrame, target: str, group_col: str, date_col: str) -> DataFrame:
    """(features, label) of the known values with the deepest history there is: 7 values before them, or fewer if
    no series is that long, filled up with the oldest.  Series are cut into chunks, so a hot one is split."""
    known = materialize(history.select(group_col, date_col, F.col(target).cast("double").alias("label")).where("label is not null"))
    lags = {f"__l{k}": (lambda w, k=k: F.lag("label", k).over(w)) for k in range(DEEPEST_LAG, 0, -1)}
    past = apply_windows(known, lags, [group_col], date_col, history=DEEPEST_LAG)
    past = materialize(past.select(date_col, "label", F.filter(F.array(*lags), lambda x: x.isNotNull()).alias("__past")))
    deepest = past.agg(F.max(F.size("__past"))).first()[0]
    if deepest is None:
        return past.select(array_to_vector(F.array().cast("array<double>")).alias(FEATURES), "label")
    past = past.where(F.size("__past") == deepest)
    oldest = F.coalesce(F.get("__past", F.lit(0)), F.col("label"))
    full = F.concat(F.array_repeat(oldest, DEEPEST_LAG - deepest), "__past")
    return past.select(array_to_vector(lag_vector(full, F.col(date_col))).alias(FEATURES), "label")


def fold_forecast(history: DataFrame, model, target: str = "sales", group_col: str = "store_id", date_col: str = "date",
                  horizon: int = PREDICTION_HORIZON) -> DataFrame:
    """(group, date, step, prediction) of a model fitted on LAG_FEATURES, ``horizon`` days ahead of each group.

    The model's trees become one expression, and the steps fold over a group's tail of at most 7 values: one
    row per group, no plan and no job per step.  Every group with a row gets all steps.
    """
    trees = TreeEnsemble.of(model)
    start = F.struct(F.col("__tail").alias("tail"), F.array().cast("array<double>").alias("out"))

    def step(s, i):
        p = trees.predict(lag_vector(s["tail"], F.date_add(date_col, i)))
        # bound by a fold over one element: the prediction is used twice and made once
        def grow(state, y):
            grown = F.concat(state["tail"], F.array(y))
            return F.struct(F.slice(grown, F.greatest(F.size(grown) - (DEEPEST_LAG - 1), F.lit(1)), F.lit(DEEPEST_LAG)).alias("tail"),
                            F.concat(state["out"], F.array(y)).alias("out"))
        return F.aggregate(F.array(p), s, grow)

    fold = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step, lambda s: s["out"])
    rows = _tail(history, target, group_col, date_col, DEEPEST_LAG).select(group_col, date_col, F.posexplode(fold).alias("__i", "prediction"))
    return rows.select(group_col, F.date_add(date_col, F.col("__i") + 1).alias(date_col), (F.col("__i") + 1).alias("step"), "prediction")


def recursive_forecast(history: DataFrame, target: str = "sales", group_col: str = "store_id",
                       date_col: str = "date", horizon: int = PREDICTION_HORIZON, params: dict | None = None) -> DataFrame:
    """Forecast ``horizon`` days ahead per group with a random forest fitted on lag features of ``history``,
    each prediction fed back as the next step's history.  (group, date, step, prediction).

    Every group with at least one row is forecast; lags beyond its history are NaN, which goes right at
    every split.  Rows without a value are no history.  A table without any value gives no row.  Trees of a
    table of less than 100 training rows see all of them: a bag that draws none would predict 0.
    """
    train = materialize(lag_training_rows(history, target, group_col, date_col))
    few = train.limit(100).count()
    if not few:
        none = history.select(group_col, F.col(date_col), F.lit(0).alias("step"), F.lit(0.0).alias("prediction"))
        return none.limit(0)
    model = fit_forest(train, "label", {**FOREST_PARAMS, "bootstrap": few == 100, **(params or {})})
    return fold_forecast(history, model, target, group_col, date_col, horizon)

"""Forecasts folded over a tree expression, and cross validation over stored blocks."""

import datetime as dt
import math

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from retailcast.operators import crossval, diagnostics, evaluation, models, rollups
from retailcast.operators.features import materialize
from retailcast.operators.tree_expression import TreeEnsemble
from tests.conftest import SF_SMALL

NAN = float("nan")
DAY = dt.date(2024, 1, 1)


def series(name, values, start=DAY):
    return [(name, start + dt.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "store_id string, date date, sales double")


@pytest.mark.parametrize("learner", [lambda: RandomForestRegressor(numTrees=7, maxDepth=4, seed=3),
                                     lambda: RandomForestRegressor(numTrees=2, maxDepth=0, seed=3), lambda: GBTRegressor(maxIter=6, maxDepth=3, seed=3)])
def test_tree_expression_equals_the_model(spark, learner):
    df = spark.range(400).select((F.col("id") % 17).cast("double").alias("a"), F.sin("id").alias("b"), (F.col("id") % 5).cast("double").alias("c"))
    df = df.withColumn("label", F.col("a") * F.col("c") + F.col("b"))
    x = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    model = learner().fit(x)
    odd = [(NAN, 0.0, 1.0), (1.0, NAN, NAN), (NAN, NAN, NAN), (-1e300, 1e300, 0.5), (3.0, 0.25, 2.0)]
    probe = df.select("a", "b", "c").union(spark.createDataFrame(odd, "a double, b double, c double"))
    xs = F.array("a", "b", "c")
    both = model.transform(probe.withColumn("features", array_to_vector(xs))).withColumn("own", TreeEnsemble.of(model).predict(xs)).collect()
    assert len(both) == 405 and all(r["own"] == pytest.approx(r["prediction"], rel=1e-12, abs=1e-12) for r in both)


def stepwise(spark, model, tails, horizon):
    """Forecast with model.transform, one step after the other."""
    out = {}
    for name, (last, tail) in tails.items():
        tail = list(tail)
        for k in range(1, horizon + 1):
            day = last + dt.timedelta(days=k)
            at = lambda j: tail[-j] if len(tail) >= j else NAN
            mean = lambda j: sum(tail[-j:]) / len(tail[-j:]) if tail else NAN
            x = [at(1), at(2), at(3), at(7), mean(3), mean(7), float(day.weekday()), float(day.month)]
            row = spark.createDataFrame([(x,)], "x array<double>").select(array_to_vector("x").alias("features"))
            out[name, k] = (day, model.transform(row).first()["prediction"])
            tail = (tail + [out[name, k][1]])[-7:]
    return out


def test_fold_forecast_equals_steps_of_transform(spark):
    rows = series("long", [10 + (i * 7) % 5 + i % 3 for i in range(60)]) + series("six", [5, 6, 7, 6, 5, 9]) + series("one", [4.0])
    rows += series("gap", [1, 2, None, 4, 5, 6, 7, 8, None]) + series("none", [None, None]) + series(None, [3, 4, 3, 4, 3, 4, 3, 4, 3, 4])
    df = frame(spark, rows)
    model = models.fit_forest(materialize(models.lag_training_rows(df, "sales", "store_id", "date")), "label", {"numTrees": 5, "seed": 1})
    got = {(r["store_id"], r["step"]): (r["date"], r["prediction"]) for r in models.fold_forecast(df, model, horizon=9).collect()}
    tails = {}
    for name in ("long", "six", "one", "gap", "none", None):
        own = [(d, v) for s, d, v in rows if s == name]
        tails[name] = (own[-1][0], [v for _, v in own if v is not None][-7:])
    want = stepwise(spark, model, tails, 9)
    assert got.keys() == want.keys()
    for key, (day, value) in want.items():
        assert got[key][0] == day and got[key][1] == pytest.approx(value, rel=1e-12), key


def test_every_series_with_a_row_is_forecast(spark):
    df = frame(spark, series("a", range(40)) + series("b", range(6)) + series("c", [2.0]))
    fc = models.recursive_forecast(df).toPandas()
    assert fc.groupby("store_id").size().to_dict() == {"a": 30, "b": 30, "c": 30} and fc.prediction.notna().all()
    # only short series: the trees learn from the deepest history there is
    short = models.recursive_forecast(frame(spark, series("b", [5, 6, 7]) + series("c", [2.0])), horizon=4).toPandas()
    assert short.groupby("store_id").size().to_dict() == {"b": 4, "c": 4}
    single = models.recursive_forecast(frame(spark, series("c", [2.0])), horizon=4).toPandas()
    assert single.prediction.tolist() == [2.0] * 4
    assert models.recursive_forecast(frame(spark, [])).count() == 0
    assert models.recursive_forecast(frame(spark, series("a", [None, None]))).count() == 0


def test_training_rows(spark):
    rows = series("a", [None, *range(1, 12)]) + series("b", [9, 8])
    got = models.lag_training_rows(frame(spark, rows), "sales", "store_id", "date").collect()
    assert sorted(r["label"] for r in got) == [8.0, 9.0, 10.0, 11.0]  # complete histories only, nulls are none
    first = next(r["features"].toArray().tolist() for r in got if r["label"] == 8.0)
    assert first[:6] == [7, 6, 5, 1, 6, 4]


def test_forecast_plan_is_small(spark):
    sd = rollups.store_days(spark, SF_SMALL, checkpoint=True).select("date", "store_id", "sales")
    fc = models.recursive_forecast(sd)
    plan = fc._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange") < 10 and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert fc.count() == 30 * sd.select("store_id").distinct().count()


# ------------------------------------------------------------ null groups --
def test_null_groups_keep_outliers_and_bounds(spark):
    rows = [(g, float(v)) for g in (None, "a") for v in [1, 2, 3, 4, 100]] + [("empty", None)]
    got = {r["g"]: r for r in diagnostics.outlier_summary(spark.createDataFrame(rows, "g string, x double"), "x", ["g"]).collect()}
    assert set(got) == {None, "a", "empty"} and got[None]["max_outlier"] == got["a"]["max_outlier"] == 100.0
    assert got["empty"]["count"] == 0 and got["empty"]["percentage"] is None
    preds = [("m", s, split, 10.0 + k, 10.0) for s in (None, "a") for split in ("validation", "test") for k in range(5)]
    iv = models.prediction_intervals(spark.createDataFrame(preds, "model string, store_id string, split string, actual double, prediction double"))
    assert iv.count() == 10 and iv.where("lower_80 is null or upper_95 is null").count() == 0


# ------------------------------------------------------------------ folds --
def test_blocks_by_hand(spark):
    df = frame(spark, series("a", range(13)) + series("b", range(10)))
    out = crossval.fold_frame(df, ["date", "store_id"], 5)
    ordered = sorted(out.collect(), key=lambda r: (r["date"], r["store_id"]))
    assert [r["block"] for r in ordered] == [0] * 8 + [b for b in range(1, 6) for _ in range(3)]
    bounds = {r["fold"]: (r["train_rows"], r["test_rows"]) for r in crossval.fold_bounds(out).collect()}
    assert bounds == {f: (8 + 3 * f, 3) for f in range(5)}
    few = crossval.fold_frame(frame(spark, series("a", range(4))), ["date"], 5)
    assert [r["block"] for r in few.collect()] == [0] * 4 and crossval.fold_scores(crossval.baseline_folds(few)).count() == 0
    assert crossval.fold_frame(frame(spark, []), ["date"], 5).count() == 0


def test_blocks_are_the_exploded_folds(spark):
    from retailcast.operators import split

    sd = rollups.store_days(spark, SF_SMALL, checkpoint=True).select("date", "store_id", "sales")
    out = crossval.fold_frame(sd, ["date", "store_id"], 5)
    old = {(r["date"], r["store_id"], r["fold"]): r["role"] for r in split.expanding_folds(sd, ["date", "store_id"], 5).collect()}
    new = {(r["date"], r["store_id"], f): "train" if r["block"] <= f else "test"
           for r in out.collect() for f in range(5) if r["block"] <= f + 1}
    assert old == new
    # a fold reads only its folders
    plan = out.where(F.col("block") <= 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block" in plan and "(block" in plan


def test_ensemble_weights_come_from_the_training_rows(spark):
    sd = rollups.store_days(spark, SF_SMALL, checkpoint=True).select("date", "store_id", "sales")
    preds = materialize(evaluation.baseline_predictions(crossval.fold_frame(sd, ["date", "store_id"], 5), keep=("block",)))
    pdf = preds.toPandas()
    for r in crossval.train_r2(preds, 5).collect():
        own = pdf[(pdf.model == r["model"]) & (pdf.block <= r["fold"])]
        r2 = 1 - ((own.actual - own.prediction) ** 2).sum() / ((own.actual - own.actual.mean()) ** 2).sum()
        assert r["r2"] == pytest.approx(r2, rel=1e-9)
    all_ = crossval.baseline_folds(crossval.fold_frame(sd, ["date", "store_id"], 5))
    assert all_.where("model = 'ensemble'").count() == pdf[pdf.block > 0][["date", "store_id"]].drop_duplicates().shape[0]


def test_models_are_fitted_per_fold(spark):
    rows = [(f"s{k}", DAY + dt.timedelta(days=i), float(i), float(i * 2 + k)) for k in range(3) for i in range(40)]
    df = spark.createDataFrame(rows, "store_id string, date date, x double, sales double")
    out = crossval.fold_frame(df, ["date", "store_id"], 3)
    seen = []

    def learner(train):
        seen.append(train.count())
        return models.fit_forest(train, "sales", {"numTrees": 3})

    preds = crossval.learned_folds(out, learners={"forest": learner}, folds=3)
    assert seen == [30, 60, 90] and preds.groupBy("fold").count().orderBy("fold").collect() == [(0, 30), (1, 30), (2, 30)]
    scores = crossval.fold_scores(preds)
    assert scores.count() == 12 and {r["folds"] for r in crossval.score_summary(scores).collect()} == {3}
    # later days are unknown when a fold is fitted: a forest can't reach beyond what it has seen
    worst = preds.groupBy("fold").agg(F.max("prediction").alias("p"), F.min("actual").alias("a")).collect()
    assert all(r["p"] <= r["a"] + 3 for r in worst)
    assert crossval.learned_folds(crossval.fold_frame(df.limit(0), ["date"], 3), folds=3).count() == 0
    assert not any(math.isnan(r["value"]) for r in scores.collect())

"""Golden values taken from the original workflow's own sample inputs."""

import pytest
from pyspark.sql import functions as F

from retailcast.operators import encode, evaluation, metrics, validate
from retailcast.operators.drift import ks_statistic
from retailcast.sources.files import json_key_values, map_value_sum

SAMPLE = {"xgboost": (22.432, 12.025, 10.613, 0.936),
          "lightgbm": (24.992, 13.918, 12.437, 0.921),
          "ensemble": (23.380, 12.414, 11.154, 0.930)}


@pytest.fixture()
def long(spark):
    rows = [(m, k, v) for m, vals in SAMPLE.items() for k, v in zip(("rmse", "mae", "mape", "r2"), vals)]
    return spark.createDataFrame(rows, "model string, metric string, value double")


def test_average_rank(long):
    got = {r.model: r.average_rank for r in metrics.average_rank(long).collect()}
    assert got == {"xgboost": 1.0, "ensemble": 2.0, "lightgbm": 3.0}


def test_average_rank_missing_metric_ranks_last(spark):
    rows = [("a", "rmse", 1.0), ("a", "mae", 1.0), ("a", "mape", 1.0),
            ("b", "rmse", 2.0), ("b", "mae", 2.0), ("b", "mape", 2.0), ("b", "r2", 0.1)]
    got = {r.model: r.average_rank for r in metrics.average_rank(spark.createDataFrame(
        rows, "model string, metric string, value double")).collect()}
    assert got == {"a": 1.25, "b": 1.75}  # a: 1+1+1+2 (missing r2 ranks last), b: 2+2+2+1


def test_normalized_scores(long):
    got = {(r.model, r.metric): round(r.score, 4) for r in metrics.normalized_scores(long).collect()}
    for k in ("rmse", "mae", "mape", "r2"):
        assert got[("xgboost", k)] == 1.0
        assert got[("lightgbm", k)] == 0.1
    assert [got[("ensemble", k)] for k in ("rmse", "mae", "mape", "r2")] == [0.6667, 0.8151, 0.7331, 0.64]


def test_normalized_all_equal(spark):
    rows = [(m, k, 1.0) for m in ("a", "b") for k in ("rmse", "mae", "mape", "r2")]
    got = metrics.normalized_scores(spark.createDataFrame(rows, "model string, metric string, value double"))
    assert {r.score for r in got.collect()} == {0.55}


def test_best_per_metric(long):
    got = {r.metric: r.best_model for r in metrics.best_per_metric(long).collect()}
    assert got == {"rmse": "xgboost", "mae": "xgboost", "mape": "xgboost", "r2": "xgboost"}


def test_target_encoding_toy(spark):
    df = spark.createDataFrame([(1, "Alice", 1), (2, "Bob", 0), (3, "Charlie", 1), (4, "Bob", 1)],
                               "id int, name string, target int")
    enc, glob = encode.fit_target_encoding(df, "name", "target", 1.0)
    got = {r.name: round(r.name_target_encoded, 4) for r in enc.collect()}
    assert got == {"Alice": 0.875, "Bob": 0.5833, "Charlie": 0.875}
    unseen = spark.createDataFrame([("Dora",)], "name string")
    out = encode.apply_target_encoding(unseen, enc, glob, "name").collect()[0]
    assert out.name_target_encoded == 0.75


def test_json_key_value_sum(spark):
    s = '{"1001": 234.57, "1002": 753.05, "1003": 652.43, "1004": 307.89}'
    df = spark.createDataFrame([(s,)], "j string")
    kv = json_key_values(df, "j")
    assert kv.count() == 4
    assert round(kv.agg(F.sum("value")).first()[0], 2) == 1947.94
    per_row = df.select(map_value_sum("m").alias("t")) if False else \
        df.select(F.from_json("j", "map<string,double>").alias("m")).select(map_value_sum("m").alias("t"))
    assert round(per_row.first().t, 2) == 1947.94


def test_ks_distance(spark):
    a = spark.range(0, 50).select(F.col("id").cast("double").alias("x"))
    b = spark.range(10, 60).select(F.col("id").cast("double").alias("x"))
    r = ks_statistic(a, b, "x").first()
    assert r.statistic == pytest.approx(0.2)
    assert (r.n1, r.n2, r.drift) == (50, 50, True)


def test_missing_items(spark):
    exp = spark.createDataFrame([("models/",), ("scalers.pkl",), ("nope",)], "name string")
    found = spark.createDataFrame([("models/x/a.pkl",), ("scalers.pkl",)], "key string")
    assert [r.name for r in validate.missing_items(exp, found).collect()] == ["nope"]


def test_ensemble_weights_two_models(spark):
    val = spark.createDataFrame([("a", 0.936), ("b", 0.921)], "model string, r2 double")
    got = {r.model: r.weight for r in evaluation.ensemble_weights(val).collect()}
    wa, wb = 0.936 / (0.936 + 0.921), 0.921 / (0.936 + 0.921)
    assert got["a"] == pytest.approx(wa / (wa + wb))
    assert got["b"] == pytest.approx(wb / (wa + wb))


def test_ensemble_weights_floor_and_zero_sum(spark):
    val = spark.createDataFrame([("a", 0.99), ("b", 0.01), ("c", -1.0)], "model string, r2 double")
    got = {r.model: r.weight for r in evaluation.ensemble_weights(val).collect()}
    raw = {"a": 0.99, "b": 0.2, "c": 0.2}
    assert got == pytest.approx({k: v / sum(raw.values()) for k, v in raw.items()})
    zero = spark.createDataFrame([("a", -0.5), ("b", 0.0)], "model string, r2 double")
    assert {r.weight for r in evaluation.ensemble_weights(zero).collect()} == {0.5}

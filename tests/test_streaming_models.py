import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from retailcast.operators import models, rollups
from retailcast.sources import retail
from retailcast.streaming import incremental


def test_streaming_rollup_equals_batch(spark, tmpdir_path):
    lines = retail.sales(spark, SF_SMALL).where(F.col("date") < F.lit(dt.date(1995, 3, 1)))
    src = os.path.join(tmpdir_path, "src")
    # one folder per month, as daily files would land
    lines.withColumn("m", F.date_format("date", "yyyyMM")).write.partitionBy("m").parquet(src)
    # a late sentinel batch far ahead moves the watermark past every real day
    sentinel = lines.limit(1).withColumn("date", F.lit(dt.date(1999, 1, 1)))
    sentinel.write.parquet(os.path.join(src, "m=199901"))
    stream = incremental.read_sales_stream(spark, src, files_per_trigger=1)
    out = os.path.join(tmpdir_path, "out")
    q = incremental.start_parquet_sink(incremental.streaming_daily_sales(stream), out,
                                       os.path.join(tmpdir_path, "ckpt"))
    q.awaitTermination(300)
    got = spark.read.parquet(out).where(F.col("date") < F.lit(dt.date(1999, 1, 1)))
    exp = rollups.daily_sales(lines)
    assert got.count() == exp.count()
    diff = exp.select("date", "store_id", "product_id", F.round("sales", 6).alias("s")).exceptAll(
        got.select("date", "store_id", "product_id", F.round("sales", 6).alias("s")))
    assert diff.count() == 0


def test_models_train_and_beat_floor(spark):
    from retailcast.plans.queries_diag import feature_split

    res = models.train_all(feature_split(spark, SF_SMALL), gbt_params={"maxIter": 15},
                           forest_params={"numTrees": 20})
    m = {(r.model, r.split): r for r in res["metrics"].collect()}
    assert {k[0] for k in m} == {"boosted_trees", "random_forest", "ensemble"}
    assert m[("boosted_trees", "train")].r2 > 0.5
    w = {r.model: r.weight for r in res["weights"].collect()}
    assert sum(w.values()) == pytest.approx(1.0) and min(w.values()) >= 0.2 / 1.2 - 1e-9
    imp = res["importances"].where("model = 'boosted_trees'").agg(F.sum("importance")).first()[0]
    assert imp == pytest.approx(1.0, abs=1e-6)
    # what is written and read back predicts the same
    root = tempfile.mkdtemp(prefix="rc-models-")
    models.save_bundle(res, root)
    test = feature_split(spark, SF_SMALL).where("split = 'test'")
    key = ["model", "date", "store_id"]
    again = models.predict_bundle(models.load_bundle(spark, root), test, "sales")
    both = res["predictions"].where("split = 'test'").join(again.select(*key, F.col("prediction").alias("again")), key)
    assert both.count() == again.count() > 0
    assert both.where(F.abs(F.col("prediction") - F.col("again")) > 1e-6 * F.abs("prediction")).count() == 0


def test_prediction_intervals_and_recursive_forecast(spark):
    from retailcast.plans.queries_eval import all_predictions

    iv = models.prediction_intervals(all_predictions(spark, SF_SMALL)).where("model = 'naive_lag_1'")
    r = iv.where("lower_95 IS NOT NULL").first()
    assert r.lower_95 <= r.lower_80 <= r.upper_80 <= r.upper_95
    sd = rollups.store_days(spark, SF_SMALL).select("date", "store_id", "sales")
    fc = models.recursive_forecast(sd, horizon=3).toPandas()
    assert set(fc.step) == {1, 2, 3}
    assert fc.groupby("store_id").size().eq(3).all()
    again = models.recursive_forecast(sd, horizon=3).toPandas()
    assert fc.sort_values(["store_id", "step"]).prediction.tolist() == again.sort_values(["store_id", "step"]).prediction.tolist()


def test_trailing_mean_by_hand(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, k), float(k)) for k in range(1, 10)] + [("b", dt.date(2024, 1, 1), 5.0)],
                               "store_id string, date date, sales double")
    got = {(r.store_id, r.step): (r.date, r.prediction) for r in models.trailing_mean_forecast(df, horizon=3).collect()}
    tail, want = [float(k) for k in range(3, 10)], []
    for _ in range(3):
        want.append(sum(tail) / 7)
        tail = tail[1:] + [want[-1]]
    assert [got["a", k][1] for k in (1, 2, 3)] == pytest.approx(want) and got["a", 3][0] == dt.date(2024, 1, 12)
    assert [got["b", k][1] for k in (1, 2, 3)] == [5.0] * 3


def test_comparison_bundle_leaves_stability_out_of_short_tests(spark):
    from retailcast.operators import report

    rows = [(m, dt.date(2024, 1, 1) + dt.timedelta(days=i), "s", "test", 10.0 + i % 5, 10.0 + i % 3) for m in ("x", "y") for i in range(20)]
    preds = spark.createDataFrame(rows, "model string, date date, store_id string, split string, actual double, prediction double")
    short, long = report.comparison_bundle(preds, window=30), report.comparison_bundle(preds, window=5)
    assert "stability" not in short and long["stability"].count() == 2 and long["qq"].count() == 40

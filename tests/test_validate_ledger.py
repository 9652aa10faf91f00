import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailcast.operators import ledger, validate


def test_missing_columns_and_types(spark):
    df = spark.createDataFrame([(1.0, "a")], "sales double, store_id string")
    miss = [r.detail for r in validate.missing_columns(spark, df).collect()]
    assert miss == ["date", "product_id"]
    t = validate.type_contract(spark, df, {"sales": "double", "store_id": "int"}).collect()
    assert len(t) == 1 and "store_id" in t[0].detail


def test_value_checks_and_cast_failures(spark):
    df = spark.createDataFrame([(1, 10.0, "1"), (-2, -5.0, "x"), (3, 2e6, None)],
                               "quantity_sold int, sales double, code string")
    v = {r.check: r.n_failed for r in validate.value_checks(
        df, {"neg_q": F.col("quantity_sold") < 0, **validate.range_checks()}, "t").collect()}
    assert v == {"neg_q": 1, "sales_out_of_range": 2}  # -5.0 and 2e6
    c = {r.column: r.failed for r in validate.cast_failures(df, {"code": "int"}).collect()}
    assert c == {"code": 1}


def test_file_checks_and_summary(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "d")
    spark.createDataFrame([(1,)], "a int").coalesce(1).write.parquet(root)
    good = [r.path for r in __import__("retailcast.sources.files", fromlist=["x"]).list_files(
        spark, root, "*.parquet").collect()]
    with open(os.path.join(root, "junk.parquet"), "wb") as f:
        f.write(b"garbage")
    expected = spark.createDataFrame([(good[0],), ("file:" + os.path.join(root, "gone.parquet"),)], "path string")
    issues = validate.file_checks(spark, expected, root, T.StructType([T.StructField("a", T.IntegerType())]))
    kinds = sorted(r.issue for r in issues.collect())
    assert kinds == ["damaged footer", "missing file"]
    s = validate.issue_summary(issues, 1).first()
    assert s.num_issues_found == 2 and len(s.first_issues) == 1


def test_per_file_checks(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "s")
    spark.createDataFrame([(1, 2.0), (-1, 3.0)], "quantity_sold int, revenue double").coalesce(1).write.parquet(p)
    r = validate.per_file_checks(spark.read.parquet(p)).first()
    assert (r.rows, r.negative_quantity, r.negative_revenue) == (2, 1, 0)


def test_ledger_runs_versions_stages(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "ledger")
    m1 = spark.createDataFrame([("ensemble_rmse", 5.0), ("ensemble_r2", 0.9)], "key string, value double")
    m2 = spark.createDataFrame([("ensemble_rmse", 4.0), ("ensemble_r2", 0.8)], "key string, value double")
    ledger.log_run(spark, root, "r1", {"lr": 0.1}, m1)
    ledger.log_run(spark, root, "r2", {"lr": 0.2}, m2)
    assert ledger.best_run(spark, root, "ensemble_rmse").first().run_id == "r2"
    assert ledger.best_run(spark, root, "ensemble_r2", ascending=False).first().run_id == "r1"
    wide = {r.run_id: r for r in ledger.run_view(spark, root, ["ensemble_rmse", "ensemble_r2"]).collect()}
    assert wide["r1"].ensemble_rmse == 5.0
    assert ledger.latest_version(spark, root, "m", fallback_key="ensemble_rmse").first().run_id == "r2"
    v1 = ledger.register_version(spark, root, "m", "r1").first().version
    v2 = ledger.register_version(spark, root, "m", "r2").first().version
    assert (v1, v2) == (1, 2)
    ledger.set_stage(spark, root, "m", 1, "Production")
    assert ledger.latest_version(spark, root, "m").first().version == 2
    assert ledger.latest_version(spark, root, "m", stage="Production").first().version == 1
    keys = ledger.split_metric_key(spark.createDataFrame([("naive_lag_1_rmse",), ("other",)], "key string"))
    got = {r.key: (r.model, r.metric) for r in keys.collect()}
    assert got == {"naive_lag_1_rmse": ("naive_lag_1", "rmse"), "other": (None, None)}
    long = spark.createDataFrame([("a", "rmse", 2.0), ("b", "rmse", 1.0)], "model string, metric string, value double")
    assert ledger.best_model(long).first().best_model == "b"

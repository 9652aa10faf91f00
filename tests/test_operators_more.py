"""Operators of the validation, roll-up, selection and report families on small literal frames."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from retailcast.functions import calendar as cal
from retailcast.operators import evaluation, ledger, metrics, models, rollups, validate
from retailcast.operators.features import fill_missing
from retailcast.sources import files, footers, retail
from tests.conftest import SF_SMALL

D = dt.date


def test_promotion_flag_equals_the_joined_summary(spark):
    lines = retail.sales(spark, SF_SMALL)
    one = rollups.daily_sales(lines, retail.PROMOTION_MIN_DISCOUNT)
    summary = rollups.promotion_summary(retail.promotions(spark, SF_SMALL, lines))
    two = rollups.with_promotion_flag(rollups.daily_sales(lines), summary)
    keys = [*rollups.DAILY_KEYS, "has_promotion"]
    assert one.select(*keys).exceptAll(two.select(*keys)).count() == 0 and one.count() == two.count()
    assert one.agg(F.sum("has_promotion")).first()[0] > 0


def test_lines_with_unknown_keys_are_kept(spark, tmpdir_path):
    day = dt.datetime(2024, 1, 2)
    frames = {"lineitem": ([(1, 9, 2.0, 10.0, 0.1, day), (1, 1, 1.0, 5.0, 0.0, day), (7, 1, 0.0, 5.0, 0.0, day)],
                           "l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp"),
              "supplier": ([(1, 3)], "s_suppkey long, s_nationkey int"), "part": ([(1, "t")], "p_partkey long, p_type string"),
              "orders": ([(5, day), (6, day)], "o_custkey long, o_orderdate timestamp"), "customer": ([(5, 3)], "c_custkey long, c_nationkey int")}
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmpdir_path}/{name}.parquet")
    got = {(r.store_id, r.category) for r in retail.sales(spark, tmpdir_path).collect()}
    assert got == {("unknown", "t"), ("3", "t")}
    assert retail.sales(spark, tmpdir_path, every_line=True).where("quantity_sold = 0 and category = 'unknown'").count() == 1
    assert {r.store_id for r in retail.customer_traffic(spark, tmpdir_path).collect()} == {"3", "unknown"}


@pytest.mark.parametrize("chunk", [2, 5, 8192])
def test_fills_do_not_depend_on_the_chunk(spark, chunk):
    values = {"a": [None, None, 3.0, None, None, None, 7.0, None], "b": [None] * 4, None: [1.0, None, None, 4.0, None, None]}
    rows = [(g, D(2024, 1, 1) + dt.timedelta(days=i), v) for g, own in values.items() for i, v in enumerate(own)]
    df = spark.createDataFrame(rows, "g string, date date, x_lag_1 double")
    got = {}
    for r in fill_missing(df, ["g"], "date", chunk_rows=chunk).orderBy("date").collect():
        got.setdefault(r.g, []).append(r.x_lag_1)
    assert got == {"a": [3.0] * 6 + [7.0] * 2, "b": [None] * 4, None: [1.0] * 3 + [4.0] * 3}


def test_file_without_rows_is_listed(spark, tmpdir_path):
    spark.createDataFrame([(1, -2.0)], "quantity_sold int, revenue double").coalesce(1).write.parquet(f"{tmpdir_path}/a")
    spark.createDataFrame([], "quantity_sold int, revenue double").coalesce(1).write.parquet(f"{tmpdir_path}/b")
    df = spark.read.option("recursiveFileLookup", "true").parquet(tmpdir_path)
    per = validate.per_file_checks(df, listed=files.list_files(spark, tmpdir_path, "*.parquet")).collect()
    assert sorted((r["rows"], r.negative_revenue) for r in per) == [(0, 0), (1, 1)]


def test_root_with_pattern_characters(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "a+b")
    for name in ("x", "y"):
        spark.range(3).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    assert {r.dataset for r in footers.manifest(spark, root).collect()} == {"x", "y"}


def test_json_report_is_one_file(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "r")
    files.write_json_report(spark.createDataFrame([("m", 1.5)], "model string, rmse double"), path)
    parts = [f for f in os.listdir(path) if f.endswith(".json")]
    assert len(parts) == 1 and json.loads(open(os.path.join(path, parts[0])).read()) == {"model": "m", "rmse": 1.5}
    with pytest.raises(ValueError):
        files.require_rows(spark.range(0))


def test_actuals_join_by_chosen_keys(spark):
    actual = spark.createDataFrame([(1, "a", 5.0), (1, "b", 6.0)], "date int, store_id string, sales double")
    preds = spark.createDataFrame([(1, "a", 4.0), (2, "a", 1.0)], "date int, store_id string, prediction double")
    assert [tuple(r) for r in evaluation.join_actuals(actual, preds).select("prediction", "actual").collect()] == [(4.0, 5.0)]


def test_feature_selection_keeps_what_matters(spark):
    rows = [(D(2024, 1, 1) + dt.timedelta(days=i), "s", float(i % 17), 1.0, 3.0 * (i % 17), "train") for i in range(200)]
    df = spark.createDataFrame(rows, "date date, store_id string, useful double, constant double, sales double, split string")
    assert [r.feature for r in models.select_features(df).collect()] == ["useful"]


def test_unreadable_ledger_is_no_empty_ledger(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "runs")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        ledger.read(spark, tmpdir_path, "runs").count()
    assert ledger.read(spark, tmpdir_path, "run_params").count() == 0


def test_rolling_metrics_do_not_depend_on_the_chunk(spark):
    rows = [("m", s, D(2024, 1, 1) + dt.timedelta(days=i), float(i * 7 % 11), float(i % 5)) for s in ("x", "y") for i in range(70)]
    df = spark.createDataFrame(rows, "model string, store_id string, date date, actual double, prediction double")
    whole = metrics.rolling_metrics(df, window=10, chunk_rows=8192)
    parts = metrics.rolling_metrics(df, window=10, chunk_rows=16)
    rounded = lambda d: d.select("store_id", "date", *[F.round(c, 9) for c in ("rolling_mae", "rolling_rmse", "rolling_r2")])
    assert whole.count() == 120 and rounded(whole).exceptAll(rounded(parts)).count() == 0


def test_timestamp_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 5, 6, 7, 8, 9),)], "t timestamp")
    assert df.select(cal.iso_format(F.col("t")), cal.iso_format(F.col("t"), "yyyy-MM-dd'T'HH:mm:ss")).first()[:] == (
        "2024-05-06", "2024-05-06T07:08:09")

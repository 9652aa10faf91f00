import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from retailcast.operators import split
from retailcast.operators.ordering import POS, row_index, thin_evenly


def _days(spark, n_days=40, stores=("a", "b", "c")):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), s, float(i)) for i in range(n_days) for s in stores]
    return spark.createDataFrame(rows, "date date, store_id string, sales double")


def test_row_index_is_global_order(spark):
    df = _days(spark)
    pdf = row_index(df, ["date", "store_id"]).toPandas().sort_values(["date", "store_id"])
    assert pdf[POS].tolist() == list(range(len(pdf)))


def test_row_index_per_group(spark):
    df = _days(spark)
    pdf = row_index(df, ["date"], ["store_id"]).toPandas()
    for _, g in pdf.groupby("store_id"):
        assert g.sort_values("date")[POS].tolist() == list(range(len(g)))


def test_thin_evenly_matches_linspace(spark):
    df = spark.range(1234).select(F.col("id").alias("v"), (F.col("id") % 2).alias("g"))
    got = sorted(r.v for r in thin_evenly(df.where("g = 0"), ["v"], 500).collect())
    n = 617
    exp_pos = np.linspace(0, n - 1, 500, dtype=int)
    exp = sorted(int(2 * p) for p in exp_pos)
    assert got == exp
    small = thin_evenly(spark.range(300).select(F.col("id").alias("v")), ["v"], 500)
    assert small.count() == 300


def test_chronological_split_sizes_and_order(spark):
    df = _days(spark, 37)
    s = split.chronological_split(df, ["date", "store_id"], "sales").toPandas()
    n = len(s)
    counts = s.split.value_counts().to_dict()
    assert counts["train"] == int(n * 0.8)
    assert counts["validation"] == int(n * 0.1)
    assert counts["test"] == n - int(n * 0.8) - int(n * 0.1)
    assert s[s.split == "train"].date.max() <= s[s.split == "validation"].date.min()
    assert s[s.split == "validation"].date.max() <= s[s.split == "test"].date.min()


def test_split_drops_null_targets_after_cut(spark):
    rows = [(dt.date(2024, 1, i + 1), "a", None if i == 0 else float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "date date, store_id string, sales double")
    s = split.chronological_split(df, ["date", "store_id"], "sales").toPandas()
    assert len(s) == 9 and (s.split == "train").sum() == 7


def test_expanding_folds(spark):
    df = _days(spark, 20, ("a",))
    f = split.expanding_folds(df, ["date"], 3).toPandas()
    n, size = 20, 20 // 4
    for k in range(3):
        fold = f[f.fold == k]
        start = n - (3 - k) * size
        assert (fold.role == "test").sum() == size
        assert (fold.role == "train").sum() == start
        assert fold[fold.role == "train"].date.max() < fold[fold.role == "test"].date.min()


def test_label_codes_follow_string_order(spark):
    from retailcast.operators.encode import apply_label_codes, fit_label_codes

    words = ["b", "a", "ab", "abc", "A", "Z", "zz", "é", "éa", "10", "9", "100", "a", None, "b"]
    df = spark.createDataFrame([(w,) for w in words], "cat string")
    codes = dict(fit_label_codes(df, "cat").collect())
    classes = sorted({w for w in words if w is not None}, key=lambda w: w.encode("utf-8"))
    assert codes == {w: i for i, w in enumerate(classes)}
    out = apply_label_codes(spark.createDataFrame([("zz",), ("new",)], "cat string"),
                            fit_label_codes(df, "cat"), "cat")
    assert sorted(r.cat for r in out.collect()) == [-1, codes["zz"]]


def test_row_index_with_nulls_and_ties(spark):
    rows = [("a", 1, 0), ("a", 1, 1), ("a", 1, 1), ("a", None, 5), ("a", 0, 9), (None, 2, 0), (None, None, 1), (None, 2, 1)]
    df = spark.createDataFrame(rows, "g string, d int, v int")
    got = row_index(df, ["d"], ["g"]).collect()
    for g in ("a", None):
        own = sorted((r[POS], r.d) for r in got if r.g == g)
        assert [p for p, _ in own] == list(range(len(own)))
        days = [d for _, d in own]
        assert days == sorted(days, key=lambda d: (d is None, d or 0))  # nulls last
    assert sorted(r[POS] for r in row_index(df, ["d"]).collect()) == list(range(len(rows)))


def test_ungrouped_lag_with_repeated_dates(spark):
    from retailcast.operators.features import lag_features

    df = spark.createDataFrame([(i // 5, float(i)) for i in range(60)], "date int, x double")
    out = lag_features(df, "x", None, "date", lags=(1, 3), chunk_rows=8).toPandas()
    assert out["x_lag_1"].isna().sum() == 1 and out["x_lag_3"].isna().sum() == 3


def test_label_codes_of_any_type_and_shared_prefix(spark):
    from retailcast.operators.encode import fit_label_codes

    df = spark.range(3000).selectExpr("concat('store_', lpad(id, 5, '0')) as s", "cast(id * 7 - 900 as int) as k").repartition(5)
    for col in ("s", "k"):
        codes = fit_label_codes(df, col).toPandas().sort_values(col)
        assert list(codes[f"{col}_code"]) == list(range(3000))


def test_range_cuts_are_even_whatever_the_values(spark):
    from retailcast.operators.ordering import cut_bucket, range_cuts

    df = spark.range(20_000).selectExpr("cast(id as double) as x").union(spark.createDataFrame([(1e12,)], "x double"))
    per = df.groupBy(cut_bucket("x", range_cuts(df, "x", 32)).alias("b")).count().toPandas()
    assert len(per) == 32 and per["count"].max() < 3 * 20_000 / 32

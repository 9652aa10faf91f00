"""Window features against pandas references on small literal frames."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from retailcast.operators import features as feat


def _frame(rng, groups=3, n=60, null_share=0.0):
    rows = []
    d0 = dt.date(2024, 1, 1)
    for g in range(groups):
        m = n + g * 7
        for i in range(m):
            v = float(rng.normal(100, 20))
            if rng.random() < null_share:
                v = None
            rows.append((f"s{g}", d0 + dt.timedelta(days=i), v))
    return pd.DataFrame(rows, columns=["store_id", "date", "sales"])


def _to_spark(spark, pdf):
    return spark.createDataFrame(pdf, "store_id string, date date, sales double")


def _sorted(pdf):
    return pdf.sort_values(["store_id", "date"]).reset_index(drop=True)


def test_lags_match_pandas(spark):
    pdf = _frame(np.random.default_rng(1))
    out = _sorted(feat.lag_features(_to_spark(spark, pdf), "sales", ["store_id"]).toPandas())
    ref = _sorted(pdf)
    for k in (1, 2, 3, 7, 14, 21, 30):
        exp = ref.groupby("store_id")["sales"].shift(k)
        assert np.allclose(out[f"sales_lag_{k}"].astype(float), exp, equal_nan=True)


def test_rolling_match_pandas(spark):
    pdf = _frame(np.random.default_rng(2))
    out = _sorted(feat.rolling_features(_to_spark(spark, pdf), "sales", ["store_id"]).toPandas())
    ref = _sorted(pdf)
    g = ref.groupby("store_id")["sales"]
    for w in (3, 7, 30):
        r = g.rolling(w, min_periods=1)
        assert np.allclose(out[f"sales_rolling_{w}_mean"], r.mean().reset_index(level=0, drop=True))
        assert np.allclose(out[f"sales_rolling_{w}_min"], r.min().reset_index(level=0, drop=True))
        assert np.allclose(out[f"sales_rolling_{w}_max"], r.max().reset_index(level=0, drop=True))
        assert np.allclose(out[f"sales_rolling_{w}_median"], r.median().reset_index(level=0, drop=True))
        assert np.allclose(out[f"sales_rolling_{w}_std"].astype(float),
                           r.std().reset_index(level=0, drop=True), equal_nan=True)
        # property: min <= mean <= max
        assert (out[f"sales_rolling_{w}_min"] <= out[f"sales_rolling_{w}_mean"] + 1e-9).all()
        assert (out[f"sales_rolling_{w}_mean"] <= out[f"sales_rolling_{w}_max"] + 1e-9).all()


def test_closed_left_excludes_current_row(spark):
    pdf = _frame(np.random.default_rng(3), groups=1, n=20)
    out = _sorted(feat.rolling_features(_to_spark(spark, pdf), "sales", ["store_id"], windows=(3,),
                                        functions=("mean",), closed="left").toPandas())
    exp = _sorted(pdf)["sales"].shift(1).rolling(3, min_periods=1).mean()
    assert np.allclose(out["sales_rolling_3_mean"].astype(float), exp, equal_nan=True)


def test_chunked_path_equals_direct_path(spark):
    pdf = _frame(np.random.default_rng(4), groups=2, n=150)
    sdf = _to_spark(spark, pdf)
    direct = _sorted(feat.lag_and_rolling(sdf, "sales", ["store_id"]).toPandas())
    chunked = _sorted(feat.lag_and_rolling(sdf, "sales", ["store_id"], chunk_rows=40).toPandas())
    assert list(direct.columns) == list(chunked.columns)
    for c in direct.columns[3:]:
        assert np.allclose(direct[c].astype(float), chunked[c].astype(float), equal_nan=True), c


def test_ungrouped_lags_use_chunks(spark):
    pdf = _frame(np.random.default_rng(5), groups=1, n=100).drop(columns=["store_id"])
    sdf = spark.createDataFrame(pdf, "date date, sales double")
    out = feat.lag_features(sdf, "sales", None, lags=(1, 7)).toPandas().sort_values("date")
    ref = pdf.sort_values("date")
    assert np.allclose(out["sales_lag_7"].astype(float), ref["sales"].shift(7), equal_nan=True)


@pytest.mark.parametrize("seed", [11, 12, 13, 14, 15])
def test_compat_fill_equals_global_fill(spark, seed):
    rng = np.random.default_rng(seed)
    pdf = _frame(rng, groups=4, n=25, null_share=0.4)
    pdf = pdf.rename(columns={"sales": "sales_lag_1"})
    # whole groups without values and a null head of the frame
    pdf.loc[pdf.store_id == "s1", "sales_lag_1"] = None
    sdf = spark.createDataFrame(pdf, "store_id string, date date, sales_lag_1 double")
    out = _sorted(feat.fill_missing(sdf, ["store_id"], compat=True).toPandas())
    ref = _sorted(pdf)
    exp = ref["sales_lag_1"].ffill().bfill()
    assert np.allclose(out["sales_lag_1"].astype(float), exp)


def test_grouped_fill_stays_inside_group(spark):
    pdf = _frame(np.random.default_rng(21), groups=3, n=20, null_share=0.3).rename(columns={"sales": "x_rolling"})
    sdf = spark.createDataFrame(pdf, "store_id string, date date, x_rolling double")
    out = _sorted(feat.fill_missing(sdf, ["store_id"]).toPandas())
    ref = _sorted(pdf)
    exp = ref.groupby("store_id")["x_rolling"].transform(lambda s: s.ffill().bfill())
    assert np.allclose(out["x_rolling"].astype(float), exp.astype(float), equal_nan=True)


def test_mean_fill(spark):
    sdf = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0), ("a", dt.date(2024, 1, 2), None),
                                 ("a", dt.date(2024, 1, 3), 3.0)], "store_id string, date date, traffic double")
    out = feat.fill_missing(sdf, ["store_id"]).orderBy("date").toPandas()
    assert out["traffic"].tolist() == [1.0, 2.0, 3.0]


def test_full_feature_build_columns(spark):
    pdf = _frame(np.random.default_rng(31), groups=2, n=40)
    out = feat.create_all_features(_to_spark(spark, pdf), "sales", "date", ["store_id"], ["store_id"])
    cols = set(out.columns)
    assert {"year", "month", "day", "day_of_week", "quarter", "week_of_year", "is_weekend", "is_holiday"} <= cols
    assert len([c for c in cols if "_lag_" in c]) == 7
    assert len([c for c in cols if "_rolling_" in c]) == 25
    assert {"month_sin", "month_cos", "day_sin", "day_cos", "day_of_week_sin", "day_of_week_cos"} <= cols
    lag_cols = [c for c in out.columns if "_lag_" in c or "_rolling_" in c]
    nulls = out.select([out[c].isNull().cast("int").alias(c) for c in lag_cols]).toPandas().sum().sum()
    assert nulls == 0

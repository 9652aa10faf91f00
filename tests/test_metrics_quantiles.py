import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from retailcast.operators import diagnostics, evaluation, metrics, report
from retailcast.operators.quantiles import exact_quantiles


def _preds(spark, rng, n=80, models=("m1", "m2")):
    rows = []
    for m in models:
        for i in range(n):
            y = float(rng.normal(100, 10))
            rows.append((m, dt.date(2024, 1, 1) + dt.timedelta(days=i), "s", "test", y, y + float(rng.normal(0, 5))))
    return spark.createDataFrame(rows, "model string, date date, store_id string, split string, actual double, "
                                       "prediction double")


def test_perfect_prediction(spark):
    df = spark.createDataFrame([("m", 1.0, 1.0), ("m", 2.0, 2.0), ("m", 4.0, 4.0)],
                               "model string, actual double, prediction double")
    r = metrics.model_metrics(df, by=("model",)).first()
    assert (r.rmse, r.mae, r.mape, r.r2) == (0.0, 0.0, 0.0, 1.0)


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(3)
    df = _preds(spark, rng)
    pdf = df.toPandas()
    got = {r.model: r for r in metrics.model_metrics(df, by=("model",)).collect()}
    for m, g in pdf.groupby("model"):
        e = g.actual - g.prediction
        assert got[m].rmse == pytest.approx(np.sqrt((e ** 2).mean()))
        assert got[m].mae == pytest.approx(e.abs().mean())
        assert got[m].mape == pytest.approx((e / g.actual).abs().mean() * 100)
        sst = ((g.actual - g.actual.mean()) ** 2).sum()
        assert got[m].r2 == pytest.approx(1 - (e ** 2).sum() / sst)


def test_zero_target_is_skipped_in_mape(spark):
    df = spark.createDataFrame([("m", 0.0, 1.0), ("m", 2.0, 1.0)], "model string, actual double, prediction double")
    assert metrics.model_metrics(df, by=("model",)).first().mape == pytest.approx(50.0)


def test_ensemble_lies_between_members(spark):
    rng = np.random.default_rng(4)
    p = _preds(spark, rng, 30)
    w = spark.createDataFrame([("m1", 0.9, 0.6), ("m2", 0.8, 0.4)], "model string, r2 double, weight double")
    ens = evaluation.ensemble_predictions(p, w, ["date", "store_id", "split"]).toPandas()
    wide = p.toPandas().pivot_table(index="date", columns="model", values="prediction")
    ens = ens.set_index("date").prediction.reindex(wide.index).to_numpy()
    lo, hi = wide.min(axis=1).to_numpy(), wide.max(axis=1).to_numpy()
    assert ((ens >= lo - 1e-9) & (ens <= hi + 1e-9)).all()
    assert np.allclose(ens, 0.6 * wide.m1.to_numpy() + 0.4 * wide.m2.to_numpy())


def test_rolling_metrics_match_loop(spark):
    rng = np.random.default_rng(5)
    df = _preds(spark, rng, 60, ("m1",))
    got = metrics.rolling_metrics(df, ("store_id",), "date", 30).toPandas().sort_values("date")
    pdf = df.toPandas().sort_values("date").reset_index(drop=True)
    maes, r2s = [], []
    for i in range(30, len(pdf)):
        w = pdf.iloc[i - 30:i]
        e = w.actual - w.prediction
        maes.append(e.abs().mean())
        r2s.append(1 - (e ** 2).sum() / ((w.actual - w.actual.mean()) ** 2).sum())
    assert len(got) == 30
    assert np.allclose(got.rolling_mae, maes) and np.allclose(got.rolling_r2, r2s)
    st = metrics.stability_scores(spark.createDataFrame(got)).first()
    assert st.mae_cv == pytest.approx(np.std(maes) / (np.mean(maes) + 1e-8))


def test_exact_quantiles_against_numpy(spark):
    rng = np.random.default_rng(6)
    vals = np.concatenate([rng.normal(size=5000), np.full(3000, 1.5)])
    df = spark.createDataFrame(pd.DataFrame({"x": vals}))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.975, 1.0]
    got = exact_quantiles(df, "x", probs).first()
    assert np.allclose([got[f"q_{i}"] for i in range(len(probs))], np.percentile(vals, [p * 100 for p in probs]))


def test_outlier_summary(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, -50.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = diagnostics.outlier_summary(df, "x").first()
    q1, q3 = np.percentile(vals, [25, 75])
    assert (r.q1, r.q3) == (q1, q3)
    assert r["count"] == 2 and r.min_outlier == -50.0 and r.max_outlier == 100.0
    assert r.percentage == round(2 / 7 * 100, 2)
    none = diagnostics.outlier_summary(spark.createDataFrame([(1.0,), (2.0,)], "x double"), "x").first()
    assert none["count"] == 0 and none.min_outlier is None


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(8)
    vals = rng.normal(size=1000)
    df = spark.createDataFrame(pd.DataFrame({"model": "m", "r": vals}))
    h = report.density_histogram(df, "r", 30).toPandas().sort_values("bin")
    dens, edges = np.histogram(vals, bins=30, density=True)
    cnt, _ = np.histogram(vals, bins=30)
    assert h["count"].tolist() == cnt.tolist()
    assert np.allclose(h.density, dens) and np.allclose(h.bin_start, edges[:-1])


def test_box_statistics(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 50.0]
    df = spark.createDataFrame([("m", v) for v in vals], "model string, r double")
    b = report.box_statistics(df, "r").first()
    assert (b.q1, b.median, b.q3) == tuple(np.percentile(vals, [25, 50, 75]))
    assert b.whisker_high == 6.0 and b.whisker_low == 1.0 and b.n_fliers == 1


def test_qq_points(spark):
    rng = np.random.default_rng(9)
    df = _preds(spark, rng, 200, ("m1",))
    q = report.qq_points(df).toPandas().sort_values("rank")
    assert q["rank"].tolist() == list(range(200))
    assert q.residual.is_monotonic_increasing and q.theoretical.is_monotonic_increasing
    assert q.slope.iloc[0] > 0


def test_importance_summaries(spark):
    rows = [("a", f"f{i}", float(20 - i)) for i in range(20)] + [("b", f"f{i}", float(i)) for i in range(20)]
    imp = spark.createDataFrame(rows, "model string, feature string, importance double")
    top = report.top_features(imp, 15)
    assert top.count() == 30
    cons = {r.feature: r.n_models for r in report.feature_consistency(imp, 15).collect()}
    assert set(cons) == {f"f{i}" for i in range(5, 15)} and set(cons.values()) == {2}
    mat = report.importance_matrix(imp, 15).toPandas()
    assert len(mat) == 20 * 2
    assert mat.groupby("feature").normalized.max().between(0.99, 1.0).all()


def test_quantiles_keep_null_groups_and_survive_skew(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    values = {"hot": np.concatenate([rng.normal(size=60_000), np.zeros(20_000), [1e9]]), None: rng.normal(size=7), "one": np.array([4.0])}
    rows = [(g, float(x)) for g, v in values.items() for x in v] + [("hot", None), (None, None)]
    got = {r.g: r for r in exact_quantiles(spark.createDataFrame(rows, "g string, x double"), "x", [0.0, 0.25, 0.5, 0.999, 1.0], ["g"]).collect()}
    for g, v in values.items():
        want = np.quantile(v, [0.0, 0.25, 0.5, 0.999, 1.0])
        assert [got[g][f"q_{i}"] for i in range(5)] == pytest.approx(list(want), rel=1e-12, abs=1e-12)


def test_alerts_compare_shares(spark):
    long = spark.createDataFrame([("a", "mape", 12.0), ("a", "rmse", 2000.0), ("b", "mape", 25.0)], "model string, metric string, value double")
    got = {(r.model, r.metric): r.alert for r in metrics.performance_alerts(long, {"rmse": 1000.0, "mape": 0.2}).collect()}
    assert got == {("a", "mape"): False, ("a", "rmse"): True, ("b", "mape"): True}


def test_normal_ppf_against_the_library(spark):
    from statistics import NormalDist

    from retailcast.operators.report import normal_ppf

    ps = [1e-12, 1e-5, 0.01, 0.074, 0.075, 0.2, 0.5, 0.7, 0.926, 0.99, 1 - 1e-9]
    df = spark.createDataFrame([(p,) for p in [*ps, 0.0, 1.0]], "p double")
    got = [r[0] for r in df.select(normal_ppf(F.col("p"))).collect()]
    assert got[:-2] == pytest.approx([NormalDist().inv_cdf(p) for p in ps], rel=1e-9) and got[-2:] == [None, None]

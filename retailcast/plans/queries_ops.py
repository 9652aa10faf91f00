"""Registered queries: validation, JSON source, manifest, ledger views, rules, intervals,
calendar-derived frames, trained models and recursive forecasts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from retailcast.config import VALUE_RANGES
from retailcast.functions import calendar as cal
from retailcast.operators import diagnostics as diag
from retailcast.operators import encode, evaluation, ledger, metrics, models, report, rollups, validate
from retailcast.operators.features import materialize
from retailcast.plans import sql_features as sqlf
from retailcast.plans.oracle_sql import with_fixtures
from retailcast.plans.queries_diag import FEAT_CTES, _corr_sql, feature_frame, feature_split
from retailcast.plans.queries_eval import (EVAL_CTES, SPLIT_CTES, all_predictions, store_split,
                                          test_metrics_long)
from retailcast.plans.registry import present, register, rnd, rounded
from retailcast.sources import files, retail
from retailcast.session import ensure_checkpoint_dir
from retailcast.sources.tables import read_table

_LO, _HI = VALUE_RANGES["sales"]


# -------------------------------------------------------------- validation --
@register("value_checks", with_fixtures(f"""
SELECT 'sales' AS dataset, 'negative_quantity' AS "check", count(*) AS n_rows,
       count(CASE WHEN quantity_sold < 0 THEN 1 END) AS n_failed FROM rc_raw_sales
UNION ALL SELECT 'sales', 'zero_quantity', count(*), count(CASE WHEN quantity_sold = 0 THEN 1 END) FROM rc_raw_sales
UNION ALL SELECT 'sales', 'negative_revenue', count(*), count(CASE WHEN revenue < 0 THEN 1 END) FROM rc_raw_sales
UNION ALL SELECT 'sales', 'null_date', count(*), count(CASE WHEN date IS NULL THEN 1 END) FROM rc_raw_sales
UNION ALL SELECT 'sales', 'unknown_store', count(*), count(CASE WHEN store_id = 'unknown' THEN 1 END) FROM rc_raw_sales
UNION ALL SELECT 'sales', 'unknown_category', count(*), count(CASE WHEN category = 'unknown' THEN 1 END) FROM rc_raw_sales
UNION ALL SELECT 'store_days', 'sales_out_of_range', count(*),
       count(CASE WHEN NOT (sales BETWEEN {_LO} AND {_HI}) THEN 1 END) FROM rc_store_days
UNION ALL SELECT 'store_days', 'null_traffic', count(*), count(CASE WHEN customer_traffic IS NULL THEN 1 END)
       FROM rc_store_days"""))
def q_value_checks(spark, sf_dir):
    s = retail.sales(spark, sf_dir, every_line=True)  # before any line is dropped
    a = validate.value_checks(s, {"negative_quantity": F.col("quantity_sold") < 0,
                                  "zero_quantity": F.col("quantity_sold") == 0,
                                  "negative_revenue": F.col("revenue") < 0,
                                  "null_date": F.col("date").isNull(),
                                  "unknown_store": F.col("store_id") == retail.UNKNOWN,
                                  "unknown_category": F.col("category") == retail.UNKNOWN}, "sales")
    sd = rollups.store_days(spark, sf_dir)
    b = validate.value_checks(sd, {**validate.range_checks(),
                                   "null_traffic": F.col("customer_traffic").isNull()}, "store_days")
    return a.unionByName(b)


@register("cast_failures", """
SELECT 'props' AS "column", count(CASE WHEN props IS NOT NULL AND try_cast(props AS DOUBLE) IS NULL THEN 1 END) AS failed
FROM events
UNION ALL SELECT 'value', count(CASE WHEN value IS NOT NULL AND try_cast(value AS BIGINT) IS NULL THEN 1 END) FROM events""")
def q_cast_failures(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["props", "value"])
    return validate.cast_failures(ev, {"props": "double", "value": "bigint"})


@register("json_event_values", f"""
SELECT event_type, k AS key, count(*) AS n, {rnd("sum(try_cast(json_extract(props, '$.\"' || k || '\"') AS DOUBLE))", 4)} AS total
FROM (SELECT event_type, props, unnest(json_keys(props)) AS k FROM events) GROUP BY event_type, k""")
def q_json_event_values(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_type", "props"])
    kv = files.json_key_values(ev, "props", ["event_type"])
    return kv.groupBy("event_type", "key").agg(F.count(F.lit(1)).alias("n"),
                                               rounded(F.sum("value"), 4).alias("total"))


# ------------------------------------------------------------------ ledger --
_KEYS = [f"{m}_{k}" for m in (*evaluation.BASELINES, "ensemble") for k in ("rmse", "mae", "mape", "r2")]


@register("run_metrics_wide", with_fixtures(
    "SELECT 'current' AS run_id, " +
    ", ".join(f"{rnd(f'max(CASE WHEN model || chr(95) || metric = {chr(39)}{k}{chr(39)} THEN value END)', 6)} AS {k}"
              for k in _KEYS) + " FROM rc_test_long", EVAL_CTES))
def q_run_metrics_wide(spark, sf_dir):
    keys = ledger.metrics_as_keys(test_metrics_long(spark, sf_dir)).withColumn("run_id", F.lit("current"))
    wide = keys.groupBy("run_id").pivot("key", _KEYS).agg(F.max("value"))
    return present(wide, 6)


@register("metric_key_parse", with_fixtures(f"""
SELECT key, nullif(regexp_extract(key, '^(.+)_(rmse|mae|mape|r2)$', 1), '') AS model,
       nullif(regexp_extract(key, '^(.+)_(rmse|mae|mape|r2)$', 2), '') AS metric, {rnd('value', 6)} AS value
FROM (SELECT model || '_' || metric AS key, value FROM rc_test_long)""", EVAL_CTES))
def q_metric_key_parse(spark, sf_dir):
    keys = ledger.metrics_as_keys(test_metrics_long(spark, sf_dir))
    return present(ledger.split_metric_key(keys).select("key", "model", "metric", "value"), 6)


@register("best_model", with_fixtures(f"""
SELECT model AS best_model, {rnd('value', 6)} AS rmse FROM rc_test_long WHERE metric = 'rmse'
ORDER BY value ASC NULLS LAST, model LIMIT 1""", EVAL_CTES))
def q_best_model(spark, sf_dir):
    return present(ledger.best_model(test_metrics_long(spark, sf_dir)), 6)


# ----------------------------------------------------------- rules, bounds --
def _n_features(df):
    return len([c for c in df.columns if c not in ("date", "sales", "split", "row_index")])


@register("diagnosis_rules", with_fixtures(f"""
SELECT "check", {rnd('value', 6)} AS value, threshold,
       coalesce(CASE WHEN "check" = 'train_rows' THEN value < threshold ELSE value > threshold END, false) AS fired
FROM (
  SELECT 'mean_shift_' || split AS "check", abs((m - mt) / nullif(mt, 0)) AS value, 0.2 AS threshold FROM (
    SELECT split, avg(sales) AS m, max(CASE WHEN split = 'train' THEN avg(sales) END) OVER () AS mt
    FROM rc_split GROUP BY split) WHERE split <> 'train'
  UNION ALL SELECT 'n_features', CAST({len(sqlf.FEATURE_COLUMNS) + 1} AS DOUBLE), 50.0
  UNION ALL SELECT 'high_correlation_features', CAST(count(CASE WHEN abs(correlation) > 0.95 THEN 1 END) AS DOUBLE), 0.0
    FROM ({_corr_sql('rc_fsplit', sqlf.FEATURE_COLUMNS, 'sales', "WHERE split = 'train'")})
  UNION ALL SELECT 'train_rows', CAST(count(*) AS DOUBLE), 1000.0 FROM rc_split WHERE split = 'train'
  UNION ALL SELECT 'zero_target_share', count(CASE WHEN sales = 0 THEN 1 END) / count(*), 0.1
    FROM rc_split WHERE split = 'train')""", FEAT_CTES))
def q_diagnosis_rules(spark, sf_dir):
    fs = feature_split(spark, sf_dir)
    train = fs.where(F.col("split") == "train")
    profile = diag.split_profile(store_split(spark, sf_dir), "sales")
    corr = diag.target_correlations(train, "sales", list(sqlf.FEATURE_COLUMNS))
    rules = diag.diagnosis_rules(profile, corr, train, "sales", _n_features(fs))
    return rules.select("check", rounded("value", 6).alias("value"), "threshold", "fired")


_PROBS = [(1 - 0.8) / 2, (1 + 0.8) / 2, (1 - 0.95) / 2, (1 + 0.95) / 2]


@register("prediction_intervals", with_fixtures(f"""
SELECT p.model, p.date, p.store_id, {rnd('p.prediction', 3)} AS prediction,
       {rnd('p.prediction + q0', 3)} AS lower_80, {rnd('p.prediction + q1', 3)} AS upper_80,
       {rnd('p.prediction + q2', 3)} AS lower_95, {rnd('p.prediction + q3', 3)} AS upper_95
FROM rc_all_preds p LEFT JOIN (
  SELECT model, store_id, {", ".join(f"quantile_cont(actual - prediction, {p!r}) AS q{i}" for i, p in enumerate(_PROBS))}
  FROM rc_all_preds WHERE split = 'validation' GROUP BY model, store_id) q USING (model, store_id)
WHERE p.split = 'test'""", EVAL_CTES))
def q_prediction_intervals(spark, sf_dir):
    iv = models.prediction_intervals(all_predictions(spark, sf_dir))
    return present(iv.select("model", "date", "store_id", "prediction", "lower_80", "upper_80",
                             "lower_95", "upper_95"), 3)


# --------------------------------------------------------- calendar frames --
def _events_sql():
    from retailcast.plans.oracle_sql import _nth_sql
    rows = []
    for n, m, d, dur, disc in cal.PROMOTION_EVENTS:
        start = f"({_nth_sql(11, 'Thu', 4)}) + 1" if n == "Black Friday" else f"make_date(y, {m}, {d})"
        rows.append(f"SELECT '{n}' AS promotion_type, {start} AS start_date, {dur} AS duration, "
                    f"{disc} AS discount_percent FROM rc_pyears")
    return " UNION ALL ".join(rows)


@register("promotion_calendar", with_fixtures(f"""
SELECT CAST(e.start_date + CAST(g.i AS INTEGER) AS DATE) AS date, e.promotion_type,
       CAST(e.discount_percent AS DOUBLE) AS discount_percent
FROM ({_events_sql()}) e, rc_span s, (SELECT range AS i FROM range(0, 31)) g
WHERE g.i < e.duration AND e.start_date BETWEEN s.d0 AND s.d1 AND e.start_date + CAST(g.i AS INTEGER) <= s.d1""",
    """rc_span AS (SELECT min(CAST(l_shipdate AS DATE)) AS d0, max(CAST(l_shipdate AS DATE)) AS d1 FROM lineitem),
rc_pyears AS (SELECT CAST(range AS INTEGER) AS y FROM range((SELECT year(d0) FROM rc_span),
                                                          (SELECT year(d1) FROM rc_span) + 1))"""))
def q_promotion_calendar(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_shipdate"])
    arr = li.select(F.array(F.min(F.to_date("l_shipdate")), F.max(F.to_date("l_shipdate")))).scalar()
    return cal.promotion_calendar(spark, arr[0], arr[1])


_DOW = ", ".join(str(x) for x in cal.DOW_FACTORS)


_MARGIN = 1 - retail.COST_RATIO
_ECON_SQL = with_fixtures(f"""
SELECT date, store_id, product_id, quantity_sold,
       {rnd('unit_price * (1 - discount_percent)', 4)} AS actual_price,
       {rnd('quantity_sold * unit_price * (1 - discount_percent)', 2)} AS revenue,
       {rnd(f'quantity_sold * unit_price * (1 - {_MARGIN!r})', 2)} AS cost,
       {rnd(f'quantity_sold * unit_price * (1 - discount_percent) - quantity_sold * unit_price * (1 - {_MARGIN!r})', 2)}
         AS profit
FROM rc_sales""")


@register("sales_economics", _ECON_SQL)
def q_sales_economics(spark, sf_dir):
    """Per sales line: actual price, revenue, cost and profit from price, discount and margin."""
    s = retail.sales(spark, sf_dir).select("date", "store_id", "product_id", "quantity_sold", "unit_price",
                                          "discount_percent", F.lit(_MARGIN).alias("margin"))
    e = cal.sales_economics(s, price="unit_price", discount="discount_percent",
                            quantity="quantity_sold", margin="margin")
    return e.select("date", "store_id", "product_id", "quantity_sold",
                    rounded("actual_price", 4).alias("actual_price"), rounded("revenue", 2).alias("revenue"),
                    rounded("cost", 2).alias("cost"), rounded("profit", 2).alias("profit"))


@register("expected_traffic", with_fixtures(f"""
SELECT date, store_id, customer_traffic,
       CAST(trunc(base * list_extract([{_DOW}], isodow(date)) * CASE WHEN is_holiday = 1 THEN 1.3 ELSE 1.0 END
                  * greatest(0.5, least(1.2, 1.0)) * (1 + 0.0)) AS BIGINT) AS expected_traffic
FROM (SELECT t.*, avg(customer_traffic) OVER (PARTITION BY store_id) AS base FROM rc_traffic_summary t)"""))
def q_expected_traffic(spark, sf_dir):
    t = rollups.traffic_summary(retail.customer_traffic(spark, sf_dir))
    base = t.groupBy("store_id").agg(F.avg("customer_traffic").alias("__base"))
    j = t.join(base, "store_id")
    exp = cal.expected_traffic(F.col("__base"), cal.day_of_week_factor(F.col("date")), F.col("is_holiday"),
                               F.lit(1.0), F.lit(0.0))
    return j.select("date", "store_id", "customer_traffic", exp.alias("expected_traffic"))


@register("densified_store_days", with_fixtures(f"""
SELECT c.date, c.store_id, {rnd('s.sales', 3)} AS sales, s.date IS NOT NULL AS observed
FROM (SELECT store_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
      FROM rc_store_days GROUP BY store_id) c
LEFT JOIN rc_store_days s USING (store_id, date)"""))
def q_densified_store_days(spark, sf_dir):
    sd = rollups.store_days(spark, sf_dir).select("date", "store_id", "sales")
    d = cal.densify(sd)
    return d.select("date", "store_id", rounded("sales", 3).alias("sales"), "observed")


@register("interaction_features", with_fixtures("""
SELECT date, store_id, product_id, category, store_id || '_' || category AS store_id_category_interaction
FROM rc_daily_base"""))
def q_interaction_features(spark, sf_dir):
    d = rollups.daily_sales(retail.sales(spark, sf_dir)).select("date", "store_id", "product_id", "category")
    return cal.interaction_features(d, ["store_id", "category"])


# ---------------------------------------------------------- trained models --
@register("model_training_metrics")
def q_model_training_metrics(spark, sf_dir):
    res = models.train_all(feature_split(spark, sf_dir))
    m = res["metrics"]
    return m.select("model", "split", "rmse", "mae", "mape", "r2", "n")


@register("model_importances")
def q_model_importances(spark, sf_dir):
    res = models.train_all(feature_split(spark, sf_dir))
    from retailcast.operators import report
    return report.top_features(res["importances"], 20)


@register("recursive_forecast")
def q_recursive_forecast(spark, sf_dir):
    sd = rollups.store_days(spark, sf_dir, checkpoint=True).select("date", "store_id", "sales")
    return models.recursive_forecast(sd)


@register("trailing_mean_forecast", with_fixtures(f"""
SELECT store_id, date, step, {rnd('prediction', 3)} AS prediction FROM rc_steps WHERE step > 0""", """
rc_steps AS (
  WITH RECURSIVE r AS (
    SELECT store_id, max(date) AS date, 0 AS step, list(sales ORDER BY date) AS tail, CAST(NULL AS DOUBLE) AS prediction
    FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY date DESC) AS rn FROM rc_store_days)
    WHERE rn <= 7 GROUP BY store_id
    UNION ALL
    SELECT store_id, date + 1, step + 1, list_append(CASE WHEN len(tail) >= 7 THEN tail[2:] ELSE tail END, list_avg(tail)), list_avg(tail)
    FROM r WHERE step < 30)
  SELECT * FROM r)"""))
def q_trailing_mean_forecast(spark, sf_dir):
    sd = rollups.store_days(spark, sf_dir).select("date", "store_id", "sales")
    return present(models.trailing_mean_forecast(sd), 3)


# ------------------------------------------------- counts, reports, files --
@register("category_counts", with_fixtures("SELECT category, count(*) AS count FROM rc_sales GROUP BY category"))
def q_category_counts(spark, sf_dir):
    return encode.value_counts(retail.sales(spark, sf_dir), "category")


@register("category_means", with_fixtures(
    f"SELECT category, {rnd('avg(revenue)', 4)} AS mean_revenue FROM rc_sales GROUP BY category"))
def q_category_means(spark, sf_dir):
    return present(encode.mean_by(retail.sales(spark, sf_dir), "category", "revenue"), 4)


@register("joined_actuals", with_fixtures(f"""
SELECT p.model, p.date, p.store_id, {rnd('p.prediction', 3)} AS prediction, {rnd('s.sales', 3)} AS actual
FROM rc_all_preds p JOIN rc_store_days s ON s.date = p.date AND s.store_id = p.store_id WHERE split = 'test'""", EVAL_CTES))
def q_joined_actuals(spark, sf_dir):
    preds = all_predictions(spark, sf_dir).where(F.col("split") == "test").select("model", "date", "store_id", "prediction")
    out = evaluation.join_actuals(rollups.store_days(spark, sf_dir), preds)
    return present(out.select("model", "date", "store_id", "prediction", "actual"), 3)


@register("performance_report", with_fixtures(f"""
SELECT m.model, {rnd('m.rmse', 3)} AS rmse, {rnd('m.mae', 3)} AS mae, {rnd('m.mape', 6)} AS mape, {rnd('m.r2', 6)} AS r2, m.n,
       r.average_rank, s.first_date, s.last_date
FROM rc_test_metrics m
JOIN (SELECT model, sum(rk) / 4.0 AS average_rank FROM (
        SELECT model, rank() OVER (PARTITION BY metric ORDER BY CASE WHEN metric = 'r2' THEN -value ELSE value END) AS rk
        FROM rc_test_long) GROUP BY model) r USING (model)
JOIN (SELECT model, min(date) AS first_date, max(date) AS last_date FROM rc_all_preds WHERE split = 'test' GROUP BY model) s
  USING (model)""", EVAL_CTES))
def q_performance_report(spark, sf_dir):
    r = report.performance_report(all_predictions(spark, sf_dir))
    return r.select("model", rounded("rmse", 3).alias("rmse"), rounded("mae", 3).alias("mae"), rounded("mape", 6).alias("mape"),
                    rounded("r2", 6).alias("r2"), "n", "average_rank", "first_date", "last_date")


@register("line_file_checks", """
SELECT 'lineitem.parquet' AS file, count(*) AS rows, min(l_quantity) AS min_quantity, min(l_extendedprice) AS min_revenue,
       count(CASE WHEN l_quantity < 0 THEN 1 END) AS negative_quantity,
       count(CASE WHEN l_extendedprice < 0 THEN 1 END) AS negative_revenue FROM lineitem""")
def q_line_file_checks(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem", ["l_quantity", "l_extendedprice"])
    per = validate.per_file_checks(lines, "l_quantity", "l_extendedprice")
    return per.withColumn("file", F.element_at(F.split("file", "/"), -1))


def _fresh(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("partitioned_round_trip", with_fixtures(f"""
SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, count(*) AS n, {rnd('sum(sales)', 2)} AS sales
FROM rc_store_days GROUP BY 1, 2"""))
def q_partitioned_round_trip(spark, sf_dir):
    """Store-days written to folders by year and month, then read back."""
    root = _fresh(spark, "daily")
    files.write_partitioned(rollups.store_days(spark, sf_dir), root, by=("year", "month"))
    back = files.require_rows(spark.read.parquet(root), root)
    return back.groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), rounded(F.sum("sales"), 2).alias("sales"))


@register("weekly_snapshot", with_fixtures(f"""
SELECT CAST(year(date) AS INTEGER) AS year, CAST(weekofyear(date) AS INTEGER) AS week, count(*) AS n, {rnd('sum(sales)', 2)} AS sales
FROM rc_store_days WHERE isodow(date) = 7 GROUP BY 1, 2"""))
def q_weekly_snapshot(spark, sf_dir):
    """The Sundays of the store-days written by year and week, then read back."""
    root = _fresh(spark, "weekly")
    files.write_weekly_snapshot(rollups.store_days(spark, sf_dir), root)
    return spark.read.parquet(root).groupBy("year", "week").agg(F.count(F.lit(1)).alias("n"), rounded(F.sum("sales"), 2).alias("sales"))


def _logged_runs(spark, sf_dir):
    """A ledger with one run per model, its test metrics as keys."""
    root = _fresh(spark, "ledger")
    long = materialize(test_metrics_long(spark, sf_dir))
    for model in (*evaluation.BASELINES, "ensemble"):
        ledger.log_run(spark, root, model, {"model": model}, long.where(F.col("model") == model).select(F.col("metric").alias("key"), "value"))
    return root


@register("ledger_run_view", with_fixtures(
    "SELECT model AS run_id, " + ", ".join(f"{rnd(f'max(CASE WHEN metric = {chr(39)}{k}{chr(39)} THEN value END)', 6)} AS {k}"
                                           for k in ("rmse", "mae", "mape", "r2")) + " FROM rc_test_long GROUP BY model", EVAL_CTES))
def q_ledger_run_view(spark, sf_dir):
    return present(ledger.run_view(spark, _logged_runs(spark, sf_dir), ["rmse", "mae", "mape", "r2"]), 6)


@register("ledger_best_run", with_fixtures(f"""
SELECT model AS run_id, 'rmse' AS key, {rnd('value', 6)} AS value FROM rc_test_long WHERE metric = 'rmse'
ORDER BY rc_test_long.value, model LIMIT 1""", EVAL_CTES))
def q_ledger_best_run(spark, sf_dir):
    return present(ledger.best_run(spark, _logged_runs(spark, sf_dir), "rmse").select("run_id", "key", "value"), 6)

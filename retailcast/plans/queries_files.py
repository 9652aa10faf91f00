"""Registered queries: files and footers, samples, snapshots, versions, completeness, recommendations, bounds."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailcast.operators import completeness, ledger, models, recommend, rollups, validate
from retailcast.operators import diagnostics as diag
from retailcast.plans import sql_features as sqlf
from retailcast.plans.oracle_sql import with_fixtures
from retailcast.plans.queries_diag import FEAT_CTES, _corr_sql, feature_split
from retailcast.plans.queries_eval import EVAL_CTES, SPLIT_CTES, all_predictions, store_split, test_metrics_long
from retailcast.plans.registry import present, register, rnd, rounded
from retailcast.session import ensure_checkpoint_dir
from retailcast.sources import commit_log, files, footers
from retailcast.sources.tables import SCHEMAS, read_table

# date columns of the driver tables, for footers
DATE_COLUMNS = ("l_shipdate", "o_orderdate", "ts")
_DATES = T.StructType([f for t in ("lineitem", "orders", "events") for f in SCHEMAS[t].fields if f.name in DATE_COLUMNS])


def fresh(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------- footers (A7, K1) --
_TABLES = {"region": None, "nation": None, "customer": None, "supplier": None, "part": None, "orders": "o_orderdate", "lineitem": "l_shipdate",
           "events": "ts", "documents": None, "embeddings": None, "pages": None, "benchmark": None, "labels": None, "conversations": None}


@register("file_manifest", " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, count(*) AS n_rows, {f'CAST(min({c}) AS DATE)' if c else 'CAST(NULL AS DATE)'} AS first_date, "
    f"{f'CAST(max({c}) AS DATE)' if c else 'CAST(NULL AS DATE)'} AS last_date, 0 AS bad_files FROM {t}" for t, c in _TABLES.items()))
def q_file_manifest(spark, sf_dir):
    """Rows, date range and bad files of every table, from the footers of its files."""
    return footers.manifest(spark, sf_dir, DATE_COLUMNS, _DATES).select("dataset", "n_rows", "first_date", "last_date", "bad_files")


@register("report_data_summary", """
SELECT (SELECT count(*) FROM lineitem) AS total_rows, 0 AS bad_files,
       (SELECT count(*) FROM (SELECT 1 FROM lineitem HAVING count(CASE WHEN l_quantity = 0 THEN 1 END) > 0
        UNION ALL SELECT 1 FROM lineitem HAVING count(CASE WHEN l_discount >= 0.09 THEN 1 END) > 0)) AS issues_found""")
def q_report_data_summary(spark, sf_dir):
    return _line_summary(spark, sf_dir).select("total_rows", "bad_files", "issues_found")


def _line_summary(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem", ["l_quantity", "l_discount"])
    checks = validate.value_checks(lines, {"zero_quantity": F.col("l_quantity") == 0, "deep_discount": F.col("l_discount") >= 0.09}, "lineitem")
    issues = checks.where("n_failed > 0").select(F.col("check").alias("issue"), F.col("n_failed").cast("string").alias("detail"))
    facts = footers.read_footers(spark, f"{sf_dir}/lineitem.parquet", DATE_COLUMNS, schema=_DATES)
    return validate.data_summary(facts, issues)


# ---------------------------------------------------- samples, quarantine (A2, A3) --
_MONTHS = "SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, count(*) AS n, {total} AS sales FROM rc_store_days GROUP BY 1, 2"


def _monthly(spark, sf_dir):
    root = fresh(spark, "monthly")
    sd = rollups.store_days(spark, sf_dir).where("date is not null")
    files.write_partitioned(sd, root, by=("year", "month"))
    return root, sd.schema


@register("sampled_files", with_fixtures(f"""
SELECT * FROM ({_MONTHS.format(total=rnd('sum(sales)', 2))}) ORDER BY year, month LIMIT 5"""))
def q_sampled_files(spark, sf_dir):
    """Store-days written by month; a scan of the first five files in path order."""
    root, schema = _monthly(spark, sf_dir)
    some = files.read_sample(spark, root, 5, schema)
    return some.groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), rounded(F.sum("sales"), 2).alias("sales"))


@register("tolerant_load", with_fixtures(f"""
SELECT count(*) AS n, {rnd('sum(sales)', 2)} AS sales, count(DISTINCT year(date) * 12 + month(date)) AS files_read, 0 AS files_skipped
FROM rc_store_days WHERE date IS NOT NULL"""))
def q_tolerant_load(spark, sf_dir):
    """Store-days by month, loaded with a report of read and skipped files."""
    root, schema = _monthly(spark, sf_dir)
    rows, report = files.tolerant_load(spark, root, schema, fresh(spark, "loaded"))
    read = report.agg(F.count_if(F.col("status") == "read").alias("files_read"), F.count_if(F.col("status") == "skipped").alias("files_skipped"))
    return rows.agg(F.count("*").alias("n"), rounded(F.sum("sales"), 2).alias("sales")).crossJoin(read)  # one row each


# ------------------------------------------------------- commit log (A8, J4, F5) --
@register("snapshot_table", with_fixtures(f"""
SELECT number, count(*) AS n, {rnd('sum(sales)', 2)} AS sales FROM (
  SELECT unnest([1, 2, 3]) AS number, * FROM rc_split)
WHERE split = CASE number WHEN 1 THEN 'train' WHEN 2 THEN 'validation' ELSE split END AND (number < 3 OR split <> 'train')
GROUP BY number""", SPLIT_CTES))
def q_snapshot_table(spark, sf_dir):
    """A table replaced by the validation rows and extended by the test rows, read at each of its three commits."""
    root, rows = fresh(spark, "snapshots"), store_split(spark, sf_dir)
    part = lambda name: rows.where(F.col("split") == name).select("date", "store_id", "sales")
    numbers = [commit_log.write_snapshot(part("train"), root), commit_log.write_snapshot(part("validation"), root),
               commit_log.write_snapshot(part("test"), root, append=True)]
    out = [commit_log.read_snapshot(spark, root, n).agg(F.lit(n).alias("number"), F.count("*").alias("n"), rounded(F.sum("sales"), 2).alias("sales"))
           for n in numbers]
    return out[0].unionByName(out[1]).unionByName(out[2])


@register("latest_versions", with_fixtures("""
SELECT model AS model_name, row_number() OVER (PARTITION BY 1 ORDER BY model) AS version, model AS run_id,
       CASE WHEN row_number() OVER (ORDER BY model) = count(*) OVER () THEN 'Production' ELSE 'None' END AS stage
FROM (SELECT DISTINCT model FROM rc_test_long) ORDER BY model DESC LIMIT 1""", EVAL_CTES).replace("SELECT model AS model_name", "SELECT 'sales' AS model_name"))
def q_latest_versions(spark, sf_dir):
    """Every model of the test metrics registered as a version in name order, the last one promoted."""
    root = fresh(spark, "versions")
    names = [r["model"] for r in test_metrics_long(spark, sf_dir).select("model").distinct().orderBy("model").collect()]  # four models
    for name in names:
        ledger.register_version(spark, root, "sales", name)
    ledger.set_stage(spark, root, "sales", len(names), "Production")
    return ledger.latest_version(spark, root, "sales", stage="Production")


# --------------------------------------------------------- completeness (J8, C10) --
_EXPECTED = """SELECT DISTINCT 'year=' || year(o_orderdate) || '/month=' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || '/' AS name FROM orders"""
_LISTED = """SELECT DISTINCT 'year=' || year(date) || '/month=' || lpad(CAST(month(date) AS VARCHAR), 2, '0') || '/' AS name
FROM rc_store_days WHERE month(date) <= 6"""


@register("artifact_completeness", with_fixtures(f"""
SELECT (SELECT count(*) FROM ({_LISTED})) AS listed, count(*) AS expected, count(l.name) AS found, count(*) - count(l.name) AS missing,
       count(*) = count(l.name) AS success
FROM ({_EXPECTED}) e LEFT JOIN ({_LISTED}) l USING (name)"""))
def q_artifact_completeness(spark, sf_dir):
    """Folders of the first half-years of the store-days against the months of the orders."""
    return _artifacts(spark, sf_dir)[0]


@register("artifact_items", with_fixtures(f"""
SELECT e.name, l.name IS NOT NULL AS found FROM ({_EXPECTED}) e LEFT JOIN ({_LISTED}) l USING (name)"""))
def q_artifact_items(spark, sf_dir):
    return _artifacts(spark, sf_dir)[1]


def _artifacts(spark, sf_dir):
    root = fresh(spark, "artifacts")
    files.write_partitioned(rollups.store_days(spark, sf_dir).where(F.month("date") <= 6), root, by=("year", "month"))
    months = read_table(spark, sf_dir, "orders", ["o_orderdate"]).select(
        F.concat(F.lit("year="), F.year("o_orderdate"), F.lit("/month="), F.lpad(F.month("o_orderdate").cast("string"), 2, "0"), F.lit("/")).alias("name"))
    return completeness.artifact_check(spark, root, months.distinct(), "*.parquet")


# ----------------------------------------------------- recommendations (J7), bounds (C4) --
def _rule_sql() -> str:
    quote = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)
    return "VALUES " + ", ".join("(" + ", ".join(quote(v) for v in r) + ")" for r in recommend.RULES)


_SHOWN = "CASE unit WHEN 'percent' THEN printf('%.1f%%', {v} * 100) ELSE printf('%.0f', {v}) END"


@register("recommendations", with_fixtures(f"""
SELECT "check", severity, {rnd('value', 6)} AS value, CAST(threshold AS DOUBLE) AS threshold,
       replace(replace(text, '{{value}}', {_SHOWN.format(v='value')}), '{{threshold}}', {_SHOWN.format(v='CAST(threshold AS DOUBLE)')}) AS text
FROM (
  SELECT 'mean_shift_' || split AS "check", abs((m - mt) / nullif(mt, 0)) AS value FROM (
    SELECT split, avg(sales) AS m, max(CASE WHEN split = 'train' THEN avg(sales) END) OVER () AS mt FROM rc_split GROUP BY split) WHERE split <> 'train'
  UNION ALL SELECT 'n_features', CAST({len(sqlf.FEATURE_COLUMNS) + 1} AS DOUBLE)
  UNION ALL SELECT 'high_correlation_features', CAST(count(CASE WHEN abs(correlation) > 0.95 THEN 1 END) AS DOUBLE)
    FROM ({_corr_sql('rc_fsplit', sqlf.FEATURE_COLUMNS, 'sales', "WHERE split = 'train'")})
  UNION ALL SELECT 'train_rows', CAST(count(*) AS DOUBLE) FROM rc_split WHERE split = 'train'
  UNION ALL SELECT 'zero_target_share', count(CASE WHEN sales = 0 THEN 1 END) / count(*) FROM rc_split WHERE split = 'train')
JOIN ({_rule_sql()}) AS r("check", comparison, threshold, severity, unit, text) USING ("check")
WHERE CASE comparison WHEN '>' THEN value > threshold WHEN '<' THEN value < threshold END""", FEAT_CTES))
def q_recommendations(spark, sf_dir):
    fs = feature_split(spark, sf_dir)
    train = fs.where(F.col("split") == "train")
    n = len([c for c in fs.columns if c not in ("date", "sales", "split", "row_index")])
    measured = diag.diagnosis_rules(diag.split_profile(store_split(spark, sf_dir), "sales"),
                                    diag.target_correlations(train, "sales", list(sqlf.FEATURE_COLUMNS)), train, "sales", n)
    out = recommend.recommendations(measured, recommend.rule_table(spark))
    return out.select("check", "severity", rounded("value", 6).alias("value"), "threshold", "text")


@register("given_bounds", with_fixtures(f"""
SELECT date, store_id, {rnd('prediction', 3)} AS prediction, {rnd('lo', 3)} AS prediction_lower, {rnd('hi', 3)} AS prediction_upper
FROM rc_all_preds LEFT JOIN (SELECT date, min(prediction) AS lo, max(prediction) AS hi FROM rc_all_preds
                             WHERE split = 'test' AND model <> 'ensemble' GROUP BY date) USING (date)
WHERE split = 'test' AND model = 'ensemble'""", EVAL_CTES))
def q_given_bounds(spark, sf_dir):
    """The ensemble's test predictions between bounds from a table of other predictions of the day."""
    test = all_predictions(spark, sf_dir).where(F.col("split") == "test")
    bounds = test.where(F.col("model") != "ensemble").select("date", F.col("prediction").alias("lower"), F.col("prediction").alias("upper"))
    out = models.with_bounds(test.where(F.col("model") == "ensemble"), bounds)
    return present(out.select("date", "store_id", "prediction", "prediction_lower", "prediction_upper"), 3)


# ------------------------------------------------------------------- F7, H19 --
@register("head_sample", with_fixtures(f"""
SELECT date, store_id, {rnd('sales', 2)} AS sales, quantity_sold FROM rc_store_days ORDER BY date, store_id LIMIT 5"""))
def q_head_sample(spark, sf_dir):
    sd = rollups.store_days(spark, sf_dir).select("date", "store_id", "sales", "quantity_sold")
    return present(validate.head_sample(sd, ["date", "store_id"], 5), 2)


@register("clean_parts", r"""
SELECT p_partkey, regexp_replace(p_name, '^\s+|\s+$', '', 'g') AS p_name, regexp_replace(p_type, '^\s+|\s+$', '', 'g') AS p_type,
       round(p_retailprice, 1) AS p_retailprice FROM part""")
def q_clean_parts(spark, sf_dir):
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_retailprice"])
    return validate.rounded_to(validate.stripped(part, ["p_name", "p_type"]), ["p_retailprice"], 1)

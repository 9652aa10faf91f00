"""Driver contract and a sample of registered queries against their DuckDB twins (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare_frames

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
SAMPLE = ["store_daily_sales", "daily_sales", "lag_features", "fill_compat", "chronological_split",
          "target_encoding", "model_metrics", "model_ranking", "rolling_metrics", "outlier_summary",
          "ks_drift", "thinned_series", "json_event_values", "promotion_calendar", "value_checks",
          "prediction_intervals", "residual_histogram", "date_features", "label_encoding", "qq_points",
          "trailing_mean_forecast", "performance_alerts", "line_file_checks", "partitioned_round_trip", "ledger_best_run"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["date", "store_id", "sales", "quantity_sold", "profit", "has_promotion",
                          "customer_traffic", "is_holiday"]
    assert df.count() > 0


def test_registry_consistent():
    q, sql = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 50


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_duckdb(spark, con, name):
    sdf = entry_mod.queries()[name](spark, SF_SMALL).toPandas()
    ddf = con.execute(entry_mod.oracle_sql()[name]).df()
    ok, msg = compare_frames(sdf, ddf)
    assert ok, msg

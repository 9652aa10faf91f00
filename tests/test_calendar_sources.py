import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from retailcast.functions import calendar as cal
from retailcast.sources import files, footers

D = dt.date


def test_holidays_2024_and_observed(spark):
    h = {r.date for r in cal.holiday_dimension(spark, (2021, 2024)).collect()}
    for d in [D(2024, 1, 1), D(2024, 1, 15), D(2024, 2, 19), D(2024, 5, 27), D(2024, 6, 19), D(2024, 7, 4),
              D(2024, 9, 2), D(2024, 10, 14), D(2024, 11, 11), D(2024, 11, 28), D(2024, 12, 25)]:
        assert d in h, d
    assert D(2021, 12, 31) in h        # 1 Jan 2022 is a Saturday
    assert D(2023, 1, 2) in h          # 1 Jan 2023 is a Sunday
    assert D(2021, 6, 18) in h         # Juneteenth 2021 on a Saturday
    assert D(2024, 3, 1) not in h


# written out by hand: (dates that are holidays, dates that are none)
@pytest.mark.parametrize("days, flag", [
    (["1870-12-25", "1900-07-04", "1970-12-25", "1969-05-30", "1965-02-22", "1950-11-11", "1939-11-23", "1940-11-21",
      "1938-11-24", "1975-10-27", "1993-12-24", "1994-12-26", "1999-12-31", "2004-12-31", "2010-12-31", "2022-06-20",
      "2026-07-03", "2100-12-25", "2105-11-26", "2150-09-07"], 1),
    (["1869-12-25", "1969-05-26", "1939-11-30", "1975-11-11", "1970-12-28", "1985-01-21", "2020-06-19", "2024-11-29",
      "2100-12-26", "2023-12-26", "2024-10-28"], 0)])
def test_holidays_by_rule_in_any_year(spark, days, flag):
    df = spark.createDataFrame([(D.fromisoformat(x),) for x in days], "date date")
    assert {str(r.date): r.is_holiday for r in cal.holiday_flag(df).collect()} == dict.fromkeys(days, flag)


def test_null_date_is_no_holiday(spark):
    assert cal.holiday_flag(spark.createDataFrame([(None,)], "date date")).first().is_holiday == 0


def test_date_parts_and_cyclical(spark):
    df = spark.createDataFrame([(D(2024, 1, 6),), (D(2024, 7, 4),)], "date date")
    r = cal.cyclical_features(cal.date_parts(df), "date").orderBy("date").collect()
    assert (r[0].day_of_week, r[0].is_weekend, r[0].is_holiday, r[0].week_of_year) == (5, 1, 0, 1)
    assert (r[1].quarter, r[1].is_holiday, r[1].day_of_week) == (3, 1, 3)
    assert r[0].month_sin == pytest.approx(0.0) and r[0].month_cos == pytest.approx(1.0)


def test_demand_factors(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), "fitness", 0), (D(2024, 8, 5), "back_to_school", 0),
                                (D(2024, 3, 3), "holiday", 1), (D(2024, 3, 3), "all_year", 0)],
                               "date date, kind string, hol int")
    r = df.select(cal.seasonality_factor(F.col("date"), F.col("kind"), F.col("hol")).alias("s"),
                  cal.day_of_week_factor(F.col("date")).alias("w")).collect()
    assert [x.s for x in r] == [1.5, 1.4, 1.3, 1.0]
    assert r[0].w == 0.9 and r[2].w == 1.2
    q = spark.range(1).select(cal.expected_quantity(F.lit(10000), F.lit("medium"), F.lit(100.0), F.lit(1.0),
                                                    F.lit(0.1)).alias("q")).first().q
    assert q == int(10000 * 0.001 * 0.7 * 0.5 * 1.0 * 1.3)
    t = spark.range(1).select(cal.expected_traffic(F.lit(1000), F.lit(1.3), F.lit(1), F.lit(2.0),
                                                   F.lit(-0.3)).alias("t")).first().t
    assert t == int(1000 * 1.3 * 1.3 * 1.2 * 0.7)


def test_promotion_calendar(spark):
    p = cal.promotion_calendar(spark, F.lit(D(2024, 1, 1)), F.lit(D(2024, 12, 31))).toPandas()
    bf = sorted(p[p.promotion_type == "Black Friday"].date)
    assert bf[0] == D(2024, 11, 29) and len(bf) == 5
    assert len(p[p.promotion_type == "Christmas Sale"]) == 10
    clipped = cal.promotion_calendar(spark, F.lit(D(2024, 1, 1)), F.lit(D(2024, 12, 20))).toPandas()
    assert len(clipped[clipped.promotion_type == "Christmas Sale"]) == 6


def test_interactions_keep_nulls(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None)], "s string, c string")
    r = cal.interaction_features(df, ["s", "c"]).orderBy("s").collect()
    assert r[0].s_c_interaction == "a_x" and r[1].s_c_interaction is None


def test_densify(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 1), 1.0), ("a", D(2024, 1, 4), 2.0)],
                               "store_id string, date date, sales double")
    d = cal.densify(df).orderBy("date").collect()
    assert [x.observed for x in d] == [True, False, False, True]


def test_writers_listing_and_tolerant_read(spark, tmpdir_path):
    df = spark.createDataFrame([(D(2024, 1, 1), "a", 1.0), (D(2024, 1, 7), "b", 2.0), (D(2024, 1, 8), "a", 3.0)],
                               "date date, store_id string, sales double")
    root = os.path.join(tmpdir_path, "sales")
    files.write_partitioned(df, root)
    assert os.path.isdir(os.path.join(root, "year=2024", "month=01", "day=07"))
    # a zero-byte and a corrupt file are skipped by the tolerant scan
    bad = os.path.join(root, "year=2024", "month=01", "day=09")
    os.makedirs(bad)
    open(os.path.join(bad, "empty.parquet"), "wb").close()
    with open(os.path.join(bad, "junk.parquet"), "wb") as f:
        f.write(b"not parquet at all")
    back = files.read_parquet_tolerant(spark, root)
    assert back.count() == 3
    assert back.where(F.col("day") == 8).count() == 1
    listed = {os.path.basename(r.path) for r in files.list_files(spark, root, "*.parquet").collect()}
    assert "junk.parquet" in listed and "empty.parquet" not in listed
    snap = os.path.join(tmpdir_path, "inventory")
    files.write_weekly_snapshot(df, snap)
    assert spark.read.parquet(snap).count() == 1  # 7 Jan 2024 is the only Sunday
    man = footers.manifest(spark, tmpdir_path).toPandas().set_index("dataset")
    assert man.loc["sales", "n_files"] >= 3
    s = footers.manifest_summary(footers.manifest(spark, tmpdir_path)).first()
    assert s.file_counts["sales"] == man.loc["sales", "n_files"]

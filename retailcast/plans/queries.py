"""Registered queries (imported for their side effect of filling REGISTRY)."""

from __future__ import annotations

from pyspark.sql import functions as F

from retailcast.operators import rollups
from retailcast.plans.oracle_sql import with_fixtures
from retailcast.plans.registry import present, register, rnd, rounded
from retailcast.sources import retail


# ---------------------------------------------------------------- roll-ups --
@register("store_daily_sales", with_fixtures(f"""
SELECT date, store_id, {rnd('sales', 2)} AS sales, quantity_sold, {rnd('profit', 2)} AS profit,
       {rnd('has_promotion', 6)} AS has_promotion, customer_traffic, is_holiday
FROM rc_store_days"""))
def q_store_daily_sales(spark, sf_dir):
    sd = rollups.store_days(spark, sf_dir)
    return sd.select("date", "store_id", rounded("sales", 2).alias("sales"), "quantity_sold",
                     rounded("profit", 2).alias("profit"), rounded("has_promotion", 6).alias("has_promotion"),
                     "customer_traffic", "is_holiday")


@register("daily_sales", with_fixtures(f"""
SELECT date, store_id, product_id, category, quantity_sold, {rnd('sales', 2)} AS sales,
       {rnd('cost', 2)} AS cost, {rnd('profit', 2)} AS profit,
       {rnd('discount_percent', 6)} AS discount_percent, {rnd('unit_price', 4)} AS unit_price,
       has_promotion, customer_traffic, is_holiday
FROM rc_daily"""))
def q_daily_sales(spark, sf_dir):
    d = rollups.enriched_daily_sales(spark, sf_dir)
    return d.select("date", "store_id", "product_id", "category", "quantity_sold",
                    rounded("sales", 2).alias("sales"), rounded("cost", 2).alias("cost"),
                    rounded("profit", 2).alias("profit"),
                    rounded("discount_percent", 6).alias("discount_percent"),
                    rounded("unit_price", 4).alias("unit_price"),
                    "has_promotion", "customer_traffic", "is_holiday")


@register("promotion_summary", with_fixtures(f"""
SELECT date, product_id, {rnd('discount_percent', 6)} AS discount_percent, has_promotion
FROM rc_promo_summary"""))
def q_promotion_summary(spark, sf_dir):
    p = rollups.promotion_summary(retail.promotions(spark, sf_dir))
    return present(p.select("date", "product_id", "discount_percent", "has_promotion"), 6)


@register("traffic_summary", with_fixtures("""
SELECT date, store_id, customer_traffic, is_holiday FROM rc_traffic_summary"""))
def q_traffic_summary(spark, sf_dir):
    return rollups.traffic_summary(retail.customer_traffic(spark, sf_dir))


# ---------------------------------------------------------------- features --
from retailcast.functions import calendar as cal  # noqa: E402
from retailcast.operators import features as feat  # noqa: E402
from retailcast.plans import sql_features as sqlf  # noqa: E402


def _lag_sql():
    cols = ",\n  ".join(f"{rnd(e, 6)} AS {n}" for n, e in sqlf.lag_exprs("sales").items())
    return with_fixtures(f"SELECT date, store_id, {rnd('sales', 6)} AS sales,\n  {cols}\nFROM rc_store_days")


@register("lag_features", _lag_sql())
def q_lag_features(spark, sf_dir):
    sd = rollups.store_days(spark, sf_dir).select("date", "store_id", "sales")
    return present(feat.lag_features(sd, "sales", ["store_id"]), 6)


def _rolling_sql():
    cols = ",\n  ".join(f"{rnd(e, 3)} AS {n}" for n, e in sqlf.rolling_exprs("sales").items())
    return with_fixtures(f"SELECT date, store_id, {rnd('sales', 3)} AS sales,\n  {cols}\nFROM rc_store_days")


@register("rolling_features", _rolling_sql())
def q_rolling_features(spark, sf_dir):
    sd = rollups.store_days(spark, sf_dir).select("date", "store_id", "sales")
    return present(feat.rolling_features(sd, "sales", ["store_id"]), 3)


@register("date_features", with_fixtures(
    "SELECT date, store_id, " + ", ".join(f"{e} AS {n}" for n, e in sqlf.DATE_PART_SQL.items()) +
    " FROM rc_store_days"))
def q_date_features(spark, sf_dir):
    sd = rollups.store_days(spark, sf_dir).select("date", "store_id")
    return cal.date_parts(sd, "date")


@register("cyclical_features", with_fixtures(
    "SELECT date, store_id, " + ", ".join(f"{rnd(e, 6)} AS {n}" for n, e in sqlf.CYCLICAL_SQL.items()) +
    " FROM rc_store_days"))
def q_cyclical_features(spark, sf_dir):
    sd = rollups.store_days(spark, sf_dir).select("date", "store_id")
    return present(cal.cyclical_features(sd, "date"), 6)


def _feature_frame(spark, sf_dir, compat):
    sd = rollups.store_days(spark, sf_dir).drop("is_holiday")
    f = feat.create_all_features(sd, "sales", "date", ["store_id"], ["store_id"], compat_fill=compat,
                                 checkpoint=True)
    doubles = [c for c, t in f.dtypes if t == "double"]
    cyc = {"month_sin", "month_cos", "day_sin", "day_cos", "day_of_week_sin", "day_of_week_cos"}
    return f.select(*[rounded(c, 6 if c in cyc else 3).alias(c) if c in doubles else F.col(c)
                      for c in f.columns])


@register("fill_grouped", with_fixtures(sqlf.feature_frame_sql(False)[1], sqlf.feature_frame_sql(False)[0]))
def q_fill_grouped(spark, sf_dir):
    return _feature_frame(spark, sf_dir, False)


@register("fill_compat", with_fixtures(sqlf.feature_frame_sql(True)[1], sqlf.feature_frame_sql(True)[0]))
def q_fill_compat(spark, sf_dir):
    return _feature_frame(spark, sf_dir, True)

"""Roll-ups of line-level sales to product-day and store-day grain.

Physical plan notes (see tests/test_plans.py):
* The lines are scanned once.  The promotion flag of a (date, product) comes from the deepest
  discount, which the product-day aggregate carries along; a window over the product-days
  spreads it, so the lines meet no promotion table.
* The product-day and store-day aggregates pre-aggregate on the map side, so a product or a
  store with a third of all rows is merged before its shuffle.
* The traffic summary is store-day grain (calendar x stores); AQE broadcasts
  it when its measured size is under the broadcast threshold and otherwise
  keeps a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DAILY_KEYS = ["date", "store_id", "product_id", "category"]


def daily_sales(sales: DataFrame, promotion_min: float | None = None) -> DataFrame:
    """Sum quantity, revenue (as ``sales``), cost, profit; mean discount and unit price.

    With ``promotion_min`` also ``has_promotion``: 1 if any line of the (date, product), in any
    store, has at least that discount.
    """
    aggs = [F.sum("quantity_sold").alias("quantity_sold"), F.sum("revenue").alias("sales"), F.sum("cost").alias("cost"),
            F.sum("profit").alias("profit"), F.avg("discount_percent").alias("discount_percent"),
            F.avg("unit_price").alias("unit_price")]
    if promotion_min is None:
        return sales.groupBy(*DAILY_KEYS).agg(*aggs)
    daily = sales.groupBy(*DAILY_KEYS).agg(*aggs, F.max("discount_percent").alias("__deepest"))
    deepest = F.max("__deepest").over(Window.partitionBy("date", "product_id"))
    return daily.withColumn("has_promotion", F.coalesce(deepest >= promotion_min, F.lit(False)).cast("tinyint")).drop("__deepest")


def promotion_summary(promotions: DataFrame) -> DataFrame:
    """One row per promoted (date, product): deepest discount and flag 1."""
    return (promotions.groupBy("date", "product_id")
                      .agg(F.max("discount_percent").alias("discount_percent"))
                      .withColumn("has_promotion", F.lit(1).cast("tinyint")))


def traffic_summary(traffic: DataFrame) -> DataFrame:
    """Per (date, store): total traffic and whether any row is a holiday."""
    return (traffic.groupBy("date", "store_id")
                   .agg(F.sum("customer_traffic").alias("customer_traffic"),
                        F.max("is_holiday").alias("is_holiday")))


def with_promotion_flag(daily: DataFrame, promo_summary: DataFrame) -> DataFrame:
    """Left join the promotion flag on (date, product_id); no promotion -> 0."""
    p = promo_summary.select("date", "product_id", "has_promotion")
    return (daily.join(p, ["date", "product_id"], "left")
                 .withColumn("has_promotion", F.coalesce("has_promotion", F.lit(0).cast("tinyint"))))


def with_traffic(daily: DataFrame, traffic_sum: DataFrame) -> DataFrame:
    """Left join traffic on (date, store_id); days without traffic stay null."""
    return daily.join(traffic_sum, ["date", "store_id"], "left")


def store_daily_sales(daily: DataFrame) -> DataFrame:
    """Store-day roll-up: sums, promotion share, traffic and holiday flag.

    Traffic and holiday are constant inside a (date, store) group after the
    traffic join, so ``max`` returns that value deterministically.
    """
    return (daily.groupBy("date", "store_id")
                 .agg(F.sum("sales").alias("sales"),
                      F.sum("quantity_sold").alias("quantity_sold"),
                      F.sum("profit").alias("profit"),
                      F.avg("has_promotion").alias("has_promotion"),
                      F.max("customer_traffic").alias("customer_traffic"),
                      F.max("is_holiday").alias("is_holiday")))


def enriched_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product-day sales with promotion flag and store traffic (D1 + C1 + D3 + C2)."""
    from retailcast.sources.retail import PROMOTION_MIN_DISCOUNT, customer_traffic, sales

    daily = daily_sales(sales(spark, sf_dir), PROMOTION_MIN_DISCOUNT)
    return with_traffic(daily, traffic_summary(customer_traffic(spark, sf_dir)))


def store_days(spark: SparkSession, sf_dir: str, checkpoint: bool = False) -> DataFrame:
    """The training frame: one row per (date, store).

    Its size is bounded by stores x days, whatever the volume of sales lines.
    With ``checkpoint`` it is written once to the shared checkpoint folder, so
    the many passes of split, quantiles and metrics read that small table
    instead of re-running the scan, joins and roll-ups (and survive the loss of
    an executor without recomputing them).
    """
    sd = store_daily_sales(enriched_daily_sales(spark, sf_dir))
    if checkpoint:
        from retailcast.operators.features import materialize
        sd = materialize(sd)
    return sd

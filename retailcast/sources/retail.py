"""Retail inputs (sales, promotions, customer traffic) derived from the driver tables.

Mapping (one row of ``sales`` per lineitem):
  date = ship date, store = supplier nation, product = part key,
  category = part type, revenue = extended price net of discount,
  cost = 70 % of extended price, profit = revenue - cost.
Promotions are the discounted sales lines; traffic counts orders per
customer nation and day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailcast.functions.calendar import holiday_flag
from retailcast.sources.tables import read_table

# --- fixed values of the mapping ---------------------------------------------
COST_RATIO = 0.7
PROMOTION_MIN_DISCOUNT = 0.09
PROMOTION_TYPE = "Discount"
UNKNOWN = "unknown"
# -----------------------------------------------------------------------------


def sales(spark: SparkSession, sf_dir: str, every_line: bool = False) -> DataFrame:
    """Line-level sales with the retail column names; keeps quantity > 0 unless ``every_line``.

    A line whose supplier or part is not listed belongs to the store or category ``unknown``.
    """
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"])
    sup = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_type"])
    # Dimension joins: Spark picks broadcast from file statistics when a side is
    # under spark.sql.autoBroadcastJoinThreshold and a shuffle join otherwise,
    # and AQE re-decides from the measured size at runtime.
    if not every_line:
        li = li.where(F.col("l_quantity") > 0)
    joined = (li.join(sup, li.l_suppkey == sup.s_suppkey, "left")
                .join(part, li.l_partkey == part.p_partkey, "left"))
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    cost = F.col("l_extendedprice") * F.lit(COST_RATIO)
    return (joined
            .select(F.to_date("l_shipdate").alias("date"),
                    F.coalesce(F.col("s_nationkey").cast("string"), F.lit(UNKNOWN)).alias("store_id"),
                    F.col("l_partkey").cast("string").alias("product_id"),
                    F.coalesce("p_type", F.lit(UNKNOWN)).alias("category"),
                    F.col("l_quantity").cast("long").alias("quantity_sold"),
                    F.try_divide("l_extendedprice", "l_quantity").alias("unit_price"),
                    F.col("l_discount").alias("discount_percent"),
                    revenue.alias("revenue"),
                    cost.alias("cost"),
                    (revenue - cost).alias("profit")))


def promotions(spark: SparkSession, sf_dir: str, sales_df: DataFrame | None = None) -> DataFrame:
    """Promotion calendar: discounted (date, product) pairs with their deepest discount."""
    s = sales_df if sales_df is not None else sales(spark, sf_dir)
    return (s.where(F.col("discount_percent") >= PROMOTION_MIN_DISCOUNT)
             .groupBy("date", "product_id")
             .agg(F.max("discount_percent").alias("discount_percent"))
             .withColumn("promotion_type", F.lit(PROMOTION_TYPE)))


def customer_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily customer traffic per store (orders per customer nation and day)."""
    o = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    t = (o.join(c, o.o_custkey == c.c_custkey, "left")
          .groupBy(F.to_date("o_orderdate").alias("date"),
                   F.coalesce(F.col("c_nationkey").cast("string"), F.lit(UNKNOWN)).alias("store_id"))
          .agg(F.count(F.lit(1)).alias("customer_traffic")))
    return holiday_flag(t, "date", "is_holiday")

"""Two-sample Kolmogorov-Smirnov distance between two sets of values.

D = max_x |F1(x) - F2(x)|.  Values are pre-aggregated to (value, n1, n2) so
repeated values collapse; running counts use value ranges cut at sampled values
(range totals -> prefix sums over the ranges -> running sums inside each
range), so no single task sorts the whole sample, outliers or not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailcast.config import DRIFT_THRESHOLD
from retailcast.operators.features import materialize
from retailcast.operators.ordering import cut_bucket, range_cuts


def ks_statistic(a: DataFrame, b: DataFrame, col: str, threshold: float = DRIFT_THRESHOLD,
                 parts: int = 64) -> DataFrame:
    """One row: statistic, n1, n2, drift (statistic > threshold)."""
    x = F.col(col).cast("double")
    tagged = (a.select(x.alias("__x"), F.lit(1).alias("__a"), F.lit(0).alias("__b"))
               .unionByName(b.select(x.alias("__x"), F.lit(0).alias("__a"), F.lit(1).alias("__b")))
               .where(F.col("__x").isNotNull()))
    # read three times below: written once
    per_value = materialize(tagged.groupBy("__x").agg(F.sum("__a").alias("__na"), F.sum("__b").alias("__nb")))
    pv = per_value.withColumn("__bk", cut_bucket("__x", range_cuts(per_value, "__x", parts)))
    totals = pv.groupBy("__bk").agg(F.sum("__na").alias("__ta"), F.sum("__nb").alias("__tb"))
    # one row per range: the running totals before it and the totals of all
    before = Window.orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("__bk").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offs = totals.select("__bk", F.coalesce(F.sum("__ta").over(before), F.lit(0)).alias("__oa"),
                         F.coalesce(F.sum("__tb").over(before), F.lit(0)).alias("__ob"),
                         F.sum("__ta").over(every).alias("__n1"), F.sum("__tb").over(every).alias("__n2"))
    w = Window.partitionBy("__bk").orderBy("__x").rowsBetween(Window.unboundedPreceding, 0)
    cum = pv.join(offs, "__bk").select(
        "__n1", "__n2", F.try_divide(F.col("__oa") + F.sum("__na").over(w), F.col("__n1")).alias("__fa"),
        F.try_divide(F.col("__ob") + F.sum("__nb").over(w), F.col("__n2")).alias("__fb"))
    d = cum.agg(F.max(F.abs(F.col("__fa") - F.col("__fb"))).alias("statistic"),
                F.max("__n1").cast("long").alias("n1"), F.max("__n2").cast("long").alias("n2"))
    return d.select("statistic", "n1", "n2", (F.col("statistic") > threshold).alias("drift"))

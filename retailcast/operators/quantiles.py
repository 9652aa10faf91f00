"""Exact quantiles without gathering a group into one task.

``percentile`` keeps every distinct value of a group in one aggregation
buffer; a hot group would have to fit in one task's memory.  Here:

1. one aggregate per group gives n and, from ``percentile_approx`` (rank error
   <= n/accuracy), values ``lo``/``hi`` below and above each wanted rank; a group
   of up to ``SMALL`` rows takes its whole range instead;
2. each row meets its group's one row of brackets and is kept for the
   quantiles whose bracket holds it; kept rows are pre-aggregated to
   (value, count), so a value repeated a billion times is one row;
3. brackets are cut into slices with running totals, so that a hot bracket is
   sorted slice by slice, and the exact order statistics are interpolated linearly
   (the same definition as ``percentile`` / DuckDB ``quantile_cont``).

Null values are left out; rows with a null group are a group of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailcast.operators.features import materialize
from retailcast.operators.ordering import null_safe

ACCURACY = 10000
MARGIN = 4.0 / ACCURACY
SMALL = 20_000
SLICES = 64


def exact_quantiles(df: DataFrame, col: str, probs: list[float], group_cols: list[str] | None = None,
                    prefix: str = "q") -> DataFrame:
    """One row per group with columns ``{prefix}_{i}`` = linear quantile probs[i] of ``col``.

    The group and value columns are written once, since three passes read them.
    """
    g = list(group_cols or ["__all"])
    x = F.col(col)
    src = df if group_cols else df.withColumn("__all", F.lit(0))
    base = materialize(src.where(x.isNotNull()).select(*g, x.cast("double").alias("__x")))
    k = len(probs)
    approx = lambda ps: F.percentile_approx("__x", F.array(*[F.lit(p) for p in ps]), ACCURACY)
    stats = base.groupBy(*g).agg(F.count(F.lit(1)).alias("__n"), F.min("__x").alias("__mn"), F.max("__x").alias("__mx"),
                                 approx([max(0.0, p - MARGIN) for p in probs]).alias("__lo"),
                                 approx([min(1.0, p + MARGIN) for p in probs]).alias("__hi"))
    small = F.col("__n") <= SMALL
    stats = stats.select(*g, "__n", F.when(small, F.array_repeat("__mn", k)).otherwise(F.col("__lo")).alias("__lo"),
                         F.when(small, F.array_repeat("__mx", k)).otherwise(F.col("__hi")).alias("__hi"))
    j = null_safe(base, stats, g)
    below = j.groupBy(*g).agg(F.first("__n").alias("__n"), F.array(*[
        F.count_if(F.col("__x") < F.col("__lo")[i]) for i in range(k)]).alias("__below"))
    held = F.filter(F.sequence(F.lit(0), F.lit(k - 1)),
                    lambda i: (F.col("__x") >= F.col("__lo")[i]) & (F.col("__x") <= F.col("__hi")[i]))
    inside = j.select(*g, "__x", "__lo", "__hi", F.explode(held).alias("__i"))
    lo, hi = F.col("__lo")[F.col("__i")], F.col("__hi")[F.col("__i")]
    slice_ = F.when(hi > lo, F.least(F.floor((F.col("__x") - lo) / (hi - lo) * SLICES), F.lit(SLICES - 1))).otherwise(0)
    inside = inside.groupBy(*g, "__i", slice_.alias("__s"), "__x").agg(F.count(F.lit(1)).alias("__c"))
    totals = inside.groupBy(*g, "__i", "__s").agg(F.sum("__c").alias("__t"))
    before = Window.partitionBy(*g, "__i").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*g, "__i", "__s", F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__off"))
    run = Window.partitionBy(*g, "__i", "__s").orderBy("__x").rowsBetween(Window.unboundedPreceding, 0)
    cum = null_safe(inside.withColumn("__run", F.sum("__c").over(run)), totals, g + ["__i", "__s"])
    cum = null_safe(cum, below, g)
    h = (F.col("__n") - 1) * F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("__i") + 1)
    # rank (0-based) of the last copy of each value
    last_rank = F.col("__below")[F.col("__i")] + F.col("__off") + F.col("__run") - 1
    picked = cum.groupBy(*g, "__i").agg(
        F.min(F.when(last_rank >= F.floor(h), F.col("__x"))).alias("__v0"),
        F.min(F.when(last_rank >= F.floor(h) + 1, F.col("__x"))).alias("__v1"),
        F.first(h - F.floor(h)).alias("__frac"))
    val = F.when(F.col("__frac") == 0, F.col("__v0")).otherwise(
        F.col("__v0") + F.col("__frac") * (F.coalesce(F.col("__v1"), F.col("__v0")) - F.col("__v0")))
    wide = picked.select(*g, "__i", val.alias("__q")).groupBy(*g).agg(
        *[F.max(F.when(F.col("__i") == i, F.col("__q"))).alias(f"{prefix}_{i}") for i in range(k)])
    return wide if group_cols else wide.drop("__all")

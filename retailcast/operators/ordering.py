"""Positions in a global or per-group order without a single-partition window.

``row_index`` gives each row its 0-based position in ``order_cols`` order
(optionally restarting per ``group_cols``).  A plain ``row_number()`` over an
un-partitioned window would move every row into one task.  Instead:

1. count rows per (group, bucket), where bucket = the first order column
   (a date: bounded by the calendar, not by the data volume);
2. prefix-sum those counts per group - a window over the *counts* frame;
3. number rows inside each (group, bucket) and add the bucket's offset.

Only step 3 touches full rows, and it is partitioned by (group, bucket).
Null order values come last, null groups are a group of their own, and rows that
tie on all order columns are numbered by a hash of the whole row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

POS = "row_index"


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which null equals null; the keys come from the left side."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = [left[c].eqNullSafe(r[f"__r_{c}"]) for c in keys]
    joined = left.join(r, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__r_{c}" for c in keys])


def row_index(df: DataFrame, order_cols: list[str], group_cols: list[str] | None = None,
              out_col: str = POS, bucket_expr: Column | None = None) -> DataFrame:
    """0-based position in ``order_cols`` order (per ``group_cols`` if given).

    ``bucket_expr`` replaces the first order column as the bucket; it must be
    non-decreasing in the order (e.g. a coarse range bucket of a continuous
    value, so the counts frame stays small even when every value is distinct).
    """
    groups = list(group_cols or [])
    rest = list(order_cols) if bucket_expr is not None else list(order_cols[1:])
    ties = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    rows = df.withColumn("__bucket", bucket_expr if bucket_expr is not None else F.col(order_cols[0]))
    keys = groups + ["__bucket"]
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    bucket = F.col("__bucket").asc_nulls_last()
    cum = Window.partitionBy(*groups).orderBy(bucket) if groups else Window.orderBy(bucket)
    before = F.sum("__n").over(cum.rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(*keys, F.coalesce(before, F.lit(0)).alias("__off"))
    within = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in rest], F.xxhash64(*ties))
    return (null_safe(rows, offsets, keys, "left")
            .withColumn(out_col, F.col("__off") + F.row_number().over(within) - 1).drop("__off", "__bucket"))


SAMPLE_PER_CUT = 64


def range_cuts(rows: DataFrame, col: str, parts: int = 64) -> list:
    """Cut points that split the distinct values of ``col`` into about ``parts`` equal ranges.

    They come from a sample of at most 64 values per part, taken in hash order: bounded,
    the same on every run, and blind to prefixes or outliers.  Any sortable type.
    """
    some = rows.where(F.col(col).isNotNull()).select(col).distinct().orderBy(F.xxhash64(col)).limit(parts * SAMPLE_PER_CUT)
    values = sorted(r[0] for r in some.collect())
    return sorted({values[k * len(values) // parts] for k in range(1, parts)}) if len(values) >= parts else []


def cut_bucket(col: str | Column, cuts: list) -> Column:
    """How many cut points are at or below the value: an order-preserving bucket."""
    x = F.col(col) if isinstance(col, str) else col
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= x))


def thin_evenly(df: DataFrame, order_cols: list[str], points: int = 500,
                group_cols: list[str] | None = None) -> DataFrame:
    """Keep every row when n <= points, else rows at positions
    floor(i * ((n-1)/(points-1))), i = 0..points-1 (the last one is n-1).

    n is a per-group count (a scalar subquery when ungrouped); the chosen
    positions are generated with ``sequence`` and semi-joined to the row index,
    so nothing is collected and no group is sorted in one task.
    """
    group_cols = list(group_cols or [])
    idx = row_index(df, order_cols, group_cols)
    if group_cols:
        n = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("__n"))
        base = n.select(*group_cols, "__n", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("__i"))
        ncol = F.col("__n")
    else:
        ncol = df.select(F.count(F.lit(1))).scalar()
        base = df.sparkSession.range(points).select(F.col("id").alias("__i"))
    step = (ncol - 1).cast("double") / float(points - 1)
    pos = (F.when(F.col("__i") == points - 1, ncol - 1)
             .otherwise(F.floor(F.col("__i") * step))).cast("long")
    keep_all = null_safe(idx, n.where(F.col("__n") <= points).select(*group_cols), group_cols, "left_semi") \
        if group_cols else idx.where(ncol <= points)
    picks = base.where(ncol > points).select(*group_cols, pos.alias(POS))
    thinned = null_safe(idx, picks, group_cols + [POS], "left_semi")
    return keep_all.unionByName(thinned)

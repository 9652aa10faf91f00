"""Categorical and numeric encoders fitted on one frame and applied to others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailcast.config import TARGET_ENCODING_SMOOTHING
from retailcast.operators.features import materialize, scalar_row


def fit_label_codes(train: DataFrame, col: str) -> DataFrame:
    """(col, code): classes in ascending order, codes 0..k-1.

    Classes of any type are numbered with ``row_index`` over ranges cut at sampled
    classes, so millions of classes are ranked over many tasks, whatever prefix
    they share.
    """
    from retailcast.operators.ordering import cut_bucket, range_cuts, row_index

    classes = train.select(col).where(F.col(col).isNotNull()).distinct()
    code = f"{col}_code"
    idx = row_index(classes, [col], out_col=code, bucket_expr=cut_bucket(col, range_cuts(classes, col)))
    return idx.select(col, F.col(code).cast("int").alias(code))


def apply_label_codes(df: DataFrame, codes: DataFrame, col: str, replace: bool = True) -> DataFrame:
    """Replace ``col`` by its code; classes unseen when fitting get -1."""
    code = f"{col}_code"
    j = df.join(codes, col, "left").withColumn(code, F.coalesce(F.col(code), F.lit(-1)))
    return j.drop(col).withColumnRenamed(code, col) if replace else j


def fit_scaler(train: DataFrame, cols: list[str]):
    """Mean and population std of each column on ``train`` (zero std -> 1).

    Returns ``transform(df) -> DataFrame``; statistics are one row, joined once.
    """
    stats = train.agg(*[F.avg(c).alias(f"__m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"__s_{c}") for c in cols])

    def transform(df: DataFrame) -> DataFrame:
        # one row of statistics, joined once
        j = df.join(F.broadcast(stats))
        sd = {c: F.col(f"__s_{c}") for c in cols}
        out = {c: (F.col(c).cast("double") - F.col(f"__m_{c}")) /
               F.when(s.isNull() | (s == 0), F.lit(1.0)).otherwise(s) for c, s in sd.items()}
        return j.withColumns(out).drop(*[f"__m_{c}" for c in cols], *[f"__s_{c}" for c in cols])

    return transform


def fit_target_encoding(train: DataFrame, col: str, target: str,
                        smoothing: float = TARGET_ENCODING_SMOOTHING) -> tuple[DataFrame, object]:
    """Smoothed target mean per class: (n * mean_c + s * mean) / (n + s).

    Returns (per-class table, global-mean Column for unseen classes).  The classes' sums are written, one row
    per class, and give the global mean too: ``train`` is read once.
    """
    per = materialize(train.groupBy(col).agg(F.count(F.lit(1)).alias("__n"), F.avg(target).alias("__m"), F.count(target).alias("__k")))
    glob = scalar_row(per, [F.try_divide(F.sum(F.col("__m") * F.col("__k")), F.sum("__k"))])(0)
    enc = per.select(col, ((F.col("__n") * F.col("__m") + F.lit(smoothing) * glob)
                           / (F.col("__n") + F.lit(smoothing))).alias(f"{col}_target_encoded"))
    return enc, glob


def apply_target_encoding(df: DataFrame, enc: DataFrame, glob, col: str) -> DataFrame:
    name = f"{col}_target_encoded"
    return df.join(enc, col, "left").withColumn(name, F.coalesce(F.col(name), glob))


def target_encode(df: DataFrame, cols: list[str], target: str,
                  smoothing: float = TARGET_ENCODING_SMOOTHING) -> DataFrame:
    out = df
    for c in cols:
        enc, glob = fit_target_encoding(df, c, target, smoothing)
        out = apply_target_encoding(out, enc, glob, c)
    return out


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def mean_by(df: DataFrame, col: str, target: str) -> DataFrame:
    return df.groupBy(col).agg(F.avg(target).alias(f"mean_{target}"))

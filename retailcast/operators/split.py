"""Chronological train/validation/test split and expanding-window folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailcast.config import CV_FOLDS, TEST_SIZE, VALIDATION_SIZE
from retailcast.operators.ordering import POS, row_index

SPLIT = "split"


def chronological_split(df: DataFrame, order_cols: list[str], target: str | None = None,
                        test_size: float = TEST_SIZE, validation_size: float = VALIDATION_SIZE) -> DataFrame:
    """Tag rows train / validation / test by their position in ``order_cols`` order.

    train = first floor(n * (1 - test - validation)) rows, validation = the next
    floor(n * validation), test = the rest; rows with a null target are dropped
    after the cut.  n is a scalar subquery; positions come from ``row_index``
    (no single-partition sort).
    """
    idx = row_index(df, order_cols)
    n = df.select(F.count(F.lit(1))).scalar()
    train_frac = 1 - test_size - validation_size
    n_train = F.floor(n * F.lit(train_frac))
    n_val = F.floor(n * F.lit(validation_size))
    out = idx.withColumn(SPLIT, F.when(F.col(POS) < n_train, F.lit("train"))
                         .when(F.col(POS) < n_train + n_val, F.lit("validation"))
                         .otherwise(F.lit("test")))
    if target:
        out = out.where(F.col(target).isNotNull())
    return out


def expanding_folds(df: DataFrame, order_cols: list[str], folds: int = CV_FOLDS) -> DataFrame:
    """Time-series folds: fold i trains on everything before its test block.

    test block size = n // (folds + 1); fold i (0-based) tests rows
    [n - (folds - i) * size, n - (folds - i - 1) * size) and trains on all
    rows before that.  Output: input columns + fold, role (train/test); rows
    after a fold's test block are not part of that fold.
    """
    idx = row_index(df, order_cols)
    n = df.select(F.count(F.lit(1))).scalar()
    size = F.floor(n / F.lit(folds + 1))
    f = F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("fold")
    x = idx.select("*", f)
    start = n - (F.lit(folds) - F.col("fold")) * size
    role = F.when(F.col(POS) < start, F.lit("train")).when(F.col(POS) < start + size, F.lit("test"))
    return x.withColumn("role", role).where(F.col("role").isNotNull())

"""Expanding-window cross validation over one written frame.

Rows are numbered in time order once and written with ``block``: block 0 is only ever trained on, block
k (1..folds) is tested by fold k - 1, and fold f trains on all blocks up to f.  So a fold is a filter on a
folder column, no row is copied per fold, and later folds don't repeat the work of the frame.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailcast.config import CV_FOLDS, METRICS, MIN_ENSEMBLE_WEIGHT
from retailcast.operators import evaluation, metrics
from retailcast.operators.features import materialize
from retailcast.operators.models import FEATURES, Preprocessor, fit_forest
from retailcast.operators.ordering import POS, row_index
from retailcast.session import ensure_checkpoint_dir

BLOCK = "block"


def fold_frame(df: DataFrame, order_cols: list[str], folds: int = CV_FOLDS) -> DataFrame:
    """``df`` with its ``block``, written to folders by block and read back.

    Of n rows the last ``folds`` blocks hold n // (folds + 1) each, block 0 the rest.  Fewer rows than
    folds + 1 are all block 0, so no fold tests anything.
    """
    spark = df.sparkSession
    rows = materialize(df)
    size = rows.count() // (folds + 1)
    idx = row_index(rows, order_cols)
    # counted from the end: the last ``size`` rows are the last block
    last = F.lit(rows.count() - 1) - F.col(POS)
    block = F.greatest(F.lit(0).cast("long"), F.lit(folds) - F.floor(last / size)) if size else F.lit(0)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/folds-{uuid.uuid4().hex}"
    idx.withColumn(BLOCK, block.cast("int")).drop(POS).write.partitionBy(BLOCK).parquet(path)
    schema = idx.drop(POS).schema.add(BLOCK, "integer")
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def fold_bounds(frame: DataFrame, date_col: str = "date") -> DataFrame:
    """(fold, train_rows, test_rows, first_date, last_date) of the test blocks, one row per fold."""
    per = frame.groupBy(BLOCK).agg(F.count("*").alias("n"), F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"))
    before = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    rows = per.withColumn("train_rows", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return rows.where(F.col(BLOCK) > 0).select((F.col(BLOCK) - 1).alias("fold"), "train_rows", F.col("n").alias("test_rows"),
                                               "first_date", "last_date")


def train_r2(preds: DataFrame, folds: int) -> DataFrame:
    """(fold, model, r2) of long predictions with ``block``, over each fold's training rows.

    One aggregate per (block, model); a fold's sums are running totals over the blocks.
    """
    y, e = F.col("actual"), F.col("actual") - F.col("prediction")
    centre = preds.agg(F.avg("actual")).first()[0] or 0.0  # one number: keeps the sums of squares small
    sums = preds.groupBy(BLOCK, "model").agg(F.sum(e * e).alias("sse"), F.sum(y - centre).alias("s"), F.sum((y - centre) * (y - centre)).alias("q"),
                                             F.count(y).alias("n"))
    upto = Window.partitionBy("model").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, 0)
    run = sums.select(BLOCK, "model", *[F.sum(c).over(upto).alias(c) for c in ("sse", "s", "q", "n")])
    sst = F.greatest(F.col("q") - F.col("s") * F.col("s") / F.col("n"), F.lit(0.0))
    # a model without predictions in a block keeps the sums of the last block that has some
    last = F.max_by(F.struct("sse", sst.alias("sst")), BLOCK).alias("t")
    some = run.select("*", F.explode(F.sequence(F.col(BLOCK), F.lit(folds - 1))).alias("fold")).where(F.col(BLOCK) < folds)
    return some.groupBy("fold", "model").agg(last).select("fold", "model", metrics._r2(F.col("t.sse"), F.col("t.sst")).alias("r2"))


def fold_ensemble(preds: DataFrame, folds: int, keys: list[str], name: str = "ensemble",
                  min_weight: float = MIN_ENSEMBLE_WEIGHT) -> DataFrame:
    """Weighted mean of the models' test predictions, weights per fold from R^2 on the fold's training rows."""
    r2 = train_r2(preds, folds)
    per = Window.partitionBy("fold")  # one row per model
    floor = F.greatest(F.coalesce("r2", F.lit(0.0)), F.lit(0.0))
    total = F.sum(floor).over(per)
    share = F.when(total > 0, floor / total).otherwise(1.0 / F.count("*").over(per))
    weights = materialize(r2.select("fold", "model", F.greatest(F.lit(min_weight), share).alias("weight")))
    test = preds.where(F.col(BLOCK) > 0).withColumn("fold", F.col(BLOCK) - 1)
    # one row per fold and model
    both = test.join(F.broadcast(weights), ["fold", "model"])
    return (both.groupBy("fold", *keys)
            .agg(F.first("actual").alias("actual"), (F.sum(F.col("weight") * F.col("prediction")) / F.sum("weight")).alias("prediction"))
            .select("fold", F.lit(name).alias("model"), *keys, "actual", "prediction"))


def baseline_folds(frame: DataFrame, target: str = "sales", group_cols=("store_id",), order_col: str = "date",
                   folds: int = CV_FOLDS) -> DataFrame:
    """(fold, model, keys, actual, prediction) of the stand-in forecasts and their ensemble on every test block."""
    preds = materialize(evaluation.baseline_predictions(frame, target, group_cols, order_col, keep=(BLOCK,)))
    keys = [order_col, *group_cols]
    own = preds.where(F.col(BLOCK) > 0).select((F.col(BLOCK) - 1).alias("fold"), "model", *keys, "actual", "prediction")
    return own.unionByName(fold_ensemble(preds, folds, keys))


Learner = Callable[[DataFrame], object]


def learned_folds(frame: DataFrame, target: str = "sales", learners: dict[str, Learner] | None = None, keys=("date", "store_id"),
                  folds: int = CV_FOLDS) -> DataFrame:
    """(fold, model, keys, actual, prediction) of models fitted anew for every fold on its training rows.

    A learner maps a training frame (features, label ``target``) to a fitted model.  Codes and scales are
    fitted on the training rows of the fold too.  Rows without a target are left out; a fold without rows to
    train on or to test is skipped.  Predictions are written fold by fold.
    """
    learners = learners or {"random_forest": lambda train: fit_forest(train, target)}
    frame = frame.where(F.col(target).isNotNull())
    parts = []
    for fold in range(folds):
        train, test = frame.where(F.col(BLOCK) <= fold), frame.where(F.col(BLOCK) == fold + 1)
        if not train.limit(1).count() or not test.limit(1).count():
            continue
        prepared = Preprocessor.fit(train, target, exclude=("date", "split", "row_index", BLOCK))
        matrix = materialize(prepared.apply(train).select(FEATURES, target))
        rows = prepared.apply(test).select(*keys, F.col(target).alias("actual"), FEATURES)
        for name, fit in learners.items():
            done = fit(matrix).transform(rows)
            parts.append(materialize(done.select(F.lit(fold).alias("fold"), F.lit(name).alias("model"), *keys, "actual", "prediction")))
    if not parts:
        return frame.select(F.lit(0).alias("fold"), F.lit("").alias("model"), *keys, F.col(target).alias("actual"),
                            F.lit(0.0).alias("prediction")).limit(0)
    return reduce(DataFrame.unionByName, parts)


def fold_scores(preds: DataFrame) -> DataFrame:
    """(fold, model, metric, value, n): the metrics of every fold and model."""
    wide = metrics.model_metrics(preds, by=("fold", "model"))
    return wide.unpivot(["fold", "model", "n"], list(METRICS), "metric", "value").select("fold", "model", "metric", "value", "n")


def score_summary(scores: DataFrame) -> DataFrame:
    """(model, metric, mean, std, folds) over the folds."""
    return scores.groupBy("model", "metric").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                                                 F.count("value").alias("folds"))
